"""What near dedup writes of the shingle sets."""

from __future__ import annotations

from quarry.llm import near_dedup


def test_sets_are_written_once_and_packed(spark, monkeypatch):
    """Full sets lay in the table twice, as numbers and packed, and were exchanged twice."""
    seen, keep = {}, near_dedup.saved

    def watched(df, tag, slim=False):
        if tag == "near-sets":
            seen["columns"], seen["plan"] = df.columns, df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, tag, slim)

    monkeypatch.setattr(near_dedup, "saved", watched)
    base = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-1], "x"])), (3, " ".join(base)), (3, " ".join(base)), (4, "other words that stand on their own here"), (None, " ".join([*base, "y"])), (6, None)]
    out = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).collect()
    assert seen["columns"] == ["node", "shingles"] and "Aggregate [print" in seen["plan"]
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in out if r["doc_id"] != 6) == [(0, 57, 1, False), (1, 56, 1, True), (2, 56, 1, False), (3, 56, 1, False), (3, 56, 1, False), (4, 4, 4, True)]
