"""What license scans write, and repeated rows."""

from __future__ import annotations

from pathlib import Path

from quarry.llm import license_scan
from quarry.llm.common import shared_dir
from quarry.llm.license_texts import TEMPLATES


def test_files_do_not_grow_with_the_texts_partitions(spark):
    """Each partition of texts wrote a file of candidates with their hashes, right after the scan, when executors are largest."""
    rows = [(i, f"w{i} {TEMPLATES['MIT text']} " * 2) for i in range(64)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, rows[3][1]), (None, rows[3][1]), (7, "another text with the same number"), (8, None)]
    top, files, found = Path(shared_dir(spark).removeprefix("file://")), [], []
    for n in (4, 24):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        before = set(top.rglob("part-*.parquet"))
        found.append(sorted(map(repr, map(tuple, license_scan.license_scan(docs).where("template = 'MIT text'").collect()))))
        files.append(len(set(top.rglob("part-*.parquet")) - before))
    assert files[0] == files[1]
    assert found[0] == found[1] and len(found[0]) == 68
    assert sum(x.startswith("(7,") for x in found[0]) == 3 and sum(x.startswith("(None,") for x in found[0]) == 2
