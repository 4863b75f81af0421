"""Every query of the engine by name, with SQL for DuckDB where SQL can express it."""

from __future__ import annotations

from quarry.plans import queries_more, queries_raster, queries_runs, queries_splats

QUERIES = queries_raster.QUERIES | queries_splats.QUERIES | queries_runs.QUERIES | queries_more.QUERIES
ORACLES = queries_raster.ORACLES | queries_splats.ORACLES | queries_runs.ORACLES | queries_more.ORACLES
