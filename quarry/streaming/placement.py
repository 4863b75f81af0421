"""Placement of pixels that arrive as a stream: routing and positions need no neighbour, so no state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quarry.functions import geometry as g
from quarry.operators.place import routed

PIXELS = "pano string, r bigint, c bigint, h bigint, w bigint, d double, sky boolean"


def positions(px: DataFrame) -> DataFrame:
    """(pano, r, c, x, y, z) of content pixels, of a stream or a table alike."""
    return g.with_directions(routed(px)).where("content").selectExpr("pano", "r", "c", "dx * d as x", "dy * d as y", "dz * d as z")


def start(spark, source: str, sink: str, checkpoint: str) -> StreamingQuery:
    """Parquet files of pixels in one folder to Parquet files of positions in another, each row once."""
    px = spark.readStream.schema(PIXELS).parquet(source)
    return positions(px).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
