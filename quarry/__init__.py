"""Spark-native batch analytics engine: spherical rasters, splat clouds, gates and provenance."""
