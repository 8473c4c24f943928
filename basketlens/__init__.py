"""Shop-session analytics on Spark: events -> sessions -> funnels, models, stream scoring."""

from basketlens.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
