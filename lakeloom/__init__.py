"""lakeloom: warehouse-style analytics as plain PySpark DataFrame code."""

from lakeloom.session import get_spark, scratch_path, tune

__all__ = ["get_spark", "scratch_path", "tune"]
