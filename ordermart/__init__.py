"""ordermart: a Spark-native order-level analytics mart (DataFrame API, Catalyst-planned)."""

from ordermart.config import OUTPUT_COLUMNS, RunConfig

__all__ = ["OUTPUT_COLUMNS", "RunConfig"]
