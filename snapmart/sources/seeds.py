"""Region seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapmart.schemas import REGION_SEED, REGION_SEED_ROWS


def read_region_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The seed from a header CSV, or the built-in rows when no path is given."""
    if path is None:
        return spark.createDataFrame(list(REGION_SEED_ROWS), REGION_SEED)
    return spark.read.schema(REGION_SEED).option("header", True).option("enforceSchema", False).csv(path)
