"""Category documents: nested JSON to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.schemas import CATEGORY_FILE

_REGION_FROM_NAME = r"^([A-Z]{2})_category_id(-[0-9]+)?\.json$"


def read_category_documents(spark: SparkSession, raw_dir: str) -> DataFrame:
    """One row per document with its provenance. A malformed document fails the job."""
    name = F.col("_metadata.file_name")
    return (
        spark.read.schema(CATEGORY_FILE)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", "*_category_id*.json")
        .json(raw_dir)
        .filter(name.rlike(_REGION_FROM_NAME))
        .select(
            F.regexp_extract(name, _REGION_FROM_NAME, 1).alias("_source_region"),
            name.alias("_source_file"),
            F.current_timestamp().cast("timestamp_ntz").alias("_loaded_at"),
            "items",
        )
    )


def parse_documents(texts: DataFrame, body: str = "body") -> DataFrame:
    """Documents held as JSON text in a column, parsed with the same schema."""
    others = [c for c in texts.columns if c != body]
    return texts.select(*others, F.from_json(F.col(body), CATEGORY_FILE).getField("items").alias("items"))


def flatten_documents(documents: DataFrame) -> DataFrame:
    """One row per item; a document with an empty or missing list yields no row."""
    provenance = [c for c in documents.columns if c.startswith("_")]
    return documents.select(*provenance, F.explode("items").alias("item")).select(
        *provenance,
        F.col("item.id").alias("category_id"),
        F.col("item.snippet.title").alias("category_title"),
        F.col("item.snippet.channelId").alias("category_channel_id"),
        F.col("item.snippet.assignable").alias("assignable"),
    )
