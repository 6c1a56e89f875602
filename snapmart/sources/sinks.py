"""Table and report writers. Every write replaces what it names, so a rerun never adds rows twice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def location_of(spark: SparkSession, database: str) -> str:
    return spark.sql(f"DESCRIBE DATABASE EXTENDED {database}").filter("info_name = 'Location'").first()[1]


def use_warehouse(spark: SparkSession, warehouse: str | None) -> None:
    """Write tables below `warehouse` from now on; None leaves the session's setting.

    On a cluster a warehouse on the driver's disk is refused: other machines would not see it.
    """
    if warehouse:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS snapmart LOCATION '{warehouse}'")
        spark.catalog.setCurrentDatabase("snapmart")
    place = location_of(spark, spark.catalog.currentDatabase())
    if place.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"tables would go to {place}; give a warehouse that all machines share")


def write_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a Parquet table and return it as read back.

    Rows are written where they are: no shuffle gathers a partition value, so a region with most of
    the rows is written by all tasks.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Replace a Parquet table dealt into `buckets` by `keys`, one sorted file a bucket, and return it as read back.

    Aggregates by these keys, and joins by them with a table of as many buckets, need no shuffle. All rows of a key lie in
    one bucket, so it suits keys with few rows each, such as items, which have a row a date after dedup.
    """
    writer = df.repartition(buckets, *keys).sortWithinPartitions(*keys).write.mode("overwrite").format("parquet")
    writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def write_json_report(df: DataFrame, path: str) -> None:
    """Structured report as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_json_reports(reports: Mapping[str, DataFrame], path: str) -> None:
    """A set of report tables, such as the profile, each as JSON lines under its own name."""
    for name, df in reports.items():
        write_json_report(df, f"{path}/{name}")


def load_summary(landed: DataFrame) -> DataFrame:
    """Rows per region and, with a NULL region, in total."""
    per_region = landed.groupBy("_source_region").agg(F.count("*").alias("_n"))
    return per_region.rollup("_source_region").agg(F.sum("_n").alias("n_rows"))


def load_report(landed: DataFrame) -> DataFrame:
    """Per file: landed rows, and how many of them are over-long, short or unclosed."""
    return landed.groupBy("_source_region", "_source_file").agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col("_parse_status") == c).alias(f"n_{c}") for c in ("truncated", "short", "unclosed")],
    )
