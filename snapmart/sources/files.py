"""Raw files as rows, for the landing audit, and tables kept in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, raw_dir: str, pattern: str) -> DataFrame:
    """Name and size of each matching file. File contents are not read."""
    return _files(spark, raw_dir, pattern).select(_file_name(), F.col("length").alias("size_bytes"))


def read_files(spark: SparkSession, raw_dir: str, pattern: str, max_bytes: int) -> DataFrame:
    """Name and content of each matching file up to `max_bytes`; larger files are skipped unread."""
    small = _files(spark, raw_dir, pattern).filter(F.col("length") <= max_bytes)
    return small.select(_file_name(), "content")


def _files(spark: SparkSession, raw_dir: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(raw_dir)


def _file_name():
    return F.element_at(F.split("path", "/"), -1).alias("file")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Only where that is unset and Spark runs on one machine, a temporary folder is set instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="snapmart-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Whether Spark deletes the shuffle files of a query when the query ends.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows, computed once and kept below the shared folder, so that several plans can read them.

    They are kept as compressed Parquet, of which a plan reads the columns it uses; what was shuffled for them goes
    when they are written.
    """
    spark = df.sparkSession
    folder = folder or f"{shared_root(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_SHUFFLES_GO, "false")
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(_SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(folder)


# Rows are kept in a part for each of this many input bytes. Each part reads the input again, and what all parts hold
# together stays, so more than the maximum number of parts costs more time than it saves disk.
PART_BYTES = 256 << 20
MOST_PARTS = 8


def parts_for(spark: SparkSession, path: str) -> int:
    """Into how many parts the rows of the files there are kept. File contents are not read."""
    size = _files(spark, path, "*").agg(F.sum("length")).first()[0] or 0
    return min(max(-(-size // PART_BYTES), 1), MOST_PARTS)


class Kept:
    """Models that are kept as by `settled` while a query needs them; at the end of the context all of them go.

    Models of many rows are kept in parts by a key: only one part's shuffle files are there at a time, and a part goes when the part
    made of it is kept. So the disk has one model of the rows, and a part of the next, at a time.
    """

    def __init__(self, spark: SparkSession, parts: int = 1):
        self._spark, self._parts = spark, parts
        self._root = f"{shared_root(spark)}/{uuid.uuid4().hex}"

    def __enter__(self) -> Kept:
        return self

    def __exit__(self, *failure) -> None:
        self._delete(self._root)

    def table(self, name: str, df: DataFrame) -> DataFrame:
        return settled(df, self._folder(name))

    def split(self, name: str, df: DataFrame, key: str) -> DataFrame:
        """The rows in parts; all rows of a key are in one of them. Each task's rows are sorted by it, as what repeats then takes little room."""
        part = F.pmod(F.xxhash64(key), F.lit(self._parts))
        parts = (df.filter(part == k) if self._parts > 1 else df for k in range(self._parts))
        return self._whole(name, (rows.sortWithinPartitions(key) for rows in parts))

    def made(self, source: str, rows: DataFrame, name: str, model: Callable[[DataFrame], DataFrame], last: bool = False) -> DataFrame:
        """What `model` makes of the `rows` that are kept as `source`, part by part; it must need no rows of another key.

        With `last` each part of the source goes once the part made of it is kept, so nothing may read the source afterwards.
        """

        def parts() -> Iterator[DataFrame]:
            for k in range(self._parts):
                yield model(self._spark.read.schema(rows.schema).parquet(self._folder(source, k)))
                if last:  # what was made of the part is kept by now
                    self._delete(self._folder(source, k))

        return self._whole(name, parts())

    def drop(self, name: str) -> None:
        """Delete a model. Only when no plan that is still to run reads it."""
        self._delete(self._folder(name))

    def _whole(self, name: str, parts: Iterator[DataFrame]) -> DataFrame:
        kept = [settled(df, self._folder(name, k)) for k, df in enumerate(parts)]
        return self._spark.read.schema(kept[0].schema).parquet(*[self._folder(name, k) for k in range(self._parts)])

    def _folder(self, name: str, part: int | None = None) -> str:
        return f"{self._root}/{name}" if part is None else f"{self._root}/{name}/{part}"

    def _delete(self, folder: str) -> None:
        path = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
