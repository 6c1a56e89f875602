"""Helpers shared by the operators: the shared work folder, staged tables, safe column selection, word splitting."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.workers import map_batches

__all__ = ["WORD", "Memo", "chunks", "col", "drop_staged", "map_batches", "noted_folders", "release_folders", "release_tables", "shared_folder", "staged", "text_table", "with_text", "worker_table"]

#: A word, in Spark's and Java's spelling: anything between ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


def col(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_table(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads, so that other columns of a table can't clash with its own."""
    return df.select(*[col(n) for n in names])


def with_text(df: DataFrame, keep: Iterable[str], text: str) -> DataFrame:
    """The columns `keep`, numbered, and the text, so that neither names nor a text kept twice can clash."""
    return df.select(*[col(n).alias(f"_{k}") for k, n in enumerate(keep)], col(text).alias("_text"))


_NOTED: list[list[str]] = []


@contextmanager
def noted_folders() -> Iterator[list[str]]:
    """A list of the folders that `shared_folder` makes within."""
    _NOTED.append([])
    try:
        yield _NOTED[-1]
    finally:
        _NOTED.pop()


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below `spark.checkpoint.dir`.

    Only where that is unset, as in tests on one machine, a temporary folder is set instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="snapmart-")
        spark.conf.set("spark.checkpoint.dir", root)
    folder = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    if _NOTED:
        _NOTED[-1].append(folder)
    return folder


def release_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete these folders of intermediate tables, and empty the list. Only for when what rests on them has been written."""
    while folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folders.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Whether Spark deletes the shuffle files of a query when the query ends.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: it cuts lineage and outlives lost executors.

    What was shuffled for it goes when it is written; while it is being written, lost shuffle files are made anew as ever.
    """
    spark, path = df.sparkSession, f"{folder}/{name}"
    before = spark.conf.get(_SHUFFLES_GO, "false")
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, folder: str, *patterns: str) -> None:
    """Delete the staged tables whose names match. Only when no table that is still to be computed rests on them."""
    for pattern in patterns:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in files.globStatus(path) or ():
            files.delete(status.getPath(), True)


_TABLES: dict[tuple, object] = {}


def worker_table(owner: str, key, make: Callable):
    """A table that a worker process keeps between tasks: `make()`, once for each `key` of an operator.

    Worker processes are used again by later operators, so only one operator's tables are held: those of any
    other owner go when a new one asks, and with them the memory of stages that are done.
    """
    if (owner, key) not in _TABLES:
        others = [k for k in _TABLES if k[0] != owner]
        for held in others:
            del _TABLES[held]
        if others:
            gc.collect()  # a table and its memory of words refer to each other
        _TABLES[owner, key] = make()
    return _TABLES[owner, key]


def release_tables() -> None:
    """Drop the tables that this worker process keeps, at the start of an operator that has none of its own."""
    if _TABLES:
        _TABLES.clear()
        gc.collect()  # as above


class Memo(dict):
    """Results of a pure function of short strings, in bounded memory.

    Two generations: when the young one is full it becomes the old one, whose entries are still found and
    taken over, so that frequent keys stay. Keys longer than `longest` are computed each time.
    """

    def __init__(self, compute: Callable, most: int, longest: int = 64):
        super().__init__()
        self._compute, self._most, self._longest, self._old = compute, most, longest, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
            if len(key) > self._longest:
                return value
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self._most:
            self._old = dict(self)
            self.clear()
        self[key] = value

    def known(self, key) -> bool:
        return key in self or key in self._old


def chunks(rows: Iterable, size: int):
    """Lists of at most `size` rows."""
    rows = iter(rows)
    while chunk := list(islice(rows, size)):
        yield chunk
