"""Python code on the workers."""

from __future__ import annotations

import ctypes
import pathlib
import shutil
import sys
import tempfile
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

_SHIPPED: set[str] = set()


def _give_back() -> None:
    """Return freed memory to the system: the process waits for its next task, perhaps of another operator."""
    pa.default_memory_pool().release_unused()
    trim = sys.platform == "linux" and getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def map_batches(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema) -> DataFrame:
    """`mapInArrow` with this package sent to the workers first, as `--py-files` would, once an application."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = pathlib.Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='snapmart-')}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)

    def run_and_release(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    return df.mapInArrow(run_and_release, schema)
