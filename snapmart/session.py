"""Session settings the jobs rely on. On a cluster the submitter's own settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Semantics: results depend on these, so they are always set.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Plan quality: runtime re-planning, skew splitting, small-partition merging.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even where that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Driver time: no Python call-site capture on every Column call.
DRIVER_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(
    app: str = "snapmart", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """Create (or get) a session. `master` and `extra` are for local runs and tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_CONF, **ADAPTIVE_CONF, **DRIVER_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = 8, extra: dict[str, str] | None = None) -> SparkSession:
    """One-JVM session for tests and the bench."""
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("snapmart-local", f"local[{cores}]", {**conf, **(extra or {})})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# A shuffle partition of this many input bytes sorts within a task's memory with little spill; more than
# the maximum number of partitions costs more in shuffle blocks than it saves.
SHUFFLE_PARTITION_BYTES = 1 << 30
MAX_SHUFFLE_PARTITIONS = 50_000


def shuffle_partitions_for(input_bytes: int, slots: int) -> int:
    """At least one partition per task slot, and enough to keep each near the target size."""
    return min(max(-(-input_bytes // SHUFFLE_PARTITION_BYTES), slots), max(MAX_SHUFFLE_PARTITIONS, slots))


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the session's shuffle partitions to suit the input; a higher setting is left alone.

    AQE merges partitions that turn out small, so erring high is cheap.
    """
    setting = "spark.sql.shuffle.partitions"
    wanted = shuffle_partitions_for(input_bytes, spark.sparkContext.defaultParallelism)
    number = max(wanted, int(spark.conf.get(setting)))
    spark.conf.set(setting, number)
    return number
