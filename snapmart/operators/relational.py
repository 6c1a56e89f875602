"""Generic relational operators, each written so that a key holding a large share of the rows stays cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

# A reference side is broadcast only after a count proves it has at most this many rows.
BROADCAST_ROW_LIMIT = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Mark `df` for broadcast if a bounded count proves it small, else leave the join to AQE.

    The count stops at `max_rows + 1` rows. Above the bound the join is an ordinary shuffle join, in
    which AQE splits skewed partitions. For narrow reference data only (ids, titles, keys). Call it
    once, where the reference table is made: the hint survives the selects the models apply.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key: the greatest by `order` (descending, NULLs last).

    `row_number() = 1` lets Spark keep one row per key inside each map task before the shuffle
    (WindowGroupLimit), so many copies of one key never meet in one task. For a result that does not
    depend on row order, `order` must be total over the rows of a key.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


#: Bits of the filter of keys that repeat: 2048 bitmaps of 4 KB, whatever the number of keys.
REPEATED_BITS = 1 << 26


def latest_of_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[str], bits: int = REPEATED_BITS) -> DataFrame:
    """`latest_per_key` that shuffles and sorts only rows whose key may repeat; all others stay where they are.

    A first pass counts 64-bit hashes of the keys, 16 bytes a row, and enters the hashes seen more than once in a
    bitmap of a fixed size. It is broadcast (8 MB at most), and rows that miss it have a key of their own. A row that
    hits it by chance is sorted with the others, which changes no result; the more keys repeat, the more rows are
    sorted, up to all. `df` is read twice, so it should be a table; a key with many copies leaves one row a map task.
    """
    marked = _marked(df, keys, bits)
    alone = marked.filter(~F.col("_hit")).select(*df.columns)
    return alone.unionByName(latest_per_key(marked.filter("_hit").select(*df.columns), keys, order))


def _marked(df: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """The rows with `_hit`: whether the bitmap of keys seen more than once has their key."""
    place = F.pmod(F.xxhash64(*keys), F.lit(bits))
    number, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    repeated = df.select(F.xxhash64(*keys).alias("_h")).groupBy("_h").agg(F.count("*").alias("_n")).filter("_n > 1")
    at = F.pmod("_h", F.lit(bits))
    bitmap = repeated.groupBy(F.bitmap_bucket_number(at).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bitmap"))
    # a byte of the bitmap as a number
    byte = F.conv(F.hex(F.substring("_bitmap", (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    hit = F.col("_bitmap").isNotNull() & (F.getbit(byte, (bit % 8).cast("int")) == 1)
    return df.withColumn("_bucket", number).join(F.broadcast(bitmap), "_bucket", "left").withColumn("_hit", F.coalesce(hit, F.lit(False)))


def first_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank_name: str
) -> DataFrame:
    """The first `n` rows per group with their rank; only n rows per group and map task are shuffled."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(window)).filter(F.col(rank_name) <= n)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "n_rows") -> DataFrame:
    """Keys on more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_name)).filter(F.col(count_name) > 1)


def duplicate_keys_of_table(df: DataFrame, keys: Sequence[str], count_name: str = "n_rows", bits: int = REPEATED_BITS) -> DataFrame:
    """`duplicate_keys` that shuffles only keys that may repeat, and a 64-bit hash of all others; `df` is read twice, as by `latest_of_repeated`."""
    return duplicate_keys(_marked(df.select(*keys), keys, bits).filter("_hit"), keys, count_name)


def orphans(df: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a partner in `reference`. Rows with a NULL key have none, so they are kept."""
    return df.join(reference.select(*keys), list(keys), "left_anti")


def dangling_keys(df: DataFrame, foreign_key: str, reference: DataFrame, key: str) -> DataFrame:
    """Non-NULL foreign key values absent from the reference, with row counts.

    Rows are counted per value before the join, so a value on many rows is one row in the shuffle.
    """
    values = df.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count("*").alias("n_rows"))
    return values.join(reference.select(F.col(key).alias(foreign_key)), foreign_key, "left_anti")


def set_difference(expected: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """Every name with its status: missing (only expected), extra (only found) or ok."""
    left = expected.select(name).distinct().withColumn("_expected", F.lit(True))
    right = found.select(name).distinct().withColumn("_found", F.lit(True))
    status = (
        F.when(F.col("_found").isNull(), "missing").when(F.col("_expected").isNull(), "extra").otherwise("ok")
    )
    return left.join(right, name, "full_outer").select(name, status.alias("status"))


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of same-named columns."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
