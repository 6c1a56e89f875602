"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share of all words, by weight; it stops at `cap` times the source's size, and what is
left over is shared again by weight until no target is above its cap. A document of a source with target t and
size s is wanted t / s times: the whole part are certain copies, the rest p is its chance of one copy more. That
one is drawn by Pareto order sampling: with a random number u per document (from a hash of its id and text, so
that reruns agree), documents are ranked by [u / (1 - u)] / [p / (1 - p)] and the first are taken, as many as
bring the words taken closest to the target. A column of relative wishes per document makes p unequal
within a source.

All steps are DataFrame operations. Words are summed per source and slice of the rank first; only the documents
of the one slice in which the sample ends are put in order, so a source with most of the rows isn't gathered.

Cases: a null source is a source of its own, the last; a null or empty text has size 0 and is never repeated
(taken 0); documents of one source without any words have target 0; repeated rows share one random number and are
ordered arbitrarily among themselves, which leaves the multiset of results unchanged; an empty table gives an
empty result; other columns are kept by `mix` and can't clash with its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapmart.llm.common import WORD, col, shared_folder, staged, text_table

#: Weights of the sources in the order of their names, repeated.
WEIGHTS = (1, 2, 3)
CAP = 3
#: Slices of the rank per source; one of them is put in order.
SLICES = 4096


def n_words(text: Column) -> Column:
    """Number of words; 0 without a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def chance(key: Column, text: Column) -> Column:
    """A number strictly between 0 and 1 for each document, from 52 bits of a hash."""
    mixed = F.md5(F.concat_ws("|", key.cast("string"), F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(mixed, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, size -> with weight and target. One row a source.

    The names are put in order by ranges, and the shared level is found by aggregates, so no task needs all sources.
    """
    spark = sources.sparkSession
    ranked = sources.withColumn("_absent", F.col("source").isNull())
    ranked = ranked.repartitionByRange("_absent", "source").sortWithinPartitions("_absent", "source")
    ranked = staged(ranked.withColumn("_at", F.monotonically_increasing_id()), shared_folder(spark), "sources")
    part = F.shiftright("_at", 33)
    counts = sorted((r["p"], r["n"]) for r in ranked.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())  # one row a partition
    offsets, before = {}, 0
    for p, n in counts:
        offsets[p] = before
        before += n
    at = F.col("_at") - F.shiftleft(part, 33)
    if offsets:
        at = at + F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])[part]
    place = F.pmod(at, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    weighed = ranked.select("source", "size", weight.alias("weight"), (F.col("size") * float(cap)).alias("_cap"))
    totals = weighed.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    all_words, level, seen = float(totals["size"] or 0), 0.0, -1.0
    left, shares = all_words, totals["weight"] or 0.0
    while shares > 0 and level > seen:  # sources at their cap leave; the rest share what remains, until none is above
        seen, level = level, left / shares
        full = weighed.filter(F.col("_cap") <= F.col("weight") * level)
        got = full.agg(F.sum("_cap").alias("cap"), F.sum("weight").alias("weight")).first()
        left, shares = all_words - (got["cap"] or 0.0), totals["weight"] - (got["weight"] or 0.0)
    target = F.least("_cap", F.col("weight") * level)
    return weighed.select("source", "size", "weight", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    cap: float = CAP,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    wish: str | None = None,
) -> DataFrame:
    """For each row of `docs`: doc_id, source, size, source_size, target, copies, and a key of the row's text."""
    names = [doc_id, text, source] + ([wish] if wish else [])
    rows = text_table(docs, *names).select(
        col(doc_id).alias("doc_id"),
        col(source).alias("source"),
        n_words(col(text)).alias("size"),
        chance(col(doc_id), col(text)).alias("u"),
        (col(wish).cast("double") if wish else F.lit(1.0)).alias("wish"),
    )
    rows = staged(rows, shared_folder(docs.sparkSession), "sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("size"), F.sum(F.col("size") * F.col("wish")).alias("wished"))
    sums = staged(sums, shared_folder(docs.sparkSession), "sums")
    targets = source_targets(sums.select("source", "size"), weights, cap).join(
        sums.select(F.col("source").alias("_s"), "wished"), F.col("source").eqNullSafe(F.col("_s"))
    )
    targets = targets.select(F.col("source").alias("_source"), F.col("size").alias("source_size"), "target", "wished")
    wanted = rows.join(targets, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    ratio = F.when((F.col("size") > 0) & (F.col("wished") > 0), F.least(F.lit(float(cap)), F.col("target") * F.col("wish") / F.col("wished")))
    wanted = wanted.withColumn("_ratio", F.coalesce(ratio, F.lit(0.0)))
    wanted = wanted.withColumn("_whole", F.floor("_ratio").cast("long"))
    wanted = wanted.withColumn("_p", F.col("_ratio") - F.col("_whole"))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("_p") / (1 - F.col("_p")))
    wanted = wanted.withColumn("_rank", F.when(F.col("_p") > 0, odds / (1 + odds)))
    wanted = wanted.withColumn("_slice", F.when(F.col("_p") > 0, F.least(F.lit(SLICES - 1), F.floor(F.col("_rank") * SLICES).cast("int"))))

    # words still wanted of a source after its whole copies, and the slice in which they are reached
    whole = wanted.groupBy("source").agg(F.sum(F.col("_whole") * F.col("size")).alias("certain"), F.max("target").alias("target"))
    need = whole.select(F.col("source").alias("_n"), (F.col("target") - F.col("certain")).alias("_need"))
    slices = wanted.filter(F.col("_slice").isNotNull()).groupBy("source", "_slice").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    ends = slices.join(need, F.col("source").eqNullSafe(F.col("_n")))
    ends = ends.filter((F.col("_before") <= F.col("_need")) & (F.col("_before") + F.col("words") > F.col("_need")))
    ends = ends.select(F.col("source").alias("_e"), F.col("_slice").alias("_end"), "_before", "_need")
    ends = staged(ends, shared_folder(docs.sparkSession), "ends")

    # a source without such a slice takes every document once more: its words don't pass the need
    placed = wanted.join(ends, F.col("source").eqNullSafe(F.col("_e")), "left")
    inner = placed.filter(F.col("_slice") == F.col("_end"))
    order = Window.partitionBy("source").orderBy("_rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    upto_here = F.col("_before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    # taken if the words up to its middle don't pass the need: this ends closest to it
    inner = inner.withColumn("_more", (upto_here + F.col("size") / 2 <= F.col("_need")).cast("long"))
    rest = placed.filter(F.col("_end").isNull() | F.col("_slice").isNull() | (F.col("_slice") != F.col("_end")))
    more = F.when(F.col("_slice").isNull(), 0).when(F.col("_end").isNull(), 1).when(F.col("_slice") < F.col("_end"), 1).otherwise(0)
    rest = rest.withColumn("_more", more.cast("long"))
    both = inner.select(*rest.columns).unionByName(rest)
    return both.select("doc_id", "source", "size", "source_size", "target", (F.col("_whole") + F.col("_more")).alias("copies"), "u")
