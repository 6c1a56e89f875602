"""Profile of landed observations and category documents, on the raw text before dedup.

Scalars are grouped aggregates per region. Distinct counts are exact: Spark first reduces to distinct
values, hashed over all tasks, so a region with most of the rows is not one task's work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions import parse_trending_date, profile_boolean, profile_integer, profile_publish_time
from snapmart.operators.relational import first_n_per_group
from snapmart.schemas import FLAGS, MEASURES, OBSERVATION_HEADER

REGION = "_source_region"

# Sizes of the example lists.
MISSING_CATEGORY_SAMPLE = 25
PUBLISH_EXAMPLES = 5
TAG_SAMPLES = 8
TAG_SAMPLE_CHARS = 60
ID_SAMPLE = 5


def _blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def _present(column: str) -> Column:
    """The value, or NULL for blank text."""
    return F.when(F.col(column) != "", F.col(column))


def _parsed(column: str) -> Column:
    raw = F.col(column)
    if column == "trending_date":
        return parse_trending_date(raw)
    if column == "publish_time":
        return profile_publish_time(raw)
    return profile_boolean(raw) if column in FLAGS else profile_integer(raw)


def counts(landed: DataFrame) -> DataFrame:
    """Rows, distinct item ids, distinct raw and parseable dates; blanks are not counted as values."""
    return landed.groupBy(F.col(REGION).alias("region_code")).agg(
        F.count("*").alias("n_rows"),
        F.countDistinct(_present("video_id")).alias("distinct_video_id"),
        F.countDistinct(_present("trending_date")).alias("distinct_trending_date_raw"),
        F.countDistinct(parse_trending_date(F.col("trending_date"))).alias("distinct_trending_date_parsed"),
    )


def date_range(landed: DataFrame) -> DataFrame:
    """First and last date in calendar order, and the raw texts that sort first and last among valid ones.

    Texts have no hash-aggregate minimum, so the distinct ones are found first and few rows are sorted.
    """
    texts = landed.select(F.col(REGION).alias("region_code"), "trending_date").distinct()
    parsed = parse_trending_date(F.col("trending_date"))
    valid_text = F.when(parsed.isNotNull(), F.col("trending_date"))
    return texts.groupBy("region_code").agg(
        F.min(parsed).alias("min_trending_date"),
        F.max(parsed).alias("max_trending_date"),
        F.min(valid_text).alias("min_trending_date_text"),
        F.max(valid_text).alias("max_trending_date_text"),
    )


def _key_tally(landed: DataFrame) -> DataFrame:
    """Per region: rows, rows beyond the first per grain key, and beyond the first per fully equal row.

    A row travels as the SHA-256 of its unambiguous JSON text instead of all its columns. Rows are
    counted per key and fingerprint first, so a key with very many copies collapses before the shuffle.
    """
    fingerprint = F.sha2(F.to_json(F.struct(*[_present(c).alias(c) for c in OBSERVATION_HEADER])), 256)
    key = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("video_id", "trending_date")]
    distinct_rows = (
        landed.select(F.col(REGION).alias("region_code"), *key, fingerprint.alias("_row"))
        .groupBy("region_code", "video_id", "trending_date", "_row")
        .agg(F.count("*").alias("_copies"))
    )
    per_key = distinct_rows.groupBy("region_code", "video_id", "trending_date").agg(
        F.sum("_copies").alias("_rows"), F.count("*").alias("_distinct_rows")
    )
    return per_key.groupBy("region_code").agg(
        F.sum("_rows").alias("n_rows"),
        F.sum(F.col("_rows") - 1).alias("duplicate_grain_keys"),
        F.sum(F.col("_rows") - F.col("_distinct_rows")).alias("exact_duplicate_rows"),
    )


def duplicates(landed: DataFrame) -> DataFrame:
    """Duplicate grain keys and exactly equal rows per region (blank and NULL are the same field)."""
    return _key_tally(landed).drop("n_rows")


def region_scalars(landed: DataFrame) -> DataFrame:
    """Every per-region scalar that needs no distinct step, in one scan; the tables below are projections of it.

    Catalyst prunes what a projection does not use, so one table alone costs only its own columns.
    """
    typed = ("trending_date", "publish_time", *MEASURES, *FLAGS)
    numbers = {m: profile_integer(F.col(m)) for m in MEASURES}
    late = profile_publish_time(F.col("publish_time")) > parse_trending_date(F.col("trending_date")).cast("timestamp_ntz")
    return landed.groupBy(F.col(REGION).alias("region_code")).agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(_blank(c)).alias(f"blank_{c}") for c in OBSERVATION_HEADER],
        *[F.count_if((F.col(c) != "") & _parsed(c).isNull()).alias(f"failed_{c}") for c in typed],
        *[F.min(n).alias(f"min_{m}") for m, n in numbers.items()],
        *[F.max(n).alias(f"max_{m}") for m, n in numbers.items()],
        *[F.count_if(n < 0).alias(f"negative_{m}") for m, n in numbers.items()],
        F.count_if(late).alias("publish_after_trending"),
        *[F.count_if(profile_boolean(F.col(f))).alias(f"true_{f}") for f in FLAGS],
    )


def _long(scalars: DataFrame, names: Sequence[str], label: str, **fields: str) -> DataFrame:
    """One row per region and name, with the named scalars of each."""
    entry = F.explode(
        F.array(*[F.struct(F.lit(n).alias(label), *[F.col(f"{prefix}_{n}").alias(f) for f, prefix in fields.items()]) for n in names])
    )
    return scalars.select("region_code", "n_rows", entry.alias("_e")).select("region_code", "n_rows", "_e.*")


def blanks_of(scalars: DataFrame) -> DataFrame:
    long = _long(scalars, OBSERVATION_HEADER, "column_name", n_blank="blank")
    percent = (F.lit(100.0) * F.col("n_blank") / F.col("n_rows")).alias("pct_blank")
    return long.select("region_code", "column_name", "n_blank", percent)


def parse_failures_of(scalars: DataFrame) -> DataFrame:
    columns = ("trending_date", "publish_time", *MEASURES, *FLAGS)
    return _long(scalars, columns, "column_name", n_failures="failed").drop("n_rows")


def numeric_ranges_of(scalars: DataFrame) -> DataFrame:
    long = _long(scalars, MEASURES, "measure", min_value="min", max_value="max", n_negative="negative")
    return long.rollup("measure", "region_code").agg(
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum("n_negative").alias("n_negative"),
    ).filter(F.col("measure").isNotNull()).select("region_code", "measure", "min_value", "max_value", "n_negative")


def flag_totals_of(scalars: DataFrame) -> DataFrame:
    long = _long(scalars, FLAGS, "flag", n_true="true")
    return long.select("region_code", "flag", "n_true", (F.col("n_rows") - F.col("n_true")).alias("n_not_true"))


def blanks(landed: DataFrame) -> DataFrame:
    """NULL or blank count and percentage per region and column."""
    return blanks_of(region_scalars(landed))


def parse_failures(landed: DataFrame) -> DataFrame:
    """Non-blank values that do not parse, per region and typed column."""
    return parse_failures_of(region_scalars(landed))


def numeric_ranges(landed: DataFrame) -> DataFrame:
    """Minimum, maximum and negative count per region and measure, and overall (region NULL)."""
    return numeric_ranges_of(region_scalars(landed))


def unexpected_booleans(landed: DataFrame) -> DataFrame:
    """Spellings outside the profiler's boolean grammar with their frequency over the three flags.

    Rows are counted per combination of the flags before each is spread over three rows.
    """
    combined = landed.groupBy(F.col(REGION).alias("region_code"), *FLAGS).agg(F.count("*").alias("_n"))
    long = combined.unpivot(["region_code", "_n"], list(FLAGS), "flag", "raw_value")
    odd = (F.col("raw_value") != "") & profile_boolean(F.col("raw_value")).isNull()
    return long.filter(odd).groupBy("region_code", "raw_value").agg(F.sum("_n").alias("n_rows"))


def _seen_categories(landed: DataFrame) -> DataFrame:
    return (
        landed.filter(F.col("category_id") != "").select(F.col(REGION).alias("region_code"), "category_id").distinct()
    )


def category_coverage(landed: DataFrame, categories: DataFrame) -> DataFrame:
    """Per region: ids seen, ids without a category row, and the first of those in sorted order."""
    seen = _seen_categories(landed)
    known = categories.select("region_code", "category_id").distinct().withColumn("_known", F.lit(True))
    matched = seen.join(known, ["region_code", "category_id"], "left")
    missing = F.col("_known").isNull()
    totals = matched.groupBy("region_code").agg(
        F.count("*").alias("category_ids_seen"), F.count_if(missing).alias("category_ids_no_match")
    )
    first = first_n_per_group(
        matched.filter(missing), ["region_code"], [F.col("category_id")], MISSING_CATEGORY_SAMPLE, "_rank"
    )
    sample = first.groupBy("region_code").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "region_code", "category_id"))), ", ").alias(
            "no_match_sample"
        )
    )
    return totals.join(sample, "region_code", "left")


def _with_late_publish(landed: DataFrame) -> tuple[DataFrame, Column]:
    """Raw texts and the test for a publish timestamp after midnight of the trending date (no tolerance)."""
    late = profile_publish_time(F.col("publish_time")) > parse_trending_date(F.col("trending_date")).cast(
        "timestamp_ntz"
    )
    return landed.select(F.col(REGION).alias("region_code"), "video_id", "publish_time", "trending_date"), late


def publish_after_trending(landed: DataFrame) -> DataFrame:
    """Rows published after midnight of their trending date, per region."""
    return region_scalars(landed).select("region_code", "publish_after_trending")


def publish_after_examples(landed: DataFrame) -> DataFrame:
    """The first few offending rows per region, by item, date and publish text."""
    rows, late = _with_late_publish(landed)
    order = [F.col(c) for c in ("video_id", "trending_date", "publish_time")]
    return first_n_per_group(rows.filter(late), ["region_code"], order, PUBLISH_EXAMPLES, "example")


def flag_totals(landed: DataFrame) -> DataFrame:
    """True and other rows per region and flag; an unexpected spelling is not true."""
    return flag_totals_of(region_scalars(landed))


def _variants(landed: DataFrame, label: Column) -> DataFrame:
    """Distinct labels per region and item; (region, item, label) is reduced first, so no item is hot."""
    return (
        landed.filter(F.col("video_id") != "")
        .select(F.col(REGION).alias("region_code"), "video_id", label.alias("_label"))
        .filter(F.col("_label").isNotNull())
        .distinct()
        .groupBy("region_code", "video_id")
        .agg(F.count("*").alias("n_labels"))
    )


def title_changes(landed: DataFrame) -> DataFrame:
    """Items with more than one title, and title changes (titles beyond the first). A blank title counts."""
    n = F.col("n_labels")
    return (
        _variants(landed, F.coalesce(F.col("title"), F.lit("")))
        .groupBy("region_code")
        .agg(F.count_if(n > 1).alias("videos_with_multiple_titles"), F.sum(n - 1).alias("title_change_count"))
    )


def channel_changes(landed: DataFrame) -> DataFrame:
    """Items with more than one channel label; blank labels are skipped."""
    labelled = _variants(landed, _present("channel_title"))
    return labelled.groupBy("region_code").agg(
        F.count_if(F.col("n_labels") > 1).alias("videos_with_multiple_channels")
    )


def tag_samples(landed: DataFrame) -> DataFrame:
    """The first distinct tag-text beginnings per region, in sorted order."""
    beginnings = (
        landed.filter(F.col("tags") != "")
        .select(F.col(REGION).alias("region_code"), F.substring("tags", 1, TAG_SAMPLE_CHARS).alias("tag_sample"))
        .distinct()
    )
    return first_n_per_group(beginnings, ["region_code"], [F.col("tag_sample")], TAG_SAMPLES, "example")


def category_documents(documents: DataFrame) -> DataFrame:
    """Per region: items, ids and titles used more than once, missing titles, assignable tally, first ids.

    Ids and titles are counted in a grouped step, so no list of a region's items is built. A missing
    title counts as one more title when looking for repeats.
    """
    items = documents.select(
        F.col(REGION).alias("region_code"), "_source_file", F.posexplode("items").alias("_pos", "item")
    ).select(
        "region_code",
        "_source_file",
        "_pos",
        F.col("item.id").alias("id"),
        F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.assignable").alias("assignable"),
    )
    flag = F.col("assignable")
    tally = items.groupBy("region_code").agg(
        F.count("*").alias("item_count"),
        F.count_if(F.col("title").isNull() | (F.col("title") == "")).alias("null_titles"),
        F.count_if(flag).alias("assignable_true"),
        F.count_if(~flag).alias("assignable_false"),
        F.count_if(flag.isNull()).alias("assignable_null"),
    )

    # an id and a title per item, counted together
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("id", "title")]))
    uses = items.select("region_code", kinds.alias("_use")).groupBy("region_code", "_use").agg(F.count("*").alias("_n"))
    repeated = uses.filter(F.col("_n") > 1).groupBy("region_code").agg(
        F.count_if(F.col("_use.kind") == "id").alias("duplicate_ids"),
        F.count_if(F.col("_use.kind") == "title").alias("duplicate_titles"),
    )
    first = first_n_per_group(items, ["region_code"], [F.col("_source_file"), F.col("_pos")], ID_SAMPLE, "_rank")
    sample = first.groupBy("region_code").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_rank", "id"))), lambda s: s["id"]), ", "
        ).alias("ids_sample")
    )
    joined = tally.join(repeated, "region_code", "left").join(sample, "region_code", "left")
    return joined.fillna(0, ["duplicate_ids", "duplicate_titles"])


def _per_item(landed: DataFrame) -> DataFrame:
    """Rows and distinct regions per item id, reduced per region first."""
    return (
        landed.filter(F.col("video_id") != "")
        .groupBy("video_id", REGION)
        .agg(F.count("*").alias("_n"))
        .groupBy("video_id")
        .agg(F.sum("_n").alias("n_rows"), F.count(REGION).alias("n_regions"))
    )


def cross_region(landed: DataFrame) -> DataFrame:
    """Ids on more than one row, ids in more than one region, and the id on most rows (smallest id on ties)."""
    per_item = _per_item(landed)
    n_rows, n_regions = F.col("n_rows"), F.col("n_regions")
    return per_item.agg(
        F.count_if(n_rows > 1).alias("ids_on_many_rows"),
        F.count_if(n_regions > 1).alias("ids_in_many_regions"),
        F.min(F.struct((-n_rows).alias("neg_rows"), "video_id", "n_regions")).alias("_top"),
    ).select(
        "ids_on_many_rows",
        "ids_in_many_regions",
        F.col("_top.video_id").alias("top_video_id"),
        (-F.col("_top.neg_rows")).alias("top_n_rows"),
        F.col("_top.n_regions").alias("top_n_regions"),
    )


def totals_of(tally: DataFrame) -> DataFrame:
    return tally.agg(
        F.count("*").alias("csv_count"),
        F.sum("n_rows").alias("total_rows"),
        F.sum(F.col("n_rows") - F.col("duplicate_grain_keys")).alias("total_distinct_keys"),
        F.sum("duplicate_grain_keys").alias("total_dup_keys"),
        F.sum("exact_duplicate_rows").alias("total_exact_dup"),
    )


def totals(landed: DataFrame) -> DataFrame:
    """Grand totals over the regions."""
    return totals_of(_key_tally(landed))


def full_profile(landed: DataFrame, categories: DataFrame, documents: DataFrame) -> dict[str, DataFrame]:
    """Every profile table by name. Scalars and key tally, one row a region each, are computed once for all tables."""
    scalars, tally = region_scalars(landed).persist(), _key_tally(landed).persist()
    return {
        "counts": counts(landed),
        "date_range": date_range(landed),
        "duplicates": tally.drop("n_rows"),
        "blanks": blanks_of(scalars),
        "parse_failures": parse_failures_of(scalars),
        "numeric_ranges": numeric_ranges_of(scalars),
        "unexpected_booleans": unexpected_booleans(landed),
        "category_coverage": category_coverage(landed, categories),
        "publish_after_trending": scalars.select("region_code", "publish_after_trending"),
        "publish_after_examples": publish_after_examples(landed),
        "flag_totals": flag_totals_of(scalars),
        "title_changes": title_changes(landed),
        "channel_changes": channel_changes(landed),
        "tag_samples": tag_samples(landed),
        "category_documents": category_documents(documents),
        "cross_region": cross_region(landed),
        "totals": totals_of(tally),
    }
