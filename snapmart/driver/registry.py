"""Registered queries: each runs library operators over the driver's whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import functions as fn
from snapmart.driver import adapter, landing
from snapmart.operators import audit, profile, quality, relational
from snapmart.plans import dimensions, enrich, fact, items, lifecycle, marts, staging
from snapmart.schemas import FLAGS, OBSERVATION_HEADER
from snapmart.sources import categories as category_files
from snapmart.sources import observations as observation_files
from snapmart.sources import sinks
from snapmart.sources.files import Kept, parts_for, settled, shared_root

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def presented(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, doubles to six places: the form both engines print alike."""

    def shown(field: T.StructField) -> F.Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


class Tables:
    """The models over one table directory, built lazily from each other."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def landed(self) -> DataFrame:
        return adapter.landed_observations(self.spark, self.sf_dir)

    def raw(self, name: str) -> DataFrame:
        return adapter.table(self.spark, self.sf_dir, name)

    @cached_property
    def source(self) -> DataFrame:
        return staging.source_observations(self.landed, adapter.REGION_NAMES)

    @cached_property
    def staged(self) -> DataFrame:
        return staging.stg_observations(self.landed, adapter.REGION_NAMES)

    @cached_property
    def undeduplicated(self) -> DataFrame:
        return staging.type_observations(self.source)

    @cached_property
    def categories(self) -> DataFrame:
        # AQE broadcasts it if its bytes allow; unique by construction, so joins to it that nothing uses are dropped
        landed = adapter.landed_categories(self.spark, self.sf_dir)
        categories = staging.stg_categories(landed, adapter.REGION_NAMES)
        keys = ["region_code", "category_id"]
        rest = [c for c in categories.columns if c not in keys]
        unique = categories.groupBy(*keys).agg(F.first(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
        return unique.select(*categories.columns)

    @cached_property
    def part_documents(self) -> DataFrame:
        return category_files.parse_documents(adapter.part_documents(self.spark, self.sf_dir))

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.int_enriched(self.staged, self.categories)

    @cached_property
    def items(self) -> DataFrame:
        return items.item_aggregate(self.staged)

    @cached_property
    def landing(self) -> str:
        """A folder with the landed rows and the category documents as files."""
        return landing.write_landing(self.spark, self.sf_dir)

    @cached_property
    def lifecycle(self) -> DataFrame:
        return lifecycle.int_lifecycle(self.staged)

    @cached_property
    def dim_region(self) -> DataFrame:
        # the region table has five rows by the definition of the data set
        return dimensions.dim_region(F.broadcast(adapter.region_seed(self.spark, self.sf_dir)))

    @cached_property
    def dim_category(self) -> DataFrame:
        return dimensions.dim_category(self.categories)

    @cached_property
    def dim_video(self) -> DataFrame:
        return dimensions.dim_video(self.staged)

    @cached_property
    def fact(self) -> DataFrame:
        return self.fact_of(self.enriched)

    def fact_of(self, enriched: DataFrame) -> DataFrame:
        return fact.fct_daily(enriched, self.dim_region, self.dim_category)


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a function of the tables under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(build(Tables(spark, sf_dir)))

    _QUERIES[build.__name__] = run
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- scans, projections, set operations ---


@query
def scan_project_cast(t: Tables) -> DataFrame:
    return t.source


@query
def star_rename(t: Tables) -> DataFrame:
    return t.staged.select("*", F.col("trending_date").alias("trending_date_text"))


@query
def json_items_flatten(t: Tables) -> DataFrame:
    return category_files.flatten_documents(t.part_documents)


@query
def union_regions(t: Tables) -> DataFrame:
    """One relation per region, united by name."""
    return relational.union_by_name([staging.source_observations(t.landed, (r,)) for r in adapter.REGION_NAMES])


@query
def union_categories(t: Tables) -> DataFrame:
    landed = adapter.landed_categories(t.spark, t.sf_dir)
    return relational.union_by_name([staging.stg_categories(landed, (r,)) for r in adapter.REGION_NAMES])


@query
def set_diff_names(t: Tables) -> DataFrame:
    expected = t.raw("orders").select(F.concat(F.lit("o"), "o_orderkey").alias("name"))
    found = t.raw("lineitem").select(F.concat(F.lit("o"), F.col("l_orderkey") + F.col("l_linenumber")).alias("name"))
    return relational.set_difference(expected, found, "name")


@query
def load_summary(t: Tables) -> DataFrame:
    return sinks.load_summary(t.landed)


# --- scalar functions ---


@query
def safe_divide(t: Tables) -> DataFrame:
    ratio = fn.safe_divide(F.col("comment_count"), F.col("views"))
    return t.source.select("region_code", "video_id", "views", "comment_count", ratio.alias("ratio"))


@query
def normalize_boolean(t: Tables) -> DataFrame:
    return t.source.select(
        "region_code", "video_id", *[fn.normalize_boolean(F.col(f"{f}_raw")).alias(f) for f in FLAGS]
    )


@query
def tags_normalized(t: Tables) -> DataFrame:
    tags = fn.normalize_tags(F.col("tags_raw")).alias("tags_normalized")
    return t.source.select("region_code", "video_id", "tags_raw", tags)


@query
def tag_count(t: Tables) -> DataFrame:
    return t.source.select("region_code", "video_id", "tags_raw", fn.tag_count(F.col("tags_raw")).alias("tag_count"))


@query
def trending_date_parse(t: Tables) -> DataFrame:
    parsed = fn.parse_trending_date(F.col("trending_date")).alias("trending_date_parsed")
    return t.source.select("region_code", "video_id", "trending_date", parsed)


@query
def publish_time_parse(t: Tables) -> DataFrame:
    parsed = fn.parse_publish_time(F.col("publish_time_raw")).alias("publish_time")
    return t.source.select("region_code", "video_id", "publish_time_raw", parsed)


@query
def days_since_publish(t: Tables) -> DataFrame:
    days = fn.days_between(
        fn.parse_publish_time(F.col("publish_time_raw")), fn.parse_trending_date(F.col("trending_date"))
    )
    return t.source.select("region_code", "video_id", "trending_date", days.alias("days_since_publish"))


@query
def surrogate_key(t: Tables) -> DataFrame:
    return t.source.select(
        "region_code",
        "video_id",
        "trending_date",
        "description",
        fn.surrogate_key("region_code").alias("key_1"),
        fn.surrogate_key("region_code", "description").alias("key_2"),
        fn.observation_key().alias("key_3"),
    )


@query
def validity_flag(t: Tables) -> DataFrame:
    flag = fn.has_valid_engagement().alias("has_valid_engagement")
    return t.undeduplicated.select("region_code", "video_id", "views", flag)


@query
def engagement_rates(t: Tables) -> DataFrame:
    rates = [rate.alias(name) for name, rate in fn.engagement_rates().items()]
    return t.source.select("region_code", "video_id", *rates)


# --- windows and joins ---


@query
def dedup_latest(t: Tables) -> DataFrame:
    return staging.deduplicate(t.source)


@query
def dedup_of_table(t: Tables) -> DataFrame:
    """Dedup of written rows: only those whose key may repeat are shuffled."""
    return staging.deduplicate_table(settled(t.source))


@query
def latest_row_pick(t: Tables) -> DataFrame:
    order = ("trending_date_parsed", "_loaded_at", "trending_date")
    return relational.latest_per_key(t.staged, ("region_code", "video_id"), order)


@query
def left_join_category(t: Tables) -> DataFrame:
    return enrich.join_categories(t.source, t.categories).select(
        "region_code", "video_id", "trending_date", "category_id", "category_title", "category_assignable"
    )


@query
def inner_join_lifecycle(t: Tables) -> DataFrame:
    return marts.items_with_lifecycle(t.items)


@query
def inner_join_bucketed(t: Tables) -> DataFrame:
    """The same as an inner join of lifecycle and fact, from tables bucketed by item, without a shuffle."""
    keys, number = ("region_code", "video_id"), int(t.spark.conf.get("spark.sql.shuffle.partitions"))

    def bucketed(df: DataFrame) -> DataFrame:
        name = f"bucketed_{uuid.uuid4().hex}"
        return sinks.write_bucketed(df, name, keys, number, f"{shared_root(t.spark)}/{name}")

    t.staged = settled(t.staged)  # both tables are made of it
    rows = t.fact.select(*keys, "trending_date", "channel_title", "has_valid_engagement", "engagement_rate")
    return marts.joined_items(bucketed(t.lifecycle), bucketed(rows))


@query
def left_join_video(t: Tables) -> DataFrame:
    rows = t.source.select("region_code", "video_id", "trending_date")
    return fact.join_video_keys(rows, t.dim_video).select(*rows.columns, "video_key")


@query
def anti_join_orphans(t: Tables) -> DataFrame:
    rows = t.source.select("region_code", "video_id", "trending_date", "category_id")
    return relational.orphans(rows, t.categories, ["region_code", "category_id"])


@query
def relationships_violations(t: Tables) -> DataFrame:
    return relational.dangling_keys(t.source, "category_id", t.categories.filter("assignable"), "category_id")


# --- models ---


@query
def stg_observations(t: Tables) -> DataFrame:
    return t.staged


@query
def stg_categories(t: Tables) -> DataFrame:
    return t.categories


@query
def int_enriched(t: Tables) -> DataFrame:
    return t.enriched


@query
def int_lifecycle(t: Tables) -> DataFrame:
    return t.lifecycle


@query
def dim_region(t: Tables) -> DataFrame:
    return t.dim_region


@query
def dim_category(t: Tables) -> DataFrame:
    return t.dim_category


@query
def dim_video(t: Tables) -> DataFrame:
    return t.dim_video


@query
def fct_daily(t: Tables) -> DataFrame:
    return t.fact


@query
def mart_video_lifecycle(t: Tables) -> DataFrame:
    return marts.mart_video_lifecycle(t.lifecycle)


@query
def mart_channel_performance(t: Tables) -> DataFrame:
    return marts.mart_channel_performance(t.items)


@query
def mart_category_performance(t: Tables) -> DataFrame:
    return marts.mart_category_performance(t.fact, t.dim_category)


@query
def mart_regional_trending(t: Tables) -> DataFrame:
    return marts.mart_regional_trending(t.fact)


# --- data quality; where the models leave nothing to find, violations are seeded ---


@query
def dq_not_null(t: Tables) -> DataFrame:
    staged = t.staged
    return quality.null_counts(staged, staged.columns)


@query
def dq_unique(t: Tables) -> DataFrame:
    return quality.unique(t.undeduplicated, "observation_key")


@query
def dq_accepted_values(t: Tables) -> DataFrame:
    return quality.accepted_values(t.source, "comments_disabled_raw", ("True", "False"))


@query
def dq_relationships(t: Tables) -> DataFrame:
    usable = t.dim_video.filter(~F.col("video_error_or_removed") & ~F.col("ratings_disabled"))
    return quality.relationships(t.source, "video_id", usable, "video_id")


@query
def dq_unique_combo(t: Tables) -> DataFrame:
    return quality.unique_combination(t.staged, ["region_code", "video_id"])


@query
def dq_orphan_category(t: Tables) -> DataFrame:
    return quality.orphan_categories(t.staged, t.categories)


@query
def dq_lifecycle_dates(t: Tables) -> DataFrame:
    return quality.lifecycle_dates(t.lifecycle)


@query
def dq_duplicate_grain(t: Tables) -> DataFrame:
    return quality.duplicate_grain(t.fact_of(enrich.int_enriched(t.undeduplicated, t.categories)))


@query
def dq_nonnegative(t: Tables) -> DataFrame:
    shifted = t.fact.withColumns({"likes": F.col("likes") - 10, "comment_count": F.col("comment_count") - 5})
    return quality.negative_measures(shifted)


@query
def dq_publish_before_trending(t: Tables) -> DataFrame:
    return quality.published_after_trending(t.enriched)


@query
def dq_table_report(t: Tables) -> DataFrame:
    name = "stg_observations"
    return quality.check_table(name, {name: t.staged}, quality.DECLARED[name], adapter.REGION_NAMES)


@query
def dq_full_report(t: Tables) -> DataFrame:
    """Every declared check on every model, and the rules, as the build reports them. Each model is computed once.

    A model goes when nothing reads it any more, and checks are computed one at a time, so that the disk has few models and the
    shuffle files of one part or check.
    """
    models: dict[str, DataFrame] = {}
    reports: list[DataFrame] = []
    with Kept(t.spark, parts_for(t.spark, adapter.path(t.sf_dir, "lineitem"))) as kept:

        def checked(*names: str, small: bool = False) -> None:
            parts = quality.check_parts(models, adapter.REGION_NAMES, names, table=not small)
            for part in [relational.union_by_name(parts)] if small else parts:
                reports.append(kept.table(f"report_{len(reports)}", part))

        models["bronze_categories"] = adapter.landed_categories(t.spark, t.sf_dir)
        models["region_seed"] = adapter.region_seed(t.spark, t.sf_dir)
        models["stg_categories"] = t.categories = kept.table("stg_categories", t.categories)
        models |= {"dim_region": t.dim_region, "dim_category": t.dim_category}
        checked("bronze_categories", "region_seed", "dim_region", "dim_category", small=True)

        models["bronze_observations"] = t.landed = kept.split("bronze_observations", t.landed, "video_id")
        checked("bronze_observations")
        landed = models.pop("bronze_observations")
        t.staged = kept.made("bronze_observations", landed, "stg_observations", lambda rows: staging.stg_observations(rows, adapter.REGION_NAMES, table=True), last=True)
        models["stg_observations"] = t.staged
        checked("stg_observations", "stg_categories")

        models["int_lifecycle"] = t.lifecycle = kept.made("stg_observations", t.staged, "int_lifecycle", lifecycle.int_lifecycle)
        models["mart_video_lifecycle"] = marts.mart_video_lifecycle(t.lifecycle)
        checked("int_lifecycle", "mart_video_lifecycle")
        del models["int_lifecycle"], models["mart_video_lifecycle"]
        kept.drop("int_lifecycle")
        models["dim_video"] = kept.made("stg_observations", t.staged, "dim_video", dimensions.dim_video)
        models["mart_channel_performance"] = marts.mart_channel_performance(t.items)
        checked("dim_video", "mart_channel_performance")
        del models["stg_observations"], models["mart_channel_performance"]

        t.enriched = kept.made("stg_observations", t.staged, "int_enriched", lambda rows: enrich.int_enriched(rows, t.categories), last=True)
        models["int_enriched"] = t.enriched
        checked("int_enriched")
        del models["int_enriched"]
        models["fct_daily"] = t.fact = kept.made("int_enriched", t.enriched, "fct_daily", t.fact_of, last=True)
        models["mart_category_performance"] = marts.mart_category_performance(t.fact, t.dim_category)
        models["mart_regional_trending"] = marts.mart_regional_trending(t.fact)
        checked("fct_daily", "mart_category_performance", "mart_regional_trending")
        return settled(relational.union_by_name(reports))


@query
def dq_observed_report(t: Tables) -> DataFrame:
    """The report of a table whose rows and column checks were counted while it was written."""
    name, folder = "stg_observations", f"{shared_root(t.spark)}/{uuid.uuid4().hex}"
    observed = quality.Observed(name, adapter.REGION_NAMES)
    observed.watch(t.staged).write.parquet(folder)
    counts = observed.counts()
    report = quality.check_table(name, {name: t.spark.read.parquet(folder)}, quality.DECLARED[name], adapter.REGION_NAMES, counts)
    rows = t.spark.createDataFrame([(name, "n_rows", "", counts[quality.ROWS])], report.schema)
    return report.unionByName(rows)


# --- profile ---


@query
def profile_counts(t: Tables) -> DataFrame:
    return profile.counts(t.landed)


@query
def profile_date_range(t: Tables) -> DataFrame:
    return profile.date_range(t.landed)


@query
def profile_duplicates(t: Tables) -> DataFrame:
    return profile.duplicates(t.landed)


@query
def profile_nulls(t: Tables) -> DataFrame:
    return profile.blanks(t.landed)


@query
def profile_parse_failures(t: Tables) -> DataFrame:
    return profile.parse_failures(t.landed)


@query
def profile_numeric_ranges(t: Tables) -> DataFrame:
    return profile.numeric_ranges(t.landed)


@query
def profile_bool_unexpected(t: Tables) -> DataFrame:
    return profile.unexpected_booleans(t.landed)


@query
def profile_category_coverage(t: Tables) -> DataFrame:
    return profile.category_coverage(t.landed, t.categories)


@query
def profile_publish_after(t: Tables) -> DataFrame:
    return profile.publish_after_trending(t.landed)


@query
def profile_publish_after_examples(t: Tables) -> DataFrame:
    return profile.publish_after_examples(t.landed)


@query
def profile_flags(t: Tables) -> DataFrame:
    return profile.flag_totals(t.landed)


@query
def profile_title_changes(t: Tables) -> DataFrame:
    return profile.title_changes(t.landed)


@query
def profile_channel_changes(t: Tables) -> DataFrame:
    return profile.channel_changes(t.landed)


@query
def profile_tag_samples(t: Tables) -> DataFrame:
    return profile.tag_samples(t.landed)


@query
def profile_category_docs(t: Tables) -> DataFrame:
    return profile.category_documents(t.part_documents)


@query
def profile_cross_region(t: Tables) -> DataFrame:
    return profile.cross_region(t.landed)


@query
def profile_totals(t: Tables) -> DataFrame:
    return profile.totals(t.landed)


# --- landing: CSV records and file facts ---


def _csv_records(t: Tables) -> DataFrame:
    """Landed rows as CSV text with quoted commas, quotes and line breaks; rows with 6 dislikes lose
    their last fields, rows with 7 gain some, and rows with 5 a hundred empty ones."""

    def quoted(text: F.Column) -> F.Column:
        return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))

    dislikes = F.col("dislikes")
    texts = {c: F.coalesce(F.col(c), F.lit("")) for c in OBSERVATION_HEADER}
    texts["title"] = quoted(F.concat(F.col("title"), F.lit(', "new" '), dislikes))
    texts["channel_title"] = quoted(F.concat(F.col("channel_title"), F.lit("\nline two")))
    texts["tags"] = quoted(texts["tags"])
    fields = [texts[c] for c in OBSERVATION_HEADER]
    line = (
        F.when(dislikes == "6", F.concat_ws(",", *fields[:12]))
        .when(dislikes == "7", F.concat_ws(",", *fields, F.lit(""), F.lit("surplus")))
        .when(dislikes == "5", F.concat_ws(",", *fields, F.lit("," * 99)))
        .otherwise(F.concat_ws(",", *fields))
    )
    return t.landed.select("_source_region", line.alias("line"))


@query
def csv_accepted_rows(t: Tables) -> DataFrame:
    parsed = observation_files.parse_lines(_csv_records(t))
    kept = parsed.filter(F.col(observation_files.PARSE_STATUS).isin(*observation_files.ACCEPTED))
    return kept.select("_source_region", *OBSERVATION_HEADER, observation_files.PARSE_STATUS)


@query
def csv_rejected_rows(t: Tables) -> DataFrame:
    parsed = observation_files.parse_lines(_csv_records(t))
    rejected = parsed.filter(F.col(observation_files.PARSE_STATUS) != observation_files.STATUS_OK)
    return rejected.groupBy("_source_region", observation_files.PARSE_STATUS).agg(F.count("*").alias("n_rows"))


@query
def audit_file_facts(t: Tables) -> DataFrame:
    """Documents as files: German ones end in a byte that is not UTF-8, French ones have CRLF for spaces."""
    text, lang = F.col("text"), F.col("lang")
    content = (
        F.when(lang == "de", F.concat(F.encode(text, "UTF-8"), F.unhex(F.lit("FF"))))
        .when(lang == "fr", F.encode(F.replace(text, F.lit(" "), F.lit("\r\n")), "UTF-8"))
        .otherwise(F.encode(text, "UTF-8"))
    )
    name = F.concat(F.lit("doc"), "doc_id", F.lit(".txt"))
    files = t.raw("documents").select(name.alias("file"), content.alias("content"))
    return files.select("file", *audit.file_facts(F.col("content")))


@query
def audit_json_shape(t: Tables) -> DataFrame:
    """Parts as documents; some hold a number for an item, some an item without its snippet."""
    bodies = adapter.part_documents(t.spark, t.sf_dir).select(F.col("_source_file").alias("file"), "body")
    number = F.regexp_extract("file", "[0-9]+", 0).cast("bigint")
    body = F.when(number % 11 == 0, '{"items": [{"id": "1", "snippet": {}}, 1]}').when(number % 13 == 0, '{"items": [{"id": "1"}]}')
    body = F.coalesce(body, F.col("body"))
    return bodies.select("file", audit.json_problem(F.encode(body, "UTF-8")).alias("problem"))


@query
def audit_header_drift(t: Tables) -> DataFrame:
    """Suppliers as files: a plain, a quoted, a marked, a longer header, and one with two names exchanged."""
    names, kind = list(OBSERVATION_HEADER), F.col("s_suppkey") % 5
    plain = ",".join(names)
    line = (
        F.when(kind == 0, plain)
        .when(kind == 1, ",".join(f'"{n}"' for n in names))
        .when(kind == 2, "\ufeff" + plain)
        .when(kind == 3, plain + ",extra")
        .otherwise(plain.replace("views,likes", "likes,views"))
    )
    file = F.concat(F.lit("s"), "s_suppkey").alias("file")
    return t.raw("supplier").select(file, audit.csv_problem(F.concat(line, F.lit("\r"))).alias("problem"))


@query
def audit_manifest(t: Tables) -> DataFrame:
    """Orders as files that a manifest lists with some sizes and hashes changed, some left out, some not hashed."""
    key = F.col("o_orderkey")
    file, digest = F.concat(F.lit("o"), key).alias("file"), F.concat(F.lit("h"), key)
    report = t.raw("orders").filter(key % 7 != 0).select(file, key.alias("size_bytes"), F.when(key % 5 != 0, digest).alias("sha256"))
    listed = t.raw("orders").filter(key % 11 != 0).select(
        file, F.when(key % 3 == 0, key + 1).otherwise(key).alias("size_bytes"), F.when(key % 2 == 0, F.lit("x")).otherwise(digest).alias("sha256")
    )
    return audit.compare_manifest(report, listed)


@query
def audit_trees(t: Tables) -> DataFrame:
    """Documents as files: the digest trees of their lines, with nodes of three so that there are several levels."""
    lines = t.raw("documents").select(F.concat(F.lit("doc"), "doc_id").alias("file"), F.posexplode(F.split("text", "\n")).alias("n", "value"))
    return audit.digest_tree(lines, fan=3)


def _judged(t: Tables) -> DataFrame:
    """Parts as files, some in two numbered parts, some missing, extra or unsound."""
    key = F.col("p_partkey")
    name = lambda suffix: F.concat(F.lit("x"), key, F.lit(suffix))
    expected = t.raw("part").filter(key % 4 != 0).select(name(".csv").alias("file"))
    files = F.when(key % 5 == 0, F.array(name("-1.csv"), name("-2.csv"))).otherwise(F.array(name(".csv")))
    facts = t.raw("part").filter(key % 3 != 0).select(
        F.explode(files).alias("file"), F.lit("csv").alias("type"), key.alias("size_bytes"),
        F.when(F.col("p_size") % 7 == 0, "unsound").alias("problem"),
    )
    return audit.judged(expected, facts)


@query
def audit_verdicts(t: Tables) -> DataFrame:
    return _judged(t).select("file", "status", "verdict")


@query
def audit_totals(t: Tables) -> DataFrame:
    return audit.audit_totals(_judged(t))


@query
def loaded_totals(t: Tables) -> DataFrame:
    return quality.loaded_totals(t.landed, adapter.landed_categories(t.spark, t.sf_dir))


@query
def load_report(t: Tables) -> DataFrame:
    """Rows and rejects per file, from the landed rows as CSV text."""
    parsed = observation_files.parse_lines(_csv_records(t)).withColumn("_source_file", F.concat("_source_region", F.lit("videos.csv")))
    return sinks.load_report(parsed)


@query
def dq_rules_report(t: Tables) -> DataFrame:
    """The five rules over the driver's models, as the build reports them."""
    t.staged = settled(t.staged)  # all of them are made of it
    return quality.check_rules({
        "stg_observations": t.staged, "stg_categories": t.categories, "int_lifecycle": t.lifecycle,
        "int_enriched": t.enriched, "fct_daily": t.fact,
    })


# --- landing files: written below the shared folder, read and audited there ---


@query
def files_landed(t: Tables) -> DataFrame:
    """Rows of the CSV files with their provenance and class."""
    landed = observation_files.read_landing(t.spark, t.landing)
    part = F.regexp_replace("_source_file", "-[0-9]+", "").alias("_source_file")
    return landed.select(*OBSERVATION_HEADER, "_source_region", part, "_bad_bytes", "_parse_status", F.col("_loaded_at").isNotNull().alias("loaded"))


@query
def files_load_report(t: Tables) -> DataFrame:
    """Rows and rejects per region of the files."""
    report = sinks.load_report(observation_files.read_landing(t.spark, t.landing))
    totals = [F.sum(c).alias(c) for c in ("n_rows", "n_truncated", "n_short", "n_unclosed")]
    return report.groupBy("_source_region").agg(*totals)


@query
def files_categories(t: Tables) -> DataFrame:
    """Items of the category documents."""
    items = category_files.flatten_documents(category_files.read_category_documents(t.spark, t.landing))
    return items.select("_source_region", "category_id", "category_title", "category_channel_id", "assignable")


@query
def files_audited(t: Tables) -> DataFrame:
    """What the audit finds in the files, by region and type: encoding, line ends, columns, items, problems."""
    facts = audit.audit_files(t.spark, t.landing)
    region = F.substring("file", 1, 2).alias("region")
    return facts.select(region, "type", "encoding", "line_ending", "problem", "n_columns", "n_items", F.length("sha256").alias("hash_length")).distinct()


@query
def files_items(t: Tables) -> DataFrame:
    """The audit's item summary of the category documents."""
    return audit.json_items(t.spark, t.landing).select(F.substring("file", 1, 2).alias("region"), "id", "title", "assignable")


@query
def check_loaded(t: Tables) -> DataFrame:
    """Verdicts over a load without one region and one column, and with categories of a region that isn't expected."""
    t.landed.filter("_source_region <> 'ASIA'").drop("views").createOrReplaceTempView("check_loaded_observations")
    documents = adapter.landed_categories(t.spark, t.sf_dir)
    documents.withColumn("_source_region", F.replace("_source_region", F.lit("EUROPE"), F.lit("ATLANTIS"))).createOrReplaceTempView("check_loaded_categories")
    return quality.check_loaded(t.spark, "check_loaded_observations", "check_loaded_categories", adapter.REGION_NAMES)
