"""Data-quality checks. Each returns the failing rows or values; an empty result is a pass."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapmart.operators.relational import dangling_keys, duplicate_keys, duplicate_keys_of_table, orphans, union_by_name
from snapmart.schemas import KNOWN_ORPHAN_CATEGORY, MEASURES, REGIONS


# --- generic checks ---------------------------------------------------------------------------


def null_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column_name, n_failures) for every column, counted in one pass over the table."""
    counts = df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot(list(by), list(columns), "column_name", "n_failures")


def not_null(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return null_counts(df, columns, by).filter(F.col("n_failures") > 0)


def unique(df: DataFrame, column: str, table: bool = False) -> DataFrame:
    """Values on more than one row; NULLs are not compared. `table` says that `df` is a written table, cheap to read twice."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column], table)


def unique_combination(df: DataFrame, columns: Sequence[str], table: bool = False) -> DataFrame:
    return duplicate_keys_of_table(df, columns) if table else duplicate_keys(df, columns)


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with row counts; NULL passes."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n_rows"))


def relationships(df: DataFrame, foreign_key: str, reference: DataFrame, key: str) -> DataFrame:
    return dangling_keys(df, foreign_key, reference, key)


# --- rules of this warehouse ------------------------------------------------------------------


def orphan_categories(observations: DataFrame, categories: DataFrame) -> DataFrame:
    """Staged observations without a category row, but for the id known to have none.

    A NULL category id is not reported (its comparison is unknown); the not-null check covers it.
    """
    rows = observations.select("region_code", "video_id", "trending_date", "category_id").filter(
        F.col("category_id") != KNOWN_ORPHAN_CATEGORY
    )
    return orphans(rows, categories, ["region_code", "category_id"]).select(*rows.columns)


def lifecycle_dates(lifecycle: DataFrame) -> DataFrame:
    """Items whose first date is after the last, or with no observed day."""
    first, last, days = (F.col(c) for c in ("first_trending_date", "last_trending_date", "observed_trending_days"))
    return lifecycle.select("region_code", "video_id", first, last, days).filter((first > last) | (days < 1))


def duplicate_grain(fact: DataFrame, table: bool = False) -> DataFrame:
    find = duplicate_keys_of_table if table else duplicate_keys
    return find(fact, ["observation_key", "region_code", "video_id", "trending_date"], "c")


def negative_measures(fact: DataFrame) -> DataFrame:
    """Observations with a measure below zero."""
    views, likes, dislikes, comments = (F.col(m) < 0 for m in MEASURES)
    return fact.select("region_code", "video_id", "trending_date", *MEASURES).filter(
        views | likes | dislikes | comments
    )


def published_after_trending(enriched: DataFrame, tolerance_days: int = 1) -> DataFrame:
    """Observations published later than the tolerance after their trending date."""
    days = F.col("days_since_publish")
    return enriched.select("region_code", "video_id", "trending_date_parsed", "publish_time", days).filter(
        days.isNotNull() & (days < -tolerance_days)
    )


# --- declared checks --------------------------------------------------------------------------


@dataclass(frozen=True)
class TableChecks:
    """Checks declared for one table. `by` repeats the column checks per value, e.g. per region."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    region_column: str | None = None
    unique_combinations: Sequence[Sequence[str]] = ()
    relationships: Sequence[tuple[str, str, str]] = ()  # foreign key, reference table, key
    by: Sequence[str] = field(default=())


# Which columns of which table are checked.
DECLARED: dict[str, TableChecks] = {
    "bronze_observations": TableChecks(
        not_null=("_source_region", "_source_file", "_loaded_at", "video_id", "trending_date"),
        region_column="_source_region",
        by=("_source_region",),
    ),
    "bronze_categories": TableChecks(
        not_null=("_source_region", "_source_file", "_loaded_at", "category_id"), by=("_source_region",)
    ),
    "region_seed": TableChecks(
        not_null=("region_code", "region_name", "locale", "language_code"), unique=("region_code",)
    ),
    "stg_observations": TableChecks(
        not_null=(
            "observation_key",
            "region_code",
            "video_id",
            "trending_date",
            "trending_date_parsed",
            "category_id",
            *MEASURES,
        ),
        unique=("observation_key",),
        region_column="region_code",
    ),
    "stg_categories": TableChecks(
        not_null=("region_code", "category_id"),
        region_column="region_code",
        unique_combinations=(("region_code", "category_id"),),
    ),
    "int_enriched": TableChecks(
        not_null=(
            "observation_key",
            "region_code",
            "video_id",
            "trending_date_parsed",
            "has_valid_engagement",
            "tag_count",
        ),
        unique=("observation_key",),
        region_column="region_code",
    ),
    "int_lifecycle": TableChecks(
        not_null=(
            "video_region_key",
            "region_code",
            "video_id",
            "first_trending_date",
            "last_trending_date",
            "observed_trending_days",
        ),
        unique=("video_region_key",),
        region_column="region_code",
    ),
    "dim_region": TableChecks(
        not_null=("region_key", "region_code"), unique=("region_key", "region_code"), region_column="region_code"
    ),
    "dim_category": TableChecks(
        not_null=("category_key", "region_code", "category_id"), unique=("category_key",), region_column="region_code"
    ),
    "dim_video": TableChecks(
        not_null=("video_key", "region_code", "video_id"), unique=("video_key",), region_column="region_code"
    ),
    "fct_daily": TableChecks(
        not_null=(
            "observation_key",
            "region_code",
            "video_id",
            "trending_date",
            "region_key",
            "video_key",
            *MEASURES,
            "has_valid_engagement",
        ),
        unique=("observation_key",),
        region_column="region_code",
        relationships=(
            ("region_key", "dim_region", "region_key"),
            ("video_key", "dim_video", "video_key"),
            ("category_key", "dim_category", "category_key"),
        ),
    ),
    "mart_video_lifecycle": TableChecks(
        not_null=("video_region_key", "region_code", "video_id", "observed_trending_days"),
        unique=("video_region_key",),
        region_column="region_code",
    ),
    "mart_channel_performance": TableChecks(
        not_null=("region_code", "channel_title", "distinct_videos"), region_column="region_code"
    ),
    "mart_category_performance": TableChecks(
        not_null=("region_code", "category_id", "trending_date", "observations"), region_column="region_code"
    ),
    "mart_regional_trending": TableChecks(
        not_null=("region_code", "trending_date", "observations"), region_column="region_code"
    ),
}


def _summary(failing: DataFrame, table: str, check: str, column: str) -> DataFrame:
    return failing.agg(F.count("*").alias("n_failures")).select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), F.lit(column).alias("column_name"),
        "n_failures",
    )


#: The number of rows among the counts that are taken while a table is written.
ROWS = "n_rows"


def column_counts(checks: TableChecks, regions: Sequence[str] = REGIONS) -> dict[str, Column]:
    """What not-null and accepted-region checks count in a table, by label."""
    counts = {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in checks.not_null}
    if checks.region_column:
        counts[f"accepted_values:{checks.region_column}"] = F.count_if(~F.col(checks.region_column).isin(*regions))
    return counts


class Observed:
    """Counts taken while a table is written, so that checking them costs no scan: rows and the failures of column checks.

    Give `watch(df)` to the writer; `counts()` has the numbers once the write is done. Tables whose checks are
    repeated per value (`by`) are counted by a scan afterwards: their groups aren't known before.
    """

    def __init__(self, name: str, regions: Sequence[str] = REGIONS):
        checks = DECLARED.get(name, TableChecks())
        self._columns = {} if checks.by else column_counts(checks, regions)
        self.complete = name in DECLARED and not checks.by
        self._observation = Observation(f"{name}-{uuid.uuid4().hex}")

    def watch(self, df: DataFrame) -> DataFrame:
        numbered = [c.alias(f"c{k}") for k, c in enumerate(self._columns.values())]
        return df.observe(self._observation, F.count(F.lit(1)).alias(ROWS), *numbered)

    def counts(self) -> dict[str, int]:
        found = self._observation.get
        return {ROWS: found[ROWS]} | {label: found[f"c{k}"] for k, label in enumerate(self._columns)}


def check_table(
    name: str, tables: Mapping[str, DataFrame], checks: TableChecks, regions: Sequence[str] = REGIONS, observed: Mapping[str, int] | None = None
) -> DataFrame:
    """(table_name, check_name, column_name, n_failures) for every check declared on one table.

    Not-null and accepted-region counts share one pass, or are those `observed` when the table was written; each
    key check is one aggregation.
    """
    return union_by_name(_table_parts(name, tables, checks, regions, observed))


def _table_parts(
    name: str, tables: Mapping[str, DataFrame], checks: TableChecks, regions: Sequence[str], observed: Mapping[str, int] | None, table: bool = False
) -> list[DataFrame]:
    """Its column checks, and each key check."""
    df = tables[name]
    counts = column_counts(checks, regions)
    if observed is not None:
        rows = [(label, int(observed[label])) for label in counts]
        long = df.sparkSession.createDataFrame(rows, "_check string, n_failures long")
    else:
        # each column check is one row per value of `by`
        wide = df.groupBy(*checks.by).agg(*[count.alias(label) for label, count in counts.items()])
        long = wide.unpivot(list(checks.by), list(counts), "_check", "n_failures")
    scope = F.concat_ws("/", F.lit(name), *checks.by)
    parts = [
        long.select(
            scope.alias("table_name"),
            F.substring_index("_check", ":", 1).alias("check_name"),
            F.substring_index("_check", ":", -1).alias("column_name"),
            "n_failures",
        )
    ]
    parts += [_summary(unique(df, c, table), name, "unique", c) for c in checks.unique]
    parts += [
        _summary(unique_combination(df, cols, table), name, "unique_combination", "+".join(cols))
        for cols in checks.unique_combinations
    ]
    parts += [
        _summary(relationships(df, fk, tables[ref], key), name, "relationships", fk)
        for fk, ref, key in checks.relationships
    ]
    return parts


def check_rules(tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """The same report for the five warehouse rules, as far as their tables are given; None if none are."""
    parts = _rule_parts(tables)
    return union_by_name(parts) if parts else None


def _rule_parts(tables: Mapping[str, DataFrame], table: bool = False) -> list[DataFrame]:
    """Each rule."""
    rules = [
        (("stg_observations", "stg_categories"), "orphan_categories", orphan_categories),
        (("int_lifecycle",), "lifecycle_dates", lifecycle_dates),
        (("fct_daily",), "duplicate_grain", partial(duplicate_grain, table=table)),
        (("fct_daily",), "negative_measures", negative_measures),
        (("int_enriched",), "published_after_trending", published_after_trending),
    ]
    return [_summary(rule(*[tables[n] for n in names]), names[0], check, "") for names, check, rule in rules if set(names) <= set(tables)]


def check_all(
    tables: Mapping[str, DataFrame],
    regions: Sequence[str] = REGIONS,
    only: Sequence[str] | None = None,
    observed: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """Every declared check on the tables given (or on `only` these, which may refer to the others), and the rules.

    `observed` has the counts of tables that were counted while they were written.
    """
    return union_by_name(check_parts(tables, regions, only, observed))


def check_parts(
    tables: Mapping[str, DataFrame],
    regions: Sequence[str] = REGIONS,
    only: Sequence[str] | None = None,
    observed: Mapping[str, Mapping[str, int]] | None = None,
    table: bool = False,
) -> list[DataFrame]:
    """The parts of `check_all`, which can be computed one at a time: the column checks of each table, each key check, each rule.

    `table` says that the tables are written, cheap to read twice: then only keys that may repeat are shuffled.
    """
    names = [n for n in DECLARED if n in tables and (only is None or n in only)]
    parts = [part for n in names for part in _table_parts(n, tables, DECLARED[n], regions, (observed or {}).get(n), table)]
    return parts + _rule_parts(tables if only is None else {n: tables[n] for n in only}, table)


class CheckError(Exception):
    """Tables don't pass their checks."""


def require_passed(report: DataFrame) -> None:
    """Raise with the failing checks; a report has a few hundred rows, by the checks declared."""
    failed = report.filter("n_failures > 0").orderBy("table_name", "check_name", "column_name").collect()
    if failed:
        raise CheckError("; ".join(f"{r.table_name}: {r.check_name} {r.column_name} ({r.n_failures})" for r in failed))


# --- loaded-table check -----------------------------------------------------------------------

# Columns a loaded observation table must have.
REQUIRED_COLUMNS = (
    "_source_region",
    "_source_file",
    "_loaded_at",
    "video_id",
    "trending_date",
    "title",
    "category_id",
    "views",
)


def check_loaded(
    spark: SparkSession, observations: str, categories: str, regions: Sequence[str] = REGIONS
) -> DataFrame:
    """(subject, problem) rows for absent tables, absent columns, and missing or extra regions.

    The reference has a table per region; here a region is a value of `_source_region`.
    """
    problems = []
    region_sets = []
    for name in (observations, categories):
        if not spark.catalog.tableExists(name):
            problems.append((name, "missing table"))
            continue
        columns = spark.table(name).columns
        required = REQUIRED_COLUMNS if name == observations else ("_source_region",)
        problems += [(name, f"missing column {c}") for c in required if c not in columns]
        if "_source_region" in columns:
            region_sets.append((name, spark.table(name).select("_source_region").distinct()))
    result = spark.createDataFrame(problems, "subject string, problem string")
    expected = spark.createDataFrame([(r,) for r in regions], "_source_region string").withColumn("_e", F.lit(True))
    for name, found in region_sets:
        compared = found.withColumn("_f", F.lit(True)).join(expected, "_source_region", "full_outer")
        problem = F.when(F.col("_f").isNull(), "missing region ").when(F.col("_e").isNull(), "extra region ")
        result = result.unionByName(
            compared.filter(problem.isNotNull()).select(
                F.lit(name).alias("subject"), F.concat(problem, "_source_region").alias("problem")
            )
        )
    return result


def loaded_totals(observations: DataFrame, categories: DataFrame) -> DataFrame:
    """One row: loaded observation and category rows."""
    return union_by_name(
        [
            observations.agg(F.count("*").alias("n_rows")).select(F.lit("observations").alias("subject"), "n_rows"),
            categories.agg(F.count("*").alias("n_rows")).select(F.lit("categories").alias("subject"), "n_rows"),
        ]
    )
