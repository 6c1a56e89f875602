"""Gives the driver's order tables the landed shape: text observations, category documents, region seed.

The column rules are fixed here and, as SQL, in `oracle.py`. They exercise both date centuries, bad
dates, NULL and blank fields, odd booleans, messy tags, zero views and duplicate keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.schemas import KNOWN_ORPHAN_CATEGORY
from snapmart.sources.categories import flatten_documents

# Region names of the driver tables, the allow-list of this landing area.
REGION_NAMES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

# The brands without a category row; the second carries the id that may lack one.
ORPHAN_BRAND, EXEMPT_BRAND = "Brand#25", "Brand#55"


# The columns read, so that opening a table needs no job to look at file footers.
_COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "documents": "doc_id bigint, text string, lang string",
}


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(path(sf_dir, name))


def _whole(number) -> F.Column:
    return F.floor(number).cast("bigint").cast("string")


def landed_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as landed observations: 16 text columns and the three provenance columns.

    Nation and region have 25 and 5 rows by the definition of the data set, so they are broadcast;
    orders and suppliers are left to Spark's size statistics. Parts come last and are joined by the item's id, so that order
    lines are shuffled before the parts' texts widen them, and lie by item for whatever groups them by item.
    """
    line, item = F.col("l_linenumber"), lambda key: F.concat(F.lit("p"), key)
    ordered = F.col("o_orderdate").cast("timestamp")
    tags = (
        F.when(line % 5 == 1, "")
        .when(line % 5 == 2, " [None] ")
        .when(line % 5 == 3, F.concat(F.lit('"'), F.col("p_type"), F.lit('"||"b"')))
        .when(line % 5 == 4, F.concat(F.col("p_brand"), F.lit("|b|")))
    )
    published = (
        F.when(line == 7, F.date_format(ordered, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(line == 6, "")
        .otherwise(F.date_format(ordered, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )
    comments = F.when(F.col("l_returnflag") == "A", "True").when(F.col("l_returnflag") == "N", " f ").otherwise("maybe")
    unrated = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    parts = table(spark, sf_dir, "part").withColumn("_part", item("p_partkey")).hint("shuffle_hash")
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("video_id", item("l_partkey"))
        .join(parts, F.col("video_id") == F.col("_part"))
        .select(
            "video_id",
            F.when(F.col("l_tax") == 0.08, "bad")
            .otherwise(F.date_format(F.col("l_shipdate").cast("timestamp"), "yy.dd.MM"))
            .alias("trending_date"),
            F.col("p_name").alias("title"),
            F.col("s_name").alias("channel_title"),
            F.when(F.col("p_brand") == EXEMPT_BRAND, KNOWN_ORPHAN_CATEGORY).otherwise(F.col("p_brand")).alias("category_id"),
            published.alias("publish_time"),
            tags.alias("tags"),
            F.when(F.col("l_tax") == 0, "0").otherwise(_whole(F.col("l_extendedprice"))).alias("views"),
            _whole(F.col("l_quantity")).alias("likes"),
            line.cast("string").alias("dislikes"),
            F.when(line != 6, _whole(F.col("l_quantity") / 2)).alias("comment_count"),
            F.concat(F.lit("http://x/"), F.col("l_partkey")).alias("thumbnail_link"),
            comments.alias("comments_disabled"),
            F.when(unrated, "TRUE").otherwise("False").alias("ratings_disabled"),
            F.when(F.col("l_quantity") == 50, "1").otherwise("0").alias("video_error_or_removed"),
            F.when(F.col("l_partkey") % 2 == 1, F.concat(F.lit("about "), F.col("p_type"))).alias("description"),
            F.col("r_name").alias("_source_region"),
            F.concat(F.col("r_name"), F.lit("videos.csv")).alias("_source_file"),
            F.col("o_orderdate").alias("_loaded_at"),
        )
    )


def category_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per region and brand, in the schema of the category files."""
    brand = F.col("p_brand")
    item = F.struct(
        brand.alias("id"),
        F.struct(
            F.concat(F.lit("ch-"), brand).alias("channelId"),
            F.concat(F.lit("Group "), F.substring(brand, 7, 1)).alias("title"),
            F.when(~brand.endswith("5"), brand.endswith("2")).alias("assignable"),
        ).alias("snippet"),
    )
    return (
        table(spark, sf_dir, "part")
        .select("p_brand")
        .distinct()
        .filter(~brand.isin(ORPHAN_BRAND, EXEMPT_BRAND))
        .select(brand, F.explode(F.array(*[F.lit(r) for r in REGION_NAMES])).alias("_source_region"))
        .select(
            "_source_region",
            F.concat("_source_region", F.lit("_category_id.json")).alias("_source_file"),
            F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("_loaded_at"),
            F.array(item).alias("items"),
        )
    )


def landed_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_documents(category_documents(spark, sf_dir))


def part_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per part: two items as JSON text, an empty list when the size is a multiple of 10,
    no list at all when it is a multiple of 7."""
    size = F.col("p_size")

    def item(ident: str, title: F.Column) -> F.Column:
        snippet = F.struct(
            F.concat(F.lit("ch-"), F.col("p_partkey")).alias("channelId"),
            title.alias("title"),
            F.when(size % 3 == 0, True).when(size % 3 == 1, False).alias("assignable"),
        )
        return F.struct(F.col(ident).cast("string").alias("id"), snippet.alias("snippet"))

    named = F.when(size != 1, F.col("p_name"))
    items = F.array(item("p_partkey", named), item("p_brand", F.col("p_type")))
    items = F.when(size % 7 == 0, None).when(size % 10 == 0, F.slice(items, 1, 0)).otherwise(items)
    region = F.element_at(F.array(*[F.lit(r) for r in REGION_NAMES]), (size % len(REGION_NAMES) + 1).cast("int"))
    return table(spark, sf_dir, "part").select(
        region.alias("_source_region"),
        F.concat(F.lit("part"), F.col("p_partkey"), F.lit(".json")).alias("_source_file"),
        F.to_json(F.struct(items.alias("items"))).alias("body"),
    )


def region_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region table in the seed's four text columns."""
    name = F.col("r_name")
    return table(spark, sf_dir, "region").select(
        name.alias("region_code"),
        F.initcap(name).alias("region_name"),
        F.concat(F.lit("l_"), F.col("r_regionkey")).alias("locale"),
        F.lower(F.substring(name, 1, 2)).alias("language_code"),
    )
