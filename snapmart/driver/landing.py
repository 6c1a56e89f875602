"""The driver's tables written out as landing files, so that readers and audit run on real files.

CSV and JSON files of five regions go below the shared folder: most with LF, one region's with CRLF, one region's in
Latin-1, so that its accents are not UTF-8. Titles hold quotes and commas, descriptions line breaks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.driver import adapter
from snapmart.schemas import OBSERVATION_HEADER
from snapmart.sources.files import settled, shared_root

# The two letters by which files name a region.
CODES = {name: name[:2] for name in adapter.REGION_NAMES}
RETURNS, LATIN = "ASIA", "EUROPE"


def code(region: Column) -> Column:
    return F.substring(region, 1, 2)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rows in the text that goes into files."""
    rows = adapter.landed_observations(spark, sf_dir)
    accent = F.when(F.col("_source_region") == LATIN, " café").otherwise("")
    return rows.withColumns({
        "title": F.concat(F.col("title"), F.lit(', "new"'), accent),
        "description": F.concat(F.col("description"), F.lit('\nline, "two"\n\nend')),
    })


def write_landing(spark: SparkSession, sf_dir: str) -> str:
    """Write the files into a new folder and return it."""
    folder = f"{shared_root(spark)}/{uuid.uuid4().hex}"
    # three writes read the rows
    rows = settled(observations(spark, sf_dir).select(code(F.col("_source_region")).alias("code"), "_source_region", *OBSERVATION_HEADER))
    kinds = {"returns": F.col("_source_region") == RETURNS, "latin": F.col("_source_region") == LATIN}
    kinds["plain"] = ~(kinds["returns"] | kinds["latin"])
    options = {"header": True, "quote": "\"", "escape": "\"", "emptyValue": "", "nullValue": "", "quoteAll": True}
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    own = {"returns": {"lineSep": "\r\n"}, "latin": {"encoding": "ISO-8859-1"}, "plain": {}}
    for kind, where in kinds.items():
        part = rows.filter(where).drop("_source_region")
        part.write.partitionBy("code").options(**options, **own[kind]).csv(f"{folder}/written/{kind}")
    documents = adapter.category_documents(spark, sf_dir).groupBy("_source_region").agg(F.flatten(F.collect_list("items")).alias("items"))
    documents = documents.select(code(F.col("_source_region")).alias("code"), F.to_json(F.struct("items")).alias("value"))
    documents.write.partitionBy("code").text(f"{folder}/written/documents")
    _named(spark, folder)
    return f"{folder}/landing"


def _named(spark: SparkSession, folder: str) -> None:
    """Give the written files the names that the readers look for; one call a file."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{folder}/landing"))
    for kind in ("returns", "latin", "plain", "documents"):
        for k, status in enumerate(files.globStatus(path(f"{folder}/written/{kind}/code=*/part-*"))):
            found = status.getPath()
            region = found.getParent().getName().removeprefix("code=")
            name = f"{region}_category_id-{k}.json" if kind == "documents" else f"{region}videos-{k}.csv"
            files.rename(found, path(f"{folder}/landing/{name}"))
