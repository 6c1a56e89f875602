"""Observation files: tolerant CSV scan with every malformed row kept and classified."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.schemas import OBSERVATION_FILE, OBSERVATION_HEADER
from snapmart.sources.split_records import read_records

CORRUPT = "_corrupt_record"
PARSE_STATUS = "_parse_status"
STATUS_OK, STATUS_LONG, STATUS_SHORT, STATUS_UNCLOSED = "ok", "truncated", "short", "unclosed"
ACCEPTED = (STATUS_OK, STATUS_LONG)

_REGION_FROM_NAME = r"^([A-Z]{2})videos(-[0-9]+)?\.csv$"

_CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}

# One record held as text: its line breaks are LF and a lone carriage return is content.
_ONE_RECORD = {"multiLine": "true", "lineSep": "\n"}

FILE_PATTERN = "*videos*.csv"

# Ends a row that is looked at again; no text holds it.
_SENTINEL = "\u0001\u0002\u0001"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _any_ends(row: Column) -> Column:
    """Whether a field of a parsed row ends with the sentinel."""
    ends = [F.coalesce(row[f.name].endswith(_SENTINEL), F.lit(False)) for f in OBSERVATION_FILE]
    return functools.reduce(lambda a, b: a | b, ends)


def row_status(corrupt: Column) -> Column:
    """Class of a row from its malformed text (NULL text means well-formed).

    A sentinel field is appended and the row parsed under the expected columns. If one of these ends with the
    sentinel, fields are missing (or a lost quote swallowed it): 'short'. If none does, the surplus was dropped with
    it: 'truncated', however many fields there were.
    """
    options = {k: v for k, v in _CSV_OPTIONS.items() if k != "columnNameOfCorruptRecord"} | _ONE_RECORD
    schema = ", ".join(f"{f.name} string" for f in OBSERVATION_FILE)
    parsed = F.from_csv(F.concat(F.rtrim(corrupt, F.lit("\r\n")), F.lit("," + _SENTINEL)), schema, options)
    # the struct is passed on once, so a row is parsed once
    short = F.exists(F.array(parsed), lambda row: _any_ends(row))
    return F.when(corrupt.isNull(), STATUS_OK).when(short, STATUS_SHORT).otherwise(STATUS_LONG)


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """CSV records held as text in a column, with the same options and classes as the file scan."""
    others = [c for c in lines.columns if c != line]
    schema = ", ".join(f"{f.name} string" for f in _with_corrupt(OBSERVATION_FILE))
    options = {**_CSV_OPTIONS, **_ONE_RECORD}
    # a generated row: a filter on its fields can't be moved below it, where it would parse the line again for each field
    parsed = lines.select(*others, F.inline(F.array(F.from_csv(F.col(line), schema, options))))
    return parsed.withColumn(PARSE_STATUS, row_status(F.col(CORRUPT)))


def read_observation_files(spark: SparkSession, raw_dir: str, multi_line: bool = True) -> DataFrame:
    """All regional files in one scan, a file a task: text columns, provenance, `_parse_status`, `_bad_bytes`.

    The region is the file-name prefix, so a region may be split over any number of files
    (`USvideos.csv`, `USvideos-0001.csv`, ...). Quoted line breaks make a file one task; where the
    data has none, `multi_line=False` lets Spark split big files. Empty fields, quoted or not, are
    NULL. Bytes that are not UTF-8 arrive as U+FFFD and set `_bad_bytes`.
    """
    scan = (
        spark.read.schema(_with_corrupt(OBSERVATION_FILE))
        .options(**_CSV_OPTIONS)
        .option("header", True)
        .option("enforceSchema", False)  # a header in another order fails the job
        .option("multiLine", multi_line)
        .option("columnPruning", False)  # a row is judged on all its fields, whichever are read
        .option("pathGlobFilter", FILE_PATTERN)
        .csv(raw_dir)
    )
    return _with_provenance(scan, F.col("_metadata.file_name"), row_status(F.col(CORRUPT)))


def read_landing(spark: SparkSession, raw_dir: str) -> DataFrame:
    """The same rows with every file read in splits (see `split_records`), so that no task reads a whole file.

    Lines swallowed by a quote that is never closed are kept one by one with the class 'unclosed'.
    """
    records = read_records(spark, raw_dir, FILE_PATTERN, OBSERVATION_HEADER)
    parsed = parse_lines(records.withColumn("_text", F.col("line")))
    status = F.when(F.col("_unclosed"), STATUS_UNCLOSED).otherwise(F.col(PARSE_STATUS))
    kept_text = F.when(F.col("_unclosed"), F.col("_text")).otherwise(F.col(CORRUPT))
    return _with_provenance(parsed.withColumn(CORRUPT, kept_text), F.col("_source_file"), status)


def _with_provenance(rows: DataFrame, file_name: Column, status: Column) -> DataFrame:
    any_text = F.concat_ws("", *OBSERVATION_HEADER)
    # files with other names are skipped, not read
    return rows.filter(file_name.rlike(_REGION_FROM_NAME)).select(
        *OBSERVATION_HEADER,
        CORRUPT,
        F.regexp_extract(file_name, _REGION_FROM_NAME, 1).alias("_source_region"),
        file_name.alias("_source_file"),
        F.current_timestamp().cast("timestamp_ntz").alias("_loaded_at"),
        any_text.contains("\ufffd").alias("_bad_bytes"),
        status.alias(PARSE_STATUS),
    )


def accepted(landed: DataFrame) -> DataFrame:
    """Rows the pipeline uses: well-formed ones and over-long ones cut to the expected width."""
    return landed.filter(F.col(PARSE_STATUS).isin(*ACCEPTED)).drop(CORRUPT, PARSE_STATUS, "_bad_bytes")


def rejects(landed: DataFrame) -> DataFrame:
    """Malformed rows with their raw text and class. Over-long rows appear here and among the accepted."""
    return landed.filter(F.col(PARSE_STATUS) != STATUS_OK).select(
        "_source_region", "_source_file", "_loaded_at", "video_id", PARSE_STATUS, CORRUPT
    )
