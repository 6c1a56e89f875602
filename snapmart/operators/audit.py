"""Audit of the landing area: which files are there, and is each one structurally sound."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from snapmart.operators.relational import broadcast_if_small, set_difference
from snapmart.schemas import CATEGORY_FILE, OBSERVATION_HEADER, REGIONS
from snapmart.sources.files import list_files, read_files
from snapmart.workers import map_batches

CSV_PATTERN, JSON_PATTERN = "*videos*.csv", "*_category_id*.json"

# A region's data may come in numbered parts; a part stands for the file without its number.
_PART_NUMBER = r"-[0-9]+(\.[a-z]+)$"

# Keys every category item must have.
ITEM_KEYS = ("id", "snippet")

# The whole-file hash needs a file as one value; larger files are compared by the digest trees of `file_trees`. No verdict
# depends on it. A category document is parsed as one value too, so a larger one fails the audit.
HASHED_BYTES = 1 << 30

#: Children of a node in a digest tree, and its levels between lines and root: no node has more below 2^48 lines.
FAN, LEVELS = 1 << 16, 2


class LandingError(Exception):
    """The landing area is not fit to load."""


# --- facts of one file, as Column expressions over its content --------------------------------


def encoding(content: Column) -> Column:
    """'utf-8' when the whole content decodes, else 'latin-1' (which always does)."""
    return F.when(F.is_valid_utf8(content), "utf-8").otherwise("latin-1")


def _dominant(pairs: Column, feeds: Column) -> Column:
    """CRLF when at least half of the line feeds follow a carriage return."""
    return F.when((pairs > 0) & (2 * pairs >= feeds), "CRLF").otherwise("LF")


def line_ending(content: Column) -> Column:
    """Judged on the whole content."""
    text = F.decode(content, "ISO-8859-1")
    size = F.length(text)
    feeds = size - F.length(F.replace(text, F.lit("\n")))
    # a removed pair is two characters
    return _dominant((size - F.length(F.replace(text, F.lit("\r\n")))) / 2, feeds)


def file_facts(content: Column) -> list[Column]:
    return [
        F.length(content).cast("bigint").alias("size_bytes"),
        F.sha2(content, 256).alias("sha256"),
        encoding(content).alias("encoding"),
        line_ending(content).alias("line_ending"),
    ]


def csv_problem(line: Column, header: Sequence[str] = OBSERVATION_HEADER) -> Column:
    """Why a first line is not the expected header, order included; NULL when it is."""
    first = F.substring_index(F.substring_index(line, "\n", 1), "\r", 1)
    schema = ", ".join([*(f"f{i} string" for i in range(len(header))), "_surplus string"])
    got = F.from_csv(first, schema, {"escape": '"', "columnNameOfCorruptRecord": "_surplus"})
    # the corrupt-record column stays NULL only for exactly the expected number of fields
    nothing = F.lit(None).cast("string").alias("_surplus")
    want = F.struct(*[F.lit(name).alias(f"f{i}") for i, name in enumerate(header)], nothing)
    # the parser would skip a byte order mark
    marked = first.startswith("\ufeff")
    return F.when(marked | ~got.eqNullSafe(want), F.concat(F.lit("header drift: "), first))


def _lines(spark: SparkSession, raw_dir: str, pattern: str) -> DataFrame:
    """file, _size, _block (start of the split), _id (ascending by one within a split), value."""
    return spark.read.option("lineSep", "\n").option("pathGlobFilter", pattern).text(raw_dir).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value"),
    )


def line_facts(spark: SparkSession, raw_dir: str, pattern: str) -> DataFrame:
    """Facts of each file of any size from its lines.

    encoding, line_ending, first (the first line) and line_digest (a sum of the lines' hashes, whatever their order).
    A split's lines are counted where they are read, in fixed-width buffers, and leave one row; first lines are read
    apart, from the first split of each file. The reader drops a byte order mark and a last line feed; both show in
    the number of bytes.
    """
    value = F.col("value")
    lines = _lines(spark, raw_dir, pattern)
    returned = value.endswith("\r")
    splits = lines.groupBy("file", "_size", "_block").agg(
        F.bool_and(F.is_valid_utf8(value)).alias("_valid"),
        F.count("*").alias("_lines"),
        F.count_if(returned).alias("_returned"),
        F.max(F.col("_id") * 2 + returned.cast("long")).alias("_last"),
        F.sum(F.octet_length(value) + 1).alias("_bytes"),
        F.sum(F.xxhash64(value).cast("decimal(38,0)")).alias("line_digest"),
    )
    facts = splits.groupBy("file").agg(
        F.bool_and("_valid").alias("_valid"),
        F.sum("_lines").alias("_lines"),
        F.sum("_returned").alias("_returned"),
        (F.max_by("_last", "_block") % 2 == 1).alias("_last_returned"),
        (F.sum("_bytes") - F.max("_size")).alias("_over"),
        F.sum("line_digest").alias("line_digest"),
    )
    facts = facts.join(_first_lines(lines), "file", "left")
    open_end = F.col("_over").isin(1, -2)  # the last line has no feed
    marked = F.col("_over") < 0
    pairs = F.col("_returned") - F.when(open_end & F.col("_last_returned"), 1).otherwise(0)
    feeds = F.col("_lines") - F.when(open_end, 1).otherwise(0)
    return facts.select(
        "file",
        F.when(F.col("_valid"), "utf-8").otherwise("latin-1").alias("encoding"),
        _dominant(pairs, feeds).alias("line_ending"),
        F.when(marked, F.concat(F.lit("\ufeff"), "_first")).otherwise(F.col("_first")).alias("first"),
        F.col("line_digest").cast("string").alias("line_digest"),
    )


def _first_lines(lines: DataFrame) -> DataFrame:
    """file, _first: the first line of each file. The task that reads a file's first split sees it first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None
        for batch in batches:
            files = batch.column(0).dictionary_encode()
            for name in files.dictionary.to_pylist() if batch.num_rows else []:
                if name != seen:
                    at = batch.column(0).index(name).as_py()
                    yield batch.slice(at, 1)
                    seen = name

    first = lines.filter("_block = 0").select("file", F.make_valid_utf8("value").alias("_first"))
    return map_batches(first, run, "file string, _first string")


def numbered_lines(spark: SparkSession, raw_dir: str, pattern: str) -> DataFrame:
    """file, n, value: every line with its number in its file, from 0.

    One pass counts the lines of each split; a second adds to a line's place in its split the lines of the splits
    before. Splits are cut alike in both, and no line is shuffled while there are few splits.
    """
    lines = _lines(spark, raw_dir, pattern)
    splits = lines.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "_block", (F.col("_first") - F.coalesce(before, F.lit(0))).alias("_from"))
    placed = lines.join(broadcast_if_small(splits), ["file", "_block"])
    return placed.select("file", (F.col("_id") - F.col("_from")).alias("n"), "value")


def digest_tree(lines: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """file, tree_sha256: the root of a tree of SHA-256 digests over each file's lines (file, n, value).

    A leaf is the digest of a line without its feed, in lowercase hex; a node that of the hex digests of its children, in
    order: `fan` children in each of `levels` levels, the rest in the root. Only digests are shuffled, at most `fan`
    meet in a node, and all tasks share the work on one file. A file without lines has no row.
    """
    nodes = lines.select("file", "n", F.sha2(F.col("value").cast("binary"), 256).alias("_digest"))
    children = F.sort_array(F.collect_list(F.struct("n", "_digest")))
    digest = F.sha2(F.array_join(F.transform(children, lambda c: c["_digest"]), "").cast("binary"), 256).alias("_digest")
    for _ in range(levels):
        nodes = nodes.groupBy("file", F.floor(F.col("n") / fan).alias("_parent")).agg(digest).withColumnRenamed("_parent", "n")
    return nodes.groupBy("file").agg(digest.alias("tree_sha256"))


def file_trees(spark: SparkSession, raw_dir: str) -> DataFrame:
    """file, tree_sha256 of each landing file, whatever its size.

    With the size in bytes it stands for the content: a byte order mark and a last line feed, which the lines lack, change
    the size, each by its own number of bytes.
    """
    csv, json = (digest_tree(numbered_lines(spark, raw_dir, p)) for p in (CSV_PATTERN, JSON_PATTERN))
    return csv.unionByName(json)


def json_problem(content: Column) -> Column:
    """Why the document is not `{items: [{id, snippet}, ...]}`; NULL when it is."""
    raw_items = F.from_json(content.cast("string"), "items array<string>").getField("items")
    not_object = F.exists(raw_items, lambda i: ~F.coalesce(i.startswith("{"), F.lit(False)))
    incomplete = F.exists(
        raw_items, lambda i: F.size(F.array_except(F.array(*map(F.lit, ITEM_KEYS)), F.json_object_keys(i))) > 0
    )
    return (
        F.when(raw_items.isNull(), "items: no list")
        .when(not_object, "items: entry is no object")
        .when(incomplete, f"items: entry lacks {' or '.join(ITEM_KEYS)}")
    )


# --- audit of a directory ---------------------------------------------------------------------


def expected_files(spark: SparkSession, regions: Sequence[str] = REGIONS) -> DataFrame:
    names = [(f"{r}videos.csv",) for r in regions] + [(f"{r}_category_id.json",) for r in regions]
    return spark.createDataFrame(names, "file string")


def found_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    csv, json = (list_files(spark, raw_dir, p) for p in (CSV_PATTERN, JSON_PATTERN))
    return csv.withColumn("type", F.lit("csv")).unionByName(json.withColumn("type", F.lit("json")))


def presence(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Every expected or found file with status ok, missing or extra."""
    return set_difference(expected, found, "file")


def audit_files(spark: SparkSession, raw_dir: str, hashed_bytes: int = HASHED_BYTES) -> DataFrame:
    """One row per found file: size, encoding, line ends, digest of the lines, columns or items, and the structural
    problem if any. sha256 is NULL for a file over `hashed_bytes`."""
    csv = line_facts(spark, raw_dir, CSV_PATTERN)
    csv = csv.withColumns({"problem": csv_problem(F.col("first")), "n_columns": F.size(F.split("first", ","))})
    json = line_facts(spark, raw_dir, JSON_PATTERN).withColumns({"problem": F.lit(None).cast("string"), "n_columns": F.lit(None).cast("int")})
    content = F.col("content")
    hashes = [read_files(spark, raw_dir, p, hashed_bytes).select("file", F.sha2(content, 256).alias("sha256")) for p in (CSV_PATTERN, JSON_PATTERN)]
    shapes = read_files(spark, raw_dir, JSON_PATTERN, hashed_bytes).select(
        "file",
        json_problem(content).alias("_shape"),
        F.size(F.from_json(content.cast("string"), "items array<string>").getField("items")).alias("n_items"),
        F.lit(True).alias("_parsed"),
    )
    found = found_files(spark, raw_dir).join(csv.unionByName(json).drop("first"), "file", "left")
    found = found.join(hashes[0].unionByName(hashes[1]), "file", "left").join(shapes, "file", "left")
    empty = F.col("encoding").isNull()  # a file without a line
    problem = (
        F.when((F.col("type") == "csv") & empty, "header drift: ")
        .when((F.col("type") == "json") & F.col("_parsed").isNull(), F.lit(f"larger than {hashed_bytes} bytes, not parsed"))
        .otherwise(F.coalesce("problem", "_shape"))
    )
    return found.withColumns({
        "problem": problem,
        "encoding": F.coalesce("encoding", F.lit("utf-8")),
        "line_ending": F.coalesce("line_ending", F.lit("LF")),
    }).drop("_shape", "_parsed")


def json_items(spark: SparkSession, raw_dir: str, hashed_bytes: int = HASHED_BYTES) -> DataFrame:
    """Compact item summary of the category documents. A document too large to parse fails the job."""
    too_large = list_files(spark, raw_dir, JSON_PATTERN).filter(F.col("size_bytes") > hashed_bytes)
    if not too_large.isEmpty():
        raise LandingError(f"category document over {hashed_bytes} bytes: {too_large.first().file}")
    parsed = read_files(spark, raw_dir, JSON_PATTERN, hashed_bytes).select(
        "file", F.explode(F.from_json(F.col("content").cast("string"), CATEGORY_FILE).getField("items")).alias("item")
    )
    return parsed.select(
        "file",
        F.col("item.id").alias("id"),
        F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.assignable").alias("assignable"),
    )


def audit_report(
    spark: SparkSession,
    raw_dir: str,
    regions: Sequence[str] = REGIONS,
    strict: bool = False,
    hashed_bytes: int = HASHED_BYTES,
) -> DataFrame:
    """One row per found or missing file: status, verdict (ok, warn or fail) and facts.

    A missing file fails; an extra one is a warning, or a failure under `strict`. Extra files are not
    judged on their structure.
    """
    return judged(expected_files(spark, regions), audit_files(spark, raw_dir, hashed_bytes), strict)


def judged(expected: DataFrame, facts: DataFrame, strict: bool = False) -> DataFrame:
    """The report from the expected names (file) and the facts of the files found (file, problem, ...)."""
    whole = F.regexp_replace("file", _PART_NUMBER, "$1").alias("_whole")
    facts = facts.withColumn("_whole", whole)
    status = presence(expected, facts.select(F.col("_whole").alias("file")))
    verdict = (
        F.when(F.col("status") == "missing", "fail")
        .when(F.col("status") == "extra", "fail" if strict else "warn")
        .when(F.col("problem").isNotNull(), "fail")
        .otherwise("ok")
    )
    named = status.withColumnRenamed("file", "_whole").join(facts, "_whole", "left")
    return named.withColumn("file", F.coalesce("file", "_whole")).withColumn("verdict", verdict).drop("_whole")


def audit_totals(report: DataFrame) -> DataFrame:
    """Files and bytes per type."""
    return report.filter(F.col("type").isNotNull()).groupBy("type").agg(
        F.count("*").alias("n_files"), F.sum("size_bytes").alias("total_bytes")
    )


def require_sound(report: DataFrame) -> None:
    """Raise if a file fails, with the first of them and how many there are; `report` has one row per file."""
    failed = report.filter(F.col("verdict") == "fail").select("file", "status", "problem")
    number = failed.count()
    if number:
        shown = "; ".join(f"{r.file}: {r.problem or r.status}" for r in failed.orderBy("file").take(20))
        raise LandingError(shown + (f"; {number} files in all, see the audit report" if number > 20 else ""))


def compare_manifest(report: DataFrame, manifest: DataFrame, trees: DataFrame | None = None) -> DataFrame:
    """Files against a manifest (file, size_bytes, sha256, perhaps tree_sha256): ok, size differs, hash differs, not hashed, missing, unlisted.

    Files that have both trees, found (`trees`) and listed, are compared by them; the others by the hash of the whole file.
    """
    nothing = F.lit(None).cast("string")
    tree = F.col("tree_sha256") if "tree_sha256" in manifest.columns else nothing
    listed = manifest.select("file", F.col("size_bytes").alias("_size"), F.col("sha256").alias("_hash"), tree.alias("_tree"))
    found = report.filter(F.col("size_bytes").isNotNull()).select("file", "size_bytes", "sha256")
    found = found.withColumn("tree", nothing) if trees is None else found.join(trees.withColumnRenamed("tree_sha256", "tree"), "file", "left")
    same_tree = F.col("tree") == F.col("_tree")  # NULL unless both are there
    result = (
        F.when(F.col("size_bytes").isNull(), "missing")
        .when(F.col("_size").isNull(), "unlisted")
        .when(F.col("size_bytes") != F.col("_size"), "size differs")
        .when(same_tree, "ok")
        .when(~same_tree, "hash differs")
        .when(F.col("sha256").isNull(), "not hashed")
        .when(~F.col("sha256").eqNullSafe(F.col("_hash")), "hash differs")
        .otherwise("ok")
    )
    return found.join(listed, "file", "full_outer").select("file", result.alias("result"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Flat (file, size_bytes, sha256, tree_sha256) rows of a JSON manifest with a csv and a json entry per region."""
    entry = "struct<name: string, sha256: string, size_bytes: bigint, tree_sha256: string>"
    document = spark.read.schema(f"files array<struct<csv: {entry}, json: {entry}>>").json(path, multiLine=True)
    files = document.select(F.explode("files").alias("f")).select(F.explode(F.array("f.csv", "f.json")).alias("e"))
    return files.select(F.col("e.name").alias("file"), F.col("e.size_bytes"), F.col("e.sha256"), F.col("e.tree_sha256"))
