"""CSV records of files of any size, read in splits.

A quoted field may hold line breaks, so Spark reads a multi-line CSV file in one task. Here each file is read as
lines, in as many splits as it has:

1. Each split is walked once under either assumption, that its start lies outside or inside a quoted field. Only lines
   with a quote can change the side, so only these go to Python. That gives one row of a few bytes per split, whatever
   the split holds: the side at its end under each assumption, and whether a record may fill it.
2. These rows are composed per file and tell where each split really starts. They are kept in the shared folder.
3. The second scan cuts every split into the records that lie within it. Lines are not shuffled, unless there are too many
   splits to broadcast their rows; then the lines of a split are brought together and sorted by their number.
4. Splits with a border inside a record are read once more, and only the pieces at such borders are shuffled, to the
   record that they belong to. A file without quotes has none.

A record is unclosed if its file ends inside it. Its lines are kept one by one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.operators.relational import BROADCAST_ROW_LIMIT
from snapmart.sources.files import settled
from snapmart.workers import map_batches

# positions in a CSV record: start of a field, in a bare field, in a quoted one, after a quote in a quoted one
_FIELD, _BARE, _QUOTED, _CLOSING = range(4)
_AFTER_QUOTE = (_QUOTED, _BARE, _CLOSING, _QUOTED)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted field when it starts inside or outside one.

    A quote opens a field only at its start; in a quoted field two in a row are one character.
    """
    if '"' not in line:
        return inside
    state = _QUOTED if inside else _FIELD
    for number, text in enumerate(line.split('"')):
        if number:
            state = _AFTER_QUOTE[state]
        if text and state != _QUOTED:
            state = _FIELD if text[-1] == "," else _BARE
    return state == _QUOTED


def _lines(spark: SparkSession, raw_dir: str, pattern: str) -> DataFrame:
    scan = spark.read.option("lineSep", "\n").option("pathGlobFilter", pattern).text(raw_dir)
    return scan.select(
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.make_valid_utf8("value").alias("value"),
    )


class _Walk:
    """The state of a walk through the lines of a split: only those of a record that is still open are held."""

    def __init__(self, inside: bool):
        self.inside = inside
        #: whether the lines still belong to the record that was open at the start
        self.before = inside
        #: the lines of the record that is open here
        self.open: list[str] = []

    def records(self, lines: list[str]) -> Iterator[str]:
        """The records that start in the split and end in these lines."""
        for line in lines:
            self.inside = ends_inside(line, self.inside)
            if self.before:
                self.before = self.inside
            elif self.inside:
                self.open.append(line)
            elif self.open:
                yield "\n".join([*self.open, line])
                self.open = []
            else:
                yield line


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list, bool, list[str]]]:
    """The first `keys` columns of a split, whether it starts here, and some of its lines, in order; a scan task yields a
    split's lines together. The path is the first of these columns and the block's start the third."""
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        path, block = batch.column(0).dictionary_encode(), batch.column(2).to_numpy()
        file = path.indices.to_numpy()
        starts = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1).tolist()]
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            split = [batch.column(k)[a].as_py() for k in range(keys)]
            yield split, split != now, batch.column(keys).slice(a, b - a).to_pylist()
            now = split


def _effects(lines: DataFrame) -> DataFrame:
    """One row of fixed width per split: the side at its end (true: inside) from either side at its start, and whether
    a record that is open at the start fills it. The first split of a file has the first line too.
    """
    value = F.col("value")
    telling = lines.select("_path", "_block", F.when((F.col("_block") == 0) | value.contains('"'), value).alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, row = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            path, block = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
            file = path.indices.to_numpy()
            starts = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1).tolist()]
            shown = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            texts, until = batch.column(2).filter(pa.array(shown)).to_pylist(), np.cumsum(shown)
            for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                mine = texts[until[a - 1] if a else 0 : until[b - 1]]
                if (split := (path.dictionary[int(file[a])].as_py(), int(block[a]))) != now:
                    if now is not None:
                        yield pa.RecordBatch.from_pylist([row], schema=schema)
                    now, row = split, {"_path": split[0], "_block": split[1], "_first": mine[0] if split[1] == 0 else None, "_end_out": False, "_end_in": True, "_whole_in": True}
                for line in mine:
                    row["_end_out"], row["_end_in"] = ends_inside(line, row["_end_out"]), ends_inside(line, row["_end_in"])
                    row["_whole_in"] &= row["_end_in"]
        if now is not None:
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema([("_path", pa.string()), ("_block", pa.int64()), ("_first", pa.string()), *((n, pa.bool_()) for n in ("_end_out", "_end_in", "_whole_in"))])
    return map_batches(telling, run, "_path string, _block long, _first string, _end_out boolean, _end_in boolean, _whole_in boolean")


def _placed(effects: DataFrame) -> DataFrame:
    """Splits with the side at their start, the record open there, and whether one of their borders is inside a record.

    Seen as a function of the side at its start, a split keeps the side, swaps it, or forces one. The side before
    a split is then the last forced side, swapped once per later swapping split. The windows run over the
    splits of one file.
    """
    file = Window.partitionBy("_path").orderBy("_block")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    through = file.rowsBetween(Window.unboundedPreceding, 0)
    out, in_ = F.col("_end_out"), F.col("_end_in")
    swaps = F.sum(F.when(out & ~in_, 1).otherwise(0)).over(through)
    df = effects.withColumn("_swaps", swaps)
    mark = F.when(out == in_, F.struct(out.alias("side"), F.col("_swaps").alias("at")))
    df = df.withColumn("_mark", F.last(mark, ignorenulls=True).over(before))
    since = F.coalesce(F.lag("_swaps").over(file), F.lit(0)) - F.coalesce("_mark.at", F.lit(0))
    df = df.withColumn("_inside", F.coalesce("_mark.side", F.lit(False)) != (since % 2 == 1))
    df = df.withColumns({"_end": F.when(F.col("_inside"), in_).otherwise(out), "_whole": F.col("_inside") & F.col("_whole_in")})
    # a record is named by the split in which it starts
    record = F.last(F.when(~F.col("_whole"), F.col("_block")), ignorenulls=True)
    all_ = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumns({
        "_open": record.over(before),
        "_lost": F.when(F.last("_end").over(all_), record.over(all_)),
        "_header": F.first("_first").over(all_),
        "_crossed": F.col("_inside") | F.col("_end"),
    })
    return df.select("_path", "_block", "_inside", "_open", "_lost", "_header", "_crossed")


def _started(lines: DataFrame, starts: DataFrame, max_rows: int) -> DataFrame:
    """The lines with the row of their split, those of a split together and in order."""
    if starts.limit(max_rows + 1).count() <= max_rows:
        return lines.join(F.broadcast(starts), ["_path", "_block"])
    # one scan task reads a split, so its lines are numbered in order; no join promises to keep that order
    numbered = lines.withColumn("_number", F.monotonically_increasing_id())
    return numbered.join(starts, ["_path", "_block"]).repartition("_path", "_block").sortWithinPartitions("_path", "_block", "_number")


def _without_returns(record: str) -> str:
    """A carriage return before a line break or at the end belongs to the line end."""
    return "\n".join(x.removesuffix("\r") for x in record.split("\n")) if "\r" in record else record


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that start and end in a split, without the header."""
    for (_, name, block, inside, _, _, first_line), new, lines in _runs(batches, 7):
        if new:
            walk, header = _Walk(inside), block == 0 and not inside
        records = list(walk.records(lines))
        if header and records:
            records, header = records[1:], False
        if first_line.endswith("\r"):
            records = map(_without_returns, records)
        records = [r for r in records if r]
        if records:
            yield pa.RecordBatch.from_pydict({"_source_file": pa.array([name] * len(records), pa.string()), "line": pa.array(records, pa.string())})


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of a split that belong to records over its borders; those of an unclosed record line by line."""

    def found(split: list, walk: _Walk, head: list[str]) -> pa.RecordBatch:
        path, name, block, inside, open_, lost, first_line = split
        pieces = [(open_, "\n".join(head))] if inside else []
        if walk.open:
            pieces.append((block, "\n".join(walk.open)))
        rows = []
        for record, text in pieces:
            text = _without_returns(text) if first_line.endswith("\r") else text
            rows += [(record, k, line, True) for k, line in enumerate(text.split("\n")) if line] if record == lost else [(record, -1, text, False)]
        of, number, text, unclosed = zip(*rows, strict=True) if rows else ((), (), (), ())
        same = lambda x, kind, n=len(rows): pa.array([x] * n, kind)
        return pa.RecordBatch.from_arrays(
            [same(path, pa.string()), same(name, pa.string()), same(block, pa.int64()), pa.array(of, pa.int64()), pa.array(number, pa.int32()), pa.array(text, pa.string()), pa.array(unclosed, pa.bool_())],
            names=["_path", "_source_file", "_block", "_record", "_number", "piece", "_unclosed"],
        )

    now, walk, head = None, None, []
    for split, new, lines in _runs(batches, 7):
        if new:
            if now is not None:
                yield found(now, walk, head)
            now, walk, head = split, _Walk(split[3]), []
        k = 0
        while walk.before and k < len(lines):
            head.append(lines[k])
            for _ in walk.records(lines[k : k + 1]):
                pass
            k += 1
        for _ in walk.records(lines[k:]):
            pass
    if now is not None:
        yield found(now, walk, head)


def read_records(spark: SparkSession, raw_dir: str, pattern: str, header: Sequence[str], max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """(_source_file, line, _unclosed): every record but the headers, as CSV text with LF for line breaks inside.

    Line ends are CRLF where the header's is, else LF. A record that the end of its file leaves open is returned
    line by line with `_unclosed` true, so no text is lost and no task holds it whole. Blank lines between
    records are skipped. A file whose first line is not `header` fails the job.
    """
    lines = _lines(spark, raw_dir, pattern)
    placed = _placed(_effects(lines))
    names = F.regexp_replace("_header", '["\r]', "")
    drift = F.raise_error(F.concat_ws(": ", F.lit("header drift"), F.element_at(F.split("_path", "/"), -1), names)).cast("boolean")
    starts = settled(placed.filter(F.when(names == ",".join(header), True).otherwise(drift)))  # one row per split
    columns = ["_path", "_source_file", "_block", "_inside", "_open", "_lost", "_header", "value"]
    within = map_batches(_started(lines, starts.drop("_crossed"), max_rows).select(*columns), _within, "_source_file string, line string")
    crossed = _started(lines, starts.filter("_crossed").drop("_crossed"), max_rows).select(*columns)
    pieces = map_batches(crossed, _pieces, "_path string, _source_file string, _block long, _record long, _number int, piece string, _unclosed boolean")
    in_order = F.array_sort(F.collect_list(F.struct("_block", "piece")))
    # a lost line has a key of its own: only the pieces of one record meet
    own = F.when(F.col("_unclosed"), F.col("_block"))
    crossing = (
        pieces.groupBy("_path", "_source_file", "_record", "_number", "_unclosed", own.alias("_own"))
        .agg(F.array_join(F.transform(in_order, lambda p: p["piece"]), "\n").alias("line"))
        .select("_source_file", "line", "_unclosed")
    )
    return within.withColumn("_unclosed", F.lit(False)).unionByName(crossing)
