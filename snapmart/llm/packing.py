"""Packing documents into sequences by a configuration linear program over the length histogram.

1. Every document is encoded and cut into pieces of at most `capacity` ids; a row per piece is written once, without
   its ids.
2. The histogram of piece lengths, at most `capacity` numbers whatever the input's size, goes to the driver. A
   configuration is a multiset of lengths that fits into one sequence. The linear program asks how often each
   configuration is used so that all pieces are covered by as few sequences as possible. It is solved by multiplicative
   weights: a length's price is itself times a weight, which falls exponentially with the share of its pieces that is
   covered already; the configuration of the highest price is found by knapsack dynamic programming, bounded by the
   pieces that are left, and is used until a share `STEP` of one of its lengths is covered by it.
3. Rounding: each configuration that fills a sequence is used the whole number of times below its value; what is left
   over, and what the program could only cover with room to spare, is packed by configurations around the longest length left, filled up as far as any of the lengths left allow (a knapsack
   dynamic programme over reachable sums).
4. Pieces are numbered within their length by one sort over ranges of the length, so that a length with a third of all
   pieces is spread over tasks. A configuration that is used m times takes m times its number of pieces from
   each length's numbering, so a piece finds its sequence and its place by a binary search in the table of
   configurations, which has at most a few rows per length.

Cases: a null or empty text has the end id only; a null doc_id is kept; repeated rows are packed each on its own; a text
of exactly `capacity` ids is one piece; only longer ones are cut, and the first piece is the shorter one; an empty table
gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import chunks, col, map_batches, shared_folder, staged, text_table
from snapmart.llm.token_files import encoder

CAPACITY = 2048
#: How fast a length's weight falls with the covered share of its pieces.
RATE = 0.5
#: A configuration is used until this share of the pieces of one of its lengths is covered by it.
STEP = 0.5
#: A knapsack looks at so many lengths that are least covered so far, and at as many spread over the others; if these
#: can't nearly fill a sequence, at all.
PRICED, NEARLY_FULL = 64, 0.99
#: Pieces of one length in a configuration that a knapsack prices, at most.
COPIES = 7
#: Configurations priced for each length in the histogram, at most; what they leave is rounded.
ROUNDS_PER_LENGTH = 8

#: A configuration: how many pieces of each length.
Configuration = dict[int, int]


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for each piece of each document."""
    source = text_table(docs, doc_id, text).select(col(doc_id).alias("doc_id"), col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for rows in chunks(range(batch.num_rows), 256):
                part = batch.slice(rows[0], len(rows))
                of, number, start, length, crc = [], [], [], [], []
                for k, ids in enumerate(coder.encode([t or "" for t in part.column(1).to_pylist()])):
                    ids += end
                    n, view = len(ids) // 4, memoryview(ids)
                    first = n % capacity or capacity
                    for i, at in enumerate([0, *range(first, n, capacity)]):
                        size = capacity if i else first
                        of.append(k)
                        number.append(i)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(view[4 * at : 4 * (at + size)]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(of, pa.int32())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_batches(source, run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_configuration(lengths: Sequence[int], most: Sequence[int], price: Sequence[float], capacity: int) -> tuple[Configuration, float]:
    """The configuration of the highest price, with at most `most` pieces of each length.

    Bounded knapsack: the copies of a length are items of 1, 2, 4, ... and the rest, each taken or not.
    """
    best, items, taken = np.zeros(capacity + 1), [], []
    for length, left, value in zip(lengths, most, price, strict=True):
        left, copies = min(left, capacity // length), 1
        while left:
            copies = min(copies, left)
            weight = length * copies
            with_it = best[: capacity + 1 - weight] + value * copies
            better = with_it > best[weight:]
            np.copyto(best[weight:], with_it, where=better)
            items.append((length, copies, weight))
            taken.append(better)
            left, copies = left - copies, copies * 2
    room, found = capacity, {}
    for (length, copies, weight), better in zip(reversed(items), reversed(taken), strict=True):
        if room >= weight and better[room - weight]:
            found[length] = found.get(length, 0) + copies
            room -= weight
    return found, float(best[capacity])


def solve_program(pieces_of: np.ndarray, capacity: int) -> list[tuple[float, Configuration]]:
    """How often each configuration is used, in fractions; no length is covered more than once.

    `pieces_of[length]` is a number of pieces. It ends when the lengths that aren't covered yet can't nearly fill a
    sequence among themselves: they are better packed in rounding, beside what the fractions leave of all lengths.
    """
    lengths = np.random.default_rng(0).permutation(np.flatnonzero(pieces_of))  # any fixed order: equally covered lengths take turns
    covered, used = np.zeros(capacity + 1), []
    for _ in range(ROUNDS_PER_LENGTH * len(lengths)):
        rest = lengths[covered[lengths] < 1 - 1e-9]
        if not len(rest):
            break
        rest = rest[np.argsort(covered[rest], kind="stable")]
        some = np.concatenate([rest[:PRICED], rest[PRICED :: max(1, len(rest) // PRICED)]])
        for asked in (some, rest) if len(some) < len(rest) else (rest,):
            asked = np.sort(asked)[::-1]
            most = np.minimum(COPIES, np.ceil(pieces_of[asked] * (1 - covered[asked]))).astype(np.int64)
            found, value = best_configuration(asked.tolist(), most.tolist(), (asked * np.exp(-RATE * covered[asked])).tolist(), capacity)
            if full := sum(s * a for s, a in found.items()) >= capacity * NEARLY_FULL:
                break
        if not full:
            break
        s = np.fromiter(found.keys(), np.int64)
        a = np.fromiter(found.values(), np.float64)
        times = float((np.minimum(STEP, 1 - covered[s]) * pieces_of[s] / a).min())
        covered[s] += a * times / pieces_of[s]
        used.append((times, found))
    return used


def fullest(longest: int, left: np.ndarray, capacity: int) -> Configuration:
    """One piece of the length `longest` and of others left as many as fill a sequence best.

    Knapsack over reachable sums: bit c of `sums` says that pieces seen so far, longest first, can fill c.
    """
    room, found, steps = capacity - longest, {longest: 1}, []
    sums, within = 1, (2 << (capacity - longest)) - 1
    for s in np.flatnonzero(left)[::-1].tolist():
        for _ in range(min(int(left[s]) - (s == longest), room // s)):
            more = (sums | sums << s) & within
            if more == sums:
                break
            steps.append((s, sums))
            sums = more
        if sums >> room & 1:
            break
    room = sums.bit_length() - 1
    for s, before in reversed(steps):
        if not before >> room & 1:
            found[s] = found.get(s, 0) + 1
            room -= s
    return found


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, Configuration]]:
    """Configurations and how often each is used, so that every piece of the histogram is in one sequence."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    result: list[tuple[int, Configuration]] = []

    def use(times: int, found: Configuration) -> None:
        if times:
            result.append((times, found))
            for s, a in found.items():
                left[s] -= times * a

    use(int(left[capacity]), {capacity: 1})  # whole sequences need no program
    for times, found in solve_program(left.astype(np.float64), capacity):
        if sum(s * a for s, a in found.items()) == capacity:
            use(int(times + 1e-9), found)
    while left.any():
        found = fullest(int(np.flatnonzero(left)[-1]), left, capacity)
        use(min(int(left[s]) // a for s, a in found.items()), found)
    return result


def _table(configurations: list[tuple[int, Configuration]]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Sorted keys (length, first number) with, for each, pieces per sequence, first sequence and offset."""
    rows, taken, sequence = [], {}, 0
    for times, found in configurations:
        offset = 0
        for s, a in found.items():
            rows.append((s, taken.get(s, 0), a, sequence, offset))
            taken[s] = taken.get(s, 0) + times * a
            offset += s * a
        sequence += times
    rows = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return rows[:, 0], dict(zip(("first", "each", "sequence", "offset"), rows[:, 1:].T, strict=True))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece."""
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    cut = staged(pieces(docs, tokenizer_path, end_id, capacity, doc_id, text), folder, "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    # numbered through: by length, and within a length in any order that the written table fixes
    tie = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())
    number = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = cut.withColumn("tie", tie).repartitionByRange(number, "length", "tie").sortWithinPartitions("length", "tie").drop("tie")
    ordered = staged(ordered.withColumn("at", F.monotonically_increasing_id()), folder, "ordered")
    task = F.shiftright("at", 33)
    tasks = sorted((r["task"], r["n"]) for r in ordered.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect())  # one row a task
    before = np.zeros(max((t for t, _ in tasks), default=0) + 1, np.int64)
    before[[t for t, _ in tasks]] = np.cumsum([0, *(n for _, n in tasks)])[:-1]
    first_of = np.zeros(capacity + 2, np.int64)
    for length, n in histogram.items():
        first_of[length + 1] = n
    first_of = np.cumsum(first_of)
    shared = spark.sparkContext.broadcast((before, first_of, *_table(pack_histogram(histogram, capacity))))  # bounded by `capacity` and the tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, first_of, of_length, table = shared.value
        # one sorted key from the length and the first number: the place of that number over all lengths
        keys = first_of[of_length] + table["first"]
        for batch in batches:
            at, length = batch.column("at").to_numpy(), batch.column("length").to_numpy()
            place = before[at >> 33] + (at & ((1 << 33) - 1))
            row = np.searchsorted(keys, place, "right") - 1
            within = place - keys[row]
            each = table["each"][row]
            sequence, offset = table["sequence"][row] + within // each, table["offset"][row] + within % each * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)
    return map_batches(ordered, run, f"{kinds}, sequence_id long, offset long")
