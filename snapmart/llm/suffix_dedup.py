"""Removal of repeated byte strings by a distributed difference-cover suffix array.

A byte goes if a string of `length` bytes that covers it also starts anywhere else, in any text. Strings are judged
on the input, and never cross a text's ends. Equal strings have to meet in one place to be sorted, without
gathering the corpus:

1. Dealing. The smallest hash of the 32-byte strings inside a string of `length` bytes depends on its content only, so
   equal strings have equal smallest hashes. Runs of starts with one smallest hash are a stretch of text; a
   hash that occurs once in the whole corpus can't belong to a repeated string, and its stretch drops
   out. Equal texts are one text with a count.
2. Sorting. All stretches with one hash come to one task, equal ones as one with a count, and a suffix array is built
   over them by the difference-cover algorithm: suffixes at places not divisible by three are sorted by their
   triples, by recursion on the triples' names where these aren't distinct; the rest are sorted by their first
   symbol and the rank behind it; both are merged.
3. Comparing. Neighbours in the suffix array that share a prefix of `length` bytes mark each other's starts.
4. The marked spans go back to the texts, are united, and removed.

A hash with very many different stretches (a common passage whose surroundings differ) isn't given to one task: its
strings of `length` bytes are counted by 128-bit hashes, dealt into buckets of a bounded size.

Cases: a null text is empty; texts shorter than `length` lose nothing; repeated rows repeat each other, so all their
strings go; an empty table gives an empty one; runs of one byte make stretches that are cut after `STRETCH` starts;
removal is by bytes and may cut a character, so `kept` is binary; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.llm.common import chunks, col, map_batches, release_tables, shared_folder, staged, text_table, with_text

LENGTH = 200
#: Bytes of the strings whose smallest hash deals out longer ones.
GRAM = 32
#: Starts in one stretch.
STRETCH = 1024
#: Bytes sorted at a time; different stretches of one hash that one task takes (about 300 bytes each).
TOGETHER, CROWD = 3 << 18, 2048
#: Bytes of stretches that a task remembers, to send equal ones once.
SEEN = 32 << 20


# --- dealing ---


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _loads(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, big-endian; beyond the end 0."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(text)]
    return out


def _slide(x: np.ndarray, width: int, of) -> np.ndarray:
    """`of` (np.minimum or np.maximum) over each `width` neighbours."""
    have = 1
    while have * 2 <= width:
        x, have = of(x[:-have], x[have:]), have * 2
    return of(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """63-bit hashes of the strings of GRAM bytes at each place."""
    h, size = _mix(_loads(text)[: len(text) - 7]), 8
    while size < GRAM:
        h, size = _mix(h[:-size] * np.uint64(3) + h[size:]), size * 2
    return (h >> np.uint64(1)).astype(np.int64)


def stretches(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Runs of starts of strings with one smallest hash: number of the text, first and last start in it, hash, and
    whether the hash occurs in the run more than once (as in periodic text), so that it may hold equal strings."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    none = np.empty(0, np.int64)
    if sizes.sum() < length:
        return none, none, none, none, none.astype(bool)
    grams, width = gram_hashes(np.frombuffer(b"".join(texts), np.uint8)), length - GRAM + 1
    smallest = _slide(grams, width, np.minimum)
    place = np.arange(len(smallest))
    owner = np.searchsorted(ends, place, "right")
    inside = place + length <= ends[owner]
    place, owner, least = place[inside], owner[inside], smallest[inside]
    if not len(place):
        return none, none, none, none, none.astype(bool)
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])])
    at = np.arange(len(place))
    run = np.maximum.accumulate(np.where(new, at, 0))
    new |= (at - run) % STRETCH == 0
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(place)]]) - 1
    h, lo, hi = least[first], place[first], place[last]
    # places whose hash is the smallest of some string; the last two of them in the run with the run's hash
    edge = np.full(width - 1, -1, np.int64)
    chosen = np.flatnonzero(_slide(np.concatenate([edge, smallest, edge]), width, np.maximum) == grams)
    values, number = np.unique(grams[chosen], return_inverse=True)
    keys = np.sort(number * (len(grams) + 1) + chosen)
    base = np.searchsorted(values, h) * (len(grams) + 1)
    before = np.searchsorted(keys, base + hi + width - 1, "right") - 2
    again = (before >= 0) & (keys[np.maximum(before, 0)] >= base + lo)
    start = (ends - sizes)[owner[first]]
    return owner[first], lo - start, hi - start, h, again


# --- sorting ---


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Places in the order of their suffixes, by the difference cover {1, 2} modulo 3; symbols are below 2 ** 20."""
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    s = np.concatenate([symbols + 1, [0, 0, 0]]).astype(np.int64)
    bits = int(s.max()).bit_length()
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)  # one place beyond the end keeps the halves apart
    sample = np.concatenate([ones, twos])
    key = (s[sample] << (2 * bits)) | (s[sample + 1] << bits) | s[np.minimum(sample + 2, n + 2)]
    order = np.argsort(key)
    step = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
    names = np.empty(len(sample), np.int64)
    names[order] = step
    if step[-1] + 1 < len(sample):
        order = suffix_array(names)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sorted_sample = sample[order]
    sorted_sample = sorted_sample[sorted_sample < n]
    wide = int(len(sample) + 1).bit_length()
    zeros = np.arange(0, n, 3)
    zeros = zeros[np.argsort((s[zeros] << wide) | rank[zeros + 1])]
    # how many of the rest come before each sampled suffix
    is_one = sorted_sample % 3 == 1
    before = np.empty(len(sorted_sample), np.int64)
    one, two = sorted_sample[is_one], sorted_sample[~is_one]
    before[is_one] = np.searchsorted((s[zeros] << wide) | rank[zeros + 1], (s[one] << wide) | rank[one + 1])
    by_two = lambda i: (((s[i] << bits) | s[i + 1]) << wide) | rank[i + 2]
    before[~is_one] = np.searchsorted(by_two(zeros), by_two(two))
    out = np.empty(n, np.int64)
    taken = np.arange(len(sorted_sample)) + before
    out[taken] = sorted_sample
    free = np.ones(n, bool)
    free[taken] = False
    out[free] = zeros
    return out


# --- comparing ---


def repeated_starts(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each of these different stretches whether the string at each of its starts also starts elsewhere among them."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    symbols = joined.astype(np.int64)
    symbols[begins + sizes] = 256 + np.arange(len(texts))  # each end is a symbol of its own
    begins_there = np.zeros(len(joined), bool)
    for b, n in zip(begins, sizes, strict=True):
        begins_there[b : b + n - length + 1] = True
    order = suffix_array(symbols)
    order = order[begins_there[order]]
    i, j = order[:-1], order[1:]
    same = np.arange(len(i))
    loads = _loads(joined)
    for at in sorted({*range(0, length - 7, 8), length - 8}, reverse=True):
        same = same[loads[i[same] + at] == loads[j[same] + at]]
    marked = np.zeros(len(joined), bool)
    marked[i[same]] = marked[j[same]] = True
    return [marked[b : b + n - length + 1] for b, n in zip(begins, sizes, strict=True)]


def _spans(marked: np.ndarray, length: int) -> np.ndarray:
    """Pairs (from, to) of the bytes that strings at the marked starts cover."""
    at = np.flatnonzero(marked)
    if not len(at):
        return np.empty((0, 2), np.int32)
    cut = np.flatnonzero(np.diff(at) > length)
    return np.stack([at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])] + length], axis=1).astype(np.int32)


# --- Spark ---


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[range, list[bytes]]]:
    """Rows of a batch, about a quarter of a megabyte of text at a time."""
    values = batch.column(column).cast(pa.binary())
    rows, size = [], 0
    for k in range(batch.num_rows):
        rows.append(values[k].as_py() or b"")
        size += len(rows[-1])
        if size > 1 << 18 or k + 1 == batch.num_rows:
            yield range(k + 1 - len(rows), k + 1), rows
            rows, size = [], 0


def _hashes_of(docs: DataFrame, length: int) -> DataFrame:
    """key, hashes: the smallest hashes of each text's stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in batches:
            for rows, texts in _texts(batch, 1):
                owner, _, _, h, again = stretches(texts, length)
                owner, h = np.repeat(owner, again + 1), np.repeat(h, again + 1)  # one that occurs twice counts twice
                offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(rows[0], len(rows)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(h))], names=["key", "hashes"])

    return map_batches(docs, run, "key binary, hashes array<long>")


def _occurrences(texts: DataFrame, length: int) -> DataFrame:
    """From key, copies, text, hashes: a row (stretch, key, at) for each stretch with one of the hashes, and a row
    (h, stretch, copies, bytes) for each stretch that this task hasn't sent yet, with its copies so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        schema = pa.schema([("stretch", pa.binary()), ("key", pa.binary()), ("at", pa.int32()), ("h", pa.int64()), ("copies", pa.int64()), ("bytes", pa.binary())])
        seen: dict[bytes, list] = {}
        size = 0

        def sent() -> pa.RecordBatch:
            n = len(seen)
            h, copies, found = ([x[k] for x in seen.values()] for k in range(3))
            return pa.RecordBatch.from_arrays(
                [pa.array(seen, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()), pa.array(h, pa.int64()), pa.array(copies, pa.int64()), pa.array(found, pa.binary())], schema=schema
            )

        for batch in batches:
            keys, copies, wanted = batch.column(0), batch.column(1).to_pylist(), batch.column(3)
            for rows, group in _texts(batch, 2):
                owner, first, last, h, _ = stretches(group, length)
                want = [(o, w) for o, k in enumerate(rows) for w in wanted[k].as_py()]
                pair = np.array(sorted(want), np.int64).reshape(-1, 2)
                asked = np.zeros(len(h), bool)
                bounds, wants = np.searchsorted(owner, np.arange(len(group) + 1)), np.searchsorted(pair[:, 0], np.arange(len(group) + 1))
                for o in range(len(group)):
                    asked[bounds[o] : bounds[o + 1]] = np.isin(h[bounds[o] : bounds[o + 1]], pair[wants[o] : wants[o + 1], 1])
                ids, owners, ats = [], [], []
                for o, a, b, x in zip(owner[asked].tolist(), first[asked].tolist(), last[asked].tolist(), h[asked].tolist(), strict=True):
                    found = group[o][a : b + length]
                    name = xxhash.xxh3_128_digest(found)
                    ids.append(name)
                    owners.append(rows[0] + o)
                    ats.append(a)
                    if name in seen:
                        seen[name][1] += copies[rows[0] + o]
                    else:
                        seen[name] = [x, copies[rows[0] + o], found]
                        size += len(found)
                n = len(ids)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.binary()), keys.take(pa.array(owners)), pa.array(ats, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], schema=schema
                    )
                if size > SEEN:
                    yield sent()
                    seen.clear()
                    size = 0
        if seen:
            yield sent()

    return map_batches(texts, run, "stretch binary, key binary, at int, h long, copies long, bytes binary")


def _marked(stretch_rows: DataFrame, length: int) -> DataFrame:
    """stretch, spans (pairs of 32-bit numbers) from rows h, stretch, copies, bytes in the order of h and stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(group: list[list]) -> pa.RecordBatch:
            marks = repeated_starts([g[2] for g in group], length)
            spans = [np.array([[0, len(g[2])]], np.int32) if g[1] > 1 else _spans(m, length) for g, m in zip(group, marks, strict=True)]
            some = [(g[0], x.tobytes()) for g, x in zip(group, spans, strict=True) if len(x)]
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in some], pa.binary()), pa.array([x for _, x in some], pa.binary())], names=["stretch", "spans"])

        group, size, now = [], 0, None
        for batch in batches:
            for h, name, copies, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if h != now and size > TOGETHER:
                    yield done(group)
                    group, size = [], 0
                now = h
                if group and group[-1][0] == name:
                    group[-1][1] += copies
                else:
                    group.append([name, copies, found])
                    size += len(found)
        if group:
            yield done(group)

    dealt = stretch_rows.select("h", "stretch", "copies", "bytes").repartition("h").sortWithinPartitions("h", "stretch")
    return map_batches(dealt, run, "stretch binary, spans binary")


def string_hashes(text: np.ndarray, length: int, seed: int) -> np.ndarray:
    """64-bit hashes of the strings of `length` bytes at each place."""
    h, size = _mix(_loads(text)[: len(text) - 7] ^ np.uint64(seed)), 8
    while size < length:
        step = min(size, length - size)
        h, size = _mix(h[: len(h) - step] * np.uint64(3) + h[step:]), size + step
    return h


#: A string of a crowded hash: its 128-bit hash, the stretch, the start in it, and the copies of the stretch (2: more).
_STRING = np.dtype([("a", "<u8"), ("b", "<u8"), ("stretch", "<u8", 2), ("at", "<i4"), ("copies", "<i4")])


def _counted(stretch_rows: DataFrame, length: int, buckets: int) -> DataFrame:
    """As `_marked`, for crowded hashes: their strings of `length` bytes are dealt by 128-bit hashes into buckets of a
    bounded size, packed as arrays, and counted there."""
    whole = stretch_rows.groupBy("h", "stretch").agg(F.sum("copies").alias("copies"), F.first("bytes").alias("bytes"))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in chunks(zip(*(c.to_pylist() for c in batch.columns), strict=True), 512):
                sizes = np.array([len(found) for *_, found in rows])
                text = np.frombuffer(b"".join(found for *_, found in rows), np.uint8)
                begins = np.cumsum(sizes) - sizes
                owner = np.repeat(np.arange(len(rows)), sizes - length + 1)
                at = np.concatenate([np.arange(n - length + 1) for n in sizes])
                strings = np.empty(len(owner), _STRING)
                strings["a"], strings["b"] = (string_hashes(text, length, seed)[begins[owner] + at] for seed in (1, 2))
                strings["stretch"] = np.frombuffer(b"".join(name for name, *_ in rows), "<u8").reshape(-1, 2)[owner]
                strings["at"], strings["copies"] = at, np.array([min(copies, 2) for _, copies, _ in rows])[owner]
                bucket = (strings["a"] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                parts = np.split(order, cuts)
                yield pa.RecordBatch.from_arrays([pa.array(bucket[order[np.concatenate([[0], cuts])]]), pa.array([strings[p].tobytes() for p in parts], pa.binary())], names=["bucket", "strings"])

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(blobs: list[bytes]) -> pa.RecordBatch:
            strings = np.frombuffer(b"".join(blobs), _STRING)
            order = np.lexsort((strings["b"], strings["a"]))
            a, b, copies = strings["a"][order], strings["b"][order], strings["copies"][order]
            same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
            found = strings[order[np.concatenate([[False], same]) | np.concatenate([same, [False]]) | (copies > 1)]]
            found = found[np.lexsort((found["stretch"][:, 1], found["stretch"][:, 0]))]
            cuts = np.flatnonzero((found["stretch"][1:] != found["stretch"][:-1]).any(axis=1)) + 1
            parts = [p for p in np.split(found, cuts) if len(p)]
            return pa.RecordBatch.from_arrays([pa.array([p["stretch"][0].tobytes() for p in parts], pa.binary()), pa.array([p["at"].astype("<i4").tobytes() for p in parts], pa.binary())], names=["stretch", "at"])

        now, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now and blobs:
                    yield done(blobs)
                    blobs = []
                now = bucket
                blobs.append(blob)
        if blobs:
            yield done(blobs)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column(1).to_pylist():
                at = np.frombuffer(b"".join(parts), "<i4")
                marked = np.zeros(int(at.max()) + 1, bool)
                marked[at] = True
                out.append(_spans(marked, length).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["stretch", "spans"])

    packed = map_batches(whole.select("stretch", "copies", "bytes"), dealt, "bucket long, strings binary")
    found = map_batches(packed.repartition("bucket").sortWithinPartitions("bucket"), repeated, "stretch binary, at binary")
    own = found.groupBy("stretch").agg(F.collect_list("at").alias("at"))  # at most STRETCH starts
    return map_batches(own, spans, "stretch binary, spans binary")


def text_key(text: Column) -> Column:
    """128 bits of a text's SHA-256."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def repeated_spans(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """key (see `text_key`) and spans (array of from, to; not united) of every text with repeated strings."""
    folder = shared_folder(docs.sparkSession)
    keyed = text_table(docs, text).select(text_key(col(text)).alias("key"), col(text).alias("text")).filter(F.octet_length("text") >= length)
    hashes = _hashes_of(keyed, length).groupBy("key").agg(F.count("*").alias("copies"), F.first("hashes").alias("hashes"))
    hashes = staged(hashes.withColumn("id", F.monotonically_increasing_id()), folder, "hashes")
    single = hashes.select("id", "copies", F.explode("hashes").alias("h"))
    several = single.groupBy("h").agg(F.sum("copies").alias("n")).filter("n > 1").select("h")
    wanted = single.select("id", "h").join(several, "h").groupBy("id").agg(F.collect_set("h").alias("hashes"))
    wanted = staged(wanted.join(hashes.select("id", "key", "copies"), "id").select("key", "copies", "hashes"), folder, "wanted")
    texts = keyed.join(wanted, "key").dropDuplicates(["key"]).select("key", "copies", "text", "hashes")
    found = staged(_occurrences(texts, length), folder, "stretches")
    stretch_rows = found.filter("h IS NOT NULL")
    crowded = staged(stretch_rows.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD), folder, "crowded")
    marked = _marked(stretch_rows.join(crowded, "h", "left_anti"), length)
    crowd = crowded.agg(F.sum("n")).first()[0]
    if crowd:
        marked = marked.unionByName(_counted(stretch_rows.join(crowded, "h", "left_semi"), length, -(-crowd // CROWD)))
    marked = staged(marked, folder, "marked")
    places = found.filter("key IS NOT NULL").select("stretch", "key", "at").join(marked, "stretch")

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [(np.frombuffer(x, np.int32) + at).tobytes() for at, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.binary())], names=["key", "spans"])

    own = map_batches(places.select("key", "at", "spans"), moved, "key binary, spans binary")
    return staged(own.groupBy("key").agg(F.collect_list("spans").alias("spans")), folder, "spans")  # of one text


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` with n_bytes, n_removed, n_spans and kept (the remaining bytes)."""
    spans = repeated_spans(docs, length, text)
    source = with_text(docs, keep, text)
    kinds = source.schema.fields[:-1]
    rows = source.withColumn("key", text_key(F.col("_text")))
    joined = rows.join(spans, "key", "left").select(*[f.name for f in kinds], "_text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(len(keep)).cast(pa.binary()), batch.column(len(keep) + 1)
            out = []
            for k in range(batch.num_rows):
                whole, parts = texts[k].as_py() or b"", found[k].as_py()
                if parts is None:
                    out.append((len(whole), 0, 0, whole))
                    continue
                pairs = np.frombuffer(b"".join(parts), np.int32).reshape(-1, 2)
                change = np.bincount(pairs[:, 0], minlength=len(whole) + 1) - np.bincount(pairs[:, 1], minlength=len(whole) + 1)
                gone = np.cumsum(change[:-1]) > 0
                left = np.frombuffer(whole, np.uint8)[~gone]
                out.append((len(whole), int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), left.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *[pa.array([x[k] for x in out], pa.int64()) for k in range(3)], pa.array([x[3] for x in out], pa.binary())],
                names=[*[f.name for f in kinds], "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = T.StructType([*kinds, *[T.StructField(x, T.LongType()) for x in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept", T.BinaryType())])
    return map_batches(joined, run, schema).toDF(*keep, "n_bytes", "n_removed", "n_spans", "kept")
