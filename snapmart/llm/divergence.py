"""Audit of how the sources of a language diverge in their terms, by a recount through minimal perfect hashes.

1. Exact frequency filtering: the documents of a language that hold a term are counted, per task first; terms in at
   least `least` documents are kept.
2. The kept terms of a language are dealt by a hash to shards of about `SHARD_TERMS`. A shard gets a minimal perfect
   hash: in each of several levels the terms left are thrown into a bit table, and those alone in their place stay
   there; the number of set bits before a place is the term's slot. Terms that no level parts have the last slots and
   are found by name. The terms themselves are stored in the order of their slots, so a lookup is verified.
3. The second pass over the documents: shards are broadcast, as many at a time as fit `BROADCAST_BYTES`; if the vocabulary
   is larger there are several passes. For each group (language and source) a task increments a dense array with a slot
   per term, and hands on the counts of each shard as packed numbers whenever its arrays reach `SLOTS`. Packed
   counts are added in streams, over salted keys first, so no task holds what a group has gathered.
4. For every shard, the sources of a language are compared in tiles of about `TILE`, on dense arrays, in 64-bit
   integers; sums over shards and ranks are DataFrame operations.

Quotients of 10^9 * x by y are formed in three steps of 10^3, so that 64-bit integers hold them exactly up to y =
9 * 10^15 (words of a group); beyond that Python's integers are used.

Cases: null text, language and source are ''; a language without kept terms has pairs with value 0 and no terms; a
source without terms counts as one with all counts 0; a language with one source has no pairs; repeated rows count
as documents each; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapmart.llm.common import col, map_batches, shared_folder, staged, text_table

#: Terms of a shard, about.
SHARD_TERMS = 4096
#: Bytes of perfect hashes and their terms that are broadcast at a time.
BROADCAST_BYTES = 48 << 20
#: Counters that a task holds at a time, 8 bytes each.
SLOTS = 8 << 20
#: Terms that a task counts before it hands them on.
COUNTED = 400_000
#: Sources compared at a time, about.
TILE = 48
#: Streams into which the packed counts of one group and shard are dealt before they meet.
SALTS = 32
#: Bits of a level per term left, and levels.
SPARE, LEVELS = 1.6, 24
BILLION = 10**9
_BASE = ["lang", "source"]
# letters lower-cased, other ASCII characters blank, bytes of longer characters as they are
_LETTERS = bytes(c if c >= 0x80 else (c | 0x20) if chr(c).isalpha() else 0x20 for c in range(256))
_STEP = [np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64) for k in range(LEVELS)]


def terms(text: bytes) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_LETTERS).split()


def _mixed(h: np.ndarray, level: int) -> np.ndarray:
    """Another hash for each level."""
    h = h ^ _STEP[level]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashes(found: list[bytes]) -> np.ndarray:
    """64-bit hashes, the same as Spark's xxhash64 of a string."""
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in found), np.uint64, len(found))


def perfect_hash(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Sizes of the levels, the bits of all levels, and the terms in the order of their slots (the last: those that no level parts)."""
    h, rest = hashes(found), np.arange(len(found))
    sizes, bits, order = np.zeros(LEVELS, np.int64), [], []
    for level in range(LEVELS):
        if not len(rest):
            break
        size = sizes[level] = max(16, int(len(rest) * SPARE))
        place = (_mixed(h[rest], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        bits.append(alone)
        stays = alone[place]
        kept = rest[stays]
        order.append(kept[np.argsort(place[stays])])
        rest = rest[~stays]
    order = np.concatenate([*order, rest]) if len(found) else rest
    return sizes, np.concatenate([np.zeros(0, bool), *bits]), [found[k] for k in order.tolist()]


class Shards:
    """Perfect hashes of several shards; all lookups of a batch are made together."""

    def __init__(self, rows: list[tuple[str, int, int, bytes, bytes, bytes, bytes]]):
        """rows: lang, shard, number of the language's shards, sizes of levels, bits, ends of the terms, terms."""
        self.number, self.keys, self.slot_count, self._of = {}, [], [], {}
        sizes, bits, ends, starts, self._rest = [], [], [], [0], {}
        for k, (lang, shard, number, size, bit, end, names) in enumerate(rows):
            self.number[lang] = number
            self._of[lang, shard] = k
            self.keys.append((lang, shard))
            size, end = np.frombuffer(size, "<i8"), np.frombuffer(end, "<i8")
            sizes.append(size)
            bits.append(np.unpackbits(np.frombuffer(bit, np.uint8), count=int(size.sum())).astype(bool))
            self.slot_count.append(len(end))
            ends.append(end + starts[-1])
            starts.append(starts[-1] + len(names))
            for slot in range(int(bits[-1].sum()), len(end)):  # as good as none
                self._rest[k, names[end[slot - 1] if slot else 0 : end[slot]]] = slot
        self._names = b"".join(r[6] for r in rows)
        self._size = np.array(sizes).reshape(-1, LEVELS)
        before = np.cumsum([0, *map(len, bits)])
        self._level = before[:-1, None] + np.cumsum(self._size, axis=1) - self._size
        self._bits = np.concatenate([np.zeros(0, bool), *bits])
        #: where a shard's slots begin among all; where each term ends among all names
        self.first = np.cumsum([0, *self.slot_count])
        self._ends = np.concatenate([np.zeros(0, np.int64), *ends])
        counted = np.cumsum(self._bits) - 1
        self._slot = counted - np.repeat(np.concatenate([[0], counted + 1])[before[:-1]], np.diff(before)) if len(counted) else counted

    def slots(self, lang: str, found: list[bytes]) -> np.ndarray:
        """The slot of each term among those of all shards; -1 if it isn't a kept term of these shards."""
        result = np.full(len(found), -1, np.int64)
        if lang not in self.number or not found:
            return result
        h, number = hashes(found), self.number[lang]
        of = np.array([self._of.get((lang, k), -1) for k in range(number)], np.int64)
        shard = of[h.view(np.int64) % number]  # as pmod of Spark's signed hash
        left = np.flatnonzero(shard >= 0)
        for level in range(LEVELS):
            if not len(left):
                break
            k = shard[left]
            size = self._size[k, level]
            left, k, size = left[size > 0], k[size > 0], size[size > 0]
            place = self._level[k, level] + (_mixed(h[left], level) % size.astype(np.uint64)).astype(np.int64)
            hit = self._bits[place]
            result[left[hit]] = self.first[k[hit]] + self._slot[place[hit]]
            left = left[~hit]
        if self._rest:
            for k in np.flatnonzero((result < 0) & (shard >= 0)).tolist():
                slot = self._rest.get((int(shard[k]), found[k]))
                if slot is not None:
                    result[k] = self.first[shard[k]] + slot
        there = np.flatnonzero(result >= 0)
        end = self._ends[result[there]]
        begin = np.where(result[there] > 0, self._ends[result[there] - 1], 0)
        names = self._names
        same = [names[i:j] == found[k] for k, i, j in zip(there.tolist(), begin.tolist(), end.tolist(), strict=True)]
        result[there[~np.array(same, bool)]] = -1
        return result


def _packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as their largest needs; the first byte says how many."""
    width = next(w for w in (1, 2, 4, 8) if counts.max(initial=0) < 1 << (8 * w - (w == 8)))
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _unpacked(packed: bytes | None, size: int) -> np.ndarray:
    return np.zeros(size, np.int64) if packed is None else np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """lang, term (binary) of the terms in at least `least` documents of their language. docs: lang, source, text (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, of in counts.items():
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(of), pa.string()), "term": pa.array(list(of), pa.binary()), "n": pa.array(list(of.values()), pa.int64())})
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[lang].update(set(terms(text)))
                if len(counts[lang]) > COUNTED or len(counts) > 1000:
                    yield from rows()
        yield from rows()

    counted = map_batches(docs.select("lang", "text"), run, "lang string, term binary, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("lang", "term")


def build_shards(kept: DataFrame) -> DataFrame:
    """lang, shard, shards (of the language), vocabulary (its kept terms), size (terms of the shard), and the perfect hash."""
    number = kept.groupBy("lang").agg(F.count("*").alias("vocabulary"))
    number = number.withColumn("shards", F.ceil(F.col("vocabulary") / SHARD_TERMS).cast("int"))
    dealt = kept.join(number, "lang").withColumn("shard", F.pmod(F.xxhash64(F.col("term").cast("string")), F.col("shards")).cast("int"))

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        sizes, bits, names = perfect_hash(sorted(rows["term"].to_pylist()))
        blob = lambda x: pa.array([x], pa.binary())
        return pa.table({
            "lang": rows["lang"][:1], "shard": rows["shard"][:1], "shards": rows["shards"][:1], "vocabulary": rows["vocabulary"][:1],
            "size": pa.array([len(names)], pa.int64()), "levels": blob(sizes.astype("<i8").tobytes()), "bits": blob(np.packbits(bits).tobytes()),
            "ends": blob(np.cumsum([len(t) for t in names]).astype("<i8").tobytes()), "terms": blob(b"".join(names)),
        })

    return dealt.groupBy("lang", "shard").applyInArrow(
        build, "lang string, shard int, shards int, vocabulary long, size long, levels binary, bits binary, ends binary, terms binary"
    )


def count_slots(docs: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """lang, source, shard, counts (packed), salt: what tasks have counted, for every shard with a count."""
    found = []
    bytes_of = sum(F.length(c) for c in ("levels", "bits", "ends", "terms"))
    listed = shards.select("lang", "shard", bytes_of.alias("bytes")).orderBy("lang", "shard").toLocalIterator()  # one small row a shard
    passes, held = [[]], 0
    for r in listed:
        if held and held + r["bytes"] > BROADCAST_BYTES:
            passes.append([])
            held = 0
        passes[-1].append((r["lang"], r["shard"]))
        held += r["bytes"]
    for k, chosen in enumerate(p for p in passes if p):
        (lo_lang, lo), (hi_lang, hi) = chosen[0], chosen[-1]
        at = F.struct(F.col("lang"), F.col("shard"))
        within = shards.filter((at >= F.struct(F.lit(lo_lang), F.lit(lo))) & (at <= F.struct(F.lit(hi_lang), F.lit(hi))))
        rows = within.select("lang", "shard", "shards", "levels", "bits", "ends", "terms").collect()  # at most BROADCAST_BYTES
        rows.sort(key=lambda r: (r["lang"], r["shard"]))
        shared = docs.sparkSession.sparkContext.broadcast([(*r[:3], *map(bytes, r[3:])) for r in rows])
        counted = map_batches(docs, functools.partial(_count, shared=shared), "lang string, source string, shard int, counts binary, salt int")
        found.append(staged(counted, folder, f"counted-{k}"))
        shared.unpersist()
    if not found:
        return docs.sparkSession.createDataFrame([], "lang string, source string, shard int, counts binary, salt int")
    return functools.reduce(DataFrame.unionByName, found)


def _count(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """The second pass. Columns: lang, text, source."""
    from pyspark import TaskContext

    shards, salt = Shards(shared.value), TaskContext.get().partitionId() % SALTS
    of_lang: dict[str, list[int]] = defaultdict(list)
    for k, (lang, _) in enumerate(shards.keys):
        of_lang[lang].append(k)
    #: the slots of a language are consecutive
    span = {lang: (int(shards.first[k[0]]), int(shards.first[k[-1] + 1])) for lang, k in of_lang.items()}
    counts: dict[tuple[str, str], np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), dense in counts.items():
            out = []
            for k in of_lang[lang]:
                part = dense[shards.first[k] - span[lang][0] : shards.first[k + 1] - span[lang][0]]
                if part.any():
                    out.append((shards.keys[k][1], _packed(part)))
            n = len(out)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * n, pa.string()), "source": pa.array([source] * n, pa.string()), "shard": pa.array([s for s, _ in out], pa.int32()),
                "counts": pa.array([c for _, c in out], pa.binary()), "salt": pa.array([salt] * n, pa.int32()),
            })
        counts.clear()

    for batch in batches:
        of: dict[tuple[str, str], Counter] = defaultdict(Counter)
        for lang, text, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if lang in span:
                of[lang, source].update(terms(text))
        for lang in {lang for lang, _ in of}:
            here = [(source, c) for (x, source), c in of.items() if x == lang]
            words = list(set().union(*(c for _, c in here)))
            slot = dict(zip(words, shards.slots(lang, words).tolist(), strict=True))
            begin, end = span[lang]
            for source, c in here:
                at = np.fromiter(map(slot.__getitem__, c), np.int64, len(c))
                n = np.fromiter(c.values(), np.int64, len(c))
                known = at >= 0
                if (lang, source) not in counts:
                    if counts and sum(map(len, counts.values())) + end - begin > SLOTS:
                        yield from rows()
                    counts[lang, source] = np.zeros(end - begin, np.int64)
                counts[lang, source][at[known] - begin] += n[known]
    yield from rows()


def _added(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`keys` with the sum of their packed counts; rows of one key stream by."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, done = None, None, []

        def batch_of(done: list) -> pa.RecordBatch:
            columns = zip(*[(*k, _packed(c)) for k, c in done], strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=[*keys, "counts"])

        types = []
        for batch in batches:
            types = [*(batch.schema.field(k).type for k in keys), pa.binary()]
            *at, counts = (batch.column(c).to_pylist() for c in (*keys, "counts"))
            for *key, packed in zip(*at, counts, strict=True):
                dense = _unpacked(packed, 0)
                if key == now:
                    total += dense
                    continue
                if now is not None:
                    done.append((now, total))
                    if len(done) == 256:
                        yield batch_of(done)
                        done = []
                now, total = key, dense
        if now is not None:
            yield batch_of([*done, (now, total)])

    return map_batches(rows.select(*keys, "counts").repartition(*keys).sortWithinPartitions(*keys), run, schema)


def shares(counts: np.ndarray, words: int, vocabulary: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 2) / (words + 2 * vocabulary)), exactly."""
    whole = words + 2 * vocabulary
    if whole >= 9 * 10**15:
        return np.array([1 + BILLION * (int(c) + 2) // whole for c in counts], np.int64)
    rest, result = counts + 2, np.zeros(len(counts), np.int64)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        result = result * 1000 + digit
    return result + 1


def divergence_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q))."""
    return (p - q) * (p - q) // (p + q)


_COMPARED = "lang string, source string, part string, item string, value long"


def _compare(rows: pa.Table, vocabulary: pa.Table, top: int) -> pa.Table:
    """What one tile of sources of one shard gives: sums of each pair once, and each source's first terms."""
    out: list[tuple] = []
    if rows.num_rows:
        # in one order for all shards, whatever order the shuffle left, so that each names a pair the same way
        facts = sorted(rows.to_pylist(), key=lambda r: r["source"])
        size, v = facts[0]["size"], facts[0]["vocabulary"]
        count = [_unpacked(r["counts"], size) for r in facts]
        p = [shares(c, r["words"], v) for c, r in zip(count, facts, strict=True)]
        tiles, diagonal = [r["tile"] for r in facts], facts[0]["lo"] == facts[0]["hi"]
        for i, a in enumerate(facts):
            for j in range(i + 1, len(facts)):
                if diagonal or tiles[i] != tiles[j]:
                    out.append((a["lang"], a["source"], "pair", facts[j]["source"], int(divergence_of(p[i], p[j]).sum())))
        if diagonal:
            r = vocabulary.to_pylist()[0]
            q, ends = shares(_unpacked(r["counts"], size), r["words"], v), np.frombuffer(r["ends"], "<i8").tolist()
            starts, names = [0, *ends[:-1]], r["terms"]
            for a, c, mine in zip(facts, count, p, strict=True):
                chosen = np.flatnonzero((c > 0) & (mine > q))
                if len(chosen):
                    value = divergence_of(mine[chosen], q[chosen])
                    least = np.partition(value, -min(top, len(value)))[-min(top, len(value))]
                    first = sorted((-int(x), names[starts[k] : ends[k]]) for k, x in zip(chosen.tolist(), value.tolist(), strict=True) if x >= least)[:top]
                    out += [(a["lang"], a["source"], "term", t.decode(), -x) for x, t in first]
    columns = list(zip(*out, strict=True)) or [()] * 5
    kinds = [pa.string()] * 4 + [pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "source", "part", "item", "value"])


def audit(docs: DataFrame, least: int = 10, top: int = 10, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: each source's divergence from every other of its language, and its first terms."""
    folder = shared_folder(docs.sparkSession)
    blank = lambda name: F.coalesce(col(name).cast("string"), F.lit(""))
    read = text_table(docs, *dict.fromkeys((lang, text, source)))
    read = read.select(blank(lang).alias("lang"), blank(text).cast("binary").alias("text"), blank(source).alias("source"))
    groups = staged(read.select(*_BASE).distinct(), folder, "groups")
    shards = staged(build_shards(staged(kept_terms(read, least), folder, "kept")), folder, "shards")
    counted = count_slots(read, shards, folder)
    added = staged(_added(_added(counted, [*_BASE, "shard", "salt"]), [*_BASE, "shard"]), folder, "added")
    of_lang = staged(_added(added, ["lang", "shard"]), folder, "added-lang")

    sizes = shards.select("lang", "shard", "size", "vocabulary")
    words = lambda rows, keys: _words(rows).groupBy(*keys).agg(F.sum("words").alias("words"))
    tiles = F.ceil(F.count("*") / TILE).cast("int")
    placed = groups.join(groups.groupBy("lang").agg(tiles.alias("tiles")), "lang")
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")).join(words(added, _BASE), _BASE, "left")
    # every source of a language for every shard, whether it has counts there or not
    dense = placed.join(sizes, "lang").join(added, [*_BASE, "shard"], "left").withColumn("words", F.coalesce("words", F.lit(0)))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    dense = dense.withColumn("other", other).withColumns({"lo": F.least("tile", "other"), "hi": F.greatest("tile", "other")}).drop("other", "tiles")
    named = shards.select("lang", "shard", "ends", "terms").join(of_lang, ["lang", "shard"], "left").join(words(of_lang, ["lang"]), "lang", "left")
    named = named.join(placed.select("lang", "tile").distinct(), "lang").withColumn("words", F.coalesce("words", F.lit(0)))
    named = named.select(*[F.col(a).alias(b) for a, b in (("lang", "of_lang"), ("shard", "of_shard"), ("tile", "of_tile"))], "ends", "terms", "counts", "words")
    left, right = dense.groupBy("lang", "shard", "lo", "hi"), named.groupBy("of_lang", "of_shard", "of_tile", F.col("of_tile").alias("of_other"))
    compared = staged(left.cogroup(right).applyInArrow(lambda a, b: _compare(a, b, top), _COMPARED), folder, "compared")

    once = compared.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    bare = groups.join(shards.select("lang").distinct(), "lang", "left_anti")  # languages without kept terms
    bare = bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source < item").withColumn("value", F.lit(0).cast("long"))
    once = once.unionByName(bare)
    pairs = once.unionByName(once.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    both = pairs.withColumn("part", F.lit("pair")).unionByName(compared.filter("part = 'term'"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    return both.withColumn("rank", rank).filter((F.col("part") == "pair") | (F.col("rank") <= top)).select(*_BASE, "part", "item", "value", "rank")


def _words(rows: DataFrame) -> DataFrame:
    """Rows of packed counts with their sum as `words`."""
    keep = [f for f in rows.schema.fields if f.name in _BASE]
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = [int(_unpacked(c, 0).sum()) for c in batch.column("counts").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(total, pa.int64())], names=[*names, "words"])

    return map_batches(rows.select(*names, "counts"), run, ", ".join(f"{n} string" for n in names) + ", words long")
