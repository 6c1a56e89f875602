"""Packing, clustering and the divergence audit against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapmart.llm import divergence, packing, pivot_clustering

BYTES = public_tokenizers.path("byte_bpe_50k.json")


# packing


def least_sequences(lengths: list[int], capacity: int) -> int:
    """By trying every way."""
    best = len(lengths)

    def place(k: int, rooms: list[int]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= lengths[k]}:
            rest = list(rooms)
            rest.remove(room)
            place(k + 1, [*rest, room - lengths[k]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_histogram_is_packed_whole_and_tight(lengths):
    packed = packing.pack_histogram(Counter(lengths), 20)
    used = Counter()
    for times, found in packed:
        assert times > 0 and sum(s * a for s, a in found.items()) <= 20
        used.update({s: times * a for s, a in found.items()})
    assert used == Counter(lengths)
    assert sum(t for t, _ in packed) <= least_sequences(sorted(lengths, reverse=True), 20) + 1


def test_program_covers_no_length_twice_and_prices_by_dynamic_programming():
    rng = random.Random(1)
    for _ in range(30):
        lengths = rng.sample(range(1, 30), 5)
        most, price = [rng.randint(1, 3) for _ in lengths], [rng.random() for _ in lengths]
        found, value = packing.best_configuration(lengths, most, price, 40)
        ways = [[]]
        for m in most:
            ways = [[*w, a] for w in ways for a in range(m + 1)]
        best = max(sum(a * p for a, p in zip(w, price, strict=True)) for w in ways if sum(a * s for a, s in zip(w, lengths, strict=True)) <= 40)
        assert value == pytest.approx(best) and sum(a * price[lengths.index(s)] for s, a in found.items()) == pytest.approx(best)
    pieces = np.zeros(101)
    pieces[[60, 40, 35, 25, 10]] = [100, 100, 30, 60, 7]
    used = packing.solve_program(pieces, 100)
    for s in (60, 40, 35, 25, 10):
        assert sum(t * f.get(s, 0) for t, f in used) <= pieces[s] + 1e-6
    assert sum(t for t, _ in used) <= pieces @ np.arange(101) / 100 * 1.02


# three of 648 share a sequence, whatever the others do
@pytest.mark.parametrize("counts,least", [({700: 10**12, 648: 10**12, 1348: 10**12, 2048: 5}, 10**12 + 10**12 // 3 + 6), ({1500: 10**6, 548: 10**6 + 3}, 10**6 + 1)])
def test_work_does_not_grow_with_the_number_of_pieces(counts, least):
    packed = packing.pack_histogram(counts, 2048)
    assert len(packed) < 100 and sum(t for t, _ in packed) <= least + 2


DOCS = [(1, "Some words, and more of them."), (2, None), (2, ""), (None, "no id"), (3, "word " * 5000), (4, "word " * 4095), (4, "word " * 4095), (5, "x"), (6, "Über ﬁ①漢字 " * 900)]


def test_pieces_are_placed(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumns({"length": F.lit(1), "piece": F.lit("x"), "at": F.lit(2)})
    got = packing.pack(docs, BYTES, 0, capacity=512).collect()
    want = []
    for doc_id, text in DOCS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 512 or 512
        for k, at in enumerate([0, *range(first, len(ids), 512)]):
            part = ids[at : at + (512 if k else first)]
            want.append((doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    assert len(sequences) <= -(-sum(w[3] for w in want) // 512) + 1
    assert packing.pack(docs.limit(0), BYTES, 0).count() == 0


# clustering


def clusters(rows: list[tuple], number: int, rounds: int, seed: int = 2) -> dict:
    """Plain integers; the rows keep their places."""
    v = [[int(np.floor(256 * float(x))) for x in e] for _, e in rows]
    h = [hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "~" for i, _ in rows]
    centroids = [v[k] for k in sorted(range(len(rows)), key=lambda k: (h[k], v[k]))[:number]]
    nearest = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        of = defaultdict(list)
        for x in v:
            of[nearest(x)[1]].append(x)
        centroids = [[sum(col) // len(of[k]) for col in zip(*of[k], strict=True)] if of[k] else c for k, c in enumerate(centroids)]
    found = [nearest(x) for x in v]
    inertia = Counter()
    for d, k in found:
        inertia[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, k, d, inertia[k], sum(inertia.values()), digest[k]) for (i, _), (d, k) in zip(rows, found, strict=True))


def test_clusters_are_those_of_plain_integers(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.5, 0.0, 0.5, rng.gauss(0, 1)]) for _ in range(4)]) for i in range(120)]
    rows += [(7, [0.5] * 4), (7, [0.25] * 4), (None, [0.0] * 4), (None, [9.0] * 4), *rows[:30]]  # repeated ids and rows, null ids
    odd = [(900, None), (901, []), (902, [1.0] * 3), (903, [1.0, None, 1.0, 1.0]), (904, [float("nan")] * 4), (905, [float("inf")] * 4)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumns({"v": F.lit(1), "d": F.lit("x"), "cluster": F.lit(3)})
    for number, rounds in ((8, 3), (400, 1), (1, 2)):
        got = pivot_clustering.cluster(table.repartition(3), number=number, rounds=rounds, dimension=4).collect()
        assert Counter(map(tuple, got)) == clusters(rows, number, rounds)
    assert pivot_clustering.cluster(table.limit(0), dimension=4).count() == 0


def test_bounds_spare_distances_and_lose_none():
    rng = np.random.default_rng(0)
    middle = rng.integers(-3000, 3000, (40, 64))
    v = (middle[rng.integers(0, 40, 3000)] + rng.integers(-200, 200, (3000, 64))).astype(np.int64)
    pivots = pivot_clustering.choose_pivots(middle)
    found, distance, computed = pivot_clustering.nearest_centroids(v, pivot_clustering.pivot_distances(v, pivots), middle, pivot_clustering.pivot_distances(middle, pivots))
    plain = ((v[:, None] - middle[None]) ** 2).sum(axis=2)
    assert (found == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()
    assert computed < 0.2 * plain.size


def test_components_too_large_for_the_result_fail(spark):
    table = spark.createDataFrame([(1, [1e30] * 4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        pivot_clustering.cluster(table, dimension=4).count()


# divergence


def audited(rows: list[tuple], least: int, top: int) -> Counter:
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))) for lang, text, source in rows]
    out = Counter()
    for lang in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == lang]
        frequency = Counter(t for d in here for t in set(d[2]))
        kept = {t for t, n in frequency.items() if n >= least}
        count = {s: Counter(t for d in here if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in here}}
        whole = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        q = share(whole)
        for s, c in count.items():
            p = share(c)
            pairs = [(sum(f(p[t], r[t]) for t in kept), o) for o, r in ((o, share(x)) for o, x in count.items() if o != s)]
            first = [(f(p[t], q[t]), t) for t in kept if c[t] > 0 and p[t] > q[t]]
            for part, items, last in (("pair", pairs, len(pairs)), ("term", first, top)):
                for k, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:last]):
                    out[lang, s, part, item, value, k + 1] += 1
    return out


@pytest.mark.parametrize("shard_terms,tile,passes", [(4096, 48, 1 << 30), (5, 2, 400)])
def test_audit_is_that_of_plain_counts(spark, monkeypatch, shard_terms, tile, passes):
    for name, value in (("SHARD_TERMS", shard_terms), ("TILE", tile), ("BROADCAST_BYTES", passes)):
        monkeypatch.setattr(divergence, name, value)
    rng = random.Random(6)
    words = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"] + ["Éa", "ÉA", "漢字", "Don't", "x_y", "\x85z", "ſ"]
    rows = [(rng.choice(["en", "de", None]), " ".join(rng.choices(words, k=rng.randint(0, 12))), rng.choice(["s1", "s2", "s3", "S1", None, "ü"])) for _ in range(150)]
    rows += [("xx", "rare words only", "s1"), ("xx", None, "s2"), ("yy", "", "s1"), ("en", None, "silent"), ("en", "wa " * 3000, "s1"), *rows[:20]]
    docs = spark.createDataFrame(rows, "lang string, text string, source string").withColumns({"shard": F.lit(1), "counts": F.lit("x"), "words": F.lit(2)})
    got = Counter(map(tuple, divergence.audit(docs.repartition(3), least=4, top=3).collect()))
    assert got == audited(rows, 4, 3)
    assert divergence.audit(docs.limit(0)).count() == 0
    assert divergence.audit(docs.filter("lang = 'xx'")).count() == 2


def test_comparison_does_not_depend_on_row_order():
    def table(sources: list[str]) -> pa.Table:
        return pa.Table.from_pylist([
            {"lang": "en", "source": s, "tile": 0, "lo": 0, "hi": 0, "size": 2, "vocabulary": 2, "words": 3, "counts": divergence._packed(np.array([1, 2] if s == "a" else [3, 0]))}
            for s in sources
        ])

    whole = pa.Table.from_pylist([{"counts": divergence._packed(np.array([4, 2])), "ends": np.array([1, 2], "<i8").tobytes(), "terms": b"xy", "words": 6}])
    pairs = [[r for r in divergence._compare(table(s), whole, 3).to_pylist() if r["part"] == "pair"] for s in (["a", "b"], ["b", "a"])]
    assert pairs[0] == pairs[1] and [(r["source"], r["item"]) for r in pairs[0]] == [("a", "b")]


def test_perfect_hash_has_a_slot_for_each_term_and_none_for_others(monkeypatch):
    for levels in (24, 2):  # with two levels some terms are found by name
        monkeypatch.setattr(divergence, "LEVELS", levels)
        rows, names = [], {}
        for shard in range(3):
            found = [f"t{i}".encode() for i in range(4000) if divergence.hashes([f"t{i}".encode()]).view(np.int64)[0] % 3 == shard]
            sizes, bits, order = divergence.perfect_hash(found)
            assert sorted(order) == sorted(found)
            names[shard] = order
            rows.append(("en", shard, 3, sizes.astype("<i8")[:levels].tobytes(), np.packbits(bits).tobytes(), np.cumsum([len(t) for t in order]).astype("<i8").tobytes(), b"".join(order)))
        shards = divergence.Shards(rows)
        every = [*names[0], *names[1], *names[2]]
        assert shards.slots("en", every).tolist() == list(range(4000))
        assert set(shards.slots("en", [f"u{i}".encode() for i in range(4000)]).tolist()) == {-1}
        assert shards.slots("de", [b"t1"]).tolist() == [-1]


def test_shares_are_exact():
    rng = random.Random(2)
    for whole in (7, 10**9, 10**15, 8 * 10**15, 10**18):
        counts = [0, 1, *(rng.randint(0, whole) for _ in range(50))]
        vocabulary = 3
        got = divergence.shares(np.array(counts), whole, vocabulary)
        assert got.tolist() == [1 + 10**9 * (c + 2) // (whole + 2 * vocabulary) for c in counts]


def test_divergence_within_pairs():
    p = np.array([1, 2, 10**9 + 1, 5], np.int64)
    for a, b in combinations(p.tolist(), 2):
        assert divergence.divergence_of(np.array([a]), np.array([b]))[0] == (a - b) ** 2 // (a + b)
