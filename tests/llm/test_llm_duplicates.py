"""Near-duplicates, repeated strings, components: against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.llm import common, near_duplicates, suffix_dedup
from snapmart.llm.components import components

WHITE = " \t\n\r\x0b\x0c"


def shingle_set(text, words):
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in WHITE:
        found = found.replace(c, " ")
    found = [w for w in found.split(" ") if w]
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def brute_components(rows, words, percent):
    """doc_id -> smallest id reachable, over all pairs of texts."""
    ids = sorted({d for d, _ in rows if d is not None})
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(d, shingle_set(t, words)) for d, t in rows if d is not None]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: find(d) for d in ids}


def test_workers_keep_neither_words_nor_earlier_tables():
    common.worker_table("earlier", None, dict)
    common.release_tables()
    near_duplicates.shingles(b"one two three four five six", 2)
    assert not common._TABLES


def test_empty_tables_are_not_made_of_python_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "x y z"), (4, None)], "doc_id long, text string")

    def refuse(*_, **__):
        raise AssertionError("rows of the driver's Python")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs, words=2).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def edited(rng, words, share):
    return [rng.choice(VOCABULARY) if rng.random() < share else w for w in words]


VOCABULARY = [f"w{i}" for i in range(3000)]


@pytest.mark.parametrize("words,size", [(2, 60), (5, 200), (2, 9)])
def test_same_components_as_all_pairs(spark, words, size):
    rng = random.Random(words * size)
    texts, passage = [], rng.choices(VOCABULARY, k=size // 2)
    for _ in range(12):
        base = rng.choices(VOCABULARY, k=rng.randint(size // 2, size))
        for _ in range(rng.choice([1, 2, 6])):  # families whose members are near the threshold of each other
            texts.append(" ".join(edited(rng, base, rng.choice([0, 0.02, 0.05, 0.08]))))
    for _ in range(25):  # a passage in many texts that are no copies
        texts.append(" ".join(passage + rng.choices(VOCABULARY, k=size // 3)))
    texts += ["", None, " \n ", "one", "One", "two words", "two\twords", "É x", "é x", texts[0], texts[0].upper()]
    rows = list(enumerate(texts, 100))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("x"))
    got = {r.doc_id: r for r in near_duplicates.near_duplicates(docs, words=words).collect()}
    want = brute_components(rows, words, 80)
    assert {d: r.component_id for d, r in got.items()} == want
    assert {d: r.n_shingles for d, r in got.items()} == {d: len(shingle_set(t, words)) for d, t in rows}
    assert all(r.kept == (d == want[d]) for d, r in got.items())


def test_family_below_the_threshold(spark, monkeypatch, tmp_path):
    """A family that is alike, most of it below the threshold: more than two turns, exact lists, several cells, a hub."""
    rng = random.Random(11)
    base = rng.choices(VOCABULARY, k=70)
    texts = [" ".join(edited(rng, base, 0.13)) for _ in range(45)]  # mostly unlike each other, with all frequent shingles in common
    texts += [" ".join(edited(rng, base, 0.02)) for _ in range(45)]  # links around the base
    texts += [f"{t} {rng.choice(VOCABULARY)}" for t in texts[:45:5]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(near_duplicates, "CELL", 16)
    made, dealt = {}, []
    staged, deal = near_duplicates.staged, near_duplicates._dealt

    def noted(df, folder, name):
        made[name] = staged(df, folder, name)
        if name.startswith("pairs-"):
            made[name, "n"] = made[name].count()
        return made[name]

    def noted_cells(pairs):
        cells = deal(pairs)
        dealt.append((pairs.count(), [r["count"] for r in cells.groupBy("cell").count().collect()]))
        return cells

    monkeypatch.setattr(near_duplicates, "staged", noted)
    monkeypatch.setattr(near_duplicates, "_dealt", noted_cells)
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs, words=2, k=32).collect()}
    assert got == brute_components(list(enumerate(texts)), 2, 80)
    assert "exact" in made and "pairs-2" in made
    # every pair is still dealt once, and more pairs make more cells
    assert all(sum(cells) == n for n, cells in dealt) and max(len(cells) for _, cells in dealt) > 1
    # of about 1,000 pairs of the unlike half the prefixes leave few to confirm
    assert sum(n for name, n in made.items() if isinstance(name, tuple) and name[0] >= "pairs-2") < 300


def test_a_hub_is_spread_over_cells(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "CELL", 100)
    star = spark.range(1, 10_001).selectExpr("0L AS a", "id AS b")  # one hub with all pairs: 10 by 10 cells
    sizes = [r["count"] for r in near_duplicates._dealt(star).groupBy("cell").count().collect()]
    assert sum(sizes) == 10_000 and len(sizes) == 100 and max(sizes) < 200
    assert near_duplicates._dealt(star.limit(0)).count() == 0


def test_odd_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "d e f"), (2, "d e f"), (None, "a b c"), (None, None), (3, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_duplicates.near_duplicates(docs, words=2).collect())
    assert got == {(1, 1, True): 3, (2, 1, False): 1, (None, None, True): 2, (3, 3, True): 2}
    assert near_duplicates.near_duplicates(docs.limit(0)).count() == 0


def test_least_common_bounds_the_miss():
    assert near_duplicates.least_common(64, 0.8) < 0.8 * 64
    assert near_duplicates.least_common(64, 0.8, 0.5) >= 50


def test_components_of_chains_and_stars(spark, tmp_path):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(200, 260)] + [(5, i) for i in range(300, 400)] + [(400, 399), (7, 8), (8, 8)]
    names = {i: i * 7919 % 1009 for e in edges for i in e}
    rng.shuffle(edges)
    links = spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a long, b long")
    got = {r.node: r.component for r in components(links, str(tmp_path), "c").collect()}
    groups = [set(range(200, 261)), {5, *range(300, 401)}, {7, 8}]
    assert got == {names[i]: min(names[j] for j in g) for g in groups for i in g}


def brute_removed(texts, length):
    places = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if places[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(gone)
    return out


def passages(rng):
    letters = "abcdefgh \n"
    text = lambda n: "".join(rng.choices(letters, k=n))
    shared = [text(n) for n in (199, 200, 201, 350, 900)]
    texts = [text(rng.randint(0, 300)) + rng.choice(shared) + text(rng.randint(0, 250)) + rng.choice(shared) for _ in range(30)]
    near = text(700)
    texts += [near[:k] + "#" + near[k:] for k in rng.sample(range(700), 12)]  # copies with one byte more
    texts += ["", "a" * 199, "a" * 200, "a" * 500, "ab" * 400, "é" * 130 + "x", text(5000), shared[3], shared[3], "xyz" * 1500]
    return texts


@pytest.mark.parametrize("crowd", [1, 3, suffix_dedup.CROWD])
def test_same_bytes_as_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    texts = passages(random.Random(11))
    rows = [*enumerate(texts), (None, None), (3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(0)).withColumn("kept", F.lit(0))
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs).collect())
    whole = [(t or "").encode() for _, t in rows]
    want = Counter()
    for (doc_id, _), t, gone in zip(rows, whole, brute_removed(whole, 200), strict=True):
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[doc_id, len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])] += 1
    assert got == want


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(800):
        symbols = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(0, 40))]
        want = sorted(range(len(symbols)), key=lambda i: symbols[i:])
        assert suffix_dedup.suffix_array(np.array(symbols, np.int64)).tolist() == want
