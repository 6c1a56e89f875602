"""Mixing, repetition rules, nearest neighbours: against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.llm import mixing, repetition, rotated_codes

# --- mixing ---


def brute_targets(sizes, weights, cap):
    """Excess over a cap is shared again by weight until none is above."""
    target, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if cap * sizes[s] <= weights[s] * level}
        if not full:
            return target | {s: weights[s] * level for s in open_}
        for s in full:
            target[s] = float(cap * sizes[s])
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_words_taken(spark, seed):
    rng = random.Random(seed)
    sources = ["b", "a", "Z", "é", None, "tiny", ""]
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(sources[:5] * 20 + ["tiny"])) for i in range(1500)] + [(2000, None, ""), (2001, " \n", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x")).withColumn("target", F.lit(0))
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    targets = brute_targets(sizes, {s: 1 + k % 3 for k, s in enumerate(order)}, 3)
    taken = defaultdict(int)
    for r in got:
        assert r.size == len((rows[r.doc_id][1] if r.doc_id < 1500 else "" ).split()) and 0 <= r.copies <= 3
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        taken[r.source] += r.copies * r.size
    assert all(abs(taken[s] - targets[s]) <= 60 for s in sizes)  # within a document
    again = mixing.mix(docs.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_repeated_rows_wishes_and_no_rows(spark):
    rows = [(1, "a b c", "x", 1.0)] * 40 + [(2, "d e", "y", 0.0), (2, "d e f", "y", 2.0), (None, "g", None, 1.0), (3, None, None, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, wish double")
    assert Counter(map(tuple, mixing.mix(docs).collect())) == Counter(map(tuple, mixing.mix(docs).collect()))
    wished = {(r.doc_id, r.size): r.copies for r in mixing.mix(docs, wish="wish").collect()}
    assert wished[2, 2] == 0 and wished[2, 3] >= 1
    assert mixing.mix(docs.limit(0)).count() == 0


def test_pareto_sampling_follows_its_chances(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.when(F.col("id") < 2000, "p").otherwise("q").alias("source"), (F.col("id") % 2 + 1).cast("double").alias("wish"))
    # source p shall be a third of the words, so two thirds of its documents; wishes share these 2 to 1
    got = mixing.mix(docs, wish="wish").filter("source = 'p'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.avg("copies").alias("mean")).collect()
    mean = {r.odd: r.mean for r in got}
    assert mean[0] == pytest.approx(4 / 9, abs=0.04) and mean[1] == pytest.approx(8 / 9, abs=0.04)


# --- repetition ---


def brute_longest(words):
    n = len(words)
    out = []
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while j != i and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


def test_longest_repeats():
    rng = random.Random(3)
    for _ in range(250):
        texts = [[rng.randrange(rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 5))]
        symbols = np.array([x for t in texts for x in t], np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        assert repetition.repeat_lengths(symbols, owner).tolist() == [x for t in texts for x in brute_longest(t)]


def test_measures(spark):
    rng = random.Random(8)
    line = " ".join(f"l{i}" for i in range(12))
    texts = [None, "", " \n ", "a #b* <é>\n\na #b* <é>\n \n x", line, f"{line}\n{line} \n{line}", "x " * 40, "\n".join([line, *rng.choices(["p q", "r s t"], k=9)])]
    texts += [" ".join(rng.choices("abcdefgh", k=rng.randint(5, 80))) for _ in range(40)] + ["v " * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_words", F.lit("x"))
    got = {r.doc_id: r for r in repetition.measure(docs).withColumns({"failed": repetition.base_failed(), "rep": repetition.repetitive()}).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts[:-1]):
        text, r = text or "", got[k]
        words = text.encode().split()
        longest = brute_longest(words)
        for length, count in ((5, r.n_repeat_words), (10, r.long_repeat_words)):
            inside = {i + d for i, m in enumerate(longest) if m >= length for d in range(length)}
            assert count == len(inside)
        lines = [x for x in text.split("\n") if x.strip()]
        assert (r.n_words, r.n_dup_lines, r.longest_repeat) == (len(words), len(lines) - len(set(lines)), max(longest, default=0))
        assert r.word_chars == sum(len(w.decode()) for w in words) and r.n_symbols == sum(c in "#*$%&|<>" for c in text)
    assert got[4].failed is False and got[4].rep is False  # clean
    assert got[5].failed and got[6].failed and got[len(texts) - 1].longest_repeat == 19_999
    assert repetition.measure(docs.limit(0)).count() == 0


def test_each_rule_decides_alone(spark):
    words = lambda n, c: [f"{c}{i}" for i in range(n)]
    long = words(12, "a")
    texts = {
        1: words(150, "x"),  # clean
        2: [*long, *words(126, "x"), *long],  # 24 of 150 words in long repeats, 16 %
        3: [*long, *words(376, "x"), *long],  # 6 %
        4: [*words(51, "b"), *words(1200, "x"), *words(51, "b")],  # 8 %, but one repeat of 51 words
        5: [*words(6, "c"), *words(12, "x"), *words(6, "c"), *words(20, "y")],  # short repeats, 27 %
    }
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()], "doc_id long, text string")
    rows = repetition.measure(docs).withColumns({"failed": repetition.base_failed(), "rep": repetition.repetitive()}).collect()
    got = {r.doc_id: (r.failed, 100 * r.long_repeat_words > repetition.LONG_PERCENT * r.n_words, r.longest_repeat > repetition.LONGEST, r.rep) for r in rows}
    assert got == {
        1: (False, False, False, False), 2: (False, True, False, True), 3: (False, False, False, False),
        4: (False, False, True, True), 5: (True, False, False, False),
    }


# --- nearest neighbours ---


def brute_nearest(rows, k):
    out = Counter()
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    for a, (i, q) in enumerate(ok):
        if i % 20 == 0:
            scored = [(-float(np.cumsum(q * v)[-1]), j) for b, (j, v) in enumerate(ok) if b != a and len(v) == len(q)]
            out.update((i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scored)[:k], 1))
    return out


@pytest.mark.parametrize("n,dim", [(30, 5), (900, 64)])
def test_neighbours(spark, monkeypatch, n, dim):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(10, dim))
    vectors = (centres[rng.integers(0, 10, n)] + rng.normal(size=(n, dim))).astype(np.float32).tolist()
    vectors[n // 2 : n // 2 + 8] = [vectors[0]] * 8  # a common vector
    rows = list(enumerate(vectors)) + [(20, vectors[3]), (None, vectors[1]), (1000, None), (1020, [0.0] * dim), (1040, [None] * dim), (1060, [float("nan")] * dim), (1080, [float("inf")] * dim), (1100, []), (1120, [1.0, 2.0]), (1121, [2.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("code", F.lit(1)).withColumn("row", F.lit(2))
    monkeypatch.setattr(rotated_codes, "FIRST", 64)
    index, means = rotated_codes.build_index(table)
    got = Counter(map(tuple, rotated_codes.search(index, means, F.col("vec_id") % 20 == 0, k=20).collect()))
    want = brute_nearest(rows, 20)
    assert sum((got & want).values()) >= 0.99 * sum(want.values()) and sum(got.values()) == sum(want.values())
    empty, means = rotated_codes.build_index(table.limit(0))
    assert rotated_codes.search(empty, means, F.col("vec_id") % 20 == 0).count() == 0


def test_estimates_stay_within_their_bounds():
    rng = np.random.default_rng(5)
    vectors, queries = rng.normal(size=(3000, 64)) + 0.3, rng.normal(size=(40, 64))
    centre = vectors.mean(axis=0)
    found, error = rotated_codes.estimates(*rotated_codes.encode(vectors, centre), centre, queries)
    off = np.abs(found - queries @ vectors.T) / np.linalg.norm(queries, axis=1)[:, None]
    assert (off <= error).mean() >= 0.9995
