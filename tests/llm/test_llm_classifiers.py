"""URL filter, language ID, toxicity: rules and sums by brute force, decisions by held-out accuracy."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from snapmart.llm import language_id, toxicity, url_filter

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF_DIR = "/root/testdata/sf0.001"


# --- urls ---

URLS = [
    None, "", "no-scheme.example.net/en/", "https://EXAMPLE.net/en/1", "http://a.b.example.net/en/x?y#z", "http://example.net/EN/",
    "http://net/", "http://x.net", "http://x.net?q=/", "http://myexample.com/de/", "http://m.example.com/de/1", "http://example.com/de",
    "http://org/fr/", "http://x.org/fr/a://b", "http://u@x.org:80/fr/#f", "://example.com/de/", "http://", "http://exAmple.com#/de/", "x" * 20_000 + "://y.net/",
]


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path):
    fits = [r for r in url_filter.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fits, key=lambda r: len(r[1] + r[2]), default=None)


@pytest.fixture(scope="module")
def url_model(spark):
    return url_filter.train(url_filter.labelled_urls(spark))


def test_hosts_paths_and_rules(spark, url_model):
    pages = spark.createDataFrame([*enumerate(URLS), (1, "")], "page_id long, url string").withColumn("host", F.lit(1)).withColumn("features", F.lit(2))
    got = url_filter.judge(pages, url_model).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path = brute_parts(URLS[r.page_id])
        rule = brute_rule(host, path)
        assert (r.host, r.path) == (host, path)
        assert r.rule == (rule[1] + rule[2] if rule else None)
        assert r.verdict == (rule[0] if rule else "block" if r.probability >= url_filter.BLOCK_AT else "allow")
    assert url_filter.judge(pages.limit(0), url_model).count() == 0


def test_unseen_urls_are_judged_by_their_grams(spark, url_model):
    wanted = ["https://www.city-library.example/catalog/history", "http://blog.ththor.example.com/en/16023/", "https://docs.project.example/reference/api", "http://m.thonth.example.com/fr/50861#top"]
    unwanted = ["http://mega-casino.example/poker/free-bonus", "https://hot-porn.example/xxx/videos", "http://warez-crack.example/keygen/download", "https://secure-login-verify.example/update/password"]
    pages = spark.createDataFrame(list(enumerate(wanted + unwanted)), "page_id long, url string")
    got = [r.verdict for r in url_filter.judge(pages, url_model, rules=()).orderBy("page_id").collect()]
    assert got[:4] == ["allow"] * 4 and got[4:].count("block") >= 3


def test_no_labels_allow(spark):
    one = spark.createDataFrame([("http://a", 1.0)], "url string, label double")
    assert url_filter.train(one) is None
    pages = spark.createDataFrame([(1, "http://casino")], "page_id long, url string")
    assert url_filter.judge(pages, None).first().verdict == "allow"


# --- languages ---


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "aba", "▁ab"]
    lattice, rng = language_id.Lattice(pieces), np.random.default_rng(1)
    theta = rng.random((len(pieces) + 1, 2))

    def brute(text, k):
        if not text:
            return 1.0
        total = sum(theta[i, k] * brute(text[len(p) :], k) for i, p in enumerate(pieces) if text.startswith(p))
        return total + (theta[-1, k] * brute(text[1:], k) if text[0] not in pieces else 0.0)

    words = ["a", "ab", "abab", "aab", "xaba", "bxx", "abaabababa"]
    got = lattice.scores(words, theta)
    assert np.allclose(got, [[math.log(brute("▁" + w, k)) for k in (0, 1)] for w in words])
    # the expected uses of a piece are the derivative of the log sum
    counts = rng.random((len(words), 2))
    uses = lattice.expected(words, counts, theta)
    for i in range(len(pieces)):
        more = theta.copy()
        more[i] *= 1 + 1e-6
        slope = ((lattice.scores(words, more) - got) * counts).sum(axis=0) / 1e-6
        assert np.allclose(slope, uses[i], rtol=1e-3, atol=1e-4)


def test_long_words_neither_overflow_nor_vanish():
    lattice = language_id.lattice(MODEL)
    theta = np.full((len(lattice.pieces) + 1, 1), 1e-5)
    assert np.isfinite(lattice.scores(["a" * 64, "漢" * 64, "ﬀ" * 64, "entertainment" * 4], theta)).all()
    assert lattice.scores(["x" * 64], theta)[0, 0] > -64 * 20


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held_out = language_id.bucket(F.col("doc_id"), 3) == 1
    assert docs.select("doc_id", held_out.alias("h")).filter("h").count() == sum(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in docs.collect())
    model = language_id.learn(docs.filter(~held_out), MODEL)
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "123 ² ½ _ !"), (-4, "und die " * 30_000), (None, "und die der")], "doc_id long, text string")
    found = language_id.identify(odd.withColumn("score", F.lit("x")), model, MODEL).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert got[-1] == got[-2] == got[-3] == ("und", 0.0)
    assert got[-4][0] == got[None][0] == "de"
    test = docs.filter(held_out)
    right = language_id.identify(test, model, MODEL).join(test.select("doc_id", "lang"), "doc_id").filter("lang = lang_pred").count()
    assert right >= 0.97 * test.count()
    assert language_id.identify(docs.limit(0), model, MODEL).count() == 0


def test_no_languages(spark):
    docs = spark.createDataFrame([(1, "text", None), (None, "text", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    model = language_id.learn(docs, MODEL)
    assert {r.lang_pred for r in language_id.identify(docs, model, MODEL).collect()} == {"und"}


# --- toxicity ---


def test_word_features():
    features = toxicity.Features({"stupid": 3.0, "lowe~": 2.0})
    names = dict(zip(toxicity.FEATURES, range(len(toxicity.FEATURES)), strict=True))
    plain, hidden, clean, none, empty = features.texts(["You are STUPID!", "y0u stu.p1d loweise thing", "a plain text", None, " \n"])
    assert plain[names["near"]] > 0 and plain[names["caps_share"]] > 0 and plain[names["exclaim_rate"]] > 0
    assert hidden[names["hidden_share"]] == 0.25 and hidden[names["lexicon"]] == pytest.approx(math.log1p(2))
    assert clean[names["lexicon"]] == 0 and clean[names["words"]] > 0
    assert not none.any() and not empty.any()


def test_held_out_toxicity(spark):
    rng = random.Random(4)
    clean, bad = [f"word{i}" for i in range(300)], ["idiot", "scum", "lostraschaft", "lostraun", "lostraera"]
    rows = []
    for i in range(900):
        words = rng.choices(clean, k=rng.randint(5, 60))
        toxic = int(rng.random() < 0.25)
        for _ in range(rng.randint(1, 5) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    held_out = language_id.bucket(F.col("doc_id"), 5) == 0
    labels = docs.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, toxic int"))
    model = toxicity.learn(docs.drop("toxic"), labels.filter(~held_out))
    scored = model.score(docs.withColumn("score", F.lit("x")).withColumn("features", F.lit(1))).join(docs, "doc_id").filter(held_out).collect()
    assert sum((r.score >= 0.5) == (r.toxic == 1) for r in scored) >= 0.95 * len(scored)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " \n\t"), (4, "word1 " * 50_000), (None, "idiot")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in model.score(odd).collect()}
    assert got[1] == got[2] == got[3] and all(0 <= s <= 1 for s in got.values())
    assert model.score(odd.limit(0)).count() == 0


def test_rare_label_is_sampled_for_itself(spark):
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 25 == 0).cast("int").alias("label"), F.xxhash64("id").alias("h"))
    rows, stands_for = toxicity._sampled(labels, 100)
    assert {r.label: r["count"] for r in rows.groupBy("label").count().collect()} == {0: 60, 1: 40}
    assert stands_for == {0: 16.0, 1: 1.0}
    assert toxicity._sampled(labels, 5000)[0].count() == 1000


def test_too_few_labels_score_nothing(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.learn(docs, labels).score(docs).collect()} == {0.0}
    assert toxicity.learn(docs, labels.limit(0)).score(docs).count() == 2
