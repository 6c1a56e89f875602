"""Registered queries against their SQL, the pipeline's stages, and the columns of the contracts."""

import random
from collections import Counter

import compare
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from snapmart.llm import language_id, near_duplicates, queries, toxicity
from snapmart.llm.common import shared_folder, staged

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_agrees_with_sql(spark, connection, name):
    assert compare.difference(spark, connection, SF_DIR, name) is None


@pytest.mark.parametrize(
    "name,columns",
    [
        ("op1_sentencepiece", "doc_id n_tokens ids_sha256 decoded_sha256"),
        ("op2_near_duplicates", "doc_id n_shingles component_id kept"),
        ("op3_url_filter", "page_id host path rule verdict"),
        ("op4_language_id", "doc_id held_out lang_pred score"),
        ("op5_toxicity", "doc_id held_out score predicted"),
        ("op6_token_files", "doc_id start n_tokens ids_crc32"),
    ],
)
def test_whole_tables_are_judged(spark, name, columns):
    got = queries.QUERIES[name](spark, SF_DIR)
    assert got.columns == columns.split()
    assert got.count() == spark.read.parquet(f"{SF_DIR}/{'pages' if name.startswith('op3') else 'documents'}.parquet").count()


ODD = [
    (1, "Some words that are the same in two documents of one source here", "en", "a", 1),
    (2, "Some words that are the same in two documents of one source here", None, "a", None),
    (2, "Some words that are the same in two documents of one source here", None, "a", None),
    (2, "another text under an id that is there already and so repeats", "en", None, 1),
    (3, None, "en", "a", 0),
    (4, "", "en", "", 0),
    (None, "no id", "en", "b", 5),
    (5, "x" * 400, "en", "b", 400),
    (6, "é" * 400 + "y", "en", "b", 401),
    (7, "é" * 400 + "z", "en", "b", 401),
]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({"score": F.lit("x"), "_key": F.lit(1), "copies": F.lit(2)})  # clashing names


def test_stages_keep_the_columns(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, odd.limit(0)):
            got = stage(spark, docs, SF_DIR)
            assert got.columns == (odd.columns if name != "sentencepiece" else ["doc_id", "lang", "source", "n_tokens", "ids", "decoded"])
            assert len(got.collect()) <= 2 * len(ODD)


def test_near_duplicates_leave_one_of_a_group(spark, odd):
    got = Counter((r.doc_id, (r.text or "")[:3]) for r in corpus_pipeline.drop_near_duplicates(spark, odd, SF_DIR).collect())
    assert got == {(1, "Som"): 1, (2, "ano"): 1, (3, ""): 1, (4, ""): 1, (None, "no "): 1, (5, "xxx"): 1, (6, "ééé"): 1, (7, "ééé"): 1}


def test_few_labels_reject(spark, tmp_path):
    rng = random.Random(3)
    insults, rows = ["idiot", "scum", "moron", "trash"], []
    for i in range(160):
        words = rng.choices([f"word{k}" for k in range(300)], k=rng.randint(20, 60))
        for insult in rng.sample(insults, 3) if i % 8 == 0 else []:
            words.insert(rng.randrange(len(words)), insult)
        rows.append((i, " ".join(words), int(i % 8 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs.filter("doc_id < 100").select("doc_id", "toxic").write.parquet(f"{tmp_path}/labels.parquet")
    left = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs.drop("toxic"), str(tmp_path)).collect()}
    assert sum(i % 8 == 0 for i in left) <= 2 and sum(i % 8 != 0 for i in left) >= 130


def test_unlike_texts_of_one_id_leave_one_of_each_group(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(8, a), (8, b), (9, b + " more"), (9, c), (7, a + " more"), (8, a + " more"), (8, c), (8, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()))
    assert got == {(7, a + " more"): 1, (8, b): 1, (8, c): 1}


def test_repeated_passages_go(spark, odd):
    got = {(r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.drop_repeated_passages(spark, odd, SF_DIR).filter("doc_id >= 3").collect()}
    assert got == {(3, None, 0), (4, "", 0), (5, "", 0), (6, "y", 1), (7, "z", 1)}


def test_a_pending_result_survives_the_pipeline(spark):
    pending = queries.QUERIES["op7_mixing"](spark, SF_DIR)
    n = pending.count()
    ids = corpus_pipeline.run(spark, SF_DIR)
    assert pending.count() == n and ids.count() > 0


def test_pipeline(spark):  # each stage is judged on what the one before has written
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tables, folder = [docs], shared_folder(spark)
    for name, stage in corpus_pipeline.STAGES:
        tables.append(staged(stage(spark, tables[-1], SF_DIR), folder, name.replace(" ", "-")))
    start, clean, single, cut, mixed, ids = tables
    # toxicity: exactly the documents that its model rejects
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").filter(language_id.bucket(F.col("doc_id"), 5) != 0)
    rejected = toxicity.learn(start, labels).score(start).filter("score >= 0.5").count()
    assert clean.count() == start.count() - rejected
    # one of each group
    groups = near_duplicates.near_duplicates(clean).select("component_id").distinct().count()
    assert single.count() == groups and single.select("doc_id").distinct().count() == groups
    assert cut.count() == single.count() and cut.agg(F.sum("n_chars")).first()[0] <= single.agg(F.sum("n_chars")).first()[0]
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert ids.count() == mixed.count()
    assert all(r.ids == [*library.encode(texts[r.doc_id]), 2] and r.n_tokens == len(r.ids) for r in ids.collect())
