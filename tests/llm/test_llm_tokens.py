"""SentencePiece encoding by prefix tables, and bit-plane token files."""

import io
import random
import weakref

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapmart.llm import common, sentencepiece_bpe, token_files

MODEL, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ROWS = [(1, "Hello  world.\n  Über ﬁ①漢字 ▁x"), (2, None), (3, ""), (4, " \t\n"), (3, ""), (None, "no id"), (5, "<|endoftext|> it's 3½ naïve"), (7, "word " * 60_000)]


@pytest.fixture(scope="module")
def encoder():
    return sentencepiece_bpe.PrefixTableEncoder(MODEL)


def test_every_piece_is_encoded_as_the_library_does(encoder):
    for i in range(encoder.library.get_piece_size()):
        text = encoder.library.id_to_piece(i).replace("▁", " ")
        assert encoder.encode(text) == encoder.library.encode(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([" ", "  ", "\n", "a", "the", "ing", "é", "①", "▁", "aa", ".", ",", "\x00"]), st.text(max_size=4))).map("".join))
def test_any_text_is_encoded_as_the_library_does(encoder, text):
    assert encoder.encode(text) == encoder.library.encode(text)


@pytest.mark.parametrize("n", [*range(1, 70), 1000])
def test_runs_of_blanks(encoder, n):
    for text in (" " * n, "a" + " " * n + "b", " " * n + "①" + " " * n):
        assert encoder.encode(text) == encoder.library.encode(text)


@pytest.mark.parametrize("ask", [common.release_tables, lambda: common.worker_table("another operator", None, dict)])
def test_an_encoder_that_workers_drop_is_gone(ask):
    common.release_tables()
    dropped = sentencepiece_bpe.encoder(MODEL)
    assert dropped.encode("two  words and    blanks") == dropped.library.encode("two  words and    blanks")
    dropped = weakref.ref(dropped)
    ask()
    assert dropped() is None
    common.release_tables()


def test_documents(spark, encoder):
    # extra columns, one of which has a name of the result
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1))
    got = sentencepiece_bpe.encode_and_decode(docs, MODEL).collect()
    want = [(i, [*encoder.library.encode(t or ""), 2]) for i, t in ROWS]
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.decoded == encoder.library.decode(r.ids) for r in got)
    assert sentencepiece_bpe.encode_and_decode(docs.limit(0), MODEL).count() == 0


@pytest.mark.parametrize("n", [1, 5, token_files.BLOCK - 1, token_files.BLOCK, 3 * token_files.BLOCK + 7])
def test_files_round_trip(n):
    rng = np.random.default_rng(n)
    docs = [(5, rng.integers(0, 50_000, n, dtype=np.uint32)), (None, np.array([2], np.uint32)), (9, np.array([2**32 - 1, 0], np.uint32))]
    sink = io.BytesIO()
    writer = token_files.PlaneWriter(sink)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    sink.size = lambda: sink.getbuffer().nbytes
    got = list(token_files.read_documents(sink))
    assert [(i, x.tolist()) for i, _, x in got] == [(i, x.tolist()) for i, x in docs]
    assert [s for _, s, _ in got] == [0, n, n + 1]


def test_write_and_read(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("start", F.lit(0))
    folder = str(tmp_path / "files")
    written = token_files.write_files(docs, BYTES, folder, 2, files=3)
    got = token_files.read_files(spark, folder, written).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 3, 4, 5, 7]
    texts, at = dict(ROWS), 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == [*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert r.start == at
        at += len(ids)
    # the same files again, and none for an empty table
    assert token_files.write_files(docs, BYTES, folder, 2, files=3) == written
    assert token_files.write_files(docs.limit(0), BYTES, folder, 2) == []
    assert token_files.read_files(spark, folder, []).count() == 0


def test_words_give_what_whole_texts_give():
    coder, rng = token_files.PieceEncoder(BYTES), random.Random(5)
    parts = ["It's", " we'll", "  ", "\n\n", " \n", "x1²", "½", "ª", "naïve", "–—", " 12", "...", "漢", "'", "\t", "don't,", "\x85", "\xa0", "\x1c", "\x1f ", "\x0b", "\u2026", "\u2014 ", "<|endoftext|>", "<|", "ǅ"]
    texts = ["".join(rng.choices(parts, k=12)) for _ in range(2000)]
    want = [x.ids for x in coder.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == want


def test_words_of_one_batch_stay_within_the_memory(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 50)
    coder = token_files.PieceEncoder(BYTES)
    texts = [f"one{i} two{i}xé three naïve{'long' * i} ¼½ it's\n {i}" for i in range(300)]
    want = [x.ids for x in coder.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == want
    assert len(coder.memo) <= 50 and max(map(len, coder.memo)) <= 64


def test_files_follow_the_bytes_and_part_equal_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 4000)
    same = spark.createDataFrame([(1, "the same words " * 10)] * 200, "doc_id long, text string")
    for n, docs in ((8, same), (16, same.unionByName(same))):
        written = token_files.write_files(docs, BYTES, str(tmp_path / str(n)), 2)
        assert n // 2 < len(written) <= n and max(d for _, d, _ in written) < 150
        assert token_files.read_files(spark, str(tmp_path / str(n)), written).count() == sum(d for _, d, _ in written) == docs.count()
