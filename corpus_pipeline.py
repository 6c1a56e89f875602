"""The pipeline over documents: toxicity, near-duplicates, repeated passages, mixing of sources, SentencePiece ids.

Each stage takes whole documents and returns whole documents with all their columns; the last returns token ids.
A stage's documents are a written table; when it begins, the intermediate tables of the stage before are deleted, those of
other operators of the session never.

Cases, for all stages: null and empty texts, null ids and repeated rows are rows like others; an empty table gives an empty one;
very long texts are read whole; other columns, whatever their names, go through as they are.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import language_id, mixing, near_duplicates, sentencepiece_bpe, suffix_dedup, toxicity
from snapmart.llm.common import col, noted_folders, release_folders, shared_folder, staged
from snapmart.llm.queries import table, tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a model, learned from labels of ids outside the held-out fifth, rejects.

    Null and empty texts get the score of a text without words; repeated rows are all judged alike; without labels of
    both kinds nothing is rejected.
    """
    learnable = F.coalesce(language_id.bucket(F.col("doc_id"), 5) != 0, F.lit(False))
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(learnable))
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    scored = model.score(numbered, keep=tuple(numbered.columns), text=numbered.columns[docs.columns.index("text")])
    return scored.filter("score < 0.5").drop("score").toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id (of its texts in the group, if the id repeats, one).

    An id with texts in several groups stays once for each group that it leads. Documents without words and those without an id all stay.
    """
    found = near_duplicates.near_duplicates(docs, words=5, percent=80)
    found = staged(found, shared_folder(spark), "groups")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    leads = (F.col("doc_id") == F.col("component_id")) & (F.col("text_key") == F.col("component_key"))
    first = found.filter(~alone & leads).select("doc_id", "text_key").distinct()
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    doc_id, text = (F.col(numbered.columns[docs.columns.index(n)]) for n in ("doc_id", "text"))
    keyed = numbered.withColumns({"_id": doc_id, "_key": F.xxhash64(text)})
    kept = keyed.join(first.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")), ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"])
    wordless = keyed.filter(doc_id.isNull() | (mixing.n_words(text) == 0))
    return kept.unionByName(wordless).select(*numbered.columns).toDF(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated strings; a character that is cut becomes U+FFFD; n_chars follows."""
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    name = dict(zip(docs.columns, numbered.columns, strict=True))
    left = suffix_dedup.remove_repeats(numbered, text=name["text"], keep=tuple(numbered.columns))
    whole = F.when(F.col("n_removed") > 0, F.make_valid_utf8(F.col("kept").cast("string"))).otherwise(F.col(name["text"]))
    new = {"text": whole} | ({"n_chars": F.coalesce(F.length(whole).cast("long"), F.lit(0))} if "n_chars" in name else {})
    return left.select(*[new.get(n, F.col(c)).alias(c) for n, c in name.items()]).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it; not at all if it isn't taken.

    Null and empty texts have no words and are not taken; a null source is a source of its own; rows with the same id, text
    and source are taken as often as the mix takes all of them.
    """
    mixed = mixing.mix(docs).filter("copies > 0").groupBy("doc_id", "source", "u").agg(F.sum("copies").alias("copies"))
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    name = dict(zip(docs.columns, numbered.columns, strict=True))
    keyed = numbered.withColumn("_u", mixing.chance(F.col(name["doc_id"]), F.col(name["text"]))).dropDuplicates([name["doc_id"], name["source"], "_u"])
    same = (F.col("_u") == F.col("u")) & F.col(name["doc_id"]).eqNullSafe(F.col("doc_id")) & F.col(name["source"]).eqNullSafe(F.col("source"))
    taken = keyed.join(mixed, same).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select(*numbered.columns).toDF(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids of the whole text with the end id, and the text they stand for.

    A null or empty text has the end id only; every row has its ids, repeated or not.
    """
    keep = tuple(n for n in ("doc_id", "lang", "source") if n in docs.columns)
    encoded = sentencepiece_bpe.encode_and_decode(docs, tokenizer("piece_bpe_32k.model"), keep=keep)
    return encoded.select(*map(col, keep), F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


#: Folders of the intermediate tables of the stage that was called last.
_LAST: list[str] = []


def _begun(stage: Stage) -> Stage:
    """The stage; when it is called the stage before has been written, so that one's intermediate tables go."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_folders(spark, _LAST)
        with noted_folders() as mine:
            result = stage(spark, docs, sf_dir)
        _LAST.extend(mine)
        return result

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _begun(drop_toxic)),
    ("near-duplicates", _begun(drop_near_duplicates)),
    ("suffix-array dedup", _begun(drop_repeated_passages)),
    ("mixing", _begun(mix_sources)),
    ("sentencepiece", _begun(token_ids)),
]

#: No SQL: stages rest on a trained model and a tokenizer; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again; a stage's table goes when the next is written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            folder = shared_folder(spark)
            docs = staged(docs, folder, f"stage-{k}")
            release_folders(spark, before)
            before = [folder]
    return docs
