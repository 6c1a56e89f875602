"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text are densities and rates over its words: words of a lexicon (plainly spelled, or found only
after undoing obfuscation), second-person words, lexicon words within five words of a second-person word, words in
capitals, exclamation marks, other punctuation, and letters mixed with digits or signs.

The lexicon is learned: words and word beginnings (4 to 6 letters) that are far more frequent in toxic rows. The
labelled rows are parted by a hash of their id: on half of them the lexicon is learned, on a third the trees
(so that they see the lexicon as new texts meet it), on the rest the calibration. Where a part would have fewer than
`LEAST` rows of a label, lexicon and trees share the rows by cross-fitting: a row's features come from a lexicon
learned on the other folds, whose entries need only `FEW_ROWS` toxic rows, and the trees' chances stay as they are.

At most `SAMPLE` labelled rows are learned from, half of them of either label as far as there are so many, those with
the smallest hash; their whole texts are used. Calibration, or the trees without it, weighs the rows of a label by how
many each stands for, so scores are chances at the labels' own shares. Trees and calibration are Spark ML's.

Cases: null and empty texts and texts without words have all features 0 and get the score of such a text; labels
that are null are not learned from, nor are rows whose id is null; an id that is labelled twice or repeated counts as
often as the join gives it; with fewer than two labelled rows of either label, of which none can be held against
what the other teaches, every text scores 0; empty tables, very long texts and other columns need no special care.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from snapmart.llm.common import chunks, col, map_batches, shared_folder, staged, text_table, with_text, worker_table

#: Labelled rows learned from, at most.
SAMPLE = 20_000
#: Rows of either label that a part of its own needs for trees or calibration; with fewer, this many folds share the rows.
LEAST, FOLDS = 5, 5
#: A lexicon entry occurs in so many toxic rows at least, and so many times as often in them as in others.
ENTRY_ROWS, ENTRY_RATIO, ENTRIES = 3, 8.0, 2000
#: Toxic rows of an entry where few rows are shared.
FEW_ROWS = 2
#: Words between a lexicon word and a second-person word that count as near.
NEAR = 5
REMEMBERED = 250_000
# fixed: second-person words of English, German, French and Spanish
_SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros vuestro".split()
)
# fixed: signs written for letters
_SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "+": "t", "*": None, ".": None, "-": None, "_": None, "#": None})
_EDGES = "\"'()[]{}<>.,;:!?…«»„“”‘’|*_#-"
_REPEAT = re.compile(r"(.)\1{2,}")
_INNER = re.compile(r"[^\W\d_][\d@$!+*.\-_#]+[^\W\d_]")
N_WORD = 10
FEATURES = ("words", "lexicon", "lexicon_share", "weight_share", "hidden_share", "second_share", "near_share", "near", "caps_share", "upper_rate", "exclaim_rate", "punct_rate", "mixed_share")


def _beginnings(word: str) -> list[str]:
    """A word as a lexicon may hold it: itself and its beginnings, marked as such."""
    return [word, *(word[:k] + "~" for k in (4, 5, 6) if len(word) > k)]


def _plain(token: str) -> tuple[str, str]:
    """The token's word, and its word with obfuscation undone."""
    bare = token.strip(_EDGES).lower()
    return bare, _REPEAT.sub(r"\1", token.strip("\"'()[]{}<>,;:?").lower().translate(_SIGNS))


def _word_features(token: str, lexicon: dict[str, float]) -> tuple[float, ...]:
    bare, undone = _plain(token)
    weigh = lambda w: max((lexicon.get(x, 0.0) for x in _beginnings(w)), default=0.0)
    plain = weigh(bare)
    hidden = weigh(undone) if not plain and undone != bare else 0.0
    upper = sum(map(str.isupper, token))
    letters = sum(map(str.isalpha, token))
    exclaim = token.count("!") + token.count("?")
    return (
        plain > 0, plain + hidden, hidden > 0, bare in _SECOND_PERSON, upper >= 2 and upper == letters, upper, exclaim,
        sum(not (c.isalnum() or c in "!?") for c in token), bool(_INNER.search(token)), len(token),
    )


class Features:
    """Features of texts, with those of words remembered."""

    def __init__(self, lexicon: dict[str, float]):
        self._lexicon, self._rows, self._table = lexicon, {}, np.zeros((1 << 12, N_WORD), np.float32)

    def texts(self, batch: list[str | None]) -> np.ndarray:
        found = [t.split() if t else [] for t in batch]
        if len(self._rows) > REMEMBERED:
            self._rows.clear()
        rows = self._rows
        for part in chunks([w for w in set().union(*found) if w not in rows], 4096):
            at = len(rows)
            while at + len(part) > len(self._table):
                self._table = np.concatenate([self._table, np.zeros_like(self._table)])
            self._table[at : at + len(part)] = [_word_features(w, self._lexicon) for w in part]
            rows.update(zip(part, range(at, at + len(part)), strict=True))
        return np.array([self._of(self._table[np.fromiter(map(rows.__getitem__, f), np.int64, len(f))]) for f in found]).reshape(len(found), len(FEATURES))

    @staticmethod
    def _of(w: np.ndarray) -> list[float]:
        n = len(w)
        if not n:
            return [0.0] * len(FEATURES)
        plain, weight, hidden, second, caps, upper, exclaim, punct, mixed, size = w.sum(axis=0, dtype=np.float64).tolist()
        near = 0
        if plain + hidden and second:
            hits, persons = np.flatnonzero(w[:, 0] + w[:, 2]), np.flatnonzero(w[:, 3])
            at = np.searchsorted(persons, hits)
            left = hits - persons[np.maximum(at - 1, 0)]
            right = persons[np.minimum(at, len(persons) - 1)] - hits
            near = int(((np.abs(left) <= NEAR) | (np.abs(right) <= NEAR)).sum())
        hits_n = plain + hidden
        return [
            math.log1p(n), math.log1p(hits_n), hits_n / n, weight / n, hidden / n, second / n, near / max(hits_n, 1), math.log1p(near),
            caps / n, upper / size, exclaim / size, punct / size, mixed / n,
        ]


def _features(lexicon: dict[str, float]) -> Features:
    """One table of features for each lexicon and worker process; an earlier lexicon's goes."""
    key = hashlib.md5(repr(sorted(lexicon.items())).encode()).hexdigest()
    return worker_table(f"toxicity {key}", None, lambda: Features(lexicon))


def featurise(docs: DataFrame, lexicon: dict[str, float], keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """The columns `keep`, numbered, with the vector `features`."""
    source = with_text(docs, keep, text)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most ENTRIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _features(shared.value)
        for batch in batches:
            for rows in chunks(range(batch.num_rows), 256):
                part = batch.slice(rows[0], len(rows))
                got = table.texts(part.column(len(keep)).to_pylist())
                offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.ListArray.from_arrays(offsets, pa.array(got.ravel()))], names=[*names, "f"])

    names = source.columns[:-1]
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("f", T.ArrayType(T.DoubleType()))])
    return map_batches(source, run, schema).select(*names, array_to_vector("f").alias("features"))


def learn_lexicon(rows: DataFrame, entry_rows: int = ENTRY_ROWS) -> dict[str, float]:
    """Entries and their log ratios, from rows (text, label) of a bounded sample."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for t, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = {_plain(w)[0] for w in set(t.split())}
                counts.update((x, label) for x in {x for w in tokens if len(w) > 2 for x in _beginnings(w)})
            yield pa.RecordBatch.from_pydict({"entry": [w for w, _ in counts], "label": pa.array([y for _, y in counts], pa.int32()), "n": pa.array(counts.values(), pa.int64())})

    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return {}
    counts = map_batches(rows, counted, "entry string, label int, n long").groupBy("entry").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("other")
    )
    ratio = ((F.col("toxic") + 0.5) / (totals[1] + 1.0)) / ((F.col("other") + 0.5) / (totals[0] + 1.0))
    kept = counts.withColumn("ratio", ratio).filter((F.col("toxic") >= entry_rows) & (F.col("ratio") >= ENTRY_RATIO))
    best = kept.orderBy((F.col("toxic") * F.log("ratio")).desc(), "entry").limit(ENTRIES).collect()
    return {r["entry"]: math.log(r["ratio"]) for r in best}


class Model:
    """A lexicon with the trees and, if any, their calibration; without trees every text scores 0."""

    def __init__(self, lexicon: dict[str, float], trees: GBTClassificationModel | None, calibration: IsotonicRegressionModel | None):
        self.lexicon, self.trees, self.calibration = lexicon, trees, calibration

    def score(self, docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
        """The columns `keep` with the score, 0 to 1."""
        if self.trees is None:
            return text_table(docs, *keep).withColumn("score", F.lit(0.0))
        names = [f"_{k}" for k in range(len(keep))]
        scored = self.trees.transform(featurise(docs, self.lexicon, keep, text)).select(*names, _raw("probability").alias("raw"))
        scored = self.calibration.transform(scored) if self.calibration else scored.withColumnRenamed("raw", "prediction")
        return scored.select(*names, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "prediction"))).toDF(*keep, "score")


def _raw(probability: str) -> Column:
    return vector_to_array(probability)[1]


def _sampled(labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, float]]:
    """The rows (doc_id, label, h) to learn from, at most `sample`, and how many labelled rows each stands for, by label."""
    there = {0: 0, 1: 0} | {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic = min(there[1], max(sample // 2, sample - there[0]))
    taken = {0: min(there[0], sample - toxic), 1: toxic}
    least = [labels.filter(F.col("label") == y).orderBy("h").limit(n) for y, n in taken.items()]
    return least[0].unionByName(least[1]), {y: there[y] / max(n, 1) for y, n in taken.items()}


def _trees(seen: DataFrame, weight: Column) -> GBTClassificationModel:
    trees = GBTClassifier(labelCol="label", weightCol="weight", maxIter=20, maxDepth=3, stepSize=0.2, seed=7, minInstancesPerNode=2)
    return trees.fit(seen.withColumn("weight", weight).coalesce(4))


def _parted(rows: DataFrame, folder: str, weight: Column) -> Model:
    """A model from rows (text, label, turn): lexicon, trees and calibration each from a part of them."""
    part = F.pmod("turn", F.lit(6))
    lexicon = learn_lexicon(rows.filter(part < 3).select("text", "label"))
    seen = featurise(rows.filter(part >= 3).withColumn("part", part), lexicon, ("label", "part")).toDF("label", "part", "features")
    seen = staged(seen, folder, "features")
    trees = _trees(seen.filter("part < 5"), F.lit(1.0))
    held = trees.transform(seen.filter("part = 5")).select(_raw("probability").alias("raw"), F.col("label").cast("double").alias("label"), weight.alias("weight"))
    return Model(lexicon, trees, IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight").fit(held))


def _cross_fitted(rows: DataFrame, folder: str, weight: Column, folds: int) -> Model:
    """A model from rows (text, label, turn): lexicon and trees from all of them."""
    # turns are dealt anew, so that every fold has rows of either label though some labelled ids may have no text
    place = F.row_number().over(Window.partitionBy("label").orderBy("turn"))
    dealt = rows.select("label", "turn").distinct().withColumn("fold", F.pmod(place, F.lit(folds)))
    rows = staged(rows.join(F.broadcast(dealt), ["label", "turn"]).select("text", "label", "fold"), folder, "folds")
    fold, seen = F.col("fold"), []
    for k in range(folds):
        lexicon = learn_lexicon(rows.filter(fold != k).select("text", "label"), FEW_ROWS)
        seen.append(featurise(rows.filter(fold == k), lexicon, ("label",)).toDF("label", "features"))
    seen = staged(functools.reduce(DataFrame.unionByName, seen), folder, "features")
    return Model(learn_lexicon(rows.select("text", "label"), FEW_ROWS), _trees(seen, weight), None)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """A model from the rows of `docs` that `labels` (doc_id, toxic 0/1) marks; give only rows to learn from."""
    folder = shared_folder(docs.sparkSession)
    marked = text_table(labels, doc_id, toxic).select(col(doc_id).alias("doc_id"), col(toxic).cast("int").alias("label"), F.xxhash64(col(doc_id)).alias("h"))
    marked, stands_for = _sampled(marked.filter("doc_id IS NOT NULL AND label IN (0, 1)"), sample)
    texts = text_table(docs, doc_id, text).select(col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))
    turn = F.row_number().over(Window.partitionBy("label").orderBy("h"))  # at most `sample` rows, before they get their texts
    rows = texts.join(F.broadcast(marked.withColumn("turn", turn)), "doc_id")
    rows = staged(rows.select("text", "label", "turn"), folder, "labelled")
    part = F.greatest(F.pmod("turn", F.lit(6)), F.lit(2))
    counts = {(r["part"], r["label"]): r["n"] for r in rows.groupBy(part.alias("part"), "label").agg(F.count("*").alias("n")).collect()}
    of = lambda label, *parts: sum(counts.get((p, label), 0) for p in parts)
    weight = F.when(F.col("label") == 1, stands_for[1]).otherwise(stands_for[0])
    if all(of(y, 2) and of(y, 3, 4) >= LEAST and of(y, 5) >= LEAST for y in (0, 1)):
        return _parted(rows, folder, weight)
    turns = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.countDistinct("turn").alias("n")).collect()}
    folds = min(FOLDS, *(turns.get(y, 0) for y in (0, 1)))
    return _cross_fitted(rows, folder, weight, folds) if folds > 1 else Model({}, None, None)
