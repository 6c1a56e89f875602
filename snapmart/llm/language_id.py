"""Language identification by unigrams over pieces, summed over all segmentations.

For each language the model has a probability of every piece of a fixed public vocabulary. A word's probability is
the sum over all ways to cut it into pieces of the product of their probabilities; the forward algorithm sums them
in one pass. A text's score is the sum of its words' log-probabilities, and the language with the highest is
predicted. Words are runs of letters, lower-cased, with the vocabulary's word mark before them; a run of over 64
letters is taken as words of 64. A character outside the vocabulary is a piece of a small fixed probability.

The probabilities are trained by expectation maximisation (forward-backward over all segmentations) on the word
counts of a sample of the labelled rows: the whole texts of `SAMPLE` rows per language, those with the smallest
hash of doc_id. Each step is a Spark job over the table of word counts; the driver sees a table of pieces by
languages, whose size doesn't depend on the data.

The words of a batch are scored together with numpy, and scores of words are remembered in bounded memory.

Cases: a null text or one without a letter is `und` with score 0, as is every text if no language could be learned;
rows with a null lang or doc_id are never learned from; ties go to the language first in code point order; empty
tables, repeated rows and very long texts need no special care; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from snapmart.llm.common import chunks, col, map_batches, shared_folder, staged, text_table, with_text, worker_table

UNDETERMINED = "und"
#: Labelled rows learned from, per language.
SAMPLE = 2000
STEPS = 3
#: Of a character outside the vocabulary, and the count added to every piece.
UNKNOWN, ADDED = 1e-7, 0.05
#: Remembered words of a worker: 8 bytes a language and about 150 more each.
REMEMBERED = 600_000
_WORD = re.compile(r"[^\W\d_]{1,64}")
#: Brings the probability of a cut word near 1 for a word of any length.
_SCALE = 16.0


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Lattice:
    """All segmentations of many words at once: edges (start, end, piece) grouped by the place of their end."""

    def __init__(self, pieces: list[str]):
        import ahocorasick

        self.pieces, self.mark = pieces, "▁"
        self._automaton = ahocorasick.Automaton()
        for i, p in enumerate(pieces):
            self._automaton.add_word(p, (i, len(p)))
        self._automaton.make_automaton()

    def edges(self, found: list[str]) -> tuple[list[tuple[np.ndarray, ...]], np.ndarray, int]:
        """For each place in a word its edges as arrays start, end, piece (-1: unknown); the words' ends; states."""
        joined = self.mark + f"\n{self.mark}".join(found)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
        begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        hits = [(end, i, n) for end, (i, n) in self._automaton.iter(joined)]
        hits = np.array(hits, np.int64).reshape(-1, 3)
        # state x of the joined text is the place before its character x; a word's last state is its separator's
        ends, starts, piece = hits[:, 0] + 1, hits[:, 0] + 1 - hits[:, 2], hits[:, 1]
        single = np.concatenate([np.arange(b, b + n) for b, n in zip(begins, lengths, strict=True)]) if len(found) else begins
        known = np.zeros(len(joined) + 1, bool)
        known[starts[hits[:, 2] == 1]] = True
        single = single[~known[single]]
        starts, ends = np.concatenate([starts, single]), np.concatenate([ends, single + 1])
        piece = np.concatenate([piece, np.full(len(single), -1)])
        place = ends - np.repeat(begins, lengths + 1)[starts] if len(starts) else ends
        order = np.lexsort((ends, place))
        starts, ends, piece, place = starts[order], ends[order], piece[order], place[order]
        cuts = np.flatnonzero(np.diff(place)) + 1
        levels = list(zip(np.split(starts, cuts), np.split(ends, cuts), np.split(piece, cuts), strict=True))
        return levels, begins + lengths, len(joined) + 1

    def forward(self, found: list[str], theta: np.ndarray):
        """Scaled sums over all segmentations up to each state, with the levels and the words' ends."""
        levels, last, states = self.edges(found)
        alpha = np.zeros((states, theta.shape[1]))
        alpha[last - np.fromiter(map(len, found), np.int64, len(found)) - 1] = 1.0
        for starts, ends, piece in levels:
            width = (ends - starts)[:, None]
            flow = alpha[starts] * theta[piece] * _SCALE**width
            first = np.flatnonzero(np.concatenate([[True], np.diff(ends) > 0]))
            alpha[ends[first]] = np.add.reduceat(flow, first)
        return alpha, levels, last

    def scores(self, found: list[str], theta: np.ndarray) -> np.ndarray:
        """log P(word) in each language."""
        alpha, _, last = self.forward(found, theta)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
        return np.log(np.maximum(alpha[last], 1e-300)) - (lengths * np.log(_SCALE))[:, None]

    def expected(self, found: list[str], counts: np.ndarray, theta: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in each language, over all segmentations; counts: words by languages."""
        alpha, levels, last = self.forward(found, theta)
        beta = np.zeros_like(alpha)
        beta[last] = counts / np.maximum(alpha[last], 1e-300)
        out = np.zeros((len(self.pieces) + 1, theta.shape[1]))
        for starts, ends, piece in reversed(levels):
            back = theta[piece] * _SCALE ** (ends - starts)[:, None] * beta[ends]
            np.add.at(out, piece, alpha[starts] * back)
            np.add.at(beta, starts, back)
        return out[:-1]


@lru_cache(maxsize=2)
def lattice(model_path: str) -> Lattice:
    """The pieces of a SentencePiece model; only their spelling is used."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
    odd = lambda i: lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i)
    return Lattice([lib.id_to_piece(i) for i in range(lib.get_piece_size()) if not odd(i)])


class Scorer:
    """Log-probabilities of texts, with those of words remembered."""

    def __init__(self, model_path: str, theta: np.ndarray):
        self._lattice, self._theta = lattice(model_path), theta
        self._rows: dict[str, int] = {}
        self._table = np.zeros((1 << 12, theta.shape[1] + 1))

    def texts(self, batch: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Scores (texts by languages) and whether a text has a letter."""
        found = [words(t) if t else [] for t in batch]
        if len(self._rows) > REMEMBERED:
            self._rows.clear()
        rows = self._rows
        new = [w for w in set().union(*found) if w not in rows]
        for part in chunks(new, 4096):
            at = len(rows)
            while at + len(part) > len(self._table):
                self._table = np.concatenate([self._table, np.zeros_like(self._table)])
            lettered = np.array([any(map(str.isalpha, w)) for w in part], float)
            self._table[at : at + len(part), :-1] = self._lattice.scores(part, self._theta) * lettered[:, None]
            self._table[at : at + len(part), -1] = lettered
            rows.update(zip(part, range(at, at + len(part)), strict=True))
        sums = np.array([self._table[np.fromiter(map(rows.__getitem__, f), np.int64, len(f))].sum(axis=0) for f in found]).reshape(len(found), -1)
        return sums[:, :-1], sums[:, -1] > 0


def learn(labelled: DataFrame, model_path: str, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages, and their probabilities of each piece (the last row: of an unknown character)."""
    spark = labelled.sparkSession
    rows = text_table(labelled, doc_id, text, lang).select(
        col(doc_id).alias("doc_id"), col(text).alias("text"), col(lang).alias("lang"), F.xxhash64(col(doc_id)).alias("h")
    )
    rows = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    bounds = rows.select("lang", "h").withColumn("r", rank).filter(F.col("r") <= sample).groupBy("lang").agg(F.max("h").alias("h"))
    most = {r["lang"]: r["h"] for r in bounds.collect()}  # one row a language
    langs = sorted(most, key=lambda x: x.encode())
    if not langs:
        return [], np.zeros((0, 0))
    chosen = rows.filter(F.col("h") <= F.create_map(*[F.lit(x) for pair in most.items() for x in pair])[F.col("lang")])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for t, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.update((w, k) for w in words(t))
            yield pa.RecordBatch.from_pydict({"word": [w for w, _ in counts], "k": pa.array([k for _, k in counts], pa.int32()), "n": pa.array(counts.values(), pa.int64())})

    place = F.create_map(*[F.lit(x) for pair in zip(langs, range(len(langs)), strict=True) for x in pair])[F.col("lang")]
    table = map_batches(chosen.select("text", place.cast("int").alias("k")), counted, "word string, k int, n long")
    table = staged(table.groupBy("word", "k").agg(F.sum("n").alias("n")), shared_folder(spark), "words")
    pieces = lattice(model_path).pieces
    theta = np.full((len(pieces) + 1, len(langs)), 1.0 / len(pieces))
    theta[-1] = UNKNOWN
    for _ in range(STEPS):
        shared = spark.sparkContext.broadcast(theta)  # pieces by languages

        def expected(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            now, total = shared.value, None
            for batch in batches:
                for part in chunks(zip(*(c.to_pylist() for c in batch.columns), strict=True), 4096):
                    counts = np.zeros((len(part), now.shape[1]))
                    counts[np.arange(len(part)), [k for _, k, _ in part]] = [n for *_, n in part]
                    got = lattice(model_path).expected([w for w, *_ in part], counts, now)
                    total = got if total is None else total + got
            if total is not None:
                at = np.nonzero(total)
                yield pa.RecordBatch.from_pydict({"piece": at[0], "k": at[1], "n": total[at]})

        sums = map_batches(table, expected, "piece long, k long, n double").groupBy("piece", "k").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full((len(pieces), len(langs)), ADDED)
        counts[sums["piece"], sums["k"]] += sums["n"]
        theta = np.vstack([counts / counts.sum(axis=0), np.full((1, len(langs)), UNKNOWN)])
    return langs, theta


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` with lang_pred and score, the predicted language's share of the text's probability."""
    langs, theta = model
    if not langs:
        return text_table(docs, *keep).select("*", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    source = with_text(docs, keep, text)
    shared = docs.sparkSession.sparkContext.broadcast(theta)  # pieces by languages
    fields = source.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model_path, shared.value)
        for batch in batches:
            for rows in chunks(range(batch.num_rows), 256):
                part = batch.slice(rows[0], len(rows))
                sums, lettered = scorer.texts(part.column(len(keep)).to_pylist())
                best = sums.argmax(axis=1)
                share = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                names = [langs[b] if y else UNDETERMINED for b, y in zip(best, lettered, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(names, pa.string()), pa.array(np.where(lettered, share, 0.0))], names=[*[f.name for f in fields], "lang_pred", "score"])

    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_batches(source, run, schema).toDF(*keep, "lang_pred", "score")


def _scorer(model_path: str, theta: np.ndarray) -> Scorer:
    """One scorer for each model and worker process; an earlier model's goes."""
    return worker_table(f"language {hashlib.md5(theta.tobytes()).hexdigest()}", model_path, lambda: Scorer(model_path, theta))


def bucket(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo `of`."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(of))
