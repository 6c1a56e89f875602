"""Quality rules on repetition, from a suffix array over the words of each text.

The suffixes of a text's words are sorted by prefix doubling, many texts at a time (suffixes of different texts
never compare equal). The longest common prefixes of neighbours in that order give the intervals of the maximal
repeated substrings: a word lies in a repeat of `length` words or more if a suffix that starts before it shares a
prefix that reaches beyond it with a neighbour. The spans are united; the rules limit the share of words they
cover and the longest repeat. With a length of 5 the covered words are those in 5-word windows that occur twice.

Cases: a null text has no words; a text without words fails the base rules; repeated rows give repeated rows; an
empty table gives an empty one; very long texts are sorted whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.llm.common import map_batches, with_text

#: A repeat for the base rule, in words, and the percentage of words in such repeats that it allows.
WINDOW, MOST_PERCENT = 5, 20
LEAST_WORDS = 10
#: The method's limits: percentage of words in repeats of `LONG` words or more, and the longest repeat in words. Long repeats
#: are twice as long as the base rule's windows and may cover half as much; at its share they would fail its rule first.
LONG, LONG_PERCENT, LONGEST = 10, 10, 50
#: Bytes of text sorted at a time, about.
TOGETHER = 1 << 19
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_WHITE = np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8)


class _Numbers(dict):
    """Numbers things in the order they come."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def repeat_lengths(symbols: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each place the longest prefix that its suffix shares with another suffix of the same text.

    symbols, text: for each place its symbol and the number of its text, ascending.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    end = np.searchsorted(text, text, "right")  # one past each place's text
    key = text.astype(np.int64) * (int(symbols.max()) + 1) + symbols
    rank = np.empty(n + 1, np.int64)
    active = np.argsort(key, kind="stable")
    sorted_key = key[active]
    ranks, steps = [], []
    start = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank[active] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    rank[n] = -1
    step = 1
    while True:
        tied = ~start | np.concatenate([~start[1:], [False]])
        active = active[tied]
        if not len(active):
            break
        ranks.append(rank.copy())
        steps.append(step)
        after = active + step
        second = np.where(after < end[active], rank[np.minimum(after, n)], -1 - active)  # a text's end differs from all
        first = rank[active]
        order = np.lexsort((second, first))
        active, first, second = active[order], first[order], second[order]
        new_first = np.concatenate([[True], first[1:] != first[:-1]])
        start = new_first | np.concatenate([[True], second[1:] != second[:-1]])
        at = np.arange(len(active))
        group = np.maximum.accumulate(np.where(new_first, at, 0))
        rank[active] = first + np.maximum.accumulate(np.where(start, at, 0)) - group
        step *= 2
    order = np.empty(n, np.int64)
    order[rank[:n]] = np.arange(n)
    i, j = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(max(n - 1, 0), np.int64)
    for levels, size in zip(reversed(ranks), reversed(steps), strict=True):
        same = (i < n) & (j < n)
        same[same] = levels[i[same]] == levels[j[same]]
        shared[same] += size
        i[same] += size
        j[same] += size
        i, j = np.where(i >= end[order[:-1]], n, i), np.where(j >= end[order[1:]], n, j)
    longest = np.zeros(n, np.int64)
    longest[order[:-1]] = shared
    longest[order[1:]] = np.maximum(longest[order[1:]], shared)
    return longest


def covered(longest: np.ndarray, length: int) -> np.ndarray:
    """Which places lie in a repeat of `length` or more."""
    n = len(longest)
    at = np.flatnonzero(longest >= length)
    change = np.bincount(at, minlength=n + 1) - np.bincount(at + longest[at], minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def _measure(texts: list[bytes]) -> np.ndarray:
    """Columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, long_repeat_words, longest_repeat."""
    out = np.zeros((len(texts), 7), np.int64)
    numbers = _Numbers()
    symbols = []
    for row, text in zip(out, texts, strict=True):
        found = text.split()
        symbols.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
        count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        lines = [x for x in text.split(b"\n") if x.strip()]
        row[:4] = len(found), count.sum() - count[0x80:0xC0].sum() - count[_WHITE].sum(), count[_SYMBOLS].sum(), len(lines) - len(set(lines))
    sizes = out[:, 0]
    owner = np.repeat(np.arange(len(texts)), sizes)
    longest = repeat_lengths(np.concatenate(symbols), owner)
    for column, length in ((4, WINDOW), (5, LONG)):
        out[:, column] = np.bincount(owner, weights=covered(longest, length), minlength=len(texts))
    np.maximum.at(out[:, 6], owner, longest)
    return out


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "long_repeat_words", "longest_repeat")


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` with the measures of each whole text."""
    source = with_text(docs, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.binary())
            sizes = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in texts])
            groups = np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes // TOGETHER)) + 1)
            for rows in groups:
                if len(rows):
                    part = batch.slice(int(rows[0]), len(rows))
                    got = _measure([t or b"" for t in texts[int(rows[0]) : int(rows[-1]) + 1].to_pylist()])
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *map(pa.array, got.T)], names=[*names, *MEASURES])

    names = source.columns[:-1]
    schema = T.StructType([*source.schema.fields[:-1], *[T.StructField(m, T.LongType()) for m in MEASURES]])
    return map_batches(source, run, schema).toDF(*keep, *MEASURES)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_PERCENT * F.col("n_words"))


def repetitive() -> Column:
    """The method's verdict."""
    return (100 * F.col("long_repeat_words") > LONG_PERCENT * F.col("n_words")) | (F.col("longest_repeat") > LONGEST)
