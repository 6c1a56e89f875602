"""Encoding and decoding with a merge-type (BPE) SentencePiece model by a prefix table.

Every prefix of a BPE-encoded string has exactly one last token. The table stores it for each prefix: an
automaton gives the pieces that end at the prefix's end, and of these the one is right that can stand behind the
last token of the prefix before it, i.e. no merge of an earlier rank would have joined the two. The ids of the
whole string are then recovered backwards, from the last token of the longest prefix.

Texts are cut where no piece can reach across (before a word's white-space mark, at characters outside the
vocabulary), and the ids of short pieces of text are remembered in bounded memory. Whole texts are encoded, of
any length; the table is linear in it.

Cases: a null text is encoded as an empty one; an empty text has the end id only; characters outside the
vocabulary become their UTF-8 byte pieces; repeated rows give repeated rows; an empty table gives an empty one;
other columns of the table are ignored.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from snapmart.llm.common import Memo, chunks, map_batches, with_text, worker_table

MARK = "▁"
#: Remembered pieces of text per generation and worker, about 200 bytes each.
REMEMBERED = 200_000
#: Texts handled at a time within a batch.
TEXTS = 256


class PrefixTableEncoder:
    """Encodes text as the library does with the same model file."""

    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        lib, size = self.library, self.library.get_piece_size()
        special = lambda i: lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)
        pieces = {lib.id_to_piece(i): i for i in range(size) if not special(i)}
        self._byte = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self._runs = {len(p): i for p, i in pieces.items() if set(p) == {MARK}}
        words = sorted((p for p in pieces if len(p) > 1 and set(p) != {MARK}), key=lambda p: -lib.get_score(pieces[p]))
        scores = [lib.get_score(pieces[p]) for p in words]
        run_scores = {lib.get_score(i) for n, i in self._runs.items() if n > 1}
        if (
            len(set(scores)) < len(scores)
            or any(MARK in p[1:] for p in words)
            or (run_scores and (len(run_scores) > 1 or max(run_scores) >= min(scores)))
            or not {c for p in pieces for c in p} <= pieces.keys()
        ):
            raise ValueError(f"{model_path} is no merge-type model with one rank for each piece")
        # rank of the merge that makes a piece (-1: a single character), its length and its two halves
        self._rank = [-1] * size
        self._length = [1] * size
        self._halves: list[tuple[int, int] | None] = [None] * size
        self._merged: dict[tuple[int, int], int] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._ints = list(range(size))
        self._automaton = ahocorasick.Automaton()
        for p, i in pieces.items():
            if len(p) == 1:
                self._automaton.add_word(p, (i, 1))
        made = {p for p in pieces if len(p) == 1}
        for rank, p in enumerate(words):
            i = pieces[p]
            for k in range(1, len(p)):
                a, b = p[:k], p[k:]
                if a in made and b in made and self._stay_apart(pieces[a], pieces[b]):
                    self._rank[i], self._length[i], self._halves[i] = rank, len(p), (pieces[a], pieces[b])
                    self._merged[pieces[a], pieces[b]] = rank
                    self._automaton.add_word(p, (i, len(p)))
                    made.add(p)
                    break
        self._automaton.make_automaton()
        self._pairs.clear()
        hard = "" if any("\n" in p for p in pieces) else "\n"
        letters = "".join(map(chr, filter(lambda c: chr(c).isalpha(), range(0x250))))
        closing = "".join(c for c in ".,;:!?)|" if not any(p[k] == c and p[k - 1] in letters for p in pieces for k in range(1, len(p))))
        before = f"{MARK}*[{letters}]++(?=[{re.escape(closing)}])|" if closing else ""  # no piece has a letter and then such a mark
        self._cut = re.compile(f"{before}{MARK}*[^{MARK}{hard}]+|{MARK}+" + (f"|{hard}+" if hard else ""))
        self._mark = pieces.get(MARK)
        self.memo = Memo(self._unit, REMEMBERED)
        self._run = functools.lru_cache(maxsize=4096)(self._marks)  # its own: one of the class would hold every encoder for good

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether no merge joins pieces `a` and `b` before both are complete, nor after.

        Their merges are undone, latest first (of two with one rank the right one is made last); each pair of
        pieces that then meets at the border must not merge before the merge just undone.
        """
        rank, halves, merged = self._rank, self._halves, self._merged
        before = 1 << 60
        while True:
            joined = merged.get((a, b))
            if joined is not None and joined < before:
                return False
            if rank[a] > rank[b]:
                before, a = rank[a], halves[a][1]
            elif rank[b] >= 0:
                before, b = rank[b] + 1, halves[b][0]
            else:
                return True

    def _word(self, word: str) -> list[int]:
        """Ids of a word without inner white-space marks; negative: that character, outside the vocabulary."""
        last: list[int | None] = [None] * (len(word) + 1)
        pairs, apart = self._pairs, self._stay_apart
        if len(pairs) > 300_000:
            pairs.clear()
        for end, (piece, length) in self._automaton.iter(word):  # of one end the longest comes first
            end += 1
            if last[end] is None:
                start = end - length
                before = last[start] if start else None
                if before is not None:
                    fits = pairs.get((before, piece))
                    if fits is None:
                        fits = pairs[before, piece] = apart(before, piece)
                    if not fits:
                        continue
                last[end] = piece
        ids, end, length, ints = [], len(word), self._length, self._ints
        while end:
            piece = last[end]
            if piece is None:
                ids.extend(self._byte[b] for b in reversed(word[end - 1].encode()))
                end -= 1
            else:
                ids.append(ints[piece])
                end -= length[piece]
        ids.reverse()
        return ids

    def _marks(self, n: int) -> tuple[int, ...]:
        """Ids of n white-space marks. Their pieces share one score, so the leftmost pair merges first."""
        size, after = [1] * n, [*range(1, n), None]
        before = [None, *range(n - 1)]
        heap = [(k, 1, 1) for k in range(n - 1)] if 2 in self._runs else []
        while heap:
            k, a, b = heapq.heappop(heap)
            r = after[k]
            if size[k] != a or r is None or size[r] != b:
                continue
            size[k], size[r], after[k] = a + b, 0, after[r]
            if after[k] is not None:
                before[after[k]] = k
            for left in (before[k], k):
                if left is not None and (right := after[left]) is not None and size[left] + size[right] in self._runs:
                    heapq.heappush(heap, (left, size[left], size[right]))
        return tuple(self._runs[s] for s in size if s)

    def _unit(self, unit: str) -> tuple[int, ...]:
        word = unit.lstrip(MARK)
        marks = len(unit) - len(word)
        if not word:
            return self._run(marks)
        if not marks:
            return tuple(self._word(word))
        ids = self._word(MARK + word)
        if ids[0] != self._mark:
            return (self._run(marks - 1) if marks > 1 else ()) + tuple(ids)
        return self._run(marks) + tuple(ids[1:])  # a mark that joins no word joins the marks before it

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        units = self._cut.findall(MARK + text.replace(" ", MARK))
        return list(chain.from_iterable(map(self.memo.__getitem__, units)))


def encoder(model_path: str) -> PrefixTableEncoder:
    """One encoder for each worker process."""
    return worker_table("sentencepiece", model_path, lambda: PrefixTableEncoder(model_path))


def encode_and_decode(df: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` with `ids` (the text's ids, then the end id) and `decoded` (the text the ids stand for).

    `model_path` is a file that every worker has.
    """
    source = with_text(df, keep, text)
    schema = T.StructType(
        [*source.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False), T.StructField("decoded", T.StringType(), False)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model_path)
        end, decode = coder.library.eos_id(), coder.library.decode
        for batch in batches:
            for rows in chunks(range(batch.num_rows), TEXTS):
                part = batch.slice(rows[0], len(rows))
                encoded = [[*coder.encode(t or ""), end] for t in part.column(len(keep)).to_pylist()]
                offsets = np.cumsum([0, *map(len, encoded)]).astype(np.int32)
                flat = np.fromiter(chain.from_iterable(encoded), np.int32, offsets[-1])
                decoded = [decode(ids) for ids in encoded]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(decoded, pa.string())],
                    schema=pa.schema([*[part.schema.field(i) for i in range(len(keep))], pa.field("ids", pa.list_(pa.field("element", pa.int32(), False)), False), pa.field("decoded", pa.string(), False)]),
                )

    return map_batches(source, run, schema).toDF(*keep, "ids", "decoded")
