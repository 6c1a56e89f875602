"""Token ids as bit-plane files.

A file holds the ids of consecutive documents. They are cut into blocks of `BLOCK` ids; a block is transposed into
its 32 bit planes (plane b has bit b of every id), each plane is compressed with zstandard, and planes of zeros
are left out. Small, slowly varying bits then lie together. Layout, all numbers little-endian:

    magic  b"BPL1"
    blocks of planes, one compressed frame after the other
    index  zstandard frame of int64: for each block its number of ids, its mask of stored planes, and the length
           of each of its 32 frames (0: left out)
    docs   zstandard frame of int64 pairs: doc_id, number of ids (one frame; a null doc_id is marked by its bit
           in the frame of flags that follows)
    flags  zstandard frame of one byte a document (1: doc_id is null)
    footer 6 int64: ids in all, number of documents, the three frames' lengths, BLOCK

Files are written by the tasks into a folder that all machines share (any address pyarrow's file systems know),
first under a name of their own and then renamed, so that a task that runs again leaves the same file. Documents
are dealt to files by ranges of doc_id, so many that a file has about `FILE_BYTES` of text; ties are ordered by a hash
of the text and then by a number, and repeated rows are all written.

Cases: a null text is an empty one and has the end id only; a null doc_id comes first; an empty table writes no
files; very long documents span blocks; other columns of the table are ignored.
"""

from __future__ import annotations

import re
import struct
import sys
import unicodedata
import uuid
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import chunks, col, map_batches, text_table, worker_table

MAGIC, FOOTER = b"BPL1", struct.Struct("<6q")
#: Ids in a block.
BLOCK = 1 << 16
#: Bytes of text that one file should hold, about.
FILE_BYTES = 32 << 20
#: Remembered words of a worker, about 200 bytes each; beyond it they are all forgotten and learned again. Longer ones never are.
REMEMBERED, LONGEST = 600_000, 64
#: Characters whose class every version of Unicode agrees on; other texts are split by the library alone.
_COMMON = "\x00-ɏ‐-‧"


def _packed(ids: list[int]) -> bytes:
    """Little-endian 32-bit numbers."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _byte_chars() -> dict[int, str]:
    """How byte-level vocabularies spell each byte: printable ones as themselves, the others by the characters from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(others)}


def _class(category: str) -> str:
    """The characters of _COMMON in a general category, as ranges."""
    codes = [c for lo, hi in ((0, 0x24F), (0x2010, 0x2027)) for c in range(lo, hi + 1) if unicodedata.category(chr(c))[0] == category]
    starts = [c for c in codes if c - 1 not in codes]
    return "".join(f"{chr(a)}-{chr(next(c for c in codes if c >= a and c + 1 not in codes))}" for a in starts)


class Words(dict):
    """The ids of words as little-endian bytes, asked of the library's model when a word is first met."""

    def __init__(self, model):
        super().__init__()
        self._pieces, self._chars = model.tokenize, _byte_chars()

    def __missing__(self, word: str) -> bytes:
        ids = _packed([p.id for p in self._pieces(word.encode().decode("latin-1").translate(self._chars))])
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


class PieceEncoder:
    """Encodes with the tokenizers library. The ids of frequent words are remembered as little-endian bytes.

    Byte-level BPE never merges across the words of its splitting pattern, so a word's ids don't depend on its
    neighbours. Texts with characters outside `_COMMON`, or with a special token's opening, go to the library whole.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        split, special = model["pre_tokenizer"] or {}, [t["content"] for t in model["added_tokens"]]
        #: only for a model of this kind are words encoded on their own
        self._by_word = split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"] and not model["normalizer"]
        self.library = Tokenizer.from_file(path)
        letter, number, blank = _class("L"), _class("N"), "\t-\r \x85\xa0"
        # fixed: the splitting pattern of byte-level BPE, over the characters of _COMMON
        pattern = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{blank}{letter}{number}]+|[{blank}]+(?![^{blank}])|[{blank}]+"
        self._split = re.compile(pattern).findall
        self._uncommon, self._special = re.compile(f"[^{_COMMON}]").search, special
        self.memo = Words(self.library.model)

    def _odd(self, text: str) -> bool:
        """Whether a text is left to the library."""
        return not self._by_word or any(t in text for t in self._special) or not text.isascii() and self._uncommon(text) is not None

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text. A text's words go before the next text's are made."""
        known, split = self.memo.__getitem__, self._split
        return [_packed(self.library.encode(t, add_special_tokens=False).ids) if self._odd(t) else b"".join(map(known, split(t))) for t in texts]


def encoder(path: str) -> PieceEncoder:
    """One encoder for each worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
    return worker_table("byte tokens", path, lambda: PieceEncoder(path))


def _frames(block: np.ndarray, press) -> tuple[int, list[bytes]]:
    """The mask of stored planes and the frame of each."""
    columns = np.ascontiguousarray(block.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    used, mask, frames = columns.any(axis=1), 0, [b""] * 32
    for b in range(32):
        if not used[b // 8]:
            continue
        plane = np.packbits(columns[b // 8] & np.uint8(1 << b % 8), bitorder="little")
        if plane.any():
            mask |= 1 << b
            frames[b] = press(plane.tobytes())
    return mask, frames


def _block(frames: list[bytes], n: int, unpress) -> np.ndarray:
    ids = np.zeros(n, np.uint32)
    for b, frame in enumerate(frames):
        if frame:
            plane = np.unpackbits(np.frombuffer(unpress(frame), np.uint8), count=n, bitorder="little")
            ids |= plane.astype(np.uint32) << np.uint32(b)
    return ids.astype("<u4")


class PlaneWriter:
    """Writes one file; memory is one block and the lists of documents and blocks."""

    def __init__(self, sink):
        import zstandard

        self._press = zstandard.ZstdCompressor(level=3).compress
        self._sink, self._rest, self._size = sink, [], 0
        self._index, self._docs, self._flags, self.ids = [], [], [], 0
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._docs += (doc_id or 0, len(ids))
        self._flags.append(doc_id is None)
        self._rest.append(ids)
        self._size += len(ids)
        self.ids += len(ids)
        if self._size >= BLOCK:
            whole = np.concatenate(self._rest)
            for k in range(0, len(whole) - BLOCK + 1, BLOCK):
                self._write(whole[k : k + BLOCK])
            self._rest = [whole[len(whole) // BLOCK * BLOCK :].copy()]
            self._size = len(self._rest[0])

    def _write(self, block: np.ndarray) -> None:
        mask, frames = _frames(block, self._press)
        for frame in frames:
            self._sink.write(frame)
        self._index += (len(block), mask, *map(len, frames))

    def close(self) -> None:
        if self._size:
            self._write(np.concatenate(self._rest))
        tail = [np.array(x, kind).tobytes() for x, kind in ((self._index, "<i8"), (self._docs, "<i8"), (self._flags, np.uint8))]
        tail = [self._press(x) for x in tail]
        for frame in tail:
            self._sink.write(frame)
        self._sink.write(FOOTER.pack(self.ids, len(self._flags), *map(len, tail), BLOCK))


def read_documents(source) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """doc_id, place of the first id in the file, and ids of each document of an open file, block by block."""
    import zstandard

    unpress, size = zstandard.ZstdDecompressor().decompress, source.size()
    source.seek(size - FOOTER.size)
    _, _, *tail, _ = FOOTER.unpack(source.read(FOOTER.size))
    source.seek(size - FOOTER.size - sum(tail))
    index, docs, flags = (unpress(source.read(n)) for n in tail)
    index = np.frombuffer(index, "<i8").reshape(-1, 34)
    docs, flags = np.frombuffer(docs, "<i8").reshape(-1, 2), np.frombuffer(flags, np.uint8)
    source.seek(0)
    if source.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a bit-plane file")
    blocks = (_block([source.read(n) for n in row[2:].tolist()], int(row[0]), unpress) for row in index)
    rest, start = np.empty(0, "<u4"), 0
    for (doc_id, n), null in zip(docs.tolist(), flags, strict=True):
        if n > len(rest):
            parts, have = [rest], len(rest)
            while have < n:
                parts.append(next(blocks))
                have += len(parts[-1])
            rest = np.concatenate(parts)
        yield None if null else doc_id, start, rest[:n]
        rest, start = rest[n:], start + n


def _file_system(address: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(address if "://" in address else f"file://{address}")


def write_files(
    df: DataFrame, tokenizer_path: str, folder: str, end_id: int, files: int | None = None, doc_id: str = "doc_id", text: str = "text"
) -> list[tuple[str, int, int]]:
    """Encode every text, append `end_id`, write files in ascending doc_id order; name, documents and ids of each."""
    source = text_table(df, doc_id, text)
    number = files or -(-(source.agg(F.sum(F.octet_length(col(text)))).first()[0] or 0) // FILE_BYTES) or 1
    # rows that repeat have a number, so that a file needn't hold all of them
    tie = F.struct(F.xxhash64(col(text)).alias("key"), F.monotonically_increasing_id().alias("number"))
    source = source.select(col(doc_id).alias("doc_id"), col(text).alias("text"), tie.alias("tie"))
    ordered = source.repartitionByRange(number, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        coder, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        system, base = _file_system(folder)
        system.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}.bpl"
        mine = f"{base}/.{name}.{uuid.uuid4().hex}"
        with system.open_output_stream(mine) as sink:
            writer, documents = PlaneWriter(sink), 0
            for batch in chain([first], batches):
                for rows in chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), 256):
                    for (key, _), ids in zip(rows, coder.encode([t or "" for _, t in rows]), strict=True):
                        writer.add(key, np.frombuffer(ids + end, "<u4"))
                    documents += len(rows)
            writer.close()
        system.move(mine, f"{base}/{name}")
        yield pa.RecordBatch.from_pydict({"name": [name], "documents": [documents], "ids": [writer.ids]})

    written = map_batches(ordered, run, "name string, documents long, ids long").collect()  # one row for each file
    return sorted(tuple(r) for r in written)


def read_files(spark: SparkSession, folder: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """doc_id, start (ids of all documents before it in all files), ids as little-endian 32-bit numbers."""
    starts = np.cumsum([0, *(ids for *_, ids in files)]).tolist()
    table = [(name, start) for (name, *_), start in zip(files, starts, strict=False)]
    listed = spark.createDataFrame(table, "name string, start long").repartition(max(1, len(table)), "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, base = _file_system(folder)
                with system.open_input_file(f"{base}/{name}") as source:
                    for rows in chunks(read_documents(source), 512):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[0] for r in rows], pa.int64()), pa.array([start + r[1] for r in rows], pa.int64()), pa.array([r[2].tobytes() for r in rows], pa.binary())],
                            schema=schema,
                        )

    return map_batches(listed, run, "doc_id long, start long, ids binary")
