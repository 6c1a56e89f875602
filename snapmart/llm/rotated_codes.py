"""Largest inner products by randomly rotated one-bit codes.

Each vector is taken relative to the mean vector, rotated by one random rotation, and kept as the signs of its
coordinates: one bit each, packed. With the length of the residual and its alignment with its own code (two
scalars) the code gives an unbiased estimate of the residual's inner product with any query, and a bound of its
error that holds with high probability (Gao and Long, 2024): EPSILON standard errors.

Queries meet all codes in blocks. In each block the vectors with the best estimates are scored exactly; the 20th
score is the bar, and every other vector whose estimate plus error bound reaches the bar is scored too. Exact
scores are inner products of the original vectors in double precision, added up in the order of the components.
The index holds every vector; recall is tested against brute force.

Cases: vectors that are null, empty, zero or have null or non-finite components take no part, nor do rows without
an id; vectors of different lengths never meet; a query meets every row but its own, so a repeated row meets its
twin; ties go to the smaller id; with fewer candidates than asked for all are returned; a very common vector gives
long ties but no more results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapmart.llm.common import col, map_batches, shared_folder, staged, text_table

EPSILON = 4.0
#: Rows of a block of queries and of a block of vectors at most; queries estimated at a time.
QUERY_BLOCK, VECTOR_BLOCK, AT_ONCE = 4096, 1 << 16, 128
#: Best estimates that are scored first, for the bar.
FIRST = 256
SEED = 20_240_521


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs of the rotated residuals, the residuals' lengths, and their alignment with their codes."""
    residual = (vectors - centre) @ rotation(vectors.shape[1]).T
    length = np.linalg.norm(residual, axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        align = np.abs(residual).sum(axis=1) / np.sqrt(vectors.shape[1]) / length
    return np.packbits(residual > 0, axis=1), length, np.where(length > 0, align, 1.0)


def estimates(codes: np.ndarray, length: np.ndarray, align: np.ndarray, centre: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries by vectors) and the error bound per unit of the query's length."""
    dim = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    scale = (length / align / np.sqrt(dim)).astype(np.float32)
    turned = (queries @ rotation(dim).T).astype(np.float32)
    found = (turned @ signs.T) * scale + (queries @ centre).astype(np.float32)[:, None]
    error = EPSILON * length * np.sqrt(np.maximum(0.0, 1 - align**2)) / align / np.sqrt(max(dim - 1, 1))
    return found, error


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added up in the order of the components."""
    return np.cumsum(vectors.astype(np.float64) * query, axis=1)[:, -1]


def nearest(query: np.ndarray, own: int, found: np.ndarray, error: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best vectors of a block, ties to the smaller id."""
    n = len(vectors)
    long = np.linalg.norm(query)
    chosen = np.argpartition(-found, FIRST)[:FIRST] if n > FIRST else np.arange(n)
    rough = vectors[chosen] @ query
    # single against double precision, and the order of adding up
    slack = 1e-6 * long * float(np.abs(vectors[chosen]).max(initial=0)) * np.sqrt(len(query)) + 1e-30
    if n > FIRST:
        others = rough[rows[chosen] != own]
        bar = np.partition(others, len(others) - k)[len(others) - k]
        chosen = np.flatnonzero(found + error * long >= bar - slack)
        rough = vectors[chosen] @ query
    keep = rows[chosen] != own
    chosen, rough = chosen[keep], rough[keep]
    if len(chosen) > k:
        chosen = chosen[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - slack]
    scores = exact(query, vectors[chosen])
    best = np.lexsort((rows[chosen], ids[chosen], -scores))[:k]
    return chosen[best], scores[best]


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()).reshape(-1, dim)


def build_index(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, dict[int, np.ndarray]]:
    """row, vec_id, dim, vector, code, length, align of every vector that takes part; and the mean vector by length."""
    source = text_table(table, vec_id, vector).select(col(vec_id).cast("long").alias("vec_id"), col(vector).cast("array<double>").alias("vector"))
    source = source.filter(F.col("vec_id").isNotNull() & _valid(F.col("vector"))).withColumn("dim", F.size("vector"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            dims = np.asarray(batch.column(1))
            for dim in np.unique(dims).tolist():
                part = _matrix(batch.column(0).filter(pa.array(dims == dim)), dim)
                total = sums.setdefault(dim, [np.zeros(dim), 0])
                total[0] += part.sum(axis=0)
                total[1] += len(part)
        for dim, (total, n) in sums.items():
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "total": [total], "n": [n]})

    centres: dict[int, list] = {}
    for r in map_batches(source.select("vector", "dim"), summed, "dim int, total array<double>, n long").collect():  # one row a task and length
        total = centres.setdefault(r["dim"], [0.0, 0])
        total[0], total[1] = total[0] + np.array(r["total"]), total[1] + r["n"]
    means = {dim: total / n for dim, (total, n) in centres.items()}
    shared = table.sparkSession.sparkContext.broadcast(means)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column(2))
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                codes, length, align = encode(_matrix(part.column(1), dim), shared.value[dim])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length), pa.array(align)], names=["vec_id", "vector", "dim", "code", "length", "align"])

    index = map_batches(source, coded, "vec_id long, vector array<double>, dim int, code binary, length double, align double")
    index = index.withColumn("row", F.monotonically_increasing_id())
    return staged(index, shared_folder(table.sparkSession), "index"), means


def search(index: DataFrame, means: dict[int, np.ndarray], is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each row of the index that `is_query` marks."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast(means)
    counts = index.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    query_blocks = max(1, -(-counts["q"] // QUERY_BLOCK))
    blocks = max(1, -(-counts["n"] // VECTOR_BLOCK), -(-spark.sparkContext.defaultParallelism // query_blocks))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = index.filter(is_query).select("row", "vec_id", "vector", "dim", dealt(query_blocks).alias("a")).select("*", every(blocks).alias("b"))
    vectors = index.select("row", "vec_id", "vector", "dim", "code", "length", "align", dealt(blocks).alias("b")).select("*", every(query_blocks).alias("a"))

    def cell(asked: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if asked.num_rows and block.num_rows:
            dim = asked["dim"][0].as_py()
            wanted, own, names = _matrix(asked["vector"], dim), np.asarray(asked["row"]), np.asarray(asked["vec_id"])
            held, ids, rows = _matrix(block["vector"], dim), np.asarray(block["vec_id"]), np.asarray(block["row"])
            codes = np.frombuffer(b"".join(block["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
            length, align = np.asarray(block["length"]), np.asarray(block["align"])
            for at in range(0, len(own), AT_ONCE):
                found, error = estimates(codes, length, align, shared.value[dim], wanted[at : at + AT_ONCE])
                for query, row, name, estimate in zip(wanted[at : at + AT_ONCE], own[at:], names[at:], found, strict=False):
                    places, scores = nearest(query, row, estimate, error, held, ids, rows, k)
                    out += [(row, name, ids[p], rows[p], s) for p, s in zip(places, scores, strict=True)]
        kinds = (("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.float64()))
        return pa.table({name: pa.array([x[i] for x in out], kind) for i, (name, kind) in enumerate(kinds)})

    keys = ("dim", "a", "b")
    cells = queries.groupBy(*keys).cogroup(vectors.groupBy(*keys)).applyInArrow(cell, "query_row long, query_id long, vec_id long, row long, score double")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    ranked = cells.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
