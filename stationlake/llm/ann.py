"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

A unit vector is rotated by a random orthogonal matrix and kept as the signs of its coordinates and
one correction scalar, its inner product with the sign vector. From the signs alone the inner product
with a query is estimated without bias, and the error is bounded: only vectors whose upper bound
reaches the nearest lower bounds are looked at again in full precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Queries of one block; it is sent to every task, QUERIES * dimension * 8 bytes at most.
QUERIES = 2_048
#: Vectors coded at once in a task.
CODED = 4_096
#: Width of the error bound in standard deviations of the estimate.
SPREAD = 1.9
SEED = 11


def rotation(dimension: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors and their inner products with the sign vectors."""
    turned = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ turn
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def estimate(codes: np.ndarray, scalars: np.ndarray, turned: np.ndarray, spread: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (query by vector) and the half width of their bounds (by vector)."""
    dimension = turned.shape[1]
    signs = (np.unpackbits(codes, axis=1, count=dimension).astype(np.float32) * 2 - 1) / np.sqrt(dimension)
    found = (turned.astype(np.float32) @ signs.T) / scalars.astype(np.float32)
    width = spread * np.sqrt((1 - np.minimum(scalars, 1) ** 2) / scalars**2 / max(1, dimension - 1))
    return found, width + 1e-6


def usable(vector: Column) -> Column:
    """Not null, and finite components that are not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    spread: float = SPREAD,
    block: int = QUERIES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query the ``k`` candidates of the largest cosine.

    Candidates are all rows but the query's own; equal cosines go to the smaller id; fewer candidates
    give fewer rows. Vectors that are null, zero, or hold null or non-finite components take no part,
    nor do rows without an id; a repeated id counts once (one of its vectors, the least). Vectors of
    different lengths are compared within their length only. An empty table gives no rows.

    Of equal vectors the k + 1 smallest ids are kept before the search, which loses no answer; so a
    vector that a third of all rows share costs no more than another. Queries are worked off in
    blocks against all rows; one block is all that the driver holds.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("query")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = rows.groupBy("id").agg(F.min(F.struct("vector", "query")).alias("x")).select("id", "x.*")
    copies = Window.partitionBy("vector").orderBy("id")
    candidates = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    candidates = candidates.select("id", "vector")
    asked = rows.where("query").select("id", "vector")
    parts = None
    after = None
    while True:
        ahead = asked if after is None else asked.where(F.col("id") > after)
        some = ahead.orderBy("id").limit(block).collect()
        if some:
            found = _best(_scan(candidates, some, k, spread), k)
            parts = found if parts is None else parts.unionByName(found)
            after = some[-1].id
        if len(some) < block:
            break
    if parts is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return parts


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _scan(candidates: DataFrame, queries: list, k: int, spread: float) -> DataFrame:
    """At least the ``k`` nearest candidates of each query within each batch."""
    by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for length in {len(q.vector) for q in queries}:
        own = [q for q in queries if len(q.vector) == length]
        by_length[length] = (np.array([q.id for q in own]), np.array([q.vector for q in own]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = {length: rotation(length) for length in by_length}
        for batch in batches:
            for start in range(0, batch.num_rows, CODED):
                part = batch.slice(start, CODED)
                lists = part.column(1)
                sizes = np.diff(lists.offsets.to_numpy())
                for length, (query_ids, asked) in by_length.items():
                    at = np.flatnonzero(sizes == length)
                    if not len(at):
                        continue
                    ids = part.column(0).to_numpy()[at]
                    matrix = lists.take(pa.array(at)).flatten().to_numpy().reshape(len(at), length)
                    q, c, score = _search(query_ids, asked, ids, matrix, turns[length], k, spread)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query_ids[q]), pa.array(ids[c]), pa.array(score)], ["query_id", "vec_id", "score"]
                    )

    return candidates.mapInArrow(work, "query_id long, vec_id long, score double")


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; equal vectors give equal values."""
    dot = (a * b).sum(axis=1)
    return dot / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _search(query_ids, asked, ids, matrix, turn, k, spread):
    """Positions of query and candidate and the exact cosine of the pairs worth keeping."""
    codes, scalars = encode(_unit(matrix), turn)
    turned = _unit(asked) @ turn
    found_q, found_c, found_s = [], [], []
    for lo in range(0, len(turned), 256):
        guess, width = estimate(codes, scalars, turned[lo : lo + 256], spread)
        own = query_ids[lo : lo + 256, None] == ids[None, :]
        low = np.where(own, -np.inf, guess - width)
        reach = min(k, low.shape[1])
        bar = np.partition(low, low.shape[1] - reach, axis=1)[:, low.shape[1] - reach]
        q, c = np.nonzero((guess + width >= bar[:, None]) & ~own)
        score = np.concatenate(
            [cosine(asked[lo + q[s : s + 65_536]], matrix[c[s : s + 65_536]]) for s in range(0, len(q), 65_536)] or [np.zeros(0)]
        )
        order = np.lexsort((ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        kept = place < k
        found_q.append(q[kept] + lo)
        found_c.append(c[kept])
        found_s.append(score[kept])
    return np.concatenate(found_q), np.concatenate(found_c), np.concatenate(found_s)
