"""Exact top-k inner products by length order and residual bounds.

Candidates are dealt into shards by falling length and stay sorted inside. All vectors are rotated by the eigenvectors of
the corpus' Gram matrix, which is what the right singular vectors of the whole table are. A block of candidates gets the
partial product of the first rotated dimensions; the rest is at most the product of the residual lengths (Cauchy-Schwarz).
Only pairs whose bound reaches the query's current k-th score are multiplied out, in integers. Whole blocks fall when the
longest candidate left cannot reach it. Shards keep k rows a query, and a window merges them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a shard and queries of a block at most, so a task's memory is bounded whatever the table's size.
SHARD_ROWS = 16_384
QUERY_ROWS = 1_024
STEP = 1_024
SHARE_OF_DIMENSIONS = 4


def quantised(rows: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """``id`` and integer ``v``; null vectors and such with null or non-finite components take no part."""
    number = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(number, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col(vector).isNotNull() & F.col(key).isNotNull() & ~bad).select(
        F.col(key).cast("long").alias("id"), F.transform(number, lambda x: F.floor(scale * x).cast("double")).alias("v")
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones padded with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Orthogonal directions by falling energy; what reaches the driver is one number per pair of dimensions."""

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column("v"), width)
            total += m.T @ m
        cells = np.arange(width * width)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel())], names=["cell", "value"])

    gram = np.zeros(width * width)
    for r in vectors.select("v").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value")).collect():
        gram[r[0]] = r[1]
    return np.linalg.eigh(gram.reshape(width, width))[1][:, ::-1].copy()


def _products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles while every sum fits them, else in 64-bit integers."""
    top = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * queries.shape[1]
    if top < 2**53:
        return (queries @ candidates.T).astype(np.int64)
    return queries.astype(np.int64) @ candidates.astype(np.int64).T


def best_of_shard(q_ids, q, c_ids, c, turn: np.ndarray, k: int):
    """For every query its best rows of the shard: ids, scores and a mask. Candidates must stand by falling length."""
    head = max(1, q.shape[1] // SHARE_OF_DIMENSIONS)
    qr, cr = q @ turn, c @ turn
    q_rest, c_rest = np.linalg.norm(qr[:, head:], axis=1), np.linalg.norm(cr[:, head:], axis=1)
    q_long, c_long = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
    low = np.iinfo(np.int64).min
    scores = np.full((len(q), k), low)
    ids = np.full((len(q), k), np.iinfo(np.int64).max)
    for start in range(0, len(c), STEP):
        part = slice(start, start + STEP)
        limit = scores[:, -1].astype(float)
        slack = 1.0 + 1e-9 * q_long * c_long[start]  # rounding of the rotation; scores are whole numbers
        alive = np.flatnonzero(q_long * c_long[start] + slack >= limit)
        if not len(alive):
            break  # the longest candidate left is too short for every query
        bound = qr[alive, :head] @ cr[part, :head].T + q_rest[alive, None] * c_rest[None, part] + slack[alive, None]
        open_ = (bound >= limit[alive, None]) & (q_ids[alive, None] != c_ids[None, part])
        rows, columns = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
        if not len(rows):
            continue
        own = alive[rows]
        exact = _products(q[own], c[part][columns])
        exact[~open_[np.ix_(rows, columns)]] = low
        all_scores = np.concatenate([scores[own], exact], axis=1)
        all_ids = np.concatenate([ids[own], np.broadcast_to(c_ids[part][columns], exact.shape)], axis=1)
        order = np.lexsort((all_ids, -all_scores.astype(float)), axis=1) if np.abs(all_scores[all_scores > low]).max(initial=0) < 2**53 else np.lexsort((all_ids, ~all_scores), axis=1)
        order = order[:, :k]
        scores[own] = np.take_along_axis(all_scores, order, 1)
        ids[own] = np.take_along_axis(all_ids, order, 1)
    return ids, scores, scores > low


def exact_top_k(rows: DataFrame, key: str, vector: str, k: int = 5, query_every: int = 50) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose key is divisible by ``query_every``, against all others.

    Ties go to the smaller id. Rows with the query's own id are not its candidates; of several rows with a query's id the
    smallest vector asks. Shorter vectors count as padded with zeros. Without vectors the result is empty.
    """
    spark = rows.sparkSession
    vectors = quantised(rows, key, vector)
    facts = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    n, width = facts[0], facts[1] or 1
    turn = rotation(vectors, width)
    n_shards = max(1, -(-n // SHARD_ROWS), min(n // STEP, spark.sparkContext.defaultParallelism))
    n_blocks = max(1, -(-n // (query_every * QUERY_ROWS)))
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    sized = vectors.withColumn("length", length)
    cuts = sized.select(F.percentile_approx("length", [i / n_shards for i in range(1, n_shards)], 10_000)).first()[0] if n_shards > 1 else []
    cuts = F.array(*[F.lit(float(c)) for c in cuts or []]).cast("array<double>")
    # Equal lengths would all fall between the same cuts: such ranges are dealt on by a hash of the id.
    band = F.size(F.filter(cuts, lambda c: c <= F.col("length")))
    width_of = F.greatest(F.lit(1), F.size(F.filter(cuts, lambda c: c == F.element_at(cuts, F.greatest(band, F.lit(1))))))
    dealt = F.when(band > 0, band - F.pmod(F.xxhash64("id"), width_of)).otherwise(band)
    candidates = sized.select("id", "v", "length", dealt.cast("int").alias("shard"))
    queries = vectors.where(F.col("id") % query_every == 0).groupBy("id").agg(F.min("v").alias("v"))
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_blocks)).cast("int")
    queries = queries.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    candidates = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not queries.num_rows or not candidates.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        candidates = candidates.sort_by([("length", "descending"), ("id", "ascending")])
        q_ids = queries.column("id").to_numpy()
        ids, scores, filled = best_of_shard(
            q_ids, _matrix(queries.column("v"), width), candidates.column("id").to_numpy(),
            _matrix(candidates.column("v"), width), turn, k,
        )
        owner = np.broadcast_to(q_ids[:, None], ids.shape)
        return pa.table(dict(zip(names, (owner[filled], ids[filled], scores[filled]))))

    keys = ["shard", "block"]
    found = (
        queries.groupBy(*keys)
        .cogroup(candidates.groupBy(*keys))
        .applyInArrow(run, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
