"""Sparse-matrix products over interaction rows, and what is built from them."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.functions.vectors import mean_vector, sum_vectors
from filmloom.models.blocks import BlockStore, Edges, Factors, row_sums
from filmloom.operators.relational import index_ids
from filmloom.session import StepTables

log = logging.getLogger(__name__)

BROADCAST_BYTES = 64 << 20
#: Rows whose vectors a task adds up at a time.
_SUM_ROWS = 1 << 16


def bounded_broadcast(df: DataFrame, rows: int, width: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a vector table whose counted size is under the limit."""
    return F.broadcast(df) if rows * (width + 2) * 8 <= limit else df


def sums_by_key(keys: pa.Array, matrix: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """One row per key in ascending order, null first: the sum of its rows of the matrix."""
    order = pc.array_sort_indices(keys, null_placement="at_start").to_numpy()
    ordered = keys.take(pa.array(order))
    values = ordered.slice(ordered.null_count).to_numpy(zero_copy_only=False)
    new = np.ones(len(order), bool)
    new[1 : ordered.null_count] = False
    new[ordered.null_count + 1 :] = values[1:] != values[:-1]
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(matrix[order], starts, axis=0) if len(starts) else matrix
    ends = pa.array(np.arange(0, sums.size + 1, sums.shape[1], dtype=np.int32))
    lists = pa.ListArray.from_arrays(ends, pa.array(sums.ravel()))
    return pa.RecordBatch.from_arrays([ordered.take(pa.array(starts)), lists], names=names)


def as_matrix(lists: pa.Array, size: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, size)


def _partial_sums(key: str, size: int, weighted: bool):
    """Sums of the (weighted) vectors of each key among some rows at a time, null being a key as any other."""

    def summed(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        matrix = as_matrix(table.column("vec").chunk(0), size)
        if weighted:
            matrix = matrix * table.column("_w").to_numpy()[:, None]
        return sums_by_key(table.column(key).chunk(0), matrix, [key, "vec"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= _SUM_ROWS:
                yield summed(held)
                held, n = [], 0
        if n:
            yield summed(held)

    return run


def _whole_sums(key: str, size: int):
    """Sums of rows that come in the order of their keys; only a batch and the key at its end are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [last, batch] if last is not None else [batch]
            table = pa.Table.from_batches(rows).combine_chunks()
            done = sums_by_key(table.column(key).chunk(0), as_matrix(table.column("vec").chunk(0), size), [key, "vec"])
            last = done.slice(done.num_rows - 1)
            yield done.slice(0, done.num_rows - 1)
        if last is not None:
            yield last

    return run


def sum_partials(parts: DataFrame, key: str, size: int) -> DataFrame:
    """The sum per key of vectors that tasks have summed before: (key, vec)."""
    meeting = parts.select(key, "vec").repartition(key).sortWithinPartitions(key)
    return meeting.mapInArrow(_whole_sums(key, size), meeting.schema)


def by_target(edges: DataFrame, target: str, source: str) -> DataFrame:
    """Edges in the order of their targets, so that a task adds up most of a target's vectors; hot targets are cut."""
    spark = edges.sparkSession
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return edges.repartitionByRange(width, target, source).sortWithinPartitions(target, source)


def spread(
    edges: DataFrame,
    vectors: DataFrame,
    source: str,
    target: str,
    size: int,
    n_vectors: int,
    weight: str | None = None,
    plus: DataFrame | None = None,
) -> DataFrame:
    """One sparse product: the (weighted) sum per target of its sources' vectors, and of its vectors in ``plus``.

    Small vector tables are broadcast, so the edges do not move and only partial
    sums are shuffled; larger ones meet the edges in a shuffle join whose hot
    keys adaptive execution splits. Tasks add up their rows by target first.
    """
    kept = [c for c in (source, target) if c]
    factor = [F.col(weight).cast("double").alias("_w")] if weight else []
    joined = edges.select(*kept, *factor).join(bounded_broadcast(vectors, n_vectors, size), source)
    # An edge without weight or vector adds nothing to its target.
    rows = joined.where(" AND ".join(["vec IS NOT NULL"] + ["_w IS NOT NULL"] * bool(weight)))
    schema = T.StructType([T.StructField(target, edges.schema[target].dataType), T.StructField("vec", T.ArrayType(T.DoubleType()))])
    wanted = rows.select(target, F.col("vec").cast("array<double>").alias("vec"), *(["_w"] if weight else []))
    parts = wanted.mapInArrow(_partial_sums(target, size, weight is not None), schema)
    if plus is not None:
        parts = parts.unionByName(plus.select(target, "vec"))
    return sum_partials(parts, target, size)


def hashed_normal(df: DataFrame, key: str, size: int, std: float, seed: int) -> DataFrame:
    """Normal start vectors that depend only on the key and the seed.

    Every md5 of (key, block, seed) has four words of 32 bits, and two of them make two components by Box and Muller.
    """

    def words(block: Column) -> Column:
        digest = F.md5(F.concat_ws("-", F.col(key).cast("string"), block.cast("string"), F.lit(str(seed))))
        word = [(F.conv(F.substring(digest, at, 8), 16, 10).cast("double") + 1.0) / 4294967297.0 for at in (1, 9, 17, 25)]
        return F.array(*word)

    def pairs(w: Column) -> Column:
        parts = []
        for one, two in ((0, 1), (2, 3)):
            length, turn = F.sqrt(-2.0 * F.log(w[one])) * std, 2.0 * math.pi * w[two]
            parts += [length * F.cos(turn), length * F.sin(turn)]
        return F.array(*parts)

    drawn = F.transform(F.sequence(F.lit(0), F.lit(max(0, -(-size // 4) - 1))), words)
    return df.select(key, F.slice(F.flatten(F.transform(drawn, pairs)), 1, size).alias("vec"))


def train_svd(
    train: DataFrame,
    k: int = 50,
    tol: float = 1e-3,
    max_rounds: int = 200,
    oversample: int = 10,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, list[float]]:
    """Truncated SVD of the 0/1 user x film matrix by subspace iteration.

    Returns (users, items, singular values) with user vectors U*S and item
    vectors V. Rounds stop once the k leading values change by less than
    ``tol``; without that in ``max_rounds`` there is an error. Only ``l x l`` matrices reach the driver, one a block; the
    products are jobs over block files, and nothing is shuffled in a round.
    """
    tables, store = StepTables(train.sparkSession), BlockStore(train.sparkSession)
    distinct = tables.save(train.select("user_id", "movie_id").distinct(), "distinct")
    user_numbers = tables.save(index_ids(distinct, "user_id", "_user"), "users")
    item_numbers = tables.save(index_ids(distinct, "movie_id", "_item"), "items")
    pairs = tables.save(distinct.join(user_numbers, "user_id").join(item_numbers, "movie_id").select("_user", "_item"), "pairs")
    n_users, n_items, n_pairs = user_numbers.count(), item_numbers.count(), pairs.count()
    k = max(1, min(k, min(n_users, n_items) - 1))
    size = min(k + oversample, n_items, n_users)
    by_user = store.write_edges(pairs, "_user", "_item", None, store.block_rows(n_users, n_pairs, size), n_users)
    by_item = store.write_edges(pairs, "_item", "_user", None, store.block_rows(n_items, n_pairs, size), n_items)
    drawn = hashed_normal(item_numbers, "movie_id", size, 1.0, seed).join(item_numbers, "movie_id")
    basis = store.write_factors(drawn, "_item", size, by_item.rows, n_items)

    def product(edges: Edges, sources: Factors, turn: np.ndarray | None = None, drop: bool = True) -> tuple[Factors, np.ndarray]:
        """The sum per target of its sources' vectors times ``turn``, and their products with each other."""

        def work(block: int) -> tuple[np.ndarray, np.ndarray]:
            ends, source, _ = edges.block(block)
            rows = row_sums(ends, source, None, sources)
            rows = rows if turn is None else rows @ turn
            return rows, rows.T @ rows

        made, grams = store.solve(edges, work, size)
        if drop:
            store.drop(sources)
        return made, sum(grams)

    def times(vectors: Factors, edges: Edges, matrix: np.ndarray) -> Factors:
        made, _ = store.solve(edges, lambda block: (vectors.block(block) @ matrix, None), matrix.shape[1])
        return made

    values, turn = np.zeros(k), None
    for done in range(1, max_rounds + 1):
        image = basis
        # Two products per round: each squares the gap between wanted and unwanted values.
        for _ in range(2):
            image, _ = product(by_user, image, turn)
            image, together = product(by_item, image)
            turn = None
        eigenvalues, eigenvectors = np.linalg.eigh(together)
        order = np.argsort(eigenvalues)[::-1]
        eigenvalues, eigenvectors = np.maximum(eigenvalues[order], 0.0), eigenvectors[:, order]
        inverse = np.where(eigenvalues > 1e-14 * eigenvalues[0], 1.0 / np.sqrt(np.maximum(eigenvalues, 1e-300)), 0.0)
        # The basis is the image times this matrix; the next product of sums takes it along.
        basis, turn = image, eigenvectors * inverse
        # Two products with A'A turn a singular value into its fourth power.
        estimate = (eigenvalues[:k] ** 0.125)
        settled = done > 1 and np.max(np.abs(estimate - values) / np.maximum(estimate, 1e-12)) < tol
        values = estimate
        if settled:
            break
    else:
        store.close()
        raise RuntimeError(f"no convergence to {tol} in {max_rounds} rounds; raise max_rounds or tol")
    log.info("subspace iteration: %d rounds, leading value %.4f", done, values[0])
    # Rayleigh-Ritz inside the subspace gives the factors and the final values.
    last, together = product(by_user, basis, turn, drop=False)
    ritz, rotation = np.linalg.eigh(together)
    order = np.argsort(ritz)[::-1][:k]
    items = store.frame(times(basis, by_item, turn @ rotation[:, order]), "_item").join(item_numbers, "_item")
    users = store.frame(times(last, by_user, rotation[:, order]), "_user").join(user_numbers, "_user")
    items = tables.save(items.select("movie_id", "vec"), "item-vectors")
    users = tables.save(users.select("user_id", "vec"), "user-vectors")
    store.close()
    return users, items, [float(v) for v in np.sqrt(np.maximum(ritz[order], 0.0))]


def fold_in(ratings: DataFrame, item_vectors: DataFrame, weight: str | None = "rating", size: int | None = None) -> DataFrame:
    """User vectors outside training: the rating-weighted mean of their items' vectors."""
    from filmloom.functions.vectors import vector_size
    from filmloom.operators.scoring import of_known

    joined = of_known(ratings, item_vectors, "movie_id").join(item_vectors, "movie_id")

    width = size or vector_size(item_vectors, "vec")
    return mean_vector(joined, "user_id", "vec", weight=weight, size=width)
