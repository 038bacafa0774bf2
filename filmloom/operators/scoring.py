"""Best k items per query vector, over all items, without pairing rows.

Items are dealt into blocks of bounded size and queries over salts; a cell is one block and one salt. A cell's items come
first and are held as one matrix, its queries follow row by row, so a task holds a block and a batch of queries whatever
the tables' sizes, and nothing passes through the driver. BLAS scores a slice of queries against a slice of items at a
time; only scores above the k-th best so far are looked at, and only the best rows per query and block leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.functions.vectors import vector_size
from filmloom.operators.relational import top_k_per_group

ITEM_BLOCK_ROWS = 1 << 20
#: Bytes of a block of items as a task holds it.
ITEM_BLOCK_BYTES = 64 << 20
#: Items whose ids are broadcast to leave out rows of others.
KNOWN_ITEMS = 1 << 18
#: Items of a bucket that a task holds at once.
BUCKET_BLOCK_ROWS = 1 << 15
#: Queries and items that are scored at once.
QUERY_SLICE, ITEM_SLICE = 512, 4096
_COLUMN_CHUNK = 2048


def _best_mask(scores: np.ndarray, wanted: int) -> np.ndarray:
    """Rows' best ``wanted`` cells; ties at the edge go to the leftmost cells, masked cells never count."""
    n_items = scores.shape[1]
    wanted = min(wanted, n_items)
    edge = np.partition(scores, n_items - wanted, axis=1)[:, n_items - wanted][:, None]
    keep = (scores >= edge) & (scores > -np.inf)
    # Only rows with more ties at the edge than places left need a closer look.
    for row in np.flatnonzero(keep.sum(axis=1) > wanted):
        above = scores[row] > edge[row]
        tied = np.flatnonzero(scores[row] == edge[row])[: wanted - above.sum()]
        above[tied] = True
        keep[row] = above
    return keep


class _Rows:
    """Vectors as they came, dense ones as a matrix, sparse ones as offsets, columns and values."""

    def __init__(self, columns: list[pa.Array], sparse: bool):
        self.n, self.sparse = len(columns[0]), sparse
        lens = np.diff(np.asarray(columns[0].offsets))
        flat = [c.flatten().to_numpy(zero_copy_only=False) for c in columns]
        if sparse:
            self.ends = np.concatenate([[0], np.cumsum(lens)])
            self.idx, self.val = flat
        else:
            self.matrix = flat[0].astype(np.float64).reshape(self.n, -1)

    def take(self, order: np.ndarray) -> None:
        """Puts the rows into the given order."""
        if not self.sparse:
            self.matrix = self.matrix[order]
            return
        lens = np.diff(self.ends)[order]
        ends = np.concatenate([[0], np.cumsum(lens)])
        at = np.arange(ends[-1]) + np.repeat(self.ends[:-1][order] - ends[:-1], lens)
        self.ends, self.idx, self.val = ends, self.idx[at], self.val[at]

    def columns(self, start: int, end: int) -> np.ndarray:
        return np.unique(self.idx[self.ends[start] : self.ends[end]])

    def dense(self, start: int, end: int, columns: np.ndarray) -> np.ndarray:
        """Dense matrix of the given sorted columns."""
        own = slice(self.ends[start], self.ends[end])
        owner = np.repeat(np.arange(end - start), np.diff(self.ends[start : end + 1]))
        place = np.searchsorted(columns, self.idx[own])
        place[place == len(columns)] = 0
        present = columns[place] == self.idx[own]
        matrix = np.zeros((end - start, len(columns)))
        matrix[owner[present], place[present]] = self.val[own][present]
        return matrix


def _products(queries: _Rows, start: int, end: int, items: _Rows) -> Iterator[tuple[int, np.ndarray]]:
    """Scores of a slice of queries with one slice of items after the other, each with the place of its first item."""
    if not queries.sparse:
        for at in range(0, items.n, ITEM_SLICE):
            yield at, queries.matrix[start:end] @ items.matrix[at : at + ITEM_SLICE].T
        return
    columns = queries.columns(start, end)
    chunks = [columns[c : c + _COLUMN_CHUNK] for c in range(0, len(columns), _COLUMN_CHUNK)]
    left = [queries.dense(start, end, chunk) for chunk in chunks]
    for at in range(0, items.n, ITEM_SLICE):
        upto = min(items.n, at + ITEM_SLICE)
        scores = None
        for chunk, own in zip(chunks, left):
            part = own @ items.dense(at, upto, chunk).T
            scores = part if scores is None else scores + part
        yield at, np.zeros((end - start, upto - at)) if scores is None else scores


class _Block:
    """Items of a cell in the order of their ids, null ones first."""

    def __init__(self, parts: list[pa.RecordBatch], fields: list[str], sparse: bool):
        whole = pa.Table.from_batches(parts).combine_chunks()
        column = lambda name: whole.column(name).chunk(0)
        order = pc.array_sort_indices(column("i_id"), null_placement="at_start")
        self.ids = column("i_id").take(order)
        self.nulls = self.ids.null_count
        self.known = self.ids.slice(self.nulls).to_numpy(zero_copy_only=False)
        self.rows = _Rows([column(f"i_{f}") for f in fields], sparse)
        self.rows.take(order.to_numpy())

    def seen(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """(query, place) of the seen items, by place."""
        owner = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        if not len(ids) or not len(self.known):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        place = np.minimum(np.searchsorted(self.known, ids), len(self.known) - 1)
        present = self.known[place] == ids
        order = np.argsort(place[present], kind="stable")
        return owner[present][order], place[present][order] + self.nulls


class _Best:
    """The best cells of some queries so far. Items come in the order of their ids, so later ones lose every tie."""

    def __init__(self, n: int, k: int, digits: int):
        self.k, self.digits, self.half = k, digits, 0.5 * 10.0**-digits
        self.owner, self.place, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.floor = np.full(n, -np.inf)  # the k-th best rounded score, once there are k

    def add(self, scores: np.ndarray, first: int) -> None:
        n, width = scores.shape
        full = self.floor > -np.inf
        # Half a unit below or above is where rounding moves a score to the floor or off it; a little less keeps both safe.
        lowest = self.floor + self.half
        if not full.all():
            run = max(1, min(16, width // (4 * self.k)))
            groups = width // run
            if groups >= self.k:
                tops = scores[:, : groups * run].reshape(n, run, groups).max(axis=1)
                least = np.partition(tops, groups - self.k, axis=1)[:, groups - self.k]
                lowest = np.where(full, lowest, np.round(least, self.digits) - self.half)
        lowest = np.where(np.isfinite(lowest), lowest - 1e-9 * np.maximum(1.0, np.abs(lowest)), -np.inf)
        mask = scores >= lowest[:, None]
        if np.count_nonzero(mask) > 8 * self.k * n:
            scores = np.round(scores, self.digits) + 0.0
            mask = _best_mask(scores, self.k)
        owner, place = np.nonzero(mask)
        score = np.round(scores[owner, place], self.digits) + 0.0
        better = (score > -np.inf) & (~full[owner] | (score > self.floor[owner]))
        if not better.any():
            return
        owner, place, score = owner[better], place[better] + first, score[better]
        touched = np.zeros(n, bool)
        touched[owner] = True
        own = touched[self.owner]
        owner = np.concatenate([self.owner[own], owner])
        place = np.concatenate([self.place[own], place])
        score = np.concatenate([self.score[own], score])
        order = np.lexsort((place, -score, owner))
        owner, place, score = owner[order], place[order], score[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        last = rank == self.k - 1
        self.floor[owner[last]] = score[last]
        kept = rank < self.k
        self.owner = np.concatenate([self.owner[~own], owner[kept]])
        self.place = np.concatenate([self.place[~own], place[kept]])
        self.score = np.concatenate([self.score[~own], score[kept]])


def _walk(fields: list[str], sparse: bool, work):
    """Batches of a cell's rows, items first -> the results of ``work`` on its block and each batch of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, block = None, [], None
        for whole in batches:
            cells, kinds = (whole.column(c).to_numpy() for c in ("cell", "kind"))
            cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(kinds) != 0)) + 1
            for start, end in zip([0, *cuts], [*cuts, whole.num_rows]):
                if start == end:
                    continue
                batch = whole.slice(start, end - start)
                if cells[start] != cell:
                    cell, held, block = cells[start], [], None
                if kinds[start] == 0:
                    held.append(batch.select(["i_id", *[f"i_{f}" for f in fields]]))
                    continue
                if held:
                    block, held = _Block(held, fields, sparse), []
                if block is None:
                    continue
                queries = _Rows([batch.column(f"q_{f}") for f in fields], sparse)
                owner, place = block.seen(batch.column("q_seen"))
                for at in range(0, queries.n, QUERY_SLICE):
                    upto = min(queries.n, at + QUERY_SLICE)
                    mine = (owner >= at) & (owner < upto)
                    yield from work(batch.slice(at, upto - at), block, _masked(queries, at, upto, block, owner[mine] - at, place[mine]))

    return run


def _masked(queries: _Rows, start: int, end: int, block: _Block, owner: np.ndarray, place: np.ndarray):
    """Scores by slices of items, each query's seen items out of the running."""
    for first, scores in _products(queries, start, end, block.rows):
        low, high = np.searchsorted(place, [first, first + scores.shape[1]])
        scores[owner[low:high], place[low:high] - first] = -np.inf
        yield first, scores


def _best_rows(k: int, digits: int, out_schema: pa.Schema):
    def work(batch: pa.RecordBatch, block: _Block, slices) -> Iterator[pa.RecordBatch]:
        best = _Best(batch.num_rows, k, digits)
        for first, scores in slices:
            best.add(scores, first)
        columns = [batch.column("q_id").take(pa.array(best.owner)), block.ids.take(pa.array(best.place)), pa.array(best.score)]
        yield pa.RecordBatch.from_arrays(columns, schema=out_schema)

    return work


def _block_of(item: str, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(item), F.lit(n_blocks)).cast("int")


def of_known(rows: DataFrame, items: DataFrame, key: str, n_items: int | None = None) -> DataFrame:
    """The rows of known items, where these are few: a broadcast semi join, which moves down to the scan before any shuffle.

    Rows of other items have no part in a result over the items, and a long history has mostly such rows for a small catalog.
    """
    known = items.select(key)
    few = (known.count() if n_items is None else n_items) <= KNOWN_ITEMS
    return rows.join(F.broadcast(known), key, "left_semi") if few else rows


def _cells(
    queries: DataFrame,
    items: DataFrame,
    query: str,
    item: str,
    vec: str,
    seen: DataFrame | None,
    block_rows: int,
    levels: str | None = None,
) -> tuple[DataFrame, list[str], bool]:
    """Rows of all cells in their order, the fields of a vector, and whether they are sparse."""
    sparse = vec not in queries.columns
    fields = ["idx", "val"] if sparse else [vec]
    names = ["idx", "val"] if sparse else ["vec"]
    items = items.select(F.col(item).alias("i_id"), *[F.col(f).alias(f"i_{n}") for f, n in zip(fields, names)])
    size = F.coalesce(F.sum(F.size(f"i_{names[0]}")), F.lit(0))
    measured = items.agg(F.count("*").alias("n"), size.alias("cells")).first()
    n_bytes = measured["cells"] * (12 if sparse else 8) + measured["n"] * 12
    n_blocks = max(1, math.ceil(measured["n"] / block_rows), math.ceil(n_bytes / ITEM_BLOCK_BYTES))
    # A few cells per core; each copy of a block is made for its share of the queries only.
    width = queries.sparkSession.sparkContext.defaultParallelism
    salts = max(1, math.ceil(3 * width / n_blocks))

    i_type = items.schema["i_id"].dataType.simpleString()
    more = [F.col(levels).alias("q_levels")] if levels else []
    asked = queries.select(F.col(query).alias("q_id"), *[F.col(f).alias(f"q_{n}") for f, n in zip(fields, names)], *more)
    seen_here = F.expr(f"cast(array() as array<{i_type}>)")
    block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    if seen is None:
        asked = asked.select("*", block)
    else:
        own = seen.select(F.col(query).alias("q_id"), F.col(item).cast(i_type).alias("_item")).where("_item IS NOT NULL")
        own = of_known(own, items.select(F.col("i_id").alias("_item")), "_item", measured["n"])
        by_block = own.groupBy("q_id", _block_of("_item", n_blocks).alias("_b")).agg(F.collect_set("_item").alias("ids"))
        per_query = by_block.groupBy("q_id").agg(F.collect_list(F.struct("_b", "ids")).alias("_seen"))
        asked = asked.join(per_query, "q_id", "left").select("*", block)
        here = F.filter("_seen", lambda e: e["_b"] == F.col("block"))  # a cell gets only what was seen of its own block
        seen_here = F.coalesce(F.flatten(F.transform(here, lambda e: e["ids"])), seen_here)
    salt = F.pmod(F.xxhash64("q_id", f"q_{names[0]}"), F.lit(salts))
    asked = asked.where(F.col(f"q_{names[0]}").isNotNull()).select(
        (F.col("block") * salts + salt).cast("int").alias("cell"),
        F.lit(1).alias("kind"),
        "q_id",
        *[f"q_{n}" for n in names],
        seen_here.alias("q_seen"),
        *(["q_levels"] if levels else []),
    )
    spread = items.where(F.col(f"i_{names[0]}").isNotNull()).repartition(width)  # a catalog often stands in one file
    copies = spread.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    offered = copies.select(
        (_block_of("i_id", n_blocks) * salts + F.col("salt")).cast("int").alias("cell"),
        F.lit(0).alias("kind"),
        "i_id",
        *[f"i_{n}" for n in names],
    )
    rows = offered.unionByName(asked, allowMissingColumns=True)
    return rows.repartitionById(n_blocks * salts, F.col("cell")).sortWithinPartitions("cell", "kind"), names, sparse


def score_all_pairs(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    query: str = "user_id",
    item: str = "movie_id",
    vec: str = "vec",
    seen: DataFrame | None = None,
    score: str = "score",
    digits: int = 6,
    broadcast_bytes: int = 0,
    block_rows: int = ITEM_BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` best items per query by inner product: (query, item, score, rank).

    ``vec`` is an array column on both sides, or sparse when both sides carry
    ``idx`` and ``val`` arrays instead. Scores are rounded before ranking and
    ties go to the lower item id, so results do not depend on the tiling.

    ``seen`` (query, item) pairs are left out exactly: they are gathered by query
    and item block, travel with the query, and are masked inside the tile, so a block
    never returns more than ``k`` rows per query. ``broadcast_bytes`` has no effect, as nothing is broadcast.
    """
    rows, names, sparse = _cells(queries, items, query, item, vec, seen, block_rows)
    q_type, i_type = queries.schema[query].dataType, items.schema[item].dataType
    out_schema = T.StructType(
        [T.StructField(query, q_type), T.StructField(item, i_type), T.StructField(score, T.DoubleType())]
    )
    arrow_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    arrow_out = pa.schema(
        [
            (query, arrow_type[q_type.simpleString()]),
            (item, arrow_type[i_type.simpleString()]),
            (score, pa.float64()),
        ]
    )
    best = rows.mapInArrow(_walk(names, sparse, _best_rows(k, digits, arrow_out)), out_schema)
    return top_k_per_group(best, query, [F.desc(score), F.asc(item)], k).select(query, item, score, "rank")


def _count_rows(digits: int, out_schema: pa.Schema):
    def work(batch: pa.RecordBatch, block: _Block, slices) -> Iterator[pa.RecordBatch]:
        levels = batch.column("q_levels").to_pylist()
        won, others = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for _, scores in slices:
            scores = np.round(scores, digits) + 0.0
            for at, (own, wanted) in enumerate(zip(np.sort(scores, axis=1), levels)):
                own = own[np.searchsorted(own, -np.inf, side="right") :]
                won[at] += sum((np.searchsorted(own, wanted, side=s).sum() for s in ("left", "right"))) / 2.0
                others[at] += len(own)
        yield pa.RecordBatch.from_arrays([batch.column("q_id"), pa.array(won), pa.array(others)], schema=out_schema)

    return work


def rank_sums(
    queries: DataFrame,
    items: DataFrame,
    levels: str,
    query: str = "user_id",
    item: str = "movie_id",
    vec: str = "vec",
    seen: DataFrame | None = None,
    digits: int = 6,
    broadcast_bytes: int = 0,
    block_rows: int = ITEM_BLOCK_ROWS,
) -> DataFrame:
    """(query, n_others, won) over all items but the query's ``seen`` ones.

    ``levels`` is an array of scores per query; ``won`` adds up, over them, how many items score lower, equal ones by half.
    A block returns two numbers a query, so nothing grows with the catalog but the products themselves.
    """
    rows, names, sparse = _cells(queries, items, query, item, vec, seen, block_rows, levels)
    q_type = queries.schema[query].dataType
    schema = T.StructType(
        [T.StructField(query, q_type), T.StructField("won", T.DoubleType()), T.StructField("n", T.LongType())]
    )
    arrow_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[q_type.simpleString()]
    arrow_out = pa.schema([(query, arrow_type), ("won", pa.float64()), ("n", pa.int64())])
    parts = rows.mapInArrow(_walk(names, sparse, _count_rows(digits, arrow_out)), schema)
    return parts.groupBy(query).agg(F.sum("n").alias("n_others"), F.sum("won").alias("won"))


def _near_rows(radius: float, width: int, out_schema: pa.Schema):
    """Pairs of a bucket nearer than ``radius``, from the first table alone that has them in one bucket."""

    def work(batch: pa.RecordBatch, block: _Block, slices) -> Iterator[pa.RecordBatch]:
        queries = _Rows([batch.column("q_vec")], False).matrix
        left, own = queries[:, :width], queries[:, width:]
        table = batch.column("q_table").to_numpy()
        length = np.einsum("ij,ij->i", left, left)
        for first in range(0, block.rows.n, ITEM_SLICE):
            items = block.rows.matrix[first : first + ITEM_SLICE]
            right, hashes = items[:, :width], items[:, width:]
            other = np.einsum("ij,ij->i", right, right)
            # The product is rounded otherwise than a sum of squares, so a little more is looked at.
            reach = radius * radius + 1e-9 * (1.0 + length[:, None] + other[None, :])
            q, i = np.nonzero(length[:, None] + other[None, :] - 2.0 * (left @ right.T) <= reach)
            q, i = (x[np.argmax(own[q] == hashes[i], axis=1) == table[q]] for x in (q, i))
            total = np.zeros(len(q))
            for at in range(width):
                step = left[q, at] - right[i, at]
                total += step * step
            distance = np.sqrt(total)
            near = distance < radius
            columns = [
                batch.column("q_id").take(pa.array(q[near])),
                block.ids.take(pa.array(i[near] + first)),
                pa.array(distance[near]),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=out_schema)

    return work


def bucket_pairs(
    queries: DataFrame,
    items: DataFrame,
    radius: float,
    query: str = "query_id",
    item: str = "movie_id",
    vec: str = "vec",
    hashes: str = "hashes",
    block_rows: int = BUCKET_BLOCK_ROWS,
) -> DataFrame:
    """(query, item, distance) nearer than ``radius`` among the pairs that share one of their ``hashes`` at its place.

    Rows go to their buckets, one per place; a bucket's items are dealt into blocks of bounded size and its queries visit
    each. A pair leaves a task once, from the first bucket it shares and only if it is near, so candidates are never shuffled.
    Equal rows count once.
    """
    width = vector_size(items, vec)

    def rows_of(df: DataFrame, key: str) -> DataFrame:
        whole = F.concat(F.transform(vec, lambda x: x.cast("double")), hashes).alias("vec")
        rows = df.where(F.col(vec).isNotNull()).select(F.col(key).alias("id"), whole, F.col(hashes).alias("_h")).distinct()
        return rows.select("id", "vec", F.posexplode("_h").alias("table", "bucket"))

    offered, asked = rows_of(items, item), rows_of(queries, query)
    blocks = F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")
    buckets = offered.groupBy("table", "bucket").agg(blocks)
    n_cells = buckets.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    cell = F.xxhash64("table", "bucket", "block").alias("cell")
    block = F.pmod(F.xxhash64("id", "vec"), F.col("blocks")).cast("int").alias("block")
    held = offered.join(buckets, ["table", "bucket"]).select("*", block).select(
        cell, F.lit(0).alias("kind"), F.col("id").alias("i_id"), F.col("vec").alias("i_vec")
    )
    visits = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    come = asked.join(buckets, ["table", "bucket"]).select("*", visits).select(
        cell,
        F.lit(1).alias("kind"),
        F.col("id").alias("q_id"),
        F.col("vec").alias("q_vec"),
        F.col("table").alias("q_table"),
        F.expr(f"cast(array() as array<{items.schema[item].dataType.simpleString()}>)").alias("q_seen"),
    )
    parts = max(queries.sparkSession.sparkContext.defaultParallelism, min(2 * n_cells, 10_000))
    rows = held.unionByName(come, allowMissingColumns=True).repartition(parts, "cell").sortWithinPartitions("cell", "kind")
    types = [queries.schema[query].dataType, items.schema[item].dataType, T.DoubleType()]
    out_schema = T.StructType([T.StructField(n, t) for n, t in zip((query, item, "distance"), types)])
    arrow_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
    arrow_out = pa.schema([(f.name, arrow_type[f.dataType.simpleString()]) for f in out_schema])
    return rows.mapInArrow(_walk(["vec"], False, _near_rows(radius, width, arrow_out)), out_schema)
