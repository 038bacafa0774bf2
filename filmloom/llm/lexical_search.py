"""Ranked lexical search over posting lists with range-maximum tables.

Documents are dealt into shards of about ``SHARD_POSTINGS`` postings. In a shard every posting list holds the documents'
places and impacts, and a sparse table that gives the place of the largest impact in any range with two looks. A query
searches intervals of documents, best bound first: the bound is the weighted sum of the lists' maxima in the interval. The
document with the largest single contribution is scored exactly, and the interval falls into what lies left and right of
it, whose bounds are new sums of range maxima. The search ends when no bound reaches the query's k-th score. A first share
of the shards gives the others a score to start from.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.llm.common import Scratch, small_enough
from filmloom.llm.words import byte_chunks, lowered_classes, words_of
from filmloom.operators.relational import index_ids, top_k_per_group

#: Fixed value: maximal runs of these characters are terms, after A-Z became a-z.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CHUNK = 4 << 20
#: Distinct terms of all queries that are sent to every executor; with more, all terms are shuffled to them instead.
MOST_TERMS = 200_000
SHARD_POSTINGS = 500_000
#: Queries that one task serves at once, intervals opened at once, and every which shard goes first.
QUERY_ROWS, OPENED, FIRST_SHARDS = 1024, 64, 16

_IS_TERM = np.ones(256, bool)
_IS_TERM[:0x80] = False
_IS_TERM[[*b"0123456789abcdefghijklmnopqrstuvwxyz"]] = True


def asked_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``item, item_id, term, times`` of every query row that has a term."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(key).alias("item_id"), F.col(text).alias("text"))
    terms = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    return rows.select("item", "item_id", F.explode(terms).alias("term")).groupBy("item", "item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def term_rows(docs: DataFrame, wanted: list[str] | None) -> DataFrame:
    """``id, n, terms, tfs`` of every row: its number of terms, and the wanted ones by their numbers; all by name if None."""
    held = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)
    kind = "string" if wanted is None else "int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if held is None else pa.array([w.encode() for w in held.value], pa.large_binary())
        element = pa.string() if held is None else pa.int32()

        def out(ids, n, doc, terms, tfs) -> pa.RecordBatch:
            ends = pa.array(np.searchsorted(doc, np.arange(len(ids) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, x) for x in (terms, pa.array(tfs, pa.int64()))]
            return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), *lists], names=["id", "n", "terms", "tfs"])

        def summed() -> pa.RecordBatch:
            terms = pa.array(list(tally), element)
            return out(rows.column("id"), [total], np.zeros(len(tally), np.int64), terms, list(tally.values()))

        rows, total, tally = None, 0, Counter()  # of a very long text, which comes in several chunks of the same rows
        for part, ends, data in byte_chunks(batches, "text", lowered_classes(), CHUNK, 0x20):
            _, doc, words = words_of(data, _IS_TERM[data], ends)
            n = np.bincount(doc, minlength=len(ends))
            names, index = words.dictionary, words.indices.to_numpy()
            if own is None:
                names = names.cast(pa.binary()).cast(pa.string())
            else:
                names = pa.compute.index_in(names, own)
                taken = names.is_valid().to_numpy(zero_copy_only=False)
                taken = taken[index] if len(index) else np.zeros(0, bool)
                doc, index = doc[taken], index[taken]
            pair, tfs = np.unique(doc * max(1, len(names)) + index, return_counts=True)
            doc, index = np.divmod(pair, max(1, len(names)))
            terms = names.take(pa.array(index))
            if rows is not None and part is not rows:
                yield summed()
                rows, total, tally = None, 0, Counter()
            if part.num_rows == 1:
                rows, total = part, total + int(n[0])
                tally.update(dict(zip(terms.to_pylist(), tfs.tolist())))
            else:
                yield out(part.column("id"), n, doc, terms, tfs)
        if rows is not None:
            yield summed()

    return docs.mapInArrow(run, f"id long, n long, terms array<{kind}>, tfs array<long>")


class ShardIndex:
    """Posting lists of one shard, one after the other, with one sparse table over all of them."""

    def __init__(self, terms: np.ndarray, places: np.ndarray, impacts: np.ndarray, n_docs: int):
        order = np.lexsort((places, terms))
        self.n_docs, self.impacts = n_docs, impacts[order]
        terms, self.places = terms[order], places[order]
        self.terms, first = np.unique(terms, return_index=True)
        self.edges = np.append(first, len(terms))
        self.keys = np.searchsorted(self.terms, terms) * n_docs + self.places
        longest = int(np.diff(self.edges).max(initial=1))
        row = np.arange(len(terms), dtype=np.int32)
        self.table = [row]
        while (half := 1 << (len(self.table) - 1)) * 2 <= longest:
            here, there = row[:-half], row[half:]
            better = np.where(self.impacts[here] >= self.impacts[there], here, there)
            row = np.concatenate([better, row[-half:]])
            self.table.append(row)
        self.table = np.stack(self.table)

    def best(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the lists of the largest impact of each range, and that impact; 0 for an empty range."""
        length = high - low
        level = np.frexp(np.maximum(length, 1))[1] - 1
        low = np.minimum(low, len(self.impacts) - 1)
        one, two = self.table[level, low], self.table[level, np.maximum(high - (1 << level), 0)]
        best = np.where(self.impacts[one] >= self.impacts[two], one, two)
        return best, np.where(length > 0, self.impacts[best], 0)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best documents with a score of ``least`` or more, ties to smaller places."""
        at = np.searchsorted(self.terms, terms)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == terms[known]
        at, weights = at[known], weights[known]
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(at):
            return places, scores
        size = 256
        low, high = np.empty((size, len(at)), np.int64), np.empty((size, len(at)), np.int64)
        first, bound, top = np.empty(size, np.int64), np.full(size, -1, np.int64), np.empty(size, np.int64)
        used = 0

        def put(slots, new_low, new_high, new_first):
            nonlocal used
            best, impact = self.best(new_low, new_high)
            gain = impact * weights
            low[slots], high[slots], first[slots] = new_low, new_high, new_first
            bound[slots] = gain.sum(axis=1)
            top[slots] = self.places[best[np.arange(len(best)), gain.argmax(axis=1)]]
            used = max(used, int(slots.max()) + 1)

        put(np.array([0]), self.edges[at][None, :], self.edges[at + 1][None, :], np.array([0]))
        base = at * self.n_docs
        while True:
            open_ = bound[:used]
            if len(scores) == k:  # equal scores only matter before the last one's place
                alive = (open_ > scores[-1]) | ((open_ == scores[-1]) & (first[:used] < places[-1]))
            else:
                alive = open_ >= least
            chosen = np.flatnonzero(alive)
            if not len(chosen):
                return places, scores
            if len(chosen) > OPENED:
                chosen = chosen[np.argpartition(open_[chosen], len(chosen) - OPENED)[-OPENED:]]
            doc = top[chosen]
            spot = np.searchsorted(self.keys, base[None, :] + doc[:, None])
            there = spot < len(self.keys)
            there[there] = self.keys[spot[there]] == (base[None, :] + doc[:, None])[there]
            exact = (self.impacts[np.minimum(spot, len(self.keys) - 1)] * there * weights).sum(axis=1)
            good = exact >= least
            places, scores = np.concatenate([places, doc[good]]), np.concatenate([scores, exact[good]])
            order = np.lexsort((places, -scores))[:k]
            places, scores = places[order], scores[order]
            while used + len(chosen) > size:
                low, high = np.concatenate([low, np.empty_like(low)]), np.concatenate([high, np.empty_like(high)])
                first, top = np.concatenate([first, np.empty_like(first)]), np.concatenate([top, np.empty_like(top)])
                bound = np.concatenate([bound, np.full(size, -1, np.int64)])
                size *= 2
            right = np.arange(used, used + len(chosen))
            put(right, spot + there, high[chosen], doc + 1)
            put(chosen, low[chosen], spot, first[chosen])


def search(
    docs: DataFrame,
    items: DataFrame,
    scratch: Scratch,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    k: int = 10,
    b: int = 75,
) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each query row's ``k`` best documents with a score above 0.

    Null and empty texts hold no terms: such documents count nowhere, such queries get no rows. Equal scores go to the
    smaller id, null ids last; repeated documents are found as often as they stand there, and repeated queries each get
    their rows. A very long text is read in pieces and counted as one. Empty tables give an empty result; other columns play
    no part.
    """
    spark = docs.sparkSession
    asked = scratch.save(asked_terms(items, item_key, item_text), "asked")
    terms = asked.select("term").distinct()
    wanted = None
    if small_enough(terms, MOST_TERMS):
        wanted = sorted(r["term"] for r in terms.collect())
        numbered = spark.createDataFrame(list(zip(wanted, range(len(wanted)))), "term string, number int")
    else:
        numbered = scratch.save(index_ids(terms, "term", "number").select("term", F.col("number").cast("int")), "terms")
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where("text is not null")
    counted = term_rows(source, wanted).withColumn("row", F.monotonically_increasing_id())
    counted = scratch.save(counted, "documents")  # the row numbers are read back from here on
    facts = counted.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    if wanted is None:
        each = counted.select("row", F.explode(F.arrays_zip("terms", "tfs")).alias("p")).select("row", "p.terms", "p.tfs")
        each = each.join(numbered, each["terms"] == numbered["term"]).groupBy("row")
        each = each.agg(F.collect_list("number").alias("numbers"), F.collect_list("tfs").alias("tfs"))
        lists = scratch.save(counted.select("row", "id", "n").join(each, "row"), "lists")
    else:
        lists = counted.where(F.size("terms") > 0).withColumnRenamed("terms", "numbers")
    frequency = lists.select(F.explode("numbers").alias("number")).groupBy("number").agg(F.count(F.lit(1)).alias("df"))
    n, length = facts["docs"], facts["terms"] or 1
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1)))
    weighted = asked.join(numbered, "term").join(frequency, "number").withColumn("w", weight * F.col("times"))
    packed = F.collect_list("number").alias("numbers"), F.collect_list("w").alias("weights")
    queries = scratch.save(weighted.groupBy("item", "item_id").agg(*packed), "queries")
    n_blocks = max(1, -(-queries.count() // QUERY_ROWS))
    n_shards = max(1, -(-(lists.agg(F.sum(F.size("numbers"))).first()[0] or 0) // SHARD_POSTINGS))
    shard = F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int").alias("shard")
    # In decimals: the product may pass 64 bits in a large corpus.
    m = F.expr(f"cast({100 - b} + cast(n as decimal(20,0)) * cast({b * n} as decimal(18,0)) div cast({length} as decimal(18,0)) as long)")
    placed = lists.select(shard, "id", m.alias("m"), "numbers", "tfs")
    placed = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def run(queries: pa.Table, documents: pa.Table) -> pa.Table:
        if not queries.num_rows or not documents.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("item", "doc_id", "score")})
        documents = documents.sort_by([("id", "ascending")])  # nulls last
        ids = documents.column("id").combine_chunks()
        numbers = documents.column("numbers").combine_chunks()
        tfs = documents.column("tfs").combine_chunks().flatten().to_numpy()
        doc = np.repeat(np.arange(len(ids)), np.diff(numbers.offsets.to_numpy()))
        impacts = 1_000_000_000 * tfs // (1000 * tfs + 8 * documents.column("m").to_numpy()[doc])
        index = ShardIndex(numbers.flatten().to_numpy(), doc, impacts, len(ids))
        found = [[], [], []]
        for item, own, weights, least in zip(*(queries.column(c).to_pylist() for c in ("item", "numbers", "weights", "least"))):
            places, scores = index.search(np.array(own), np.array(weights, np.int64), k, max(1, least))
            for column, values in zip(found, ([item] * len(places), places, scores)):
                column.extend(values)
        places = pa.array(found[1], pa.int64())
        return pa.table({"item": pa.array(found[0], pa.int64()), "doc_id": ids.take(places), "score": pa.array(found[2], pa.int64())})

    def over(wave: Column, asked_rows: DataFrame) -> DataFrame:
        block = F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int")
        own = asked_rows.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
        here = placed.where(wave).groupBy("shard", "block")
        return own.where(wave).groupBy("shard", "block").cogroup(here).applyInArrow(run, "item long, doc_id long, score long")

    def best(rows: DataFrame) -> DataFrame:
        return top_k_per_group(rows, "item", [F.desc("score"), F.asc_nulls_last("doc_id")], k)

    goes_first = F.col("shard") % FIRST_SHARDS == 0
    found = scratch.save(over(goes_first, queries.withColumn("least", F.lit(0).cast("long"))), "first")
    if n_shards > 1:
        least = best(found).where(F.col("rank") == k).select("item", F.col("score").alias("least"))
        told = scratch.save(queries.join(least, "item", "left").fillna(0, ["least"]), "told")
        found = found.unionByName(over(~goes_first, told))
    return best(found).join(queries.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
