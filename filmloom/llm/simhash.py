"""Near duplicates by 64-bit SimHash, compared on vertical bit planes.

Two fingerprints within the radius agree on one of ``radius + 1`` parts of their bits, so fingerprints meet in groups by a
part's leading bits; how many bits follows from the number of fingerprints, so groups keep their size while the corpus
grows. A group that is too large is divided again by the bits its members need not share, and what is still too large is
dealt out as pairs of blocks. Inside a group the fingerprints lie as 64 bit planes: one word holds one bit of 64 of them.
Distances to many fingerprints are counted at once by carry-save adders that start so far from overflow that the carry out
says "beyond the radius"; rows and words of which every lane is beyond are abandoned. A group reports a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.llm.common import Scratch, slices
from filmloom.llm.shingle_join import components

BITS, SEED = 64, 42
#: Expected and largest size of a group that is compared as a whole, and divisions at most.
GROUP, MOST, LEVELS = 1024, 8192, 3
#: Fingerprints that look at the planes at once, planes between two looks at what is abandoned, shingles counted at once.
ROWS, PLANES, COUNTED = 256, 8, 1 << 16
_ALL = np.uint64(2**64 - 1)


def fingerprint(text: bytes, width: int = 3) -> int:
    """Majority bits of the XXH64 of every shingle, repeats included; fewer words make one shingle, none zero."""
    words = text.lower().split()  # of bytes: only A-Z change, and only ASCII white space separates
    if not words:
        return 0
    whole = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(whole, np.uint8) == 0x20)
    n = max(1, len(words) - width + 1)
    starts = np.concatenate([[0], gaps + 1])[:n].tolist()
    ends = np.concatenate([gaps, [len(whole)]])[-n:].tolist()
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, COUNTED):
        part = zip(starts[at : at + COUNTED], ends[at : at + COUNTED])
        hashes = np.fromiter((digest(whole[a:b], SEED) for a, b in part), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``id, fp`` of every row; ``fp`` is the fingerprint as a signed integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            texts = part.column("text").cast(pa.large_binary()).to_pylist()
            values = np.array([fingerprint(t or b"", width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(values)], names=["id", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def near_pairs(fps: np.ndarray, radius: int, block: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), i < j, of distinct fingerprints within ``radius`` bits; with ``block`` only across two blocks."""
    n = len(fps)
    words = -(-n // 64)
    lanes = np.zeros((BITS, words * 64), np.uint8)
    lanes[:, :n] = (fps[None, :] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1)
    planes = np.packbits(lanes, axis=1, bitorder="little").view("<u8")
    counters = radius.bit_length()
    start = (1 << counters) - 1 - radius
    for first in range(0, n, ROWS):
        rows = np.arange(first, min(n, first + ROWS))
        columns = np.arange(first // 64, words)
        shape = len(rows), len(columns)
        count = [np.full(shape, _ALL if start >> c & 1 else 0, np.uint64) for c in range(counters)]
        beyond = np.zeros(shape, np.uint64)
        for plane in range(BITS):
            asked = np.where(fps[rows] >> np.uint64(plane) & np.uint64(1), _ALL, np.uint64(0))
            carry = planes[plane, columns][None, :] ^ asked[:, None]
            for c in count:
                c ^= carry
                carry &= ~c
            beyond |= carry
            if plane % PLANES == PLANES - 1 and plane < BITS - 1:
                near = beyond != _ALL
                left, below = near.any(axis=1), near.any(axis=0)
                if not left.any():
                    break
                if left.mean() < 0.7 or below.mean() < 0.7:
                    cut = np.ix_(left, below)
                    count, beyond = [c[cut] for c in count], beyond[cut]
                    rows, columns = rows[left], columns[below]
        at, word = np.nonzero(beyond != _ALL)
        if not len(at):
            continue
        open_ = np.unpackbits((~beyond[at, word]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        pair, lane = np.nonzero(open_)
        i, j = rows[at[pair]], columns[word[pair]] * 64 + lane
        good = (i < j) & (j < n)
        if block is not None:
            good[good] = block[i[good]] != block[j[good]]
        if good.any():
            yield i[good], j[good]


def _join(parents: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Parents after linking i with j; every entry is a root again."""
    while True:
        a, b = parents[i], parents[j]
        apart = a != b
        if not apart.any():
            return parents
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parents, np.maximum(a, b), np.minimum(a, b))
        while (onward := parents[parents]).tobytes() != parents.tobytes():
            parents = onward


def compare(groups: DataFrame, radius: int) -> DataFrame:
    """Links ``a, b`` that join what is near inside each (group, low, high)."""

    def links(fps: list, blocks: list) -> pa.RecordBatch:
        values, own = np.array(fps, np.int64).view(np.uint64), np.array(blocks)
        parents = np.arange(len(values))
        for i, j in near_pairs(values, radius, own if own.min() != own.max() else None):
            parents = _join(parents, i, j)
        other = np.flatnonzero(parents != np.arange(len(parents)))
        pair = [pa.array(values[x].view(np.int64)) for x in (other, parents[other])]
        return pa.RecordBatch.from_arrays(pair, names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, fps, blocks = None, [], []
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("group", "low", "high")]
            ids, own = batch.column("fp").to_pylist(), batch.column("own").to_pylist()
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            for start, end in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
                name = tuple(int(c[start]) for c in columns)
                if name != group:
                    if len(fps) > 1:
                        yield links(fps, blocks)
                    group, fps, blocks = name, [], []
                fps += ids[start:end]
                blocks += own[start:end]
        if len(fps) > 1:
            yield links(fps, blocks)

    width = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = groups.select("group", "low", "high", "fp", "own").repartition(width, "group", "low", "high")
    return spread.sortWithinPartitions("group", "low", "high").mapInArrow(run, "a long, b long").distinct()


def _parts(used: int, radius: int, wanted: int) -> list[int]:
    """Masks of the leading ``wanted`` bits of each of ``radius + 1`` parts of the bits that are not used yet."""
    rest = [bit for bit in range(BITS) if not used >> bit & 1]
    return [sum(1 << bit for bit in rest[p :: radius + 1][:wanted]) for p in range(radius + 1)]


def _long(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def near_links(fps: DataFrame, scratch: Scratch, radius: int = 2, group: int = GROUP, most: int = MOST) -> DataFrame:
    """Links ``a, b`` over a table of distinct ``fp``, which join exactly what chains of near pairs join."""
    n = fps.count()
    wanted = max(0, math.ceil(math.log2(max(n, 1) / group)))
    used = {0: _parts(0, radius, wanted) if wanted else [0]}
    rows = fps.select("fp", F.lit(0).cast("long").alias("used"), F.lit(0).cast("long").alias("group"))
    found = None
    for level in range(LEVELS):
        parts = [x for key, masks in used.items() for x in (_long(key), F.array(*[_long(m) for m in masks]))]
        rows = rows.withColumn("mask", F.explode(F.create_map(*parts)[F.col("used")]))
        # Two groups with one name would only be compared together.
        name = F.xxhash64("group", "mask", F.col("fp").bitwiseAND(F.col("mask")))
        rows = rows.select("fp", F.col("used").bitwiseOR(F.col("mask")).alias("used"), name.alias("group"))
        rows = scratch.save(rows, f"groups-{level}")
        sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        sizes = scratch.save(sizes, f"sizes-{level}")  # a table of its own, so that the join can split hot groups
        sized = rows.join(sizes, "group")
        last = level == LEVELS - 1
        blocks = F.ceil(F.col("_n") / (most // 2)).cast("int") if last else F.lit(1)
        dealt = (sized if last else sized.where(F.col("_n") <= most)).withColumn("_blocks", F.when(F.col("_n") <= most, 1).otherwise(blocks))
        dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), "_blocks").cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        dealt = dealt.select("group", "fp", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        links = scratch.save(compare(dealt, radius), f"links-{level}")
        found = links if found is None else found.union(links)
        if last or not sizes.where(F.col("_n") > most).limit(1).count():
            return found.distinct()
        rows = scratch.save(sized.where(F.col("_n") > most).select("fp", "used", "group"), f"hot-{level}")
        used = {key | mask: _parts(key | mask, radius, BITS) for key, parts in used.items() for mask in parts}
    return found


def near_duplicates(
    docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", radius: int = 2, width: int = 3
) -> DataFrame:
    """``id, fp, component_id`` of every row: rows whose fingerprints chains of near pairs join share a component.

    ``component_id`` is the smallest id that can be reached, itself included; null only where no row of the component has
    an id. Null and empty texts have the fingerprint zero and link like any other. Repeated rows stay and are linked. Very
    long texts are counted in pieces. An empty table gives an empty table; other columns play no part.
    """
    rows = scratch.save(fingerprints(docs, key, text, width), "fingerprints")
    classes = scratch.save(rows.groupBy("fp").agg(F.min("id").alias("label")), "classes")
    links = scratch.save(near_links(classes.select("fp"), scratch, radius), "links")
    ends = links.select(F.col("a").alias("class")).union(links.select("b")).distinct()
    labels = components(links, ends.withColumn("component", F.col("class")), scratch, "components")
    labelled = classes.join(labels.withColumnRenamed("class", "fp"), "fp", "left")
    labelled = labelled.select("fp", "label", F.coalesce("component", "fp").alias("component"))
    names = labelled.groupBy("component").agg(F.min("label").alias("component_id"))
    names = scratch.save(labelled.join(names, "component").select("fp", "component_id"), "names")
    return rows.join(names, "fp").select("id", "fp", "component_id")
