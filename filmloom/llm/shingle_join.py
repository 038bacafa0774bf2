"""Jaccard join of word-shingle sets by PartEnum signatures.

Sizes fall into bands; sets of one band or of two neighbours that reach the threshold differ in at most k elements. The
shingle domain is hashed into parts, and subsets of parts are enumerated so that two sets within k differences agree on
one subset at least: its content is a signature. Equal sets are one class from the start. In each group of classes with
one signature, candidates are compared by a parity sketch, whose differing bits never exceed the real difference, so it
rejects without loss. Rules with wide shingles and more differences take prefixes instead of parts: the smallest hashes,
so many that two linked sets share one of them. Surviving pairs are verified on whole texts, first each class with the most central partner of its
group; classes that the links join need no further pairs. The last round compares all pairs that are still apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.llm.common import Scratch, slices, worker_cache

SKETCH_BITS, MOST_SKETCH_BITS = 256, 1 << 24
#: Bytes of sketches that are compared at once.
COMPARED = 1 << 22
#: Bytes of texts on each side of the pairs that a worker verifies at once.
VERIFIED = 1 << 20


class Rule(NamedTuple):
    """Words of a shingle, and the similarity as a fraction, so that every bound is exact in integers.

    Parts hold few elements where many differences are allowed, and empty ones would meet; ``prefix`` takes the smallest
    hashes then. Common shingles would meet at every prefix, so it suits wide ones.
    """

    width: int = 3
    numerator: int = 9
    denominator: int = 10
    prefix: bool = False
    sketch_bits: int = SKETCH_BITS
    #: Whether a sketch has at least one bit per element. Fewer say nothing about large sets, and all of them would meet.
    sized: bool = False

    def bits(self, n: int) -> int:
        wanted = 1 << max(0, n - 1).bit_length()
        return max(self.sketch_bits, min(wanted, MOST_SKETCH_BITS)) if self.sized else self.sketch_bits


CONTRACT = Rule()
#: Before whole texts move, pairs are held against a longer sketch, which tells large sets apart as well.
WIDE_BITS = 4096
#: Stands for a null id where rows are looked up again.
NO_ID = 2**63 - 1
#: Classes of one signature that are compared at once; larger groups are cut into blocks, compared block by block.
BLOCK = 1000
#: Most rows of four numbers that are sent to every executor to pick texts beside the scan (about 40 MB as a hash table);
#: with more, whole texts are shuffled to them instead. The result is the same.
PICKED = 500_000
#: Smallest signatures of a class that travel with it, to tell which pairs have met in an earlier group.
EARLY = 8
#: Partners proposed per class and group in each round; the last round proposes all.
ROUNDS = (1, 4, None)
WORD_BYTES = rb"[^\x20\x09-\x0D]+"


def lowered(text: str) -> bytes:
    return text.encode().lower()  # bytes: only A-Z change


def _mix(x: np.ndarray, factor: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
    return x ^ (x >> np.uint64(29))


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, words_of: re.Pattern, hashes: WordHash, width: int = 3) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer words than ``width`` make one shingle, no word none."""
    words = words_of.findall(lowered(text or ""))
    if not words:
        return np.empty(0, np.uint64)
    row = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(row))
    n = len(row) - width + 1
    value = np.full(n, width, np.uint64)
    for i in range(width):
        value = _mix(value + row[i : i + n], 0x9E3779B97F4A7C15)
    return np.unique(value)


def band_limits(size: int, rule: Rule = CONTRACT) -> list[tuple[int, int]]:
    """(band, largest size) for a set's own band and the next; bands are cut where the ratio passes the threshold."""
    low, band = 1, 0
    while True:
        high = low * rule.denominator // rule.numerator
        if size <= high:
            return [(band, high), (band + 1, (high + 1) * rule.denominator // rule.numerator)]
        low, band = high + 1, band + 1


def most_different(total: int, rule: Rule = CONTRACT) -> int:
    """Largest symmetric difference of two sets that reach the threshold, from the sum of their sizes."""
    return total * (rule.denominator - rule.numerator) // (rule.denominator + rule.numerator)


def prefixes(values: np.ndarray, limits: list[tuple[int, int]], rule: Rule) -> np.ndarray:
    """Smallest hashes of a set, for its own band and the next: as many as it may lack in a partner there, and one more.

    A partner met under the own band has at least the threshold's share of the set's size; one met under the next band is
    larger than the own band, which bounds the shared elements from the sum of both sizes.
    """
    n, out = len(values), []
    (band, high), (above, _) = limits
    spread = np.sort(_mix(values, 0xD6E8FEB86659FD93))
    own = -(-n * rule.numerator // rule.denominator)
    other = -(-(n + high + 1) * rule.numerator // (rule.numerator + rule.denominator))
    for name, shared in ((band, own), (above, other)):
        if shared <= n:
            out.append(_mix(spread[: n - shared + 1] + np.uint64(name), 0xA0761D6478BD642F))
    return np.concatenate(out)


def signatures(values: np.ndarray, limits: list[tuple[int, int]], rule: Rule = CONTRACT) -> np.ndarray:
    """For both bands: split k + 1 differences over first-level parts, and each part into second-level ones.

    Small sets have three second-level parts for two differences and enumerate pairs of them, which keeps signatures from
    being empty; larger sets have one part per difference. No difference allowed means equal sets, which are one class.
    """
    if rule.prefix:
        return prefixes(values, limits, rule)
    out = []
    for band, high in limits:
        k = most_different(2 * high, rule)
        if k == 0:
            continue
        first, second, chosen = ((k + 2) // 2, 3, 2) if k <= 6 else (k + 1, 1, 1)
        spread = _mix(values + np.uint64(band), 0xD6E8FEB86659FD93)
        place = (spread >> np.uint64(32)) * np.uint64(first * second) >> np.uint64(32)
        sums = np.zeros(first * second, np.uint64)
        np.add.at(sums, place.astype(np.int64), _mix(spread, 0xA0761D6478BD642F))
        grid = sums.reshape(first, second)
        for n, subset in enumerate(combinations(range(second), chosen)):
            name = np.full(first, band * 8 + n, np.uint64) * np.uint64(1 << 32) + np.arange(first, dtype=np.uint64)
            for column in subset:
                name = _mix(name + grid[:, column], 0xBF58476D1CE4E5B9)
            out.append(name)
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def parity(values: np.ndarray, bits: int = SKETCH_BITS) -> bytes:
    """A bit per slot: whether an odd number of elements fall into it. One differing element changes one bit."""
    slot = (_mix(values, 0xE7037ED1A0B428DB) >> np.uint64(40)) % np.uint64(bits)
    odd = np.bincount(slot.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


FEATURES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("class", T.LongType()),
        T.StructField("check", T.LongType()),
        T.StructField("text_hash", T.LongType()),
        T.StructField("sketch", T.BinaryType()),
        T.StructField("signatures", T.ArrayType(T.LongType(), False)),
    ]
)


def features(docs: DataFrame, key: str, text: str, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = re.compile(WORD_BYTES)
        hashes = worker_cache("word_hashes", WordHash)
        bands: dict[int, list[tuple[int, int]]] = {}
        for part in slices(batches, "_text", 1 << 20):
            sizes, classes, checks, sketches, names = [], [], [], [], []
            for t in part.column("_text").to_pylist():
                values = shingles(t, words_of, hashes, rule.width)
                n = len(values)
                if n and n not in bands:
                    bands[n] = band_limits(n, rule)
                digest = np.frombuffer(xxhash.xxh3_128_digest(values.tobytes()), np.int64)
                sizes.append(n)
                classes.append(int(digest[0]))
                checks.append(int(digest[1]))
                sketches.append(parity(values, rule.bits(n)))
                names.append(signatures(values, bands[n], rule).view(np.int64) if n else np.empty(0, np.int64))
            ends = np.cumsum([0, *map(len, names)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(names)))
            columns = [part.column("_id"), *(pa.array(x, pa.int64()) for x in (sizes, classes, checks)), part.column("_hash")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sketches, pa.binary()), lists], names=FEATURES.names)

    rows = docs.select(docs[key].cast("long").alias("_id"), docs[text].alias("_text"), F.xxhash64(docs[text]).alias("_hash"))
    return rows.mapInArrow(run, FEATURES)


PAIRS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of one width, the shortest one's: halves added up are the sketch of half as many slots."""
    least, rows = min(map(len, sketches)), []
    if len(sketches[0]) == least == max(map(len, sketches)):
        return np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)
    for sketch in sketches:
        row = np.frombuffer(sketch, np.uint64)
        while row.nbytes > least:
            half = len(row) // 2
            row = row[:half] ^ row[half:]
        rows.append(row)
    return np.stack(rows)


def _group_pairs(members: list[tuple], most: int | None, rule: Rule, signature: int) -> set[tuple[int, int]]:
    """Pairs of one group (or of two of its blocks) that may reach the threshold and are not joined yet.

    Each class proposes its ``most`` best partners by centrality, ties to the smaller class. Copies share most of their
    groups; a pair whose lists of smallest signatures have one in common below ``signature`` meets in that group and is left
    to it.
    """
    members.sort(key=lambda m: (-m[3], m[0]))
    ids = np.array([m[0] for m in members])
    size = np.array([m[1] for m in members])
    sketch = folded([m[2] for m in members])
    joined = np.array([m[4] for m in members])
    block = np.array([m[5] for m in members])
    across = block.min() != block.max()
    earlier = [{s for s in m[6] if s < signature} for m in members]
    found = set()
    step = max(1, min(128, COMPARED // sketch.nbytes))
    for start in range(0, len(members), step):
        rows = slice(start, start + step)
        apart = np.bitwise_count(sketch[rows, None, :] ^ sketch[None, :, :]).sum(axis=2, dtype=np.int32)
        total = size[rows, None] + size[None, :]
        small, large = np.minimum(size[rows, None], size[None, :]), np.maximum(size[rows, None], size[None, :])
        good = apart * (rule.denominator + rule.numerator) <= total * (rule.denominator - rule.numerator)
        good &= (rule.denominator * small >= rule.numerator * large) & (joined[rows, None] != joined[None, :])
        if across:
            good &= block[rows, None] != block[None, :]
        if most is not None:
            good &= np.cumsum(good, axis=1) <= most
        for x, y in zip(*np.nonzero(good)):
            if earlier[start + x].isdisjoint(earlier[y]):
                p, q = int(ids[start + x]), int(ids[y])
                found.add((min(p, q), max(p, q)))
    return found


def propose(groups: DataFrame, classes: DataFrame, labels: DataFrame | None, most: int | None, rule: Rule) -> DataFrame:
    """Candidate pairs of all groups whose classes are not joined yet; a hot group is dealt out as pairs of blocks."""
    rows = groups.join(labels, "class") if labels is not None else groups.withColumn("component", F.col("class"))
    open_groups = (
        rows.groupBy("signature")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("component").alias("_low"), F.max("component").alias("_high"))
        .where("_low <> _high")
        .select("signature", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks"))
    )
    own = F.pmod(F.xxhash64("class"), F.col("_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    dealt = (
        rows.join(open_groups, "signature")
        .withColumn("own", own)
        .withColumn("other", other)
        .select("signature", "class", "component", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        .join(classes.select("class", "n_shingles", "sketch", "score", "early"), "class")
    )
    names = ["signature", "low", "high", "class", "n_shingles", "sketch", "score", "component", "own", "early"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group, sent = [], None, set()

        def out(pairs: set) -> pa.RecordBatch:
            fresh = [p for p in pairs if p not in sent]
            if len(sent) > 1 << 18:
                sent.clear()
            sent.update(fresh)
            columns = list(zip(*fresh)) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in names]
            for row in zip(*columns):
                if row[:3] != group:
                    if len(held) > 1:
                        yield out(_group_pairs(held, most, rule, group[0]))
                    held, group = [], row[:3]
                held.append(row[3:])
        if len(held) > 1:
            yield out(_group_pairs(held, most, rule, group[0]))

    width = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = dealt.select(*names).repartition(width, "signature", "low", "high")  # even: much work for few bytes
    spread = spread.sortWithinPartitions("signature", "low", "high")
    return spread.mapInArrow(run, PAIRS).distinct()


def with_wide_sketch(texts: DataFrame, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = re.compile(WORD_BYTES)
        hashes = worker_cache("word_hashes", WordHash)
        for part in slices(batches, "text", 1 << 20):
            wide = [parity(shingles(t, words_of, hashes, rule.width), WIDE_BITS) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(wide, pa.binary())], names=[*part.schema.names, "wide"])

    return texts.mapInArrow(run, T.StructType([*texts.schema, T.StructField("wide", T.BinaryType())]))


def plausible(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose long sketches differ in no more bits than linked sets may."""

    def side(name: str, key: str) -> DataFrame:
        return texts.select(F.col("class").alias(key), F.col("n_shingles").alias(f"_n{name}"), F.col("wide").alias(f"_w{name}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                one, two = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("_wa", "_wb")
                )
                apart = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
                total = batch.column("_na").to_numpy() + batch.column("_nb").to_numpy()
                good = apart * (rule.denominator + rule.numerator) <= total * (rule.denominator - rule.numerator)
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return pairs.join(side("a", "a"), "a").join(side("b", "b"), "b").mapInArrow(run, PAIRS)


def verify(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose whole texts reach the threshold, compared as sets of word tuples."""
    left = texts.select(F.col("class").alias("a"), F.col("text").alias("_left"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("_right"))

    def tuples(text: str, words_of: re.Pattern) -> set:
        words = words_of.findall(lowered(text))
        width = min(rule.width, len(words))
        return set(zip(*(words[i:] for i in range(width))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = re.compile(WORD_BYTES)
        seen: list = [None, None]
        for batch in slices(slices(batches, "_left", VERIFIED), "_right", VERIFIED):
            keep = []
            for b, x, y in zip(*(batch.column(c).to_pylist() for c in ("b", "_left", "_right"))):
                if seen[0] != b:
                    seen = [b, tuples(y, words_of)]
                one, two = tuples(x, words_of), seen[1]
                both = len(one & two)
                keep.append(rule.denominator * both >= rule.numerator * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, PAIRS)


def components(links: DataFrame, labels: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Smallest label over the links, spread until nothing changes; each step also jumps to the label's own label."""
    both = scratch.save(links.union(links.select("b", "a")).toDF("a", "b").distinct(), f"{name}-links")
    step = 0
    while True:
        near = both.join(labels.select(F.col("class").alias("b"), "component"), "b").groupBy("a")
        near = near.agg(F.min("component").alias("_near")).withColumnRenamed("a", "class")
        lower = labels.join(near, "class", "left").select(
            "class", F.col("component").alias("_old"), F.least("component", F.coalesce("_near", "component")).alias("component")
        )
        onward = lower.select(F.col("class").alias("component"), F.col("component").alias("_next"))
        jumped = lower.join(onward, "component").select("class", F.col("_next").alias("component"), "_old")
        saved = scratch.save(jumped, f"{name}-{step}")
        labels = saved.select("class", "component")
        if not saved.where("component <> _old").limit(1).count():
            return labels
        step += 1


def similar_classes(
    docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", rule: Rule = CONTRACT
) -> DataFrame:
    """``_id``, ``_hash`` (of the text), ``n_shingles``, ``component_id`` and ``component`` of every row of ``docs``.

    ``component`` tells groups apart even where ids repeat or are null; it is null for rows without shingles.

    Null and empty texts have no shingles and link with nothing; their component is their own id. Rows with equal sets
    are linked, repeated rows included. A null id never names a component unless all of its component's ids are null. An
    empty table gives an empty table.
    """
    rows = scratch.save(features(docs, key, text, rule), "features")
    classes = (
        rows.where("n_shingles > 0")
        .groupBy("class")
        .agg(
            F.min("id").alias("label"),
            F.min(F.struct(F.coalesce("id", F.lit(NO_ID)).alias("id"), "text_hash")).alias("row"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
            F.first(F.slice(F.array_sort("signatures"), 1, EARLY)).alias("early"),  # equal in a class, as its sketch
            F.min("check").alias("_low"),
            F.max("check").alias("_high"),
        )
        .withColumn("_same", F.when(F.col("_low") != F.col("_high"), F.raise_error("two sets share a hash")).otherwise(1))
        .drop("_low", "_high")
    )
    classes = scratch.save(classes, "classes").drop("_same")
    each = rows.select("class", F.explode("signatures").alias("signature"))
    shared = each.groupBy("signature").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("signature")
    shared = scratch.save(shared, "shared")  # a table of its own: the join can then split hot signatures
    groups = scratch.save(each.join(shared, "signature", "left_semi").distinct(), "pairs-of-signature")
    sizes = groups.groupBy("signature").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
    scores = groups.join(sizes, "signature").groupBy("class").agg(F.sum("_size").alias("score"))
    members = scratch.save(classes.join(scores, "class"), "members")
    groups = groups.join(sizes.select("signature"), "signature", "left_semi")
    groups = scratch.save(groups, "groups")
    own = rows.select("id", "text_hash", "n_shingles", "class")
    own = scratch.save(own, "rows")
    scratch.drop("features", "pairs-of-signature")

    wanted = members.select("class", "n_shingles", F.col("row.id").alias("_id"), F.col("row.text_hash").alias("_hash"))
    if members.count() <= PICKED:
        wanted = F.broadcast(wanted)
    named_rows = docs.select(
        F.coalesce(docs[key].cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(docs[text]).alias("_hash"), docs[text].alias("text")
    )
    texts = named_rows.join(wanted, ["_id", "_hash"]).dropDuplicates(["_id", "_hash", "class"])  # repeated rows; by the join's key
    texts = texts.select("class", "n_shingles", "text")
    labels = members.select("class", F.col("class").alias("component"))
    texts_saved, links, tested = None, None, None
    for turn, most in enumerate(ROUNDS):
        pairs = propose(groups, members, labels if turn else None, most, rule)  # at first every class is a component
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = scratch.save(pairs, f"pairs-{turn}")
        if not pairs.limit(1).count():
            continue
        if texts_saved is None:
            texts_saved = scratch.save(with_wide_sketch(texts, rule), "texts")
        close = scratch.save(plausible(pairs, texts_saved, rule), f"close-{turn}")
        good = scratch.save(verify(close, texts_saved, rule), f"good-{turn}")
        tested = pairs if tested is None else tested.union(pairs)
        links = good if links is None else links.union(good)
        labels = components(links, labels, scratch, f"components-{turn}")
    if texts_saved is not None:
        scratch.drop("texts")
    named = members.join(labels, "class")
    names = named.groupBy("component").agg(F.min("label").alias("_name"))
    named = named.join(names, "component").select("class", "component", "_name")
    single = own.join(classes.select("class", "label"), "class", "left").join(named, "class", "left")
    return single.select(
        F.col("id").alias("_id"),
        F.col("text_hash").alias("_hash"),
        "n_shingles",
        F.coalesce("_name", "label", "id").alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.coalesce("component", "class")).alias("component"),
    )
