"""Phrase collocations from streams of n-gram counts, kept in prefix and in suffix order.

Orders are counted one after the other. A phrase can only be frequent when both phrases one word shorter are, so order n
emits the places whose two shorter phrases pass a sieve: a bit table of fixed largest size over hashes of the frequent
phrases. A false bit costs rows, never results, because counts are taken over the words themselves.

The counts then stand in two range-sorted streams, by words from the front and from the back. One pass over a stream holds
the open phrases that the current one continues: what they count are its left parts (right parts in suffix order), and
when a phrase closes, its most frequent continuation is known. Keys are distinct, so the ranges are even; the open phrases
at the start of a range are handed to it as rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.llm.common import Scratch
from filmloom.llm.words import byte_chunks, lowered_classes, words_of
from filmloom.operators.relational import top_k_per_group

MOST_WORDS = 4
NO_LANG = "und"
#: Text that is counted at once, in bytes; a longer text is cut where a piece ends.
CHUNK = 4 << 20
#: Bits of a sieve: so many per frequent phrase, within the bounds.
BITS_PER_PHRASE, FEWEST_BITS, MOST_BITS = 32, 16, 27

_SPACE, _BREAK = 0x20, 0x0A
_CLASSES = lowered_classes()
_CLASSES[0x09] = _SPACE
_CLASSES[[*b".,;:!?\x0b\x0c\x0d"]] = _BREAK


def _fold(hashes: list[np.ndarray]) -> np.ndarray:
    """Hash of a phrase from the hashes of its words."""
    total = np.zeros_like(hashes[0])
    for h in hashes:
        total = (total ^ h) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang))


def _tokens(langs: list[str], ends: np.ndarray, data: np.ndarray):
    """Words of a chunk: number of each token's word, words and their languages, and each token's piece."""
    starts, text, words = words_of(data, (data != _SPACE) & (data != _BREAK), ends)
    piece = np.cumsum(data == _BREAK, dtype=np.int32)[starts] + text  # grows with every break and every text
    names, lang_of_text = np.unique(langs, return_inverse=True)
    key = words.indices.to_numpy() * len(names) + lang_of_text[text]
    distinct, number = np.unique(key, return_inverse=True)
    own_words = words.dictionary.take(pa.array(distinct // len(names)))
    return number, own_words, names[distinct % len(names)], piece


def _unique_places(numbers: np.ndarray, places: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct phrase among those that start at ``places``, and how often it occurs."""
    ids = [numbers[places + i] for i in range(order)]
    base = int(numbers.max(initial=0)) + 1
    # Pairs are numbered anew before they are paired again, so that keys stay exact in 64 bits.
    left = ids[0] * base + ids[1]
    if order > 2:
        right = ids[-2] * base + ids[-1]
        pairs, both = np.unique(np.concatenate([left, right]), return_inverse=True)
        left = both[: len(left)] * len(pairs) + both[len(left) :]
    _, first, counts = np.unique(left, return_index=True, return_counts=True)
    return places[first], counts


def counted(docs: DataFrame, order: int, sieve=None) -> DataFrame:
    """``lang, phrase, f`` of phrases of ``order`` words; for single words also each language's total with a null phrase.

    ``docs`` has ``lang`` and ``text``. ``sieve`` is the broadcast bit table of the order below.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if sieve is None else np.frombuffer(sieve.value, np.uint8)
        for rows, ends, data in byte_chunks(batches, "text", _CLASSES, CHUNK, _BREAK):
            number, words, word_lang, piece = _tokens(rows.column("lang").to_pylist(), ends, data)
            if not len(number):
                continue
            if order == 1:
                counts = np.bincount(number, minlength=len(words))
                names, of_word = np.unique(word_lang, return_inverse=True)
                totals = np.bincount(of_word, weights=counts).astype(np.int64)
                columns = [
                    pa.array([*word_lang, *names]),
                    pa.concat_arrays([words.cast(pa.binary()), pa.nulls(len(names), pa.binary())]).cast(pa.string()),
                    pa.array(np.concatenate([counts, totals])),
                ]
            else:
                hashes = np.array([_word_hash(g, w) for g, w in zip(word_lang.tolist(), words.to_pylist())], np.uint64)
                shorter = order - 1
                n = len(number) - shorter
                if n <= 0:
                    continue
                token_hash = hashes[number]
                folded = _fold([token_hash[i : len(number) - shorter + 1 + i] for i in range(shorter)])
                spot = folded & np.uint64(8 * len(bits) - 1)
                passes = (bits[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1
                places = np.flatnonzero(passes[:-1] & passes[1:] & (piece[:n] == piece[shorter:]))
                if not len(places):
                    continue
                places, counts = _unique_places(number, places, order)
                parts = [words.take(pa.array(number[places + i])) for i in range(order)]
                phrases = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
                columns = [pa.array(word_lang[number[places]]), phrases.cast(pa.binary()).cast(pa.string()), pa.array(counts)]
            whole = pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "f"])
            for start in range(0, whole.num_rows, 1 << 17):
                yield whole.slice(start, 1 << 17)

    return docs.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def broadcast_sieve(table: DataFrame):
    """Bit table over the phrases of a count table, sent to every executor: ``2**MOST_BITS`` bits at most."""
    n = max(1, table.count())
    width = min(MOST_BITS, max(FEWEST_BITS, math.ceil(math.log2(n * BITS_PER_PHRASE))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(g, p.encode().split(b" ")) for g, p in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase")))]
            if not rows:
                continue
            hashes = np.array([[_word_hash(g, w) for w in words] for g, words in rows], np.uint64)
            spots = _fold(list(hashes.T)) & np.uint64((1 << width) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(spots.astype(np.int64))], names=["spot"])

    spots = table.select("lang", "phrase").mapInArrow(run, "spot long")
    cell = F.shiftright("spot", 6).alias("cell")
    bit = F.expr("bit_or(shiftleft(1L, cast(spot & 63 as int)))").alias("bits")
    cells = spots.groupBy(cell).agg(bit).toArrow()
    bits = np.zeros(1 << (width - 6), np.int64)
    bits[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return table.sparkSession.sparkContext.broadcast(bits.astype("<i8").tobytes())


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over a sorted stream; rows out when their phrase closes."""
    names = ["lang", "phrase", "f", "parts", "extended"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    stack: list = []  # [key, count, phrase, most frequent continuation], one frame a word
    at, lang, done = None, None, []

    def close(depth: int) -> None:
        while len(stack) > depth:
            _, f, phrase, extended = stack.pop()
            done.append((lang, phrase, f, [frame[1] for frame in stack], extended))

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("part", "lang", "key", "f", "phrase"))
        for part, own_lang, key, f, phrase in zip(*columns):
            depth = 0
            if (part, own_lang) == (at, lang):
                while depth < min(len(stack), len(key) - 1) and stack[depth][0] == key[depth]:
                    depth += 1
            close(depth)
            at, lang = part, own_lang
            if depth != len(key) - 1:
                raise ValueError(f"the stream lacks a part of {phrase!r}")
            if stack:
                stack[-1][3] = max(f, stack[-1][3] or 0)
            stack.append([key[-1], f, phrase, None])
        if len(done) > 1 << 14:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
            done.clear()
    close(0)
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)


def lockstep(table: DataFrame, key: Column, scratch: Scratch, name: str) -> DataFrame:
    """``lang, phrase, f, parts, extended``: counts of the first 1, 2, ... words of ``key``, and the most frequent
    phrase that continues it by one word.

    ``table`` must hold every leading part of its phrases.
    """
    spark = table.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = table.select("lang", key.alias("key"), "f", "phrase").repartitionByRange(width, "lang", "key")
    stream = scratch.save(ranges.withColumn("part", F.spark_partition_id()), name)
    first = stream.groupBy("part").agg(F.min(F.struct("lang", "key")).alias("row")).select("part", "row.*")
    sizes = F.explode(F.sequence(F.lit(1), F.size("key") - 1)).alias("size")
    open_parts = first.where(F.size("key") > 1).select("part", "lang", "key", sizes)
    open_parts = open_parts.select(F.col("part").alias("of"), "lang", F.slice("key", F.lit(1), F.col("size")).alias("key"))
    # Under MOST_WORDS rows a range.
    handed = stream.join(F.broadcast(open_parts), ["lang", "key"]).where("part <> of")
    handed = handed.select("lang", "key", "f", "phrase", F.col("of").alias("part"))
    rows = stream.unionByName(handed).repartition(width, "part").sortWithinPartitions("part", "lang", "key")
    merged = rows.mapInArrow(_merge, "lang string, phrase string, f long, parts array<long>, extended long")
    return merged.groupBy("lang", "phrase").agg(
        F.first("f").alias("f"), F.first("parts").alias("parts"), F.max("extended").alias("extended")
    )


def count_tables(docs: DataFrame, scratch: Scratch, least: int) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, f`` of all phrases of up to four words with ``f >= least``, and ``lang, n``."""
    words = scratch.save(counted(docs, 1).where((F.col("f") >= least) | F.col("phrase").isNull()), "order-1")
    totals = words.where("phrase is null").select("lang", F.col("f").alias("n"))
    tables = [words.where((F.col("f") >= least) & F.col("phrase").isNotNull())]
    for order in range(2, MOST_WORDS + 1):
        sieve = broadcast_sieve(tables[-1])
        tables.append(scratch.save(counted(docs, order, sieve).where(F.col("f") >= least), f"order-{order}"))
        sieve.unpersist()
    table = tables[0]
    for more in tables[1:]:
        table = table.union(more)
    return table, totals


def mine(
    docs: DataFrame, scratch: Scratch, lang: str = "lang", text: str = "text", least: int = 30, absorbed: int = 80, most: int = 2000
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best ``most`` phrases of 2 to 4 words.

    Null and empty texts hold no words, a null language is ``und``. Repeated rows count each. Ties fall to the larger count,
    then to the phrase in byte order. Very long texts are counted in pieces; a text without any break is held whole by its
    task. An empty table gives an empty result; other columns play no part.
    """
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text).alias("text"))
    table, totals = count_tables(docs.where("text is not null"), scratch, least)
    words = F.split("phrase", " ")
    front = lockstep(table, words, scratch, "prefix-order")
    back = lockstep(table, F.reverse(words), scratch, "suffix-order")
    both = front.where(F.size("parts") > 0).join(
        back.select("lang", "phrase", F.col("parts").alias("_right"), F.col("extended").alias("_before")), ["lang", "phrase"]
    )
    longer = F.greatest("extended", "_before").cast("decimal(38,0)")
    kept = both.where(longer.isNull() | (longer * 100 < F.col("f").cast("decimal(38,0)") * absorbed))
    # Exact: the product may pass 64 bits, the quotient is 1,000,000 at most.
    cuts = F.expr(
        "transform(parts, (x, i) -> struct("
        "(cast(f as decimal(20,0)) * 2000000) div (cast(x as decimal(20,0)) + _right[size(parts) - 1 - i]) as score,"
        " i + 1 as cut, x as l, _right[size(parts) - 1 - i] as r))"
    )
    scored = kept.select("lang", "phrase", F.col("f").alias("a"), F.array_min(cuts).alias("_cut"))
    scored = scored.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
    best = top_k_per_group(scored, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], most)
    return best.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
