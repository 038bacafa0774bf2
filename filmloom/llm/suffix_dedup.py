"""Removal of every byte that a repeated string of ``LENGTH`` bytes covers.

Every window of that length has an anchor, the least hash of the short strings inside it, so equal windows have equal
anchors at equal places. Neighbouring windows with one anchor are a run; the bytes that all windows of a run's block share
are its key, and equal windows always meet under one key. Keys seen once are done. Under the others, equal runs are
merged first; where different ones are left, their bytes are concatenated, suffixes sorted, and intervals of the
Burrows-Wheeler transform are extended backwards breadth first. That yields common prefixes by increasing length and stops
at ``LENGTH``: neighbours still without a value share a whole window. A key with very many different runs is cut into
smaller blocks with longer keys, down to one window, where the key is the window itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.llm.common import Scratch, numbered, slices, worker_cache

LENGTH = 200
#: Length of the strings whose least hash is the anchor.
GRAM = 32
#: Windows per block, at first and for keys with too many different runs.
WIDTHS = (85, 29, 10, 4, 1)
#: Different runs of one key that one task may sort; above it the key is cut.
MOST_RUNS = 2_000
#: Texts are cut into parts of so many windows; windows are independent, so parts lose nothing.
PART = 1 << 20
CHUNK_BYTES = 1 << 19
CUT = 0xFF  # no UTF-8 text holds it


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed, and a random number per byte."""

    def __init__(self):
        self.base, self.letters = 0x9E3779B97F4A7C15, _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                row = np.full(size, base, np.uint64)
                row[0] = 1
                setattr(self, name, np.cumprod(row, dtype=np.uint64))
        return self.up, self.down


def sums(data: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(powers.letters[data] * up[: len(data)], out=total[1:])
    return total, down


def hashes(total: np.ndarray, down: np.ndarray, starts, size: int) -> np.ndarray:
    """Hash of the string of ``size`` bytes at each start, from prefix sums."""
    return _mix((total[starts + size] - total[starts]) * down[starts])


def runs_of(data: np.ndarray, length: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """First window, number of windows, start of the shared core, and key of every run of one part of a text."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    gram, width = min(GRAM, length), min(WIDTHS[0], length)
    total, down = sums(data, powers)
    grams = np.arange(len(data) - gram + 1)
    least = (hashes(total, down, grams, gram) & ~np.uint64((1 << 24) - 1)) | grams.astype(np.uint64)
    span, step = length - gram + 1, 1
    while step * 2 <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if span > step:
        least = np.minimum(least[: step - span], least[span - step :])
    anchor = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    block = (anchor - np.arange(n)) // width
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])]))
    count = np.diff(np.append(new, n))
    core = anchor[new] - width * block[new]
    key = hashes(total, down, core, length - width + 1) ^ _mix(block[new].astype(np.uint64) + np.uint64(77))
    return new, count, core, key


def parts_of(text: str | None) -> Iterator[tuple[int, bytes]]:
    whole = (text or "").encode()
    for start in range(0, max(1, len(whole) - LENGTH + 1), PART):
        yield start, whole[start : start + PART + LENGTH - 1]


# -- suffixes of one chunk -------------------------------------------------------------------------------------------


def suffix_order(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse by doubling, from eight bytes on until all suffixes differ."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(n, np.uint64)
    for i in range(8):
        word = (word << np.uint64(8)) | padded[i : i + n]
    order = np.argsort(word, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], word[order][1:] != word[order][:-1]]))
    known = 8
    while rank[order[-1]] < n - 1 and known < n:
        after = np.zeros(n, np.int64)  # 0: the text has ended
        after[: n - known] = rank[known:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        rank[order] = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        known *= 2
    if rank[order[-1]] < n - 1:
        rank[order] = np.arange(n)
    return order, rank


def common_prefixes(text: np.ndarray, order: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """Common prefix with the suffix before, for values under ``length``; -1 stands for anything longer.

    Intervals of suffixes with one prefix are extended by the letters before them, level by level. An interval's borders
    get the level's value if they have none yet, and an interval that set no border is not extended further. Letters are
    found by the stretches of equal letters in the transform, so long repeats cost little. Cuts are never extended, so
    only prefixes without a cut count.
    """
    n = len(text)
    before = text[order - 1]  # the transform; the last letter, a cut, stands before the first
    last = rank[order - 1]  # where the suffix one letter longer stands
    new = np.concatenate([[True], before[1:] != before[:-1]])
    stretch = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], n)
    value = np.full(n + 1, -1, np.int64)
    value[0] = value[n] = 0
    low, high = np.array([0]), np.array([n])
    for level in range(1, length + 1):
        first, count = stretch[low], stretch[high - 1] - stretch[low] + 1
        owner = np.repeat(np.arange(len(low)), count)
        piece = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        start, stop = np.maximum(begin[piece], low[owner]), np.minimum(end[piece], high[owner]) - 1
        letter = before[start].astype(np.int64)
        real = letter != CUT
        group = (owner * 256 + letter)[real]
        start, stop = start[real], stop[real]
        if not len(group):
            break
        by = np.argsort(group, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], group[by][1:] != group[by][:-1]]))
        low = last[start[by[edge]]]
        high = last[stop[by[np.append(edge[1:], len(by)) - 1]]] + 1
        unset = (value[low] < 0) | (value[high] < 0)
        low, high = low[unset], high[unset]
        if not len(low):
            break
        for border in (low, high):
            border = border[value[border] < 0]
            value[border] = level - 1
    return value


def repeated_windows(snippets: list[bytes], length: int) -> list[np.ndarray]:
    """For each byte string, which of its windows stand anywhere else in the strings."""
    text = np.frombuffer(b"".join(s + bytes([CUT]) for s in snippets), np.uint8)
    order, rank = suffix_order(text)
    same = common_prefixes(text, order, rank, length)[:-1] < 0
    hit = np.zeros(len(text), bool)
    hit[order[same]] = True
    hit[order[np.flatnonzero(same) - 1]] = True
    out, at = [], 0
    for s in snippets:
        out.append(hit[at : at + len(s) - length + 1])
        at += len(s) + 1
    return out


# -- keys with different runs ----------------------------------------------------------------------------------------

RUN = "key long, same long, row long, first long, n int, core int"
SNIPPET = "key long, same long, seen long, snippet binary, core int"
MARK = "key long, same long, mask binary"


def _marks(rows: DataFrame, length: int) -> DataFrame:
    """Masks of repeated windows for all keys with few enough different runs; whole keys share a chunk."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def out() -> pa.RecordBatch:
            masks = []
            for (_, _, seen, snippet), found in zip(held, repeated_windows([h[3] for h in held], length)):
                masks.append(np.packbits(found | (seen > 1)).tobytes())
            columns = [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, pa.array(masks, pa.binary())], names=["key", "same", "mask"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "same", "seen", "snippet"))):
                if size >= CHUNK_BYTES and row[0] != last:
                    yield out()
                    held, size = [], 0
                held.append(row)
                last = row[0]
                size += len(row[3])
        if held:
            yield out()

    spread = rows.select("key", "same", "seen", "snippet").repartition(width, "key").sortWithinPartitions("key")
    return spread.mapInArrow(run, MARK)


def _smaller(rows: DataFrame, length: int, width: int) -> DataFrame:
    """Runs of hot keys, cut into blocks of ``width`` windows; ``at`` is a block's first window in its run."""
    schema = "parent long, parent_same long, at int, " + SNIPPET
    names = ["key", "same", "seen", "snippet", "core"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, same, seen, snippet, core in zip(*(batch.column(c).to_pylist() for c in names)):
                n = len(snippet) - length + 1
                block = (core - np.arange(n)) // width
                starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
                for a, b in zip(starts.tolist(), [*starts[1:].tolist(), n]):
                    piece = snippet[a : b - 1 + length]
                    own = core - width * int(block[a])
                    name = xxhash.xxh3_64_intdigest(snippet[own : own + length - width + 1], seed=width) ^ (key & (2**64 - 1))
                    name = xxhash.xxh3_64_intdigest(name.to_bytes(8, "little"), seed=int(block[a]))
                    digest = xxhash.xxh3_64_intdigest(piece)
                    out.append((key, same, a, *_signed(name, digest), seen, piece, own - a))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 8, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    return rows.mapInArrow(run, schema)


def _signed(*values: int) -> list[int]:
    return np.array(values, np.uint64).view(np.int64).tolist()


def solve(rows: DataFrame, scratch: Scratch, length: int, level: int = 0) -> DataFrame:
    """Masks for saved snippet rows; hot keys go through smaller blocks and come back as masks of their runs."""
    hot_keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > MOST_RUNS).select("key")
    hot_keys = scratch.save(hot_keys, f"hot-{level}")
    if level + 1 == len(WIDTHS) or not hot_keys.limit(1).count():
        return scratch.save(_marks(rows, length), f"marks-{level}")
    cold = scratch.save(_marks(rows.join(hot_keys, "key", "left_anti").select(*rows.columns), length), f"marks-{level}")
    hot = rows.join(hot_keys, "key", "left_semi").select(*rows.columns)
    pieces = scratch.save(_smaller(hot, length, WIDTHS[level + 1]), f"pieces-{level}")
    merged = pieces.groupBy("key", "same").agg(
        F.sum("seen").alias("seen"), F.first("snippet").alias("snippet"), F.first("core").alias("core")
    )
    alone = merged.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), F.sum("seen").alias("_all")).where("_n > 1 or _all > 1")
    below = scratch.save(merged.join(alone.select("key"), "key", "left_semi").select(*rows.columns), f"below-{level}")
    found = solve(below, scratch, length, level + 1)
    gathered = (
        pieces.select("key", "same", "parent", "parent_same", "at", (F.length("snippet") - length + 1).alias("n"))
        .join(found, ["key", "same"])
        .groupBy("parent", "parent_same")
        .agg(F.collect_list(F.struct("at", "n", "mask")).alias("parts"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = []
            for parts in batch.column("parts").to_pylist():
                whole = np.zeros(max(p["at"] + p["n"] for p in parts), bool)
                for p in parts:
                    bits = np.unpackbits(np.frombuffer(p["mask"], np.uint8))[: p["n"]]
                    whole[p["at"] : p["at"] + len(bits)] = bits  # a mask ends with its last block that was not alone
                masks.append(np.packbits(whole).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("parent"), batch.column("parent_same"), pa.array(masks, pa.binary())], names=["key", "same", "mask"]
            )

    return cold.union(scratch.save(gathered.mapInArrow(run, MARK), f"gathered-{level}"))


def flat_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each one starts and the last one ends; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    values = column.buffers()[2]
    return np.frombuffer(values, np.uint8)[at[0] : at[-1]] if values is not None else np.zeros(0, np.uint8), at - at[0]


def flat_lists(column: pa.ListArray) -> tuple[pa.StructArray, np.ndarray]:
    """Items of all lists in a row, and the place of each one's list."""
    ends = np.asarray(column.offsets)
    return column.values.slice(ends[0], ends[-1] - ends[0]), np.repeat(np.arange(len(column)), np.diff(ends))


def covered(found: pa.StructArray, base: np.ndarray, size: int, length: int) -> np.ndarray:
    """Which of ``size`` bytes stand in a repeated window. An item is a run of ``n`` windows from ``first`` on, counted from
    its ``base``; ``mask`` tells which of them are repeated, and null means all. No two runs share a window."""
    first, n = (found.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "n"))
    first, mask = first + base, found.field("mask").cast(pa.large_binary())
    whole = mask.is_null().to_numpy(zero_copy_only=False)
    at = np.frombuffer(mask.buffers()[1], np.int64)[mask.offset : mask.offset + len(mask) + 1]
    bits = np.unpackbits(np.frombuffer(mask.buffers()[2] or b"", np.uint8)[at[0] : at[-1]])
    told = np.where(whole, 0, np.minimum(n, 8 * np.diff(at)))  # a mask ends with its last block that was not alone
    within = np.arange(told.sum()) - np.repeat(np.cumsum(told) - told, told)
    hit = bits[np.repeat(8 * (at[:-1] - at[0]), told) + within] > 0
    starts = (np.repeat(first, told) + within)[hit]
    edge = np.bincount(np.concatenate([starts, first[whole]]), minlength=size + 1)
    edge -= np.bincount(np.concatenate([starts + length, (first + n - 1 + length)[whole]]), minlength=size + 1)
    return np.cumsum(edge)[:size] > 0


# -- the whole job ---------------------------------------------------------------------------------------------------


def _key_rows(rows: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = worker_cache("suffix_powers", Powers)
        for part in slices(batches, "_text", 1 << 20):
            out = []
            for row, text in zip(part.column("_row").to_pylist(), part.column("_text").to_pylist()):
                for start, data in parts_of(text):
                    new, count, core, key = runs_of(np.frombuffer(data, np.uint8), length, powers)
                    out.append((key.view(np.int64), np.full(len(new), row), (new + start) << 16 | count << 8 | (core - new)))
            columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "row", "span"])

    return rows.mapInArrow(run, "key long, row long, span long")


def without_repeats(docs: DataFrame, scratch: Scratch, text: str = "text", length: int = LENGTH) -> DataFrame:
    """Adds ``n_bytes, n_removed, n_spans, kept`` (the bytes left, null where all stay) to every row.

    Rows are told apart by their place in the input's files, which no read setting and no loss of executors moves, so
    repeated rows are copies of each other and null keys need no rule. A null text counts as empty. Texts shorter
    than ``length`` keep everything. An empty table gives an empty table. Columns called like an output are replaced.
    """
    placed, _ = numbered(docs, scratch, "_row")
    rows = placed.select("_row", F.col(text).alias("_text"))
    each = _key_rows(rows, length)
    shared = each.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key")
    shared = scratch.save(shared, "shared")  # a table of its own: the join can then split hot keys
    own = each.join(shared, "key", "left_semi").groupBy("row").agg(F.collect_list(F.struct("key", "span")).alias("runs"))
    texts = scratch.save(rows.join(own, rows["_row"] == own["row"]).select("row", "_text", "runs"), "texts")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", 1 << 20):
            data, at = flat_texts(part.column("_text"))
            found, owner = flat_lists(part.column("runs"))
            span = found.field("span").to_numpy()
            first, n, core = span >> 16, span >> 8 & 255, span & 255
            core = np.where(core > 127, core - 256, core)
            low, held = first + at[owner], memoryview(data)
            ends = low + n - 1 + length
            same = [xxhash.xxh3_64_intdigest(held[i:j]) for i, j in zip(low.tolist(), ends.tolist())]
            columns = [found.field("key"), np.array(same, np.uint64).view(np.int64), part.column("row").take(pa.array(owner)), first]
            arrays = [pa.array(c) for c in columns] + [pa.array(c.astype(np.int32)) for c in (n, core)]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "same", "row", "first", "n", "core"])

    spots = scratch.save(texts.mapInArrow(runs, RUN), "runs")
    mixed = spots.groupBy("key").agg(F.min("same").alias("_low"), F.max("same").alias("_high")).where("_low <> _high")
    mixed = scratch.save(mixed.select("key"), "mixed")
    different = spots.join(mixed, "key").groupBy("key", "same").agg(
        F.count(F.lit(1)).alias("seen"), F.min(F.struct("row", "first", "n", "core")).alias("at")
    )
    wanted = different.groupBy("at.row").agg(F.collect_list(F.struct("key", "same", "seen", "at")).alias("wanted"))

    def snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", 1 << 20):
            data, at = flat_texts(part.column("_text"))
            found, owner = flat_lists(part.column("wanted"))
            place = found.field("at")
            low = place.field("first").to_numpy() + at[owner]
            ends = low + place.field("n").to_numpy() - 1 + length
            held = data.tobytes()
            cut = pa.array([held[i:j] for i, j in zip(low.tolist(), ends.tolist())], pa.binary())
            columns = [found.field("key"), found.field("same"), found.field("seen"), cut, place.field("core")]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "same", "seen", "snippet", "core"])

    cut = texts.select("row", "_text").join(wanted, "row").select("_text", "wanted").mapInArrow(snippets, SNIPPET)
    marks = solve(scratch.save(cut, "snippets"), scratch, length)
    # A key without marks has equal runs only: every one of its windows is repeated.
    judged = (
        spots.select("key", "same", "row", "first", "n")
        .join(mixed.withColumn("_mixed", F.lit(True)), "key", "left")
        .join(marks, ["key", "same"], "left")
        .where(F.col("_mixed").isNull() | F.col("mask").isNotNull())
        .groupBy("row")
        .agg(F.collect_list(F.struct("first", "n", "mask")).alias("found"))
    )
    schema = "row long, n_removed long, n_spans long, kept binary"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", 1 << 20):
            data, at = flat_texts(part.column("_text"))
            found, owner = flat_lists(part.column("found"))
            gone = covered(found, at[owner], len(data), length)
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            opens = at[:-1][at[:-1] < len(data)]
            begins[opens] = gone[opens]  # a text's first byte, whatever the text before ends with
            n_gone, n_spans = (np.diff(np.concatenate([[0], np.cumsum(x)])[at]) for x in (gone, begins))
            left = np.concatenate([[0], np.cumsum(np.diff(at) - n_gone)]).astype(np.int32)
            kept = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(left), pa.py_buffer(data[~gone])])
            columns = [part.column("row"), pa.array(n_gone), pa.array(n_spans), kept]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_removed", "n_spans", "kept"])

    changed = texts.select("row", "_text").join(judged, "row").select("row", "_text", "found").mapInArrow(remove, schema)
    added = ("n_bytes", "n_removed", "n_spans", "kept")
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes")
    every = placed.select(*[c for c in placed.columns if c not in added], size)
    out = every.join(changed.withColumnRenamed("row", "_row"), "_row", "left").drop("_row")
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_removed", "n_spans")})
