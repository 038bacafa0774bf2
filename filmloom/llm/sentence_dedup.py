"""Removal of repeated runs of sentences.

A run is long enough with ``SENTENCES`` sentences and ``RUN_WORDS`` words, or as one sentence of ``LONE_WORDS`` words. Runs
meet all over the corpus by their hash; the first place is the smallest by id, text and position. Sentences that any later
run covers are removed.

Hashed are the shortest run from every sentence on and the shortest run up to every sentence. That removes exactly what all
runs together would: of a longer run that repeats, each sentence from which a long enough run still fits is covered by the
shortest run from it, and the sentences behind by the shortest run up to the end. These parts repeat wherever the whole does,
and where the whole has an earlier place, so have they; and each of them is a run itself, so nothing else goes.

First places come from a partial minimum, so a run that a third of all documents share sends one row per task; only hashes
seen at least twice go on to the join with the places.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.llm.common import Scratch, slices

SENTENCES, RUN_WORDS, LONE_WORDS = 2, 20, 50
#: Ends of sentences: white space after a closing mark, or a line break.
BREAK = r"(?<=[.!?])\s+|\s*\n\s*"
NO_ID = 2**63 - 1


def cut(text: str, pattern: re.Pattern) -> tuple[list[str], list[int]]:
    """Sentences, and where each begins together with the white space that follows it; the ends close the last."""
    starts = [0, *(m.end() for m in pattern.finditer(text) if m.end())]
    if starts[-1] != len(text):
        starts.append(len(text))
    return [text[a:b].strip() for a, b in zip(starts, starts[1:])], starts


def runs(sentences: list[str], least: int, words: int, lone: int) -> list[tuple[int, int]]:
    """First sentence and the one after the last, of the shortest long enough run from and up to each sentence."""
    sizes = np.array([len(s.split()) for s in sentences], int)
    total, at = np.cumsum([0, *sizes]), np.arange(len(sentences))
    stop = np.maximum(np.searchsorted(total, total[:-1] + words), at + least)
    start = np.minimum(np.searchsorted(total, total[1:] - words, "right") - 1, at + 1 - least)
    alone = sizes >= lone
    stop, start = np.where(alone, at + 1, stop), np.where(alone, at, start)
    ahead = zip(at.tolist(), stop.tolist())
    return sorted({(i, j) for i, j in ahead if j <= len(sentences)} | {(i, j + 1) for i, j in zip(start.tolist(), at.tolist()) if i >= 0})


def places(rows: DataFrame, least: int, words: int, lone: int) -> DataFrame:
    schema = "id long, text_hash long, first int, stop int, run binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(BREAK)
        for part in slices(batches, "_text", 1 << 20):
            out: list[tuple] = []
            for i, h, text in zip(*(part.column(c).to_pylist() for c in ("id", "text_hash", "_text"))):
                sentences, _ = cut(text or "", pattern)
                out += [
                    (i, h, a, b, xxhash.xxh3_128_digest("\n".join(sentences[a:b]).encode())) for a, b in runs(sentences, least, words, lone)
                ]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text_hash", "first", "stop", "run"])

    return rows.mapInArrow(run, schema)


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = SENTENCES, words: int = RUN_WORDS, lone: int = LONE_WORDS
) -> DataFrame:
    """Adds ``n_sentences, n_removed, n_spans`` and replaces the text by what is left of it.

    A null text stays null and counts as empty. Rows are told apart by id and text: rows that repeat both are one document
    and are treated alike; a null id comes last. Texts shorter than a run keep everything. An empty table gives an empty
    table. Columns called like an output are replaced.
    """
    identity = {"id": F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)), "text_hash": F.xxhash64(text)}
    spots = places(docs.select(F.col(text).alias("_text"), *[c.alias(n) for n, c in identity.items()]), least, words, lone)
    place = F.struct("id", "text_hash", "first")
    seen = spots.groupBy("run").agg(F.min(place).alias("origin"), F.max(place).alias("latest")).where("origin <> latest")
    # A table of its own: the join can then split hot runs.
    seen = Scratch(docs.sparkSession).save(seen.select("run", "origin"), "seen")
    later = (
        spots.join(seen, "run")
        .where(place != F.col("origin"))
        .groupBy("id", "text_hash")
        .agg(F.collect_set(F.struct("first", "stop")).alias("_runs"))
        .withColumnsRenamed({"id": "_id", "text_hash": "_hash"})
    )
    added = ("n_sentences", "n_removed", "n_spans")
    keep = [c for c in docs.columns if c not in added]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in added])
    joined = docs.select(*keep, identity["id"].alias("_id"), identity["text_hash"].alias("_hash")).join(later, ["_id", "_hash"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(BREAK)
        for part in slices(batches, text, 1 << 20):
            left, counts = [], []
            for whole, spans in zip(part.column(text).to_pylist(), part.column("_runs").to_pylist()):
                sentences, starts = cut(whole or "", pattern)
                gone = np.zeros(len(sentences) + 1, bool)
                for span in spans or ():
                    gone[span["first"] : span["stop"]] = True
                n_spans = int(np.count_nonzero(gone[:-1] & ~np.concatenate([[False], gone[:-1]])[: len(sentences)]))
                counts.append((len(sentences), int(gone.sum()), n_spans))
                if gone.any():
                    whole = "".join(whole[a:b] for a, b, x in zip(starts, starts[1:], gone) if not x)
                left.append(whole)
            columns = {c: part.column(c) for c in keep} | {text: pa.array(left, pa.string())}
            counted = [pa.array(c, pa.int64()) for c in zip(*counts)]
            yield pa.RecordBatch.from_arrays([*(columns[c] for c in keep), *counted], names=[*keep, *added])

    return joined.select(*keep, "_runs").mapInArrow(run, schema)
