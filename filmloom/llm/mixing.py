"""Mixing sources to target weights by words.

Every document gets a hash-random key. Within a source the documents stand in the order of their keys; ranges of equal
key prefixes are summed up in parallel, the sums become offsets, and a window inside each range finishes the prefix sum.
A source gives full rounds as long as its budget lasts, then the documents before the exact cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmloom.llm.common import WORD, Scratch

#: Hexadecimal digits of the key that name a range: 4,096 ranges for each source.
RANGE_DIGITS = 3


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17) -> DataFrame:
    """Adds the size in words, the random key, the key's range, and the source in comparable form."""
    words = F.regexp_count(F.col(text), F.lit(WORD))
    order = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}")))
    return docs.withColumns(
        {
            "size": F.coalesce(words, F.lit(0)).cast("long"),
            "_order": order,
            "_range": F.substring(order, 1, RANGE_DIGITS),
            "_null": F.col(source).isNull(),
            "_source": F.coalesce(F.col(source), F.lit("")),
        }
    )


def targets(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Words to take of each source.

    Weights repeat over the sources by code point, null last. Shares of the whole size above ``most`` times a source's
    own go back to the others by weight until none is above: sources fill up in the order of limit by weight, so one
    ordered pass over the sources finds who is full. The windows here hold one row per source.
    """
    every = Window.orderBy("_null", "_source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(every) - 1) % len(weights) + 1)
    fill = Window.orderBy("_filled_at", "_null", "_source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("_all") - F.coalesce(F.sum("_most").over(before), F.lit(0))) / F.sum("weight").over(rest)
    sources = (
        rows.groupBy("_null", "_source")
        .agg(F.sum("size").alias("source_size"))
        .withColumns({"weight": weight.cast("long"), "_all": F.sum("source_size").over(Window.partitionBy())})
        .withColumn("_most", most * F.col("source_size"))
        .withColumn("_filled_at", F.col("_most") / F.col("weight"))
        .withColumn("_level", level)
        .withColumn("_full", F.col("_filled_at") <= F.col("_level"))
    )
    # A full source is followed by sources that fill later, so the first one that is not full sets the level of all others.
    shared = F.max(F.when(~F.col("_full"), F.col("_level"))).over(Window.partitionBy())
    target = F.when(F.col("_full"), F.col("_most").cast("double")).otherwise(F.col("weight") * shared)
    return sources.select("_null", "_source", "source_size", target.alias("target"))


def mix(rows: DataFrame, sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``taken`` to sized rows; ``sizes`` are the same rows without their texts.

    Documents without words are never taken. Rows with one key are ordered by size; equal ones are interchangeable. An
    empty table gives an empty table. Each source's taken words are its target, rounded down.
    """
    plan = targets(sizes, weights, most)
    by_range = Window.partitionBy("_null", "_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sizes.groupBy("_null", "_source", "_range")
        .agg(F.sum("size").alias("_sum"))
        .withColumn("_offset", F.coalesce(F.sum("_sum").over(by_range), F.lit(0)))
        .join(plan, ["_null", "_source"])
        .drop("_sum")
    )
    inside = (
        Window.partitionBy("_null", "_source", "_range").orderBy("_order", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    clash = [c for c in ("source_size", "target", "taken") if c in rows.columns]
    rounds = F.floor(F.col("_budget") / F.greatest(F.col("source_size"), F.lit(1)))
    left = F.col("_budget") - F.col("_rounds") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("_before")))
    return (
        rows.drop(*clash)
        .join(offsets, ["_null", "_source", "_range"])
        .withColumn("_before", F.col("_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("_budget", F.floor("target"))
        .withColumn("_rounds", rounds)
        .withColumn("taken", (F.col("_rounds") * F.col("size") + part).cast("long"))
        .drop("_offset", "_before", "_budget", "_rounds")
    )


def mix_documents(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """Sizes, orders and cuts the documents; every column stays."""
    rows = sized(docs)
    sizes = scratch.save(rows.select("_null", "_source", "_range", "size"), "sizes")
    return mix(rows, sizes, **options)


def written_out(mixed: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """The mix as documents: one row per whole round, and the first words of the text where the cut falls inside it."""
    schema = mixed.select(*columns).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(WORD)
        for batch in batches:
            for i, (size, taken) in enumerate(zip(batch.column("size").to_pylist(), batch.column("taken").to_pylist())):
                row = batch.select(columns).slice(i, 1)
                for _ in range(taken // size):
                    yield row
                if rest := taken % size:
                    whole = batch.column(text)[i].as_py()
                    end = next(m.end() for n, m in enumerate(word.finditer(whole), 1) if n == rest)
                    values = {c: row.column(c) for c in columns} | {text: pa.array([whole[:end]], pa.string())}
                    if "n_chars" in columns:
                        values["n_chars"] = pa.array([end], row.column("n_chars").type)
                    yield pa.RecordBatch.from_arrays([values[c] for c in columns], names=columns)

    return mixed.where(F.col("taken") > 0).select(*columns, "size", "taken").mapInArrow(run, schema)
