"""Pieces that the corpus operators share."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.session import shared_folder

#: A word as most contracts of the corpus operators define it.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def worker_cache(name: str, make: Callable[[], object]):
    """A value made once per Python worker. Task functions travel by value, so their globals end with the task."""
    store = sys.modules.setdefault("filmloom_worker_cache", types.ModuleType("filmloom_worker_cache"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that one piece holds about ``size`` bytes of a text column, one row at least."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for row, length in enumerate(lengths):
            if row > start and held + length > size:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        if start < batch.num_rows:
            yield batch.slice(start)


def text_key(text: Column) -> Column:
    """128-bit identity of a whole text; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


class Scratch:
    """Intermediate tables in the folder that all executors share; lost executors can reread them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for found in files.globStatus(path) or ():
                files.delete(found.getPath(), True)


#: Up to so many files the numbers of their first rows are broadcast.
FILES_BROADCAST = 100_000


def _one_row_per_place(docs: DataFrame) -> bool:
    """Whether the table is columns of Parquet files and nothing else, so that file and row within it name one row."""
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation" and node.relation().toString() == "parquet"


def _place(docs: DataFrame, part: str) -> Column:
    return docs.metadataColumn("_metadata").getField(part)


def _rows_by_file(docs: DataFrame) -> list:
    places = docs.select(_place(docs, "file_path").alias("file"), _place(docs, "row_index").alias("row"))
    return places.groupBy("file").agg(F.count("row").alias("n"), F.max("row").alias("last")).orderBy("file").collect()


def numbered(docs: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, int]:
    """Adds the column ``name``, dense from 0, and gives the number of rows.

    A row's number is its index within its Parquet file plus the rows of the files before, by path. How files are cut into
    splits has no part in it, so every read gives the same numbers, whatever the read settings and executors. Other inputs
    are written once and numbered there. The driver holds one number per file. A column of that name is replaced.
    """
    docs = docs.drop(name)
    files = _rows_by_file(docs) if _one_row_per_place(docs) else None
    if files is None or any(f["n"] != f["last"] + 1 for f in files):  # not Parquet, or files that are listed twice
        docs = scratch.save(docs, "rows")
        files = _rows_by_file(docs)
    starts, total = [], 0
    for f in files:
        starts.append((f["file"], total))
        total += f["n"]
    first = docs.sparkSession.createDataFrame(starts, "_number_file string, _number_start long")
    placed = docs.select(*docs.columns, _place(docs, "file_path").alias("_number_file"), _place(docs, "row_index").alias(name))
    joined = placed.join(F.broadcast(first) if len(starts) <= FILES_BROADCAST else first, "_number_file")
    return joined.select(*docs.columns, (F.col(name) + F.col("_number_start")).alias(name)), total


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder's full address, with the default file system of the session where it names none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def opened(address: str):
    """File system and path for tasks that write or read plain files; an address it doesn't know is an error."""
    from pyarrow import fs

    if address.startswith("file:"):
        return fs.LocalFileSystem(), "/" + address.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(address.replace("s3a://", "s3://", 1))


def small_enough(df: DataFrame, most: int) -> bool:
    """Whether a table has at most so many rows; the check before a broadcast."""
    return len(df.limit(most + 1).select(F.lit(1)).take(most + 1)) <= most
