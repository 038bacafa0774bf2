"""Training order on disk: a keyed permutation gives every sequence its global slot, ranges of slots become shard files.

A sequence is one document's token ids and the end token. The permutation is a Feistel network over the next even number
of bits; values beyond the table walk on through it until they fall inside (cycle walking). A shard holds the sequences of
a range of slots in order, cut into records of one size, so record i stands at byte i * stride and reading can resume at
any record. The texts move once, each task gets a range of shards and encodes their texts where it writes them.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.llm.common import Scratch, numbered, opened, qualified, slices, worker_cache

END = 50256
RECORD_TOKENS = 1_024
SHARD_SEQUENCES = 1_024
ROUNDS = 6


def feistel(values: np.ndarray, size: int, key: str) -> np.ndarray:
    """A permutation of range(size), the same for one key wherever it is computed."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}:{i}".encode()).digest()[:8], "little")) for i in range(ROUNDS)]
    out = np.asarray(values).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(29)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PLACES = "doc_id long, slot long, shard long, first_token long, n_tokens long, file string, record_bytes long"


def write_shards(
    docs: DataFrame, vocabulary: str, scratch: Scratch, order_key: str = "epoch-0", key: str = "doc_id", text: str = "text", sequences: int | None = None
) -> DataFrame:
    """Writes shard files of so many sequences (``SHARD_SEQUENCES``) below the scratch folder; one row per document, its place.

    Null and empty texts are sequences of the end token alone; a null id is kept as null; repeated rows are sequences of
    their own; an empty table writes nothing. Token ids take 16 bits, a vocabulary with larger ones is an error. A shard is
    written under another name and renamed, so a file with its final name is whole, and a task that runs again writes the
    same bytes, as rows are numbered by their place in their file. The folder's file system must be one that both Spark
    and pyarrow know (local or mounted, HDFS, S3, GCS); another one is an error before any work.
    """
    sequences = sequences or SHARD_SEQUENCES
    folder = qualified(docs.sparkSession, f"{scratch.folder}/shards")
    opened(folder)
    rows, size = numbered(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text")), scratch, "_index")

    @F.pandas_udf("long")
    def slot(index: pd.Series) -> pd.Series:
        return pd.Series(feistel(index.to_numpy(), size, order_key))

    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = -(-size // sequences)
    # The permutation spreads all documents evenly over the slots, so equal ranges need no sample.
    share = F.floor(F.col("shard") * width / max(shards, 1)).cast("int")
    placed = (
        rows.withColumn("slot", slot("_index"))
        .withColumn("shard", F.floor(F.col("slot") / sequences))
        .select("doc_id", "_text", "slot", "shard")
        .repartitionById(width, share)
        .sortWithinPartitions("shard", "slot")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        encode = worker_cache(f"order_encoder_{vocabulary}", lambda: encoder(vocabulary)).encode_ordinary
        files, root = opened(folder)
        files.create_dir(root, recursive=True)
        shard, out, temporary, at = None, None, "", 0

        def close() -> None:
            if out is not None:
                pad = -at % RECORD_TOKENS
                out.write(np.full(pad, END, "<u2").tobytes())
                out.close()
                files.move(temporary, f"{root}/shard-{shard:08d}.bin")

        for part in slices(batches, "_text", 1 << 20):
            places = []
            for doc, t, s, own in zip(*(part.column(c).to_pylist() for c in ("doc_id", "_text", "slot", "shard"))):
                if own != shard:
                    close()
                    shard, at = own, 0
                    temporary = f"{root}/.shard-{own:08d}-{uuid.uuid4().hex}"
                    out = files.open_output_stream(temporary)
                ids = np.array([*encode(t or ""), END], "<u2")
                out.write(ids.tobytes())
                places.append((doc, s, own, at, len(ids), f"{folder}/shard-{own:08d}.bin", 2 * RECORD_TOKENS))
                at += len(ids)
            kinds = [pa.int64()] * 5 + [pa.string(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*places), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in PLACES.split(", ")])
        close()

    return placed.mapInArrow(run, PLACES)


def materialise(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Writes the shards once, and keeps the places as a table: reading them again does not write again."""
    scratch = Scratch(docs.sparkSession)
    places = scratch.save(write_shards(docs, vocabulary, scratch, **options), "places")
    scratch.drop("rows", "shards/.shard-*")  # the numbered copy, and what tasks that were lost left behind
    return places


def read_records(places: DataFrame, shard: int = 0, record: int = 0) -> DataFrame:
    """Records ``shard, record, tokens`` (16-bit little endian) from that record on; sorted by both numbers they are the stream.

    Every task seeks to its first record and reads on from there, so resuming costs nothing for what was read before. A
    place behind the last record gives an empty table.
    """
    files = places.where(F.col("shard") >= shard).groupBy("shard", "file").agg(F.max("record_bytes").alias("stride"))
    begin = F.when(F.col("shard") == shard, F.lit(record)).otherwise(0).cast("long").alias("begin")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, address, stride, first in zip(*(c.to_pylist() for c in batch.columns)):
                store, path = opened(address)
                with store.open_input_file(path) as data:
                    for i in range(first, data.size() // stride, 1_024):
                        data.seek(i * stride)
                        block = data.read(1_024 * stride)
                        cut = [block[j : j + stride] for j in range(0, len(block), stride)]
                        numbers = pa.array(range(i, i + len(cut)), pa.int64())
                        columns = [pa.array([own] * len(cut), pa.int64()), numbers, pa.array(cut, pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, names=["shard", "record", "tokens"])

    return files.select("shard", "file", "stride", begin).mapInArrow(run, "shard long, record long, tokens binary")
