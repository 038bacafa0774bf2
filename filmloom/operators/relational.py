"""Keyed relational building blocks.

None of these brings a whole key group into one task: duplicates and extremes
go through partial aggregates, top-k through ``WindowGroupLimit``, and positions
inside large groups through hash buckets.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from filmloom.session import cut_lineage

log = logging.getLogger(__name__)

# Rows one sort task may hold before a group is spread over hash buckets.
HOT_GROUP_ROWS = 1_000_000


def keep_existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select([c for c in wanted if c in df.columns])


def default_missing_column(df: DataFrame, name: str, default: str = "") -> DataFrame:
    """Column present and free of nulls."""
    if name not in df.columns:
        return df.withColumn(name, F.lit(default))
    return df.withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def dedup_keep_first(
    df: DataFrame, keys: list[str], order_by: list[Column | str], last: bool = False
) -> DataFrame:
    """One row per key: the first (or last) in ``order_by``, which must be a total order.

    ``min_by`` combines map-side, so a key with very many copies costs one row
    per task in the shuffle.
    """
    payload = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    if not payload:
        return df.select(*keys).distinct()
    pick = (F.max_by if last else F.min_by)(F.struct(*payload), order)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def top_k_per_group(
    df: DataFrame, group: str | list[str], order_by: list[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The k best rows per group with their 1-based rank.

    The rank predicate becomes ``WindowGroupLimit``: each task keeps k rows per
    group before the shuffle.
    """
    keys = [group] if isinstance(group, str) else group
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def top_n(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(by), F.asc(tie)).limit(n)


def head_n(df: DataFrame, n: int, key: str = "movie_id") -> DataFrame:
    return df.orderBy(key).limit(n)


def shuffle_key(*parts: Column | str, seed: int | str) -> Column:
    """Repeatable pseudo-random order: the same on every engine that has md5."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("-", *[c.cast("string") for c in columns], F.lit(str(seed))))


def random_n(df: DataFrame, n: int, key: str = "movie_id", seed: int = 42) -> DataFrame:
    return df.orderBy(shuffle_key(key, seed=seed), key).limit(n)


def count_and_position(
    df: DataFrame, group: str, order_hash: str, tie: list[str], hot_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """Adds ``n`` (rows of the group) and ``position`` (1-based, by hash order).

    Ordinary groups take one window. A group above ``hot_rows`` is cut into
    slices of the hash range of about ``hot_rows`` rows each; a position is then
    the offset of the slice plus the rank inside it. There are at most
    ``rows / hot_rows`` hot groups and twice as many slices, which bounds both
    broadcasts.
    """
    df = df.where(F.col(group).isNotNull())
    hot = (
        df.groupBy(group).agg(F.count("*").alias("_hot_n")).where(F.col("_hot_n") > hot_rows)
    )
    # Leading 48 bits of the hash as a fraction: slices follow hash order.
    fraction = F.conv(F.substring(order_hash, 1, 12), 16, 10).cast("double") / F.lit(float(2**48))
    slices = F.ceil(F.col("_hot_n") / F.lit(hot_rows))
    slice_no = F.coalesce(F.floor(fraction * slices), F.lit(0)).cast("bigint")
    tagged = df.join(F.broadcast(hot), group, "left").withColumn("_slice", slice_no)
    part = Window.partitionBy(group, "_slice")
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.join(F.broadcast(hot), group)
        .withColumn("_slice", slice_no)
        .groupBy(group, "_slice")
        .agg(F.count("*").alias("_rows"))
        .select(group, "_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        tagged.join(F.broadcast(offsets), [group, "_slice"], "left")
        .withColumn("n", F.coalesce("_hot_n", F.count("*").over(part)))
        .withColumn(
            "position",
            F.coalesce("_offset", F.lit(0)) + F.row_number().over(part.orderBy(order_hash, *tie)),
        )
        .drop("_slice", "_hot_n", "_offset")
    )


def index_ids(df: DataFrame, key: str, index: str = "idx", hex_digits: int = 3) -> DataFrame:
    """Dense 0-based index over the distinct keys, in hash order.

    Hash order makes the buckets equally large whatever the keys look like, so
    no global sort is needed: offsets come from one row per bucket.
    """
    keyed = df.select(key).where(F.col(key).isNotNull()).distinct()
    hashed = keyed.withColumn("_hash", F.md5(F.col(key).cast("string"))).withColumn(
        "_bucket", F.substring("_hash", 1, hex_digits)
    )
    offsets = (
        hashed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .select("_bucket", "_before")
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key)) - 1
    # One offset per bucket: at most 16**hex_digits rows.
    return hashed.join(F.broadcast(offsets), "_bucket").select(
        key, (F.col("_before") + within).cast("bigint").alias(index)
    )


def global_positions(df: DataFrame, order_by: list[Column], position: str = "position") -> DataFrame:
    """1-based position of every row in a total order, by a distributed sort.

    The sorted rows are checkpointed so that both passes see the same partitions;
    the offsets are one row per partition.
    """
    ordered = cut_lineage(df.orderBy(*order_by)).withColumn("_mid", F.monotonically_increasing_id())
    ordered = ordered.withColumn("_pid", F.shiftright("_mid", 33))
    sizes = ordered.groupBy("_pid").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_pid", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.col("_before") + within + 1).alias(position)
    )


def exclude_items(df: DataFrame, excluded: DataFrame, on: str | list[str] = "movie_id") -> DataFrame:
    return df.join(excluded, on, "left_anti")


def rank_score(df: DataFrame, group: str, rank: str, out: str) -> DataFrame:
    """1 for the head of a list down to 1/len for its tail."""
    size = F.count("*").over(Window.partitionBy(group))
    return df.withColumn(out, 1.0 - (F.col(rank) - 1) / size)


def blend_outer(
    left: DataFrame, right: DataFrame, keys: list[str], left_score: str, right_score: str
) -> DataFrame:
    """Full outer merge; a row missing on one side scores 0 there."""
    merged = left.select(*keys, left_score).join(right.select(*keys, right_score), keys, "full")
    return merged.select(
        *keys,
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in (left_score, right_score)],
    )


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the left side and how many of them the right side has."""
    mine = left.select(key).where(F.col(key).isNotNull()).distinct()
    found = right.select(key).distinct().withColumn("_found", F.lit(1))
    return mine.join(found, key, "left").agg(
        F.count("*").alias("n_keys"), F.coalesce(F.sum("_found"), F.lit(0)).alias("n_found")
    )


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).where(F.col(key).isNotNull()).distinct().join(right, key, "left_anti")


def union_ratings(ratings: DataFrame, added: DataFrame) -> DataFrame:
    return ratings.unionByName(added, allowMissingColumns=True)


def upsert_ratings(ratings: DataFrame, updates: DataFrame, order_by: str = "ts") -> DataFrame:
    """A later rating of the same film replaces the earlier one.

    Rows of ``updates`` win over equally old rows of ``ratings``.
    """
    both = ratings.withColumn("_source", F.lit(0)).unionByName(updates.withColumn("_source", F.lit(1)))
    latest = dedup_keep_first(both, ["user_id", "movie_id"], [order_by, "_source", "rating"], last=True)
    return latest.drop("_source")


def toggle_favorites(favorites: DataFrame, toggles: DataFrame) -> DataFrame:
    """A toggle adds an absent favourite and removes a present one."""
    keys = ["user_id", "movie_id"]
    flips = favorites.select(*keys).distinct().unionByName(toggles.select(*keys))
    return flips.groupBy(*keys).agg(F.count("*").alias("_flips")).where(F.col("_flips") % 2 == 1).select(*keys)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count of a step as a by-product of whichever action runs it."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def single_row(df: DataFrame) -> Column:
    """The one row of an aggregate as a scalar subquery struct."""
    return df.select(F.struct(*df.columns).alias("_row")).scalar()
