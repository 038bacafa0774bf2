"""Explicit ratings to implicit interactions and train/test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmloom.operators.relational import HOT_GROUP_ROWS, count_and_position, shuffle_key

PAIR = ["user_id", "movie_id"]


def binarize_positive(ratings: DataFrame, threshold: float = 4.0) -> DataFrame:
    """Distinct (user, film) pairs rated at least ``threshold``."""
    known = F.col("user_id").isNotNull() & F.col("movie_id").isNotNull()
    return ratings.where(known & (F.col("rating") >= threshold)).select(*PAIR).distinct()


def user_interaction_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("user_id").agg(F.count("*").alias("n_interactions"))


def active_users(pairs: DataFrame, min_interactions: int = 5) -> DataFrame:
    """Pairs of the users with at least ``min_interactions`` of them."""
    keep = user_interaction_counts(pairs).where(F.col("n_interactions") >= min_interactions)
    return pairs.join(keep.select("user_id"), "user_id", "left_semi")


def label_split(
    pairs: DataFrame,
    train_fraction: float = 0.8,
    seed: int = 42,
    min_interactions: int = 1,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Every pair of a sufficiently active user, marked train or test.

    Within a user, pairs are put in hash order; the first
    ``max(1, floor(n * train_fraction))`` are train.
    """
    hashed = pairs.select(*PAIR).withColumn("_hash", shuffle_key(*PAIR, seed=seed))
    placed = count_and_position(hashed, "user_id", "_hash", ["movie_id"], hot_rows)
    n_train = F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(train_fraction)))
    return placed.where(F.col("n") >= min_interactions).select(
        *PAIR, (F.col("position") <= n_train).alias("is_train")
    )


def split_parts(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        labelled.where("is_train").select(*PAIR),
        labelled.where("NOT is_train").select(*PAIR),
    )


def split_per_user(pairs: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    return split_parts(label_split(pairs, train, seed))


def load_and_split(
    ratings: DataFrame, min_interactions: int = 5, seed: int = 42, hot_rows: int = HOT_GROUP_ROWS
) -> tuple[DataFrame, DataFrame]:
    """The shared protocol of every model: positives, active users, 80/20 per user.

    The activity filter reads the group size the split computes anyway, so it
    costs no extra shuffle.
    """
    pairs = binarize_positive(ratings)
    return split_parts(label_split(pairs, 0.8, seed, min_interactions, hot_rows))


def drop_unseen_items(test: DataFrame, known_items: DataFrame) -> DataFrame:
    """Test pairs whose film a model can recommend at all."""
    return test.join(known_items.select("movie_id").distinct(), "movie_id", "left_semi").select(*PAIR)


def random_split(ratings: DataFrame, train_fraction: float = 0.8, seed: int = 37) -> DataFrame:
    """Marks a pair by its hash: no shuffle, and repeatable on any cluster."""
    bucket = F.conv(F.substring(shuffle_key(*PAIR, seed=seed), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    return ratings.withColumn("is_train", bucket < train_fraction)


def sample_eval_users(test: DataFrame, n: int = 300, seed: int = 42) -> DataFrame:
    """Users drawn without replacement for an evaluation run."""
    users = test.select("user_id").distinct()
    return users.orderBy(shuffle_key("user_id", seed=seed), "user_id").limit(n)


def items_per_user(pairs: DataFrame, span: int = 1024) -> DataFrame:
    """Film lists per user in chunks of at most ``span`` consecutive ids.

    One row per (user, id range), so no list grows with the history of a user.
    """
    chunk = F.floor(F.col("movie_id") / span).cast("bigint")
    return (
        pairs.withColumn("chunk", chunk)
        .groupBy("user_id", "chunk")
        .agg(F.sort_array(F.collect_set("movie_id")).alias("movie_ids"))
    )


def rescale_1_5(scored: DataFrame, group: str = "user_id", score: str = "score", out: str = "rating") -> DataFrame:
    """Linear map of each list's scores onto 1..5; 3 when all are equal."""
    whole = Window.partitionBy(group)
    low, high = F.min(score).over(whole), F.max(score).over(whole)
    stretched = 1.0 + 4.0 * (F.col(score) - low) / F.nullif(high - low, F.lit(0.0))
    return scored.withColumn(out, F.coalesce(stretched, F.lit(3.0)))
