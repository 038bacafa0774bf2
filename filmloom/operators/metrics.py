"""Ranking and rating quality over long result tables.

Ranked lists are rows ``(model, user_id, movie_id, rank)``; all models and all
cut-offs are measured in one pass.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmloom.functions.vectors import dot
from filmloom.operators.interactions import user_interaction_counts
from filmloom.operators.relational import HOT_GROUP_ROWS
from filmloom.operators.scoring import rank_sums

# Labels and bounds of the activity bands.
BANDS = [("cold (5-9)", 5, 10), ("light (10-19)", 10, 20), ("heavy (20+)", 20, None)]


def _ideal_gain(k: int):
    """Best possible gain for a user with ``n_relevant`` items, as a lookup."""
    total, steps = 0.0, []
    for position in range(1, k + 1):
        total += 1.0 / math.log2(position + 1)
        steps.append(total)
    return F.element_at(F.array(*[F.lit(s) for s in steps]), F.least(F.lit(k), F.col("n_relevant")).cast("int"))


def dcg_terms(ranked: DataFrame, test: DataFrame) -> DataFrame:
    """Hit flag and discounted gain of every ranked row."""
    hits = test.select("user_id", "movie_id").withColumn("hit", F.lit(1))
    joined = ranked.join(hits, ["user_id", "movie_id"], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))
    gain = F.when(F.col("hit") == 1, 1.0 / F.log2(F.col("rank") + 1.0)).otherwise(F.lit(0.0))
    return joined.withColumn("gain", gain)


def user_metrics(
    ranked: DataFrame,
    test: DataFrame,
    ks: tuple[int, ...] = (10, 20),
    denominator: str = "list",
    eval_users: DataFrame | None = None,
) -> DataFrame:
    """Precision, recall and NDCG per model, user and cut-off.

    Users without test items are not evaluated. ``eval_users`` (model, user_id)
    adds users whose list is empty; they score 0. ``denominator='k'`` divides
    precision by the cut-off instead of the list length.
    """
    if any(k <= 0 for k in ks):
        raise ValueError("cut-offs must be positive")
    relevant = test.groupBy("user_id").agg(F.count("*").alias("n_relevant"))
    sums = []
    for k in ks:
        inside = F.col("rank") <= k
        sums += [
            F.sum(F.when(inside, 1).otherwise(0)).alias(f"_len{k}"),
            F.sum(F.when(inside, F.col("hit")).otherwise(0)).alias(f"_hits{k}"),
            F.sum(F.when(inside, F.col("gain")).otherwise(0.0)).alias(f"_dcg{k}"),
        ]
    per_user = dcg_terms(ranked, test).where(F.col("rank") <= max(ks)).groupBy("model", "user_id").agg(*sums)
    if eval_users is not None:
        per_user = eval_users.select("model", "user_id").join(per_user, ["model", "user_id"], "left").fillna(0)
    joined = per_user.join(relevant, "user_id")
    rows = []
    for k in ks:
        length = F.lit(k) if denominator == "k" else F.col(f"_len{k}")
        rows.append(
            F.struct(
                F.lit(k).alias("k"),
                F.coalesce(F.col(f"_hits{k}") / F.nullif(length, F.lit(0)), F.lit(0.0)).alias("precision"),
                (F.col(f"_hits{k}") / F.col("n_relevant")).alias("recall"),
                (F.col(f"_dcg{k}") / _ideal_gain(k)).alias("ndcg"),
            )
        )
    return joined.select("model", "user_id", F.inline(F.array(*rows)))


def mean_metrics(per_user: DataFrame) -> DataFrame:
    return per_user.groupBy("model", "k").agg(
        F.count("*").alias("n_users"),
        *[F.avg(m).alias(m) for m in ("precision", "recall", "ndcg")],
    )


def ranking_metrics(ranked: DataFrame, test: DataFrame, ks: tuple[int, ...] = (10, 20)) -> DataFrame:
    return mean_metrics(user_metrics(ranked, test, ks))


def catalog_coverage(ranked: DataFrame, train: DataFrame, k: int = 20) -> DataFrame:
    """Share of the train catalog that some user's top k shows."""
    n_items = train.agg(F.count_distinct("movie_id")).scalar()
    shown = ranked.where(F.col("rank") <= k).groupBy("model").agg(F.count_distinct("movie_id").alias("n_shown"))
    counted = shown.withColumn("n_items", n_items)
    ratio = F.coalesce(F.col("n_shown") / F.nullif(F.col("n_items"), F.lit(0)), F.lit(0.0))
    return counted.withColumn("coverage", ratio)


def assign_segment(counts: DataFrame, n: str = "n_interactions", bands: list[tuple] | None = None) -> DataFrame:
    """Activity band of each user; counts under the first band are ``below``."""
    chosen = F.lit("below")
    for label, low, high in bands or BANDS:
        inside = F.col(n) >= low
        if high is not None:
            inside = inside & (F.col(n) < high)
        chosen = F.when(inside, F.lit(label)).otherwise(chosen)
    return counts.withColumn("segment", chosen)


def segment_metrics(
    ranked: DataFrame, test: DataFrame, train: DataFrame, k: int = 10, bands: list[tuple] | None = None
) -> DataFrame:
    """Metrics per activity band; bands without users stay, with nulls."""
    segments = assign_segment(user_interaction_counts(train), bands=bands).select("user_id", "segment")
    per_user = user_metrics(ranked, test, (k,)).join(segments, "user_id")
    measured = per_user.groupBy("model", "segment").agg(
        F.count("*").alias("n_users"), *[F.avg(m).alias(m) for m in ("precision", "recall", "ndcg")]
    )
    labels = [F.lit(b[0]) for b in bands or BANDS] + [F.lit("below")]
    frame = ranked.select("model").distinct().withColumn("segment", F.explode(F.array(*labels)))
    return frame.join(measured, ["model", "segment"], "left").fillna(0, ["n_users"])


def user_auc(
    scores: DataFrame, test: DataFrame, train: DataFrame, hot_levels: int = HOT_GROUP_ROWS
) -> DataFrame:
    """ROC AUC per user from the rank sum of the test items.

    Train items are left out of the negatives; ties share their average rank;
    a user without negatives scores 0.5.
    """
    pair = ["user_id", "movie_id"]
    positives = test.select(*pair).distinct().withColumn("_pos", F.lit(1))
    evaluated = scores.join(train.select(*pair), pair, "left_anti").join(
        test.select("user_id").distinct(), "user_id", "left_semi"
    )
    marked = evaluated.join(positives, pair, "left").withColumn("_pos", F.coalesce("_pos", F.lit(0)))
    # Equal scores collapse to one row, so ranks need one window over score levels.
    levels = marked.groupBy("user_id", "score").agg(F.count("*").alias("_n"), F.sum("_pos").alias("_p"))
    negatives = F.col("_n") - F.col("_p")
    # Users with very many levels are cut into score ranges; the negatives of the
    # ranges below are one number per range. At most rows / hot_levels users are cut.
    spans = levels.groupBy("user_id").agg(
        F.count("*").alias("_levels"), F.min("score").alias("_low"), F.max("score").alias("_high")
    )
    hot = F.broadcast(spans.where(F.col("_levels") > hot_levels))
    ranges = F.ceil(F.col("_levels") / F.lit(hot_levels)) * 4
    part_no = F.floor((F.col("score") - F.col("_low")) / (F.col("_high") - F.col("_low")) * ranges)
    sliced = levels.join(hot, "user_id", "left").withColumn("_part", F.coalesce(part_no, F.lit(0)))
    below_parts = Window.partitionBy("user_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        levels.join(hot, "user_id")
        .withColumn("_part", part_no)
        .groupBy("user_id", "_part")
        .agg(F.sum(negatives).alias("_neg"))
        .select("user_id", "_part", F.sum("_neg").over(below_parts).alias("_offset"))
    )
    inside = (
        Window.partitionBy("user_id", "_part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    )
    lower = F.coalesce(F.sum(negatives).over(inside), F.lit(0)) + F.coalesce("_offset", F.lit(0))
    summed = (
        sliced.join(F.broadcast(offsets), ["user_id", "_part"], "left")
        .withColumn("_won", F.col("_p") * (lower + negatives / 2.0))
        .groupBy("user_id")
        .agg(F.sum("_won").alias("_won"), F.sum("_p").alias("n_pos"), F.sum(negatives).alias("n_neg"))
        .where(F.col("n_pos") > 0)
    )
    auc = F.coalesce(F.col("_won") / F.nullif(F.col("n_pos") * F.col("n_neg"), F.lit(0)), F.lit(0.5))
    return summed.select("user_id", "n_pos", "n_neg", auc.alias("auc"))


def factor_auc(
    users: DataFrame, items: DataFrame, test: DataFrame, train: DataFrame, digits: int = 6, **tiles: int
) -> DataFrame:
    """ROC AUC per test user of a factor model, over every film outside train: (user_id, n_pos, n_neg, auc).

    Scores are counted inside the tiles of all users x all films and never stand as rows. Equal scores count half; a user
    without negatives scores 0.5; test films without a vector and users without one are not measured.
    """
    pair = ["user_id", "movie_id"]
    liked = test.select(*pair).distinct().join(train.select(*pair), pair, "left_anti")
    own = liked.join(users.withColumnRenamed("vec", "_u"), "user_id").join(items.withColumnRenamed("vec", "_i"), "movie_id")
    level = F.round(dot(F.col("_u"), F.col("_i")), digits)
    levels = own.groupBy("user_id").agg(F.collect_list(level).alias("levels"), F.count("*").alias("n_pos"))
    asked = users.join(levels, "user_id")
    seen = train.select(*pair).union(test.select(*pair)).join(levels.select("user_id"), "user_id", "left_semi")
    counted = rank_sums(asked, items, "levels", seen=seen, digits=digits, **tiles)
    joined = levels.select("user_id", "n_pos").join(counted, "user_id", "left")
    n_neg = F.coalesce("n_others", F.lit(0).cast("long"))
    auc = F.coalesce(F.col("won") / F.nullif(F.col("n_pos") * n_neg, F.lit(0)), F.lit(0.5))
    return joined.select("user_id", "n_pos", n_neg.alias("n_neg"), auc.alias("auc"))


def rating_errors(predicted: DataFrame, rating: str = "rating", estimate: str = "estimate") -> DataFrame:
    squared = F.pow(F.col(rating).cast("double") - F.col(estimate), F.lit(2.0))
    return predicted.agg(F.count("*").alias("n"), F.avg(squared).alias("mse")).withColumn("rmse", F.sqrt("mse"))


def comparison_table(long: DataFrame, metrics: list[str]) -> DataFrame:
    """(model, metric, value) -> one row per model; absent metrics show N/A."""
    wide = long.groupBy("model").pivot("metric", metrics).agg(F.first("value"))
    value = {m: F.col(f"`{m}`") for m in metrics}
    shown = [F.when(v.isNotNull(), F.format_string("%.4f", v)).otherwise(F.lit("N/A")).alias(m) for m, v in value.items()]
    return wide.select("model", *shown)
