"""Quality rules whose cutoffs come with a bound on the good documents they may reject.

Each rule compares one ratio of a document with a cutoff of the document's stratum. Labelled documents are split by a hash:
one half plans at most one cutoff per stratum and rule, the other half, the holdout, tests it. A cutoff stands only if the
exact binomial probability of seeing so few rejected good documents, were the true rate above the allowed one, stays under
the error level shared out over the planned tests (Bonferroni). That is the Clopper-Pearson bound, read the other way round.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.llm.common import WORD, Scratch, slices, small_enough

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words")
SYMBOLS = "#*$%&|<>"
RULES = ("symbol_ratio", "upper_ratio", "dup_line_ratio", "repeat_ratio")
BROADCAST_STRATA = 10_000


def repeated_window_words(numbers: np.ndarray, width: int = 3) -> int:
    """Words inside a window of ``width`` words that occurs at least twice."""
    n = len(numbers) - width + 1
    if n < 2:
        return 0
    codes = numbers[:n].astype(np.int64)
    for shift in range(1, width):
        codes = codes * (int(numbers.max()) + 1) + numbers[shift : shift + n]
        codes = np.unique(codes, return_inverse=True)[1]  # dense again, so the products never overflow
    twice = np.bincount(codes)[codes] > 1
    covered = np.zeros(len(numbers) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(covered)[:-1]))


def text_counts(text: str, pattern: re.Pattern) -> tuple[int, ...]:
    words = pattern.findall(text)
    lines = [x for x in text.split("\n") if x.strip("\x20\t\n\x0b\x0c\r")]
    number: dict[str, int] = {}
    numbers = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    distinct_upper = {i for w, i in number.items() if len(w) > 1 and w.isupper()}
    upper = int(np.isin(numbers, list(distinct_upper)).sum()) if distinct_upper else 0
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_window_words(numbers),
        len(lines),
        upper,
    )


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base counts of each whole text, ``base_failed`` and one ratio per rule.

    Null and empty texts have zero words and fail the base check. Existing columns of these names are replaced.
    """
    keep = [c for c in df.columns if c not in COUNTS]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(WORD)
        for part in slices(batches, text, 1 << 20):
            rows = [text_counts(x or "", pattern) for x in part.column(text).to_pylist()]
            counts = [pa.array(x, pa.int64()) for x in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*map(part.column, keep), *counts], names=[*keep, *COUNTS])

    out = df.select(*keep).mapInArrow(run, schema)

    def ratio(part: str, whole: str):
        return F.col(part) / F.greatest(F.col(whole), F.lit(1))

    return out.withColumns(
        {
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            "symbol_ratio": ratio("n_symbols", "word_chars"),
            "upper_ratio": ratio("n_upper_words", "n_words"),
            "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
            "repeat_ratio": ratio("n_repeat_words", "n_words"),
        }
    )


def binomial_tail(n: int, k: int, rate: float) -> float:
    """P(X <= k) of a binomial, summed downwards from k until the terms vanish."""
    if k >= n:
        return 1.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    term = math.exp(log + k * math.log(rate) + (n - k) * math.log1p(-rate))
    if k > n * rate:  # the upper side has fewer terms then
        upper, t, i = 0.0, term, k
        while i < n and (t > 1e-18 or i < n * rate):
            t *= (n - i) * rate / ((i + 1) * (1 - rate))
            i += 1
            upper += t
        return max(0.0, 1.0 - upper)
    total, i = term, k
    while i > 0 and term > total * 1e-17:
        term *= i * (1 - rate) / ((n - i + 1) * rate)
        i -= 1
        total += term
    return min(1.0, total)


PLAN = "stratum string, n_rules int, rule string, cutoff double, n long, k long"


def plan(rows: pd.DataFrame, rate: float, error: float, good_weight: float) -> pd.DataFrame:
    """The rules that one stratum tests, each with one cutoff, chosen on the first half alone.

    m rules share the rate and the error, so m is chosen by gain among sets that the first half itself would certify; where
    no rule would be, nothing is tested and nothing is taken from the other strata.
    """
    gone = rows["k_bad"] / rows["n_bad"].clip(lower=1) - good_weight * rows["k_first"] / rows["n_first"].clip(lower=1)
    rows = rows.assign(gain=gone)[gone > 0].sort_values(["gain", "cutoff", "rule"], ascending=False)
    best, best_gain = rows[:0], 0.0
    for m in range(1, len(RULES) + 1):
        fits = [binomial_tail(int(n), int(k), rate / m) <= error / m for n, k in zip(rows["n_first"], rows["k_first"])]
        chosen = rows[fits].drop_duplicates("rule")[:m]
        if len(chosen) == m and chosen["gain"].sum() > best_gain:
            best, best_gain = chosen, chosen["gain"].sum()
    return best.assign(n_rules=len(best))[["stratum", "n_rules", "rule", "cutoff", "n", "k"]]


def calibrate(
    counted: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    stratum: str = "lang",
    label: str = "quality",
    max_false_rejection: float = 0.02,
    error: float = 0.05,
    levels: tuple[float, ...] = (0.99, 0.995, 0.998, 0.999, 1.0),
    good_weight: float = 20.0,
    seed: int = 11,
) -> DataFrame:
    """One row per (stratum, rule) with its certified cutoff; a pair without one has no row and rejects nothing.

    In every stratum, all rules together reject at most ``max_false_rejection`` of the good documents that pass the base
    check, with probability ``1 - error`` over the holdout, for all strata at once. Cutoffs are proposed at ``levels`` of
    the good documents of the first half; the best on that half by rejected bad documents minus ``good_weight`` times
    rejected good ones is planned, if positive. Strata with a plan share the error evenly, and the rules of a plan share
    its stratum's error and ``max_false_rejection``. A null stratum is a stratum of its own (empty text). Of
    several labels of one document the lowest counts; documents and labels without a key or label take no part; empty
    labels certify nothing.
    """
    marks = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    marks = marks.groupBy(F.col(key).alias("_key")).agg((F.min(label) > 0).alias("_good"))
    per_rule = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES]))
    rows = (
        counted.where(~F.col("base_failed"))
        .select(F.col(key).alias("_key"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), *RULES)
        .join(marks, "_key")
        .select("stratum", "_good", (F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(2)) == 1).alias("_holdout"), per_rule)
        .select("stratum", "_good", "_holdout", "col.rule", "col.value")
    )
    proposed = (
        rows.where(~F.col("_holdout") & F.col("_good"))
        .groupBy("stratum", "rule")
        .agg(F.percentile_approx("value", list(levels), 10_000).alias("cutoffs"))
        .select("stratum", "rule", F.explode(F.array_distinct("cutoffs")).alias("cutoff"))
    )
    above = F.col("value") > F.col("cutoff")

    def seen(good: bool, holdout: bool):
        return (F.col("_good") == F.lit(good)) & (F.col("_holdout") == F.lit(holdout))

    tested = (
        rows.join(F.broadcast(proposed), ["stratum", "rule"])
        if small_enough(proposed, BROADCAST_STRATA * len(RULES))
        else rows.join(proposed, ["stratum", "rule"])
    )
    tested = tested.groupBy("stratum", "rule", "cutoff").agg(
        F.count_if(seen(True, True)).alias("n"),
        F.count_if(seen(True, True) & above).alias("k"),
        F.count_if(seen(True, False)).alias("n_first"),
        F.count_if(seen(True, False) & above).alias("k_first"),
        F.count_if(seen(False, False)).alias("n_bad"),
        F.count_if(seen(False, False) & above).alias("k_bad"),
    )
    tested = Scratch(counted.sparkSession).save(tested, "tested")
    n_strata = max(1, tested.select("stratum").distinct().count())

    def planned_of(rows: pd.DataFrame) -> pd.DataFrame:
        return plan(rows, max_false_rejection, error / n_strata, good_weight)

    planned = Scratch(counted.sparkSession).save(tested.groupBy("stratum").applyInPandas(planned_of, PLAN), "planned")
    n_planned = max(1, planned.select("stratum").distinct().count())

    @F.pandas_udf("double")
    def p_value(n: pd.Series, k: pd.Series, n_rules: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(int(a), int(b), max_false_rejection / int(m)) for a, b, m in zip(n, k, n_rules)])

    certified = planned.withColumn("p", p_value("n", "k", "n_rules")).where(F.col("p") * n_planned * F.col("n_rules") <= error)
    return certified.select("stratum", "rule", "cutoff", "n", "k", "p")


def apply_cutoffs(counted: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Adds ``kept``: the base check passed and no ratio above its stratum's cutoff."""
    wide = cutoffs.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_cut_{r}") for r in RULES]
    )
    wide = wide.withColumnRenamed("stratum", "_stratum")
    if small_enough(wide, BROADCAST_STRATA):
        wide = F.broadcast(wide)
    rows = counted.withColumn("_own", F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    rows = rows.join(wide, F.col("_own") == F.col("_stratum"), "left")
    broken = F.lit(False)
    for r in RULES:
        broken = broken | F.coalesce(F.col(r) > F.col(f"_cut_{r}"), F.lit(False))
    return rows.withColumn("kept", ~F.col("base_failed") & ~broken).drop("_own", "_stratum", *[f"_cut_{r}" for r in RULES])
