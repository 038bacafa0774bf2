"""Dense vectors stored as arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vec: Column) -> Column:
    return F.sqrt(dot(vec, vec))


def cosine(left: Column, right: Column) -> Column:
    """0 when either side has no length."""
    length = norm(left) * norm(right)
    return F.when(length > 0, dot(left, right) / length).otherwise(F.lit(0.0))


def l2_normalize(vec: Column) -> Column:
    # The outer list of one holds the length, which would otherwise be computed anew for each component.
    divided = lambda length: F.transform(vec, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(F.lit(0.0)))
    return F.transform(F.array(norm(vec)), divided)[0]


def scale(vec: Column, factor: Column) -> Column:
    return F.transform(vec, lambda x: x.cast("double") * factor)


def vector_size(df: DataFrame, vec: str) -> int:
    """Length of the vectors, read from one row; 0 for an empty frame."""
    row = df.where(F.col(vec).isNotNull()).select(F.size(vec)).first()
    return row[0] if row else 0


def sum_vectors(
    df: DataFrame,
    keys: list[str],
    vec: str,
    size: int,
    weight: str | None = None,
    average: bool = False,
    extra: list[Column] | None = None,
) -> DataFrame:
    """(Weighted) component sum or mean per key.

    One ``sum`` per component keeps the work in Tungsten's hash aggregate with
    map-side partial sums, so a key holding a large share of the rows sends one
    partial vector per task instead of its rows.
    """
    factor = f"CAST(`{weight}` AS DOUBLE)" if weight else "1D"
    times = f" * {factor}" if weight else ""
    # Text expressions: one parse per component instead of several column objects.
    parts = [F.expr(f"sum(CAST(`{vec}`[{i}] AS DOUBLE){times})").alias(f"_s{i}") for i in range(size)]
    total = [F.expr(f"sum({factor})").alias("_total")] if average else []
    summed = df.groupBy(*keys).agg(*total, *parts, *(extra or []))
    divide = " / nullif(_total, 0D)" if average else ""
    vector = F.expr(f"array({', '.join(f'_s{i}{divide}' for i in range(size))})").alias(vec)
    inner = {"_total", *(f"_s{i}" for i in range(size))}
    return summed.select(*[c for c in summed.columns if c not in inner], vector)


def mean_vector(df: DataFrame, key: str, vec: str, weight: str | None = None, size: int | None = None) -> DataFrame:
    """Mean (or weighted mean) vector per key."""
    width = size or vector_size(df, vec)
    return sum_vectors(df, [key], vec, width, weight=weight, average=True)
