"""Writing cleaned tables, keyed tables and model factors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.schemas import TABLES


def _as_text(df: DataFrame) -> DataFrame:
    """Arrays in the ``['a', 'b']`` text form, the only one CSV can hold."""
    shown = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            # Backslashes and quotes are escaped, as the list reader undoes them.
            safe = lambda x: F.regexp_replace(x.cast("string"), r"([\\'])", r"\\$1")
            quoted = F.transform(column, lambda x: F.concat(F.lit("'"), safe(x), F.lit("'")))
            column = F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")).alias(field.name)
        shown.append(column)
    return df.select(*shown)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    writer = (_as_text(df) if fmt == "csv" else df).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_cleaned(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Each table under its own folder; returns the paths."""
    paths = {name: f"{folder}/{name}" for name in tables}
    for name, df in tables.items():
        write_table(df, paths[name], fmt)
    return paths


def save_tables(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    database: str = "default",
    buckets: dict[str, tuple[int, str]] | None = None,
) -> None:
    """Catalog tables in their fixed layout.

    ``buckets`` maps a table to (count, column): large tables bucketed on the
    join key meet later joins without a shuffle.
    """
    for name, df in tables.items():
        schema = TABLES[name]
        fitted = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns])
        writer = fitted.write.mode("overwrite").format("parquet")
        if buckets and name in buckets:
            count, column = buckets[name]
            writer = writer.bucketBy(count, column).sortBy(column)
        writer.saveAsTable(f"{database}.{name}")


def save_model(factors: dict[str, DataFrame], folder: str) -> None:
    """Factor tables side by side; ``load_model`` reads them back."""
    for name, df in factors.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_model(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}
