"""Integrity checks; each returns one row per check or problem."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom import schemas


def orphan_rows(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent; a null key has none either."""
    keys = parent.select(F.col(parent_key or child_key).alias("_parent"))
    return child.join(keys, child[child_key] == F.col("_parent"), "left_anti")


def orphan_examples(orphans: DataFrame, key: str, n: int = 10) -> DataFrame:
    return orphans.select(key).distinct().orderBy(key).limit(n)


#: Columns of earlier layouts that must be gone.
OUTDATED = (("movies", "id"),)


def filled_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, n_values): one pass per table counts the values of every column."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
        pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_values")) for c in df.columns]
        parts.append(counts.select(F.lit(name).alias("table"), F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)


def check_columns(tables: dict[str, DataFrame], expected: dict[str, list[str]] | None = None) -> DataFrame:
    """(table, column, n_values, problem) of every expected or outdated column that is not as it should be.

    A set comparison of two lists of columns: what is expected but absent is ``missing``, what holds no value is
    ``empty``, and what an earlier layout left behind is ``outdated``.
    """
    spark = next(iter(tables.values())).sparkSession
    layout = schemas.EXPECTED_COLUMNS if expected is None else expected
    wanted = [(t, c, False) for t, columns in layout.items() for c in columns] + [(t, c, True) for t, c in OUTDATED]
    wanted = spark.createDataFrame(wanted, "table string, column string, outdated boolean")
    problem = (
        F.when(F.col("outdated"), F.when(F.col("n_values").isNotNull(), "outdated"))
        .when(F.col("n_values").isNull(), "missing")
        .when(F.col("n_values") == 0, "empty")
    )
    found = wanted.join(filled_columns(tables), ["table", "column"], "left").withColumn("problem", problem)
    return found.where(F.col("problem").isNotNull()).drop("outdated")


def check_foreign_key(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """(relation, n_invalid, examples): orphan rows counted, ten distinct keys shown.

    Orphans are counted per key first; the examples then come from the ten
    smallest keys of that aggregate, never from a collected group.
    """
    orphans = orphan_rows(child, parent, child_key, parent_key)
    per_key = orphans.groupBy(F.col(child_key).cast("string").alias("key"), F.col(child_key).alias("_k")).agg(
        F.count("*").alias("n")
    )
    examples = per_key.where("_k IS NOT NULL").orderBy("_k").limit(10)
    shown = examples.agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_k", "key"))), lambda e: e["key"]), ", ")
    ).scalar()
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_invalid")).select(
        F.lit(name).alias("relation"), "n_invalid", F.coalesce(shown, F.lit("")).alias("examples")
    )


def check_foreign_keys(
    tables: dict[str, DataFrame], relations: list[tuple[str, str, str, str]] | None = None
) -> DataFrame:
    """One row per relation; a relation with an absent table is noted as skipped."""
    rows = []
    spark = next(iter(tables.values())).sparkSession
    for child, child_key, parent, parent_key in relations or schemas.RELATIONS:
        name = f"{child}.{child_key} -> {parent}.{parent_key}"
        absent = sorted({child, parent} - set(tables))
        if absent:
            note = f"skipped, missing tables {', '.join(absent)}"
            row = spark.createDataFrame([(name, None, note)], "relation string, n_invalid bigint, examples string")
        else:
            row = check_foreign_key(tables[child], child_key, tables[parent], parent_key, name)
        rows.append(row)
    return reduce(DataFrame.unionByName, rows)


def check_keyword_links(
    movies: DataFrame, keywords: DataFrame, movie_keywords: DataFrame, n_examples: int = 20, fail: bool = True
) -> DataFrame:
    """Distinct key counts and missing keys of the keyword link table."""
    rows = []
    for name, parent, key in (("keyword_id", keywords, "keyword_id"), ("movie_id", movies, "movie_id")):
        parents = parent.select(key).where(F.col(key).isNotNull()).distinct()
        used = movie_keywords.select(key).where(F.col(key).isNotNull()).distinct()
        missing = used.join(parents, key, "left_anti")
        shown = missing.orderBy(key).limit(n_examples)
        rows.append(
            used.agg(F.count("*").alias("n_used")).select(
                F.lit(name).alias("key"),
                "n_used",
                parents.agg(F.count("*")).scalar().alias("n_parents"),
                missing.agg(F.count("*")).scalar().alias("n_missing"),
                F.coalesce(
                    shown.agg(F.array_join(F.sort_array(F.collect_list(F.col(key))).cast("array<string>"), ", ")).scalar(),
                    F.lit(""),
                ).alias("examples"),
            )
        )
    result = rows[0].unionByName(rows[1])
    if fail:
        bad = [r for r in result.collect() if r["n_missing"]]
        if bad:
            raise ValueError("; ".join(f"{r['n_missing']} {r['key']} values without parent: {r['examples']}" for r in bad))
    return result


def _violations(df: DataFrame, table: str, check: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_violations")).select(
        F.lit(table).alias("table"), F.lit(check).alias("check"), "n_violations"
    )


def check_constraints(
    tables: dict[str, DataFrame],
    primary_keys: dict[str, list[str]] | None = None,
    not_null: dict[str, list[str]] | None = None,
    rating_tables: tuple[str, ...] = ("ratings",),
) -> DataFrame:
    """Repeated primary keys, nulls and out-of-range ratings: (table, check, n_violations)."""
    rows = []
    keys = schemas.PRIMARY_KEYS if primary_keys is None else primary_keys
    required = schemas.NOT_NULL if not_null is None else not_null
    for name, df in tables.items():
        if name in keys:
            repeated = df.groupBy(*keys[name]).agg(F.count("*").alias("_n")).where("_n > 1")
            rows.append(_violations(repeated, name, f"unique {', '.join(keys[name])}"))
        columns = [*keys.get(name, []), *required.get(name, [])]
        if columns:
            # One scan counts the nulls of every required column.
            counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
            rows.append(
                counted.select(
                    F.inline(
                        F.array(
                            *[
                                F.struct(
                                    F.lit(name).alias("table"),
                                    F.lit(f"not null {c}").alias("check"),
                                    F.col(c).alias("n_violations"),
                                )
                                for c in columns
                            ]
                        )
                    )
                )
            )
        if name in rating_tables and "rating" in df.columns:
            outside = df.where(~F.col("rating").between(schemas.RATING_MIN, schemas.RATING_MAX))
            rows.append(_violations(outside, name, "rating between 0.5 and 5.0"))
    return reduce(DataFrame.unionByName, rows)


def check_half_star(ratings: DataFrame) -> DataFrame:
    """Ratings off the 0.5 grid."""
    doubled = F.col("rating").cast("double") * 2
    return ratings.agg(
        F.count("*").alias("n_ratings"),
        F.count_if(doubled != F.floor(doubled)).alias("n_off_grid"),
        F.count_if(~F.col("rating").between(schemas.RATING_MIN, schemas.RATING_MAX)).alias("n_out_of_range"),
    )


def check_leakage(
    movies: DataFrame, ratings: DataFrame, links: DataFrame, train: DataFrame, test: DataFrame
) -> DataFrame:
    """The checklist before training: (check, n_violations)."""
    pair = ["user_id", "movie_id"]
    repeated_films = movies.groupBy("movie_id").agg(F.count("*").alias("_n")).where("_n > 1")
    repeated_ratings = ratings.groupBy(*pair).agg(F.count("*").alias("_n")).where("_n > 1")
    checks = [
        ("ratings outside the catalog id system", orphan_rows(ratings, movies, "movie_id")),
        ("unresolved links", links.where(F.col("tmdb_id").isNull())),
        ("duplicate movies", repeated_films),
        ("duplicate ratings", repeated_ratings),
        ("pairs in both train and test", train.select(*pair).join(test.select(*pair), pair, "left_semi")),
    ]
    rows = [
        df.agg(F.count("*").alias("n_violations")).select(F.lit(name).alias("check"), "n_violations")
        for name, df in checks
    ]
    return reduce(DataFrame.unionByName, rows)
