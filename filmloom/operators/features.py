"""TF-IDF and dense item features, all in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.functions.text import english_stop_words, tokens
from filmloom.functions.vectors import l2_normalize
from filmloom.operators.relational import single_row
from filmloom.operators.scoring import bucket_pairs


def term_counts(docs: DataFrame, key: str, text: Column, stop_words: list[str] | None = None) -> DataFrame:
    """(key, term, tf) over whole texts."""
    # The explicit null filter keeps both uses of the counts the same plan, so they share one shuffle.
    words = docs.select(key, F.explode(tokens(text)).alias("term")).where(F.col("term").isNotNull())
    stops = english_stop_words() if stop_words is None else stop_words
    if stops:
        words = words.where(~F.col("term").isin(stops))
    return words.groupBy(key, "term").agg(F.count("*").alias("tf"))


def document_frequency(counts: DataFrame, max_features: int | None = None) -> DataFrame:
    """(term, df, total); the ``max_features`` terms with the highest corpus counts."""
    vocabulary = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    if max_features is None:
        return vocabulary
    return vocabulary.orderBy(F.desc("total"), "term").limit(max_features)


def tfidf(
    docs: DataFrame,
    key: str,
    text: Column,
    max_features: int = 3000,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """L2-normalised rows (key, term, weight), idf = ln((1+n)/(1+df)) + 1.

    The vocabulary has at most ``max_features`` rows, which bounds both its
    broadcast and the terms of one document in the norm window.
    """
    counts = term_counts(docs, key, text, stop_words)
    vocabulary = document_frequency(counts, max_features).select("term", "df")
    n_docs = docs.agg(F.count("*")).scalar()
    idf = F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0
    weighted = counts.join(F.broadcast(vocabulary.withColumn("idf", idf)), "term").withColumn(
        "raw", F.col("tf") * F.col("idf")
    )
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return weighted.select(key, "term", (F.col("raw") / length).alias("weight"))


def row_l1_normalize(features: DataFrame, key: str, weight: str = "weight") -> DataFrame:
    """Weights of a key divided by their sum (a zero sum counts as 1).

    Sums are partial aggregates joined back, so a key with very many rows is
    never gathered in one task.
    """
    totals = features.groupBy(key).agg(F.sum(weight).alias("_total"))
    share = F.col(weight) / F.coalesce(F.nullif(F.col("_total"), F.lit(0.0)), F.lit(1.0))
    return features.join(totals, key).withColumn(weight, share).select(*features.columns)


def identity_plus_features(items: DataFrame, features: DataFrame, key: str = "movie_id") -> DataFrame:
    """Each item's own column next to its shared feature weights, rows summing to 1."""
    own = items.select(key, F.concat(F.lit("id:"), F.col(key).cast("string")).alias("term"), F.lit(1.0).alias("weight"))
    shared = features.join(items.select(key), key, "left_semi").select(key, "term", "weight")
    return row_l1_normalize(own.unionByName(shared), key)


def minmax_scale(df: DataFrame, column: str, out: str, default: float | None = None) -> DataFrame:
    """(x - min) / (max - min) over the whole column; a constant column becomes 0."""
    filled = F.col(column).cast("double")
    if default is not None:
        filled = F.coalesce(filled, F.lit(float(default)))
    bounds = single_row(df.agg(F.min(filled).alias("low"), F.max(filled).alias("high")))
    span = F.nullif(bounds["high"] - bounds["low"], F.lit(0.0))
    return df.withColumn(out, F.coalesce((filled - bounds["low"]) / span, F.lit(0.0)))


def dense_item_features(
    items: DataFrame, embeddings: DataFrame, key: str = "movie_id", year: str = "release_year", default_year: int = 1900
) -> DataFrame:
    """Text embedding followed by the scaled release year: (key, vec)."""
    joined = items.select(key, year).join(embeddings.select(key, "embedding"), key)
    scaled = minmax_scale(joined, year, "_year", default_year)
    vec = F.concat(F.transform("embedding", lambda x: x.cast("double")), F.array("_year"))
    return scaled.select(key, vec.alias("vec"))


def text_embeddings(items: DataFrame, key: str, text: Column, size: int = 64, seed: int = 42) -> DataFrame:
    """Averaged word vectors learned from the catalog's own texts."""
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array

    words = items.select(key, tokens(text).alias("words"))
    model = Word2Vec(vectorSize=size, minCount=1, seed=seed, inputCol="words", outputCol="v").fit(words)
    return model.transform(words).select(key, vector_to_array("v", "float32").alias("embedding"))


def unit_vectors(df: DataFrame, vec: str = "vec") -> DataFrame:
    return df.withColumn(vec, l2_normalize(F.col(vec)))


def sparse_rows(long: DataFrame, key: str, terms: DataFrame, term: str = "term", weight: str = "weight") -> DataFrame:
    """(key, idx, val) arrays; a row holds at most the size of the vocabulary."""
    cells = long.join(terms, term).select(key, F.struct("idx", F.col(weight).alias("val")).alias("_cell"))
    packed = cells.groupBy(key).agg(F.sort_array(F.collect_list("_cell")).alias("_cells"))
    return packed.select(
        key,
        F.transform("_cells", lambda c: c["idx"]).alias("idx"),
        F.transform("_cells", lambda c: c["val"]).alias("val"),
    )


def approx_knn(
    queries: DataFrame,
    items: DataFrame,
    radius: float,
    query: str = "query_id",
    item: str = "movie_id",
    bucket_length: float = 0.5,
    tables: int = 4,
    seed: int = 42,
) -> DataFrame:
    """Neighbours within ``radius`` of unit vectors by random-projection hashing: (query, item, distance).

    Pairs that share a bucket of one table at least are compared inside the bucket, and only near ones leave it.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    def featured(df: DataFrame, key: str) -> DataFrame:
        return df.where(F.col("vec").isNotNull()).select(key, "vec", array_to_vector("vec").alias("features"))

    model = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="buckets", bucketLength=bucket_length, numHashTables=tables, seed=seed
    ).fit(featured(items, item))
    places = F.array(*[vector_to_array(F.col("buckets")[t])[0] for t in range(tables)])
    left, right = (model.transform(featured(*side)).withColumn("hashes", places) for side in ((queries, query), (items, item)))
    return bucket_pairs(left, right, radius, query, item)
