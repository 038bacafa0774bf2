"""Recommenders. All users are served in one job: (user_id, movie_id, rank, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.functions.text import genre_list
from filmloom.functions.vectors import l2_normalize, mean_vector, sum_vectors, vector_size
from filmloom.models.linear import bounded_broadcast, fold_in
from filmloom.models.ranking_loss import RankingFactors
from filmloom.operators.features import sparse_rows
from filmloom.operators.interactions import rescale_1_5
from filmloom.operators.relational import (
    blend_outer,
    global_positions,
    index_ids,
    rank_score,
    shuffle_key,
    top_k_per_group,
    top_n,
)
from filmloom.operators.scoring import score_all_pairs
from filmloom.session import cut_lineage


def popular_movies(items: DataFrame, k: int = 10, min_votes: int = 0) -> DataFrame:
    """Most popular films, else best voted, else the first ones: (movie_id, rank)."""
    if min_votes and "vote_count" in items.columns:
        items = items.where(F.col("vote_count") >= min_votes)
    by = next((c for c in ("popularity", "vote_average") if c in items.columns), None)
    chosen = items.orderBy("movie_id").limit(k) if by is None else top_n(items.where(F.col(by).isNotNull()), by, k, "movie_id")
    order = [F.asc("movie_id")] if by is None else [F.desc(by), F.asc("movie_id")]
    # At most k rows reach this window.
    return chosen.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def _head_ids(items: DataFrame, n: int, order: list[Column]) -> Column:
    """The first n film ids as one scalar array: a list of fixed length."""
    head = items.orderBy(*order).limit(n).withColumn("_at", F.row_number().over(Window.orderBy(*order)))
    ids = F.transform(F.sort_array(F.collect_list(F.struct("_at", "movie_id"))), lambda x: x["movie_id"])
    return F.coalesce(head.agg(ids).scalar(), F.array().cast("array<bigint>"))


def same_for_all(users: DataFrame, ids: Column, k: int, skip: str | None = None) -> DataFrame:
    """The same short list for each user, optionally without one film of their own."""
    listed = users.withColumn("_ids", ids.cast("array<bigint>"))
    if skip:
        listed = listed.withColumn("_ids", F.filter("_ids", lambda x: x != F.col(skip)))
    cut = listed.withColumn("_ids", F.slice("_ids", 1, k))
    return cut.select(*users.columns, F.posexplode("_ids").alias("_at", "movie_id")).withColumn(
        "rank", (F.col("_at") + 1).cast("int")
    ).drop("_at")


def recommend_popular(train: DataFrame, k: int = 10, users: DataFrame | None = None) -> DataFrame:
    """Most-liked train films a user has not seen: the yardstick for every model. ``users`` asks for some users only.

    A user who has seen s films finds k unseen ones among the first k + s of the
    popular order, so only those positions are looked up, not the catalog.
    """
    likes = train.groupBy("movie_id").agg(F.count("*").cast("double").alias("score"))
    order = global_positions(likes, [F.desc("score"), F.asc("movie_id")])
    n_items = order.count()
    if users is not None:
        train = train.join(users.select("user_id").distinct(), "user_id", "left_semi")
    wanted = train.groupBy("user_id").agg(F.least(F.count("*") + k, F.lit(n_items)).alias("_upto"))
    offered = wanted.select("user_id", F.explode(F.sequence(F.lit(1), F.col("_upto"))).alias("position"))
    films = offered.join(bounded_broadcast(order, n_items, 3), "position")
    unseen = films.join(train.select("user_id", "movie_id"), ["user_id", "movie_id"], "left_anti")
    return top_k_per_group(unseen, "user_id", [F.asc("position")], k).select("user_id", "movie_id", "score", "rank")


def _term_index(weights: DataFrame) -> DataFrame:
    """(term, idx): matrix columns of the terms."""
    return index_ids(weights, "term").withColumn("idx", F.col("idx").cast("int"))


def _with_empty(rows: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Items without any term still compete, with score 0."""
    empty_idx, empty_val = F.array().cast("array<int>"), F.array().cast("array<double>")
    return items.select(key).distinct().join(rows, key, "left").select(
        key, F.coalesce("idx", empty_idx).alias("idx"), F.coalesce("val", empty_val).alias("val")
    )


def tfidf_profiles(train: DataFrame, item_terms: DataFrame) -> DataFrame:
    """Unit-length mean TF-IDF row of each user's train films: (user_id, term, weight)."""
    summed = (
        train.join(item_terms, "movie_id").groupBy("user_id", "term").agg(F.sum("weight").alias("weight"))
    )
    # One row per vocabulary term at most inside this window.
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("user_id")))
    return summed.select("user_id", "term", (F.col("weight") / length).alias("weight"))


def recommend_tfidf(train: DataFrame, item_terms: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """Cosine of the user's mean TF-IDF row to every film, seen films left out.

    The term weights are stored first: columns, profiles, item rows and the size
    check all read them.
    """
    item_terms = cut_lineage(item_terms)
    terms = _term_index(item_terms)
    profiles = sparse_rows(tfidf_profiles(train, item_terms), "user_id", terms)
    vectors = _with_empty(sparse_rows(item_terms, "movie_id", terms), items, "movie_id")
    return score_all_pairs(profiles, vectors, k, seen=train.select("user_id", "movie_id"))


def title_index(movies: DataFrame, title: str = "title") -> DataFrame:
    """Lower-cased title -> film; the last one wins when titles coincide."""
    return movies.groupBy(F.lower(F.trim(F.col(title))).alias("title_key")).agg(F.max("movie_id").alias("movie_id"))


def _grams(text: Column, n: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda at: F.substring(text, at, F.lit(n))))


def match_titles(wanted: DataFrame, movies: DataFrame, query: str = "query") -> DataFrame:
    """Each query's film: the exact title ignoring case, else the first title that
    contains the part before ``(``, else none: (query, movie_id, title, match).

    Containment is looked up through three-character pieces: a title holding the
    text holds its rarest piece, and only such titles are compared. Films of one title count once. The pieces of all titles
    are many times the catalog, which no size estimate knows, so that side is never broadcast.
    """
    asked = wanted.select(query).distinct().withColumn("_key", F.lower(F.trim(F.col(query))))
    catalog = movies.select("movie_id", "title", F.lower("title").alias("_low"))
    exact = catalog.groupBy(F.trim("_low").alias("_key")).agg(
        F.min(F.struct("movie_id", "title")).alias("_hit")
    )
    first = asked.join(exact, "_key", "left")
    part = F.trim(F.substring_index("_key", "(", 1))
    open_queries = first.where("_hit IS NULL").select(query, part.alias("_part"))

    # The smallest film is the answer to an empty text, which every title contains.
    lowest = catalog.agg(F.min(F.struct("movie_id", "title"))).scalar()
    size = F.least(F.lit(3), F.length("_part"))
    pieces = open_queries.where("_part <> ''").select(
        query,
        "_part",
        F.explode(
            F.when(size == 3, _grams(F.col("_part"), 3))
            .when(size == 2, _grams(F.col("_part"), 2))
            .otherwise(_grams(F.col("_part"), 1))
        ).alias("_gram"),
    )
    titles = catalog.groupBy("_low").agg(F.min(F.struct("movie_id", "title")).alias("_film"))
    catalog_grams = titles.select(
        "_film",
        "_low",
        F.explode(F.array_distinct(F.concat(*[_grams(F.col("_low"), n) for n in (1, 2, 3)]))).alias("_gram"),
    )
    frequency = catalog_grams.groupBy("_gram").agg(F.count("*").alias("_df"))
    rarest = pieces.join(frequency, "_gram", "left").groupBy(query, "_part").agg(
        F.min_by("_gram", F.struct(F.coalesce("_df", F.lit(0)), "_gram")).alias("_gram")
    )
    contained = (
        rarest.join(catalog_grams.hint("shuffle_merge"), "_gram")
        .where(F.contains("_low", "_part"))
        .groupBy(query)
        .agg(F.min("_film").alias("_sub"))
    )
    merged = first.join(contained, query, "left").join(
        open_queries.where("_part = ''").select(query, lowest.alias("_any")), query, "left"
    )
    hit = F.coalesce("_hit", "_sub", "_any")
    kind = (
        F.when(F.col("_hit").isNotNull(), F.lit("exact")).when(hit.isNotNull(), F.lit("partial")).otherwise(F.lit("none"))
    )
    return merged.select(query, hit["movie_id"].alias("movie_id"), hit["title"].alias("title"), kind.alias("match"))


def search_title(movies: DataFrame, text: str, limit: int = 25, regex: bool = False) -> DataFrame:
    """Titles containing the text whatever its case; an empty text lists the first films."""
    found = movies
    if text:
        low = F.lower("title")
        found = movies.where(F.col("title").rlike(f"(?i){text}") if regex else F.contains(low, F.lit(text.lower())))
    return found.orderBy("movie_id").limit(limit)


def exact_knn(
    queries: DataFrame, items: DataFrame, k: int, query: str = "query_id", exclude: DataFrame | None = None
) -> DataFrame:
    """Cosine neighbours: inner products of unit vectors, exclusions removed exactly."""
    unit = lambda df: df.withColumn("vec", l2_normalize(F.col("vec")))
    return score_all_pairs(unit(queries), unit(items), k, query=query, seen=exclude)


def recommend_from_liked(
    liked: DataFrame, features: DataFrame, movies: DataFrame, n: int = 5
) -> DataFrame:
    """From liked titles (user_id, title): cosine to the mean vector of the films found.

    Users none of whose titles is known get no rows.
    """
    known = title_index(movies.join(features.select("movie_id"), "movie_id", "left_semi"))
    films = (
        liked.select("user_id", F.lower(F.trim("title")).alias("title_key"))
        .join(known, "title_key")
        .select("user_id", "movie_id")
        .distinct()
    )
    profile = mean_vector(films.join(features, "movie_id"), "user_id", "vec", size=vector_size(features, "vec"))
    return exact_knn(profile, features, n, query="user_id", exclude=films)


def recommend_cold_start(
    favorites: DataFrame,
    item_vectors: DataFrame,
    items: DataFrame,
    k: int = 10,
    metric: str = "cosine",
    users: DataFrame | None = None,
) -> DataFrame:
    """Mean vector of favourite films against the catalog; without known favourites, popular films.

    With ``users``, only these get lists, and only these are scored.
    """
    if users is not None:
        favorites = favorites.join(users.select("user_id").distinct(), "user_id", "left_semi")
    known = favorites.select("user_id", "movie_id").distinct().join(item_vectors.select("movie_id"), "movie_id", "left_semi")
    profile = mean_vector(
        known.join(item_vectors, "movie_id"), "user_id", "vec", size=vector_size(item_vectors, "vec")
    )
    if metric == "cosine":
        best = exact_knn(profile, item_vectors, k, query="user_id", exclude=known.select("user_id", "movie_id"))
    elif metric == "dot":
        best = score_all_pairs(profile, item_vectors, k, seen=known.select("user_id", "movie_id"))
    else:
        raise ValueError(f"unknown metric {metric!r}")
    content = best.withColumn("strategy", F.lit("content-based"))
    everyone = favorites.select("user_id") if users is None else users.select("user_id")
    without = everyone.distinct().join(known.select("user_id"), "user_id", "left_anti")
    by = "popularity" if "popularity" in items.columns else "vote_average" if "vote_average" in items.columns else None
    order = [F.desc(by), F.asc("movie_id")] if by else [F.asc("movie_id")]
    popular = same_for_all(without, _head_ids(items, k, order), k)
    return content.unionByName(
        popular.select(
            "user_id", "movie_id", F.lit(None).cast("double").alias("score"), "rank", F.lit("popular").alias("strategy")
        )
    )


def genre_terms(items: DataFrame, genres: str = "genre_names") -> DataFrame:
    """(movie_id, term) per genre of a film; also the film-genre link table."""
    return items.select("movie_id", F.explode(F.array_distinct(genre_list(F.col(genres)))).alias("term"))


def recommend_genre_overlap(items: DataFrame, seeds: DataFrame, k: int = 12) -> DataFrame:
    """Films sharing most genres with each seed: (seed_id, movie_id, score, rank).

    Unknown seeds get the first films; seeds without genres the first other ones. Lists are made for each distinct set of
    genres, of which a catalog has far fewer than films.
    """
    tagged = genre_terms(items).withColumn("weight", F.lit(1.0))
    terms = _term_index(tagged)
    rows = sparse_rows(tagged.distinct(), "movie_id", terms).withColumn("_set", F.concat_ws(",", "idx"))
    asked = seeds.select(F.col("seed_id").cast("bigint")).distinct()
    # Scores depend on the sets alone. Only the first k + 1 films of a set can be among the first k + 1 of any list, and
    # lists of k + 1 leave k without the seed.
    rows = cut_lineage(rows.join(index_ids(rows, "_set", "set_id"), "_set").drop("_set"))
    heads = top_k_per_group(rows, "set_id", [F.asc("movie_id")], k + 1)
    sets = heads.where("rank = 1").select("set_id", "idx", "val")
    best = score_all_pairs(sets, heads.select("movie_id", "idx", "val"), k + 1, query="set_id").where("score > 0")
    listed = best.groupBy("set_id").agg(F.sort_array(F.collect_list(F.struct("rank", "movie_id", "score"))).alias("_films"))
    others = F.filter("_films", lambda film: ~film["movie_id"].eqNullSafe(F.col("seed_id")))
    own = asked.join(rows.select(F.col("movie_id").alias("seed_id"), "set_id"), "seed_id").join(listed, "set_id")
    own = own.select("seed_id", F.posexplode(F.slice(others, 1, k)).alias("_at", "_film"))
    best = own.select("seed_id", "_film.movie_id", "_film.score", (F.col("_at") + 1).cast("int").alias("rank"))
    bare = asked.join(rows.select(F.col("movie_id").alias("seed_id")), "seed_id", "left_anti")
    head = _head_ids(items, k + 1, [F.asc("movie_id")])
    # An unknown seed is in no list, so leaving it out changes nothing.
    listed = same_for_all(bare, head, k, skip="seed_id")
    return best.unionByName(listed.select("seed_id", "movie_id", F.lit(None).cast("double").alias("score"), "rank"))


def recommend_factors(
    users: DataFrame, items: DataFrame, k: int = 12, seen: DataFrame | None = None
) -> DataFrame:
    """Top films by factor product; ``seen`` pairs are removed when given."""
    return score_all_pairs(users, items, k, seen=seen)


def recommend_fold_in(
    ratings: DataFrame, item_vectors: DataFrame, items: DataFrame, k: int = 12, users: DataFrame | None = None
) -> DataFrame:
    """For users outside training: their rated films' weighted mean vector, rated films removed.

    Users with no known film get the same repeatable random films.
    """
    vectors = fold_in(ratings, item_vectors)
    best = score_all_pairs(vectors, item_vectors, k, seen=ratings.select("user_id", "movie_id").distinct())
    everyone = (ratings if users is None else users).select("user_id").distinct()
    without = everyone.join(vectors.select("user_id"), "user_id", "left_anti")
    random_ids = _head_ids(items, k, [shuffle_key("movie_id", seed=42), F.asc("movie_id")])
    listed = same_for_all(without, random_ids, k)
    return best.unionByName(listed.select("user_id", "movie_id", F.lit(None).cast("double").alias("score"), "rank"))


def recommend_hybrid(
    content: DataFrame, collab: DataFrame, alpha: float = 0.5, k: int = 12, group: str = "user_id"
) -> DataFrame:
    """Blend two ranked lists of up to 3k films: alpha * collaborative + (1 - alpha) * content."""
    keys = [group, "movie_id"]
    left = rank_score(content.where(F.col("rank") <= 3 * k), group, "rank", "content_score")
    right = rank_score(collab.where(F.col("rank") <= 3 * k), group, "rank", "collab_score")
    merged = blend_outer(left, right, keys, "content_score", "collab_score")
    score = F.round(alpha * F.col("collab_score") + (1 - alpha) * F.col("content_score"), 6)
    ranked = top_k_per_group(merged.withColumn("score", score), group, [F.desc("score"), F.asc("movie_id")], k)
    return ranked.select(*keys, "score", "rank")


def recommend_bpr_content(
    liked: DataFrame, model: RankingFactors, item_features: DataFrame, k: int = 5
) -> DataFrame:
    """Mean feature profile of liked films, mapped through the feature vectors; scores on 1..5."""
    mapped = item_features.join(model.features.withColumnRenamed("feature", "term"), "term")
    width = vector_size(model.features, "vec")
    pairs = liked.select("user_id", "movie_id").distinct()
    sizes = pairs.join(item_features.select("movie_id").distinct(), "movie_id", "left_semi").groupBy("user_id").agg(
        F.count("*").alias("_n")
    )
    summed = sum_vectors(pairs.join(mapped, "movie_id"), ["user_id"], "vec", width, weight="weight")
    own = F.transform("vec", lambda x: x / F.col("_n"))
    profile = summed.join(sizes, "user_id").select(
        "user_id", F.concat(F.slice(own, 1, width - 1), F.array(F.lit(1.0))).alias("vec")
    )
    best = score_all_pairs(profile, model.items, k, seen=pairs)
    return rescale_1_5(best)
