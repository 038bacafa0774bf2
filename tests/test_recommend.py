import pytest
from pyspark.sql import functions as F

from filmloom.plans import lifecycle, recommend


@pytest.fixture(scope="module")
def movies(spark):
    rows = [
        (1, "Toy Story", "Animation|Comedy", 1995, 5.0),
        (2, "toy story", "Drama", 2001, 9.0),
        (3, "(500) Days of Summer", "Drama|Comedy", 2009, 7.0),
        (4, "Heat", "", None, 1.0),
        (5, "Jumanji", "Comedy|Animation", 1995, 2.0),
    ]
    return spark.createDataFrame(rows, "movie_id bigint, title string, genre_names string, release_year int, popularity double").cache()


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.6, 0.8]), (5, [4.0, 0.3])]
    return spark.createDataFrame(rows, "movie_id bigint, vec array<double>").cache()


def lists(df, key="user_id"):
    got = {}
    for r in df.orderBy(key, "rank").collect():
        got.setdefault(r[key], []).append(r.movie_id)
    return got


def test_title_search_and_matching(spark, movies):
    assert [r.movie_id for r in recommend.search_title(movies, "(500)").collect()] == [3]
    assert recommend.search_title(movies, ".*").count() == 0
    assert recommend.search_title(movies, "^toy", regex=True).count() == 2
    assert recommend.search_title(movies, "", 2).count() == 2
    asked = spark.createDataFrame([("TOY STORY",), ("Days (2009)",), ("(500) x",), ("zz",), ("e",), ("Ju (a)",)], "query string")
    found = {r["query"]: (r.movie_id, r.match) for r in recommend.match_titles(asked, movies).collect()}
    assert found == {
        "TOY STORY": (1, "exact"), "Days (2009)": (3, "partial"), "(500) x": (1, "partial"),
        "zz": (None, "none"), "e": (3, "partial"), "Ju (a)": (5, "partial"),
    }
    index = {r.title_key: r.movie_id for r in recommend.title_index(movies).collect()}
    assert index["toy story"] == 2


def test_title_pieces_are_never_broadcast(spark):
    movies = spark.range(5).selectExpr("id AS movie_id", "concat('Film ', id) AS title")  # of known, small size
    asked = spark.range(2).selectExpr("concat('ilm ', id, ' (2009)') AS query")
    plan = recommend.match_titles(asked, movies)._jdf.queryExecution().executedPlan().toString().split("\n")
    joins = [line for line in plan if "Join [_gram" in line and "Inner" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_genre_overlap(spark, movies):
    seeds = spark.createDataFrame([(1,), (4,), (99,)], "seed_id bigint")
    assert lists(recommend.recommend_genre_overlap(movies, seeds, 3), "seed_id") == {1: [5, 3], 4: [1, 2, 3], 99: [1, 2, 3]}


def test_genre_lists_are_made_per_set(spark, monkeypatch):
    """Sixty films of three sets: three queries, at most k + 1 films of each, and the lists of every pair."""
    tags = {i: ("A|B", "B|A|B", "C")[i % 3] for i in range(57)} | {57: "A", 58: "", 59: "A|C"}
    films = spark.createDataFrame(sorted(tags.items()), "movie_id bigint, genre_names string")
    seeds = films.select(F.col("movie_id").alias("seed_id"))
    asked, score = [], recommend.score_all_pairs
    monkeypatch.setattr(recommend, "score_all_pairs", lambda q, i, *a, **b: asked.append((q.count(), i.count())) or score(q, i, *a, **b))
    got = lists(recommend.recommend_genre_overlap(films, seeds, 4), "seed_id")
    assert asked == [(4, 5 + 5 + 1 + 1)]
    sets = {i: set(filter(None, t.split("|"))) for i, t in tags.items()}
    for seed, own in sets.items():
        near = sorted((-len(own & other), i) for i, other in sets.items() if i != seed and (own & other or not own))
        assert got[seed] == [i for _, i in near[:4]]


def test_cold_start(spark, movies, vectors):
    favorites = spark.createDataFrame([(1, 1), (2, 77)], "user_id bigint, movie_id bigint")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id bigint")
    cosine = recommend.recommend_cold_start(favorites, vectors, movies, 2, users=users)
    assert lists(cosine) == {1: [5, 3], 2: [2, 3], 3: [2, 3]}
    assert {r.user_id for r in cosine.where("strategy = 'popular'").collect()} == {2, 3}
    assert lists(recommend.recommend_cold_start(favorites, vectors, movies, 1, metric="dot"))[1] == [5]
    by_vote = movies.drop("popularity").withColumn("vote_average", -F.col("movie_id").cast("double"))
    assert lists(recommend.recommend_cold_start(favorites, vectors, by_vote, 2))[2] == [1, 2]
    with pytest.raises(ValueError):
        recommend.recommend_cold_start(favorites, vectors, movies, 2, metric="l1")


def test_liked_titles(spark, movies, vectors):
    liked = spark.createDataFrame([(1, " TOY STORY "), (1, "unknown"), (2, "nothing")], "user_id bigint, title string")
    got = recommend.recommend_from_liked(liked, vectors, movies, 2)
    assert lists(got) == {1: [3, 5]}


def test_popular(spark, movies):
    assert [r.movie_id for r in recommend.popular_movies(movies, 2).orderBy("rank").collect()] == [2, 3]
    assert [r.movie_id for r in recommend.popular_movies(movies.drop("popularity"), 2).orderBy("rank").collect()] == [1, 2]
    votes = movies.withColumn("vote_count", F.col("movie_id") * 10)
    assert recommend.popular_movies(votes, 5, min_votes=40).count() == 2
    train = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (1, 2), (2, 3)], "user_id bigint, movie_id bigint")
    assert lists(recommend.recommend_popular(train, 2)) == {1: [3], 2: [2], 3: [2, 3]}


def test_fold_in(spark, movies, vectors):
    ratings = spark.createDataFrame([(1, 1, 5.0), (1, 2, 0.5), (2, 4, 3.0)], "user_id bigint, movie_id bigint, rating double")
    got = lists(recommend.recommend_fold_in(ratings, vectors, movies, 2))
    assert got[1] == [5, 3] and len(got[2]) == 2


def test_hybrid(spark):
    rows = "user_id bigint, movie_id bigint, rank int"
    content = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], rows)
    collab = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], rows)
    got = {r.movie_id: r.score for r in recommend.recommend_hybrid(content, collab, 0.5, 3).collect()}
    assert got == {11: 0.75, 10: 0.5, 12: 0.25}


def test_stages_and_routing(spark):
    counts = {1: 0, 2: 1, 3: 5, 4: 6, 5: 20, 6: 21}
    users = spark.createDataFrame([(u,) for u in counts], "user_id bigint")
    ratings = spark.createDataFrame([(u, i) for u, n in counts.items() for i in range(n)], "user_id bigint, movie_id bigint")
    stages = lifecycle.user_stage(ratings, users)
    assert {r.user_id: r.stage for r in stages.collect()} == {
        1: "new", 2: "cold_start", 3: "cold_start", 4: "warm_start", 5: "warm_start", 6: "mature",
    }
    with pytest.raises(ValueError):
        lifecycle.route_strategy(stages, "guess")
    assert {r.method for r in lifecycle.default_method(stages, 20).where("n_ratings >= 20").collect()} == {"collaborative"}

    def lists_of(first, strategy=None):
        rows = users.select("user_id", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("rank"))
        rows = rows.select("user_id", (F.col("rank") + first).cast("bigint").alias("movie_id"), "rank")
        return rows if strategy is None else rows.withColumn("strategy", F.when(F.col("user_id") == 1, "popular").otherwise(strategy))

    content, collab = lists_of(100, "content-based"), lists_of(200)
    rows = lifecycle.recommend_routed(stages, content, collab, k=2).collect()
    by_user = {r.user_id: r for r in rows}
    assert by_user[1].message == lifecycle.FALLBACK_MESSAGE and by_user[2].confidence == 0.7
    assert by_user[4].strategy == "hybrid" and by_user[6].confidence == 0.95 and by_user[6].n_ratings == 21
    assert len(rows) == 12
    alone = lifecycle.recommend_routed(stages, content, None, k=4).collect()
    assert sum(r.user_id == 4 for r in alone) == 2 and {r.strategy for r in alone if r.user_id == 6} == {"content-based"}
    asked = []
    engines = [lambda users, lists=x: asked.append({r.user_id for r in users.collect()}) or lists for x in (content, collab)]
    assert sorted(lifecycle.recommend_routed(stages, *engines, k=2).collect()) == sorted(rows)
    wanted = {r.user_id: r.strategy for r in lifecycle.route_strategy(stages).collect()}
    assert asked == [{u for u, x in wanted.items() if x in names} for names in (("content-based", "hybrid"), ("collaborative", "hybrid"))]
    forced = lifecycle.recommend_routed(stages, content, collab, k=2, force="collaborative").collect()
    assert {r.strategy for r in forced} == {"collaborative"}
