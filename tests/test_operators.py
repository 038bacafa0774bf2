import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filmloom.operators import features, interactions, metrics, quality, relational
from filmloom.operators.scoring import score_all_pairs

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def pairs_of(spark, counts):
    rows = [(u, i) for u, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "user_id bigint, movie_id bigint")


def test_split_sizes(spark):
    pairs = pairs_of(spark, {4: 4, 5: 5, 6: 6, 7: 7, 10: 10})
    marked = interactions.label_split(pairs, min_interactions=5).groupBy("user_id").agg(
        F.count_if("is_train").alias("train"), F.count_if(~F.col("is_train")).alias("test")
    )
    assert {r.user_id: (r.train, r.test) for r in marked.collect()} == {5: (4, 1), 6: (4, 2), 7: (5, 2), 10: (8, 2)}


@pytest.mark.parametrize("hot_rows", [1, 3, 50])
def test_hot_users_split_the_same(spark, hot_rows):
    pairs = pairs_of(spark, {1: 400, 2: 9, 3: 1, **{u: 5 for u in range(10, 40)}})
    plain = interactions.label_split(pairs)
    sliced = interactions.label_split(pairs, hot_rows=hot_rows)
    assert plain.exceptAll(sliced).isEmpty() and plain.count() == sliced.count()


@quick
@given(st.dictionaries(st.integers(0, 5), st.integers(1, 12), min_size=1))
def test_split_properties(spark, counts):
    train, test = interactions.split_per_user(pairs_of(spark, counts))
    train, test = ({tuple(r) for r in df.collect()} for df in (train, test))
    assert not train & test and len(train | test) == sum(counts.values())
    assert {u for u, _ in train} == set(counts)


def ranked_of(spark, lists):
    rows = [("m", u, i, at + 1) for u, items in lists.items() for at, i in enumerate(items)]
    return spark.createDataFrame(rows, "model string, user_id bigint, movie_id bigint, rank int")


def plain_metrics(ranked, relevant, k):
    top = ranked[:k]
    hits = [i in relevant for i in top]
    gain = sum(1 / math.log2(at + 2) for at, hit in enumerate(hits) if hit)
    ideal = sum(1 / math.log2(at + 2) for at in range(min(k, len(relevant))))
    return (sum(hits) / len(top) if top else 0.0), sum(hits) / len(relevant), gain / ideal


@quick
@given(
    st.dictionaries(
        st.integers(0, 4),
        st.tuples(st.lists(st.integers(0, 15), unique=True, min_size=1, max_size=12), st.sets(st.integers(0, 15), min_size=1)),
        min_size=1,
    )
)
def test_metrics_match_definition(spark, users):
    ranked = ranked_of(spark, {u: v[0] for u, v in users.items()})
    test = spark.createDataFrame([(u, i) for u, v in users.items() for i in v[1]], "user_id bigint, movie_id bigint")
    for row in metrics.user_metrics(ranked, test, (3, 10)).collect():
        want = plain_metrics(*users[row.user_id], row.k)
        assert np.allclose((row.precision, row.recall, row.ndcg), want)
        assert all(0 <= x <= 1 + 1e-12 for x in want)


def test_metric_edges(spark):
    ranked = ranked_of(spark, {1: [1], 2: [9, 1], 3: list(range(10))})
    test = spark.createDataFrame([(1, 1), (2, 1), (4, 1)], "user_id bigint, movie_id bigint")
    everyone = spark.createDataFrame([("m", 1), ("m", 2), ("m", 4)], "model string, user_id bigint")
    rows = {r.user_id: r for r in metrics.user_metrics(ranked, test, (2,), eval_users=everyone).collect()}
    assert set(rows) == {1, 2, 4}  # user 3 has nothing to find
    assert rows[1].precision == 1.0 and rows[2].ndcg == pytest.approx(1 / math.log2(3))
    assert (rows[4].precision, rows[4].recall, rows[4].ndcg) == (0.0, 0.0, 0.0)
    by_k = {r.user_id: r.precision for r in metrics.user_metrics(ranked, test, (2,), denominator="k").collect()}
    assert by_k[1] == 0.5
    with pytest.raises(ValueError):
        metrics.user_metrics(ranked, test, (0,))


def test_segments_keep_empty_bands(spark):
    train = pairs_of(spark, {1: 4, 2: 9, 3: 10})
    ranked = ranked_of(spark, {1: [50], 2: [51], 3: [52]})
    test = spark.createDataFrame([(1, 50), (2, 1000), (3, 52)], "user_id bigint, movie_id bigint")
    rows = {r.segment: r for r in metrics.segment_metrics(ranked, test, train).collect()}
    assert {k: r.n_users for k, r in rows.items()} == {"below": 1, "cold (5-9)": 1, "light (10-19)": 1, "heavy (20+)": 0}
    assert rows["heavy (20+)"].precision is None and rows["cold (5-9)"].precision == 0.0
    shown = metrics.catalog_coverage(ranked, train).first()
    assert shown.n_shown == 3 and shown.coverage == pytest.approx(0.3)


@pytest.mark.parametrize("hot_levels", [1, 4, 10**6])
def test_auc_by_brute_force(spark, hot_levels):
    rng = np.random.default_rng(3)
    score = {(u, i): float(rng.integers(0, 12)) / 4 for u in range(6) for i in range(30)}
    train = {(u, i) for u, i in score if i % 7 == u % 7}
    test = {(u, i) for u, i in score if (u + i) % 5 == 0} - train
    frame = lambda rows: spark.createDataFrame(sorted(rows), "user_id bigint, movie_id bigint")
    scores = spark.createDataFrame([(u, i, s) for (u, i), s in score.items()], "user_id bigint, movie_id bigint, score double")
    for row in metrics.user_auc(scores, frame(test), frame(train), hot_levels).collect():
        pos = [s for (u, i), s in score.items() if u == row.user_id and (u, i) in test]
        neg = [s for (u, i), s in score.items() if u == row.user_id and (u, i) not in test | train]
        wins = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
        assert row.auc == pytest.approx(wins)


def test_dedup_and_upsert(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (None, 5, "x"), (None, 4, "y"), (2, 1, "c")], "k int, at int, v string")
    first = {(r.k, r.v) for r in relational.dedup_keep_first(df, ["k"], ["at"]).collect()}
    assert first == {(1, "a"), (None, "y"), (2, "c")}
    old = spark.createDataFrame([(1, 1, 3.0, 10), (1, 2, 4.0, 10)], "user_id int, movie_id int, rating double, ts int")
    new = spark.createDataFrame([(1, 1, 5.0, 10), (1, 2, 1.0, 9)], old.schema)
    once = relational.upsert_ratings(old, new)
    assert sorted((r.movie_id, r.rating) for r in once.collect()) == [(1, 5.0), (2, 4.0)]
    assert once.exceptAll(relational.upsert_ratings(once, new)).isEmpty()


def test_positions_and_indexes(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    placed = relational.global_positions(df, [F.desc("k")]).collect()
    assert all(r.position == 1000 - r.k for r in placed)
    indexed = relational.index_ids(df.union(df), "k").collect()
    assert sorted(r.idx for r in indexed) == list(range(1000))


def _brute(queries, items, seen, k):
    best = {}
    for u, q in queries.items():
        scored = sorted((-round(float(np.dot(q, v)), 6) + 0.0, i) for i, v in items.items() if (u, i) not in seen)
        best[u] = [i for _, i in scored[:k]]
    return best


@pytest.mark.parametrize("options", [{}, {"block_rows": 7}, {"block_rows": 16, "broadcast_bytes": 0}])
def test_scoring_by_brute_force(spark, options):
    """Repeated vectors make ties; one user has seen nearly everything."""
    rng = np.random.default_rng(1)
    items = {i: rng.integers(-2, 3, 4).astype(float) for i in range(60)}
    queries = {u: rng.integers(-2, 3, 4).astype(float) for u in range(25)}
    seen = {(0, i) for i in range(57)} | {(u, (u * 7 + j) % 60) for u in range(1, 20) for j in range(5)}
    frame = lambda d, n: spark.createDataFrame([(k, v.tolist()) for k, v in d.items()], f"{n} bigint, vec array<double>")
    got = score_all_pairs(
        frame(queries, "user_id"), frame(items, "movie_id"), 5,
        seen=spark.createDataFrame(sorted(seen), "user_id bigint, movie_id bigint"), **options,
    )
    lists = {u: [] for u in queries}
    for r in got.orderBy("user_id", "rank").collect():
        lists[r.user_id].append(r.movie_id)
    assert lists == _brute(queries, items, seen, 5)


def test_scoring_broadcasts_nothing(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)], "user_id bigint, vec array<double>")
    got = score_all_pairs(rows, rows.withColumnRenamed("user_id", "movie_id"), 3)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_best_cells_by_slices():
    """Ties, masked cells and scores that rounding makes equal, in slices of any width."""
    from filmloom.operators.scoring import _Best

    for seed in range(12):
        rng = np.random.default_rng(seed)
        scores = rng.integers(-2, 3, (20, 300)) + (seed % 3 == 0) * rng.integers(0, 3, (20, 300)) * 4e-7
        scores[rng.random(scores.shape) < 0.3] = -np.inf
        best = _Best(20, 7, 6)
        for start in range(0, 300, 17 + seed * 20):
            best.add(scores[:, start : start + 17 + seed * 20].copy(), start)
        for row, own in enumerate(np.round(scores, 6)):
            wanted = [i for i in np.lexsort((np.arange(300), -own)) if own[i] > -np.inf][:7]
            mine = best.owner == row
            assert best.place[mine][np.lexsort((best.place[mine], -best.score[mine]))].tolist() == wanted


def test_sparse_scoring_equals_dense(spark):
    rng = np.random.default_rng(2)
    dense = {i: np.where(rng.random(30) < 0.2, rng.random(30), 0.0) for i in range(50)}

    def sparse(name):
        rows = [(i, [int(c) for c in np.flatnonzero(v)], [float(x) for x in v[v != 0]]) for i, v in dense.items()]
        return spark.createDataFrame(rows, f"{name} bigint, idx array<int>, val array<double>")

    got = score_all_pairs(sparse("user_id"), sparse("movie_id"), 4)
    lists = {u: [] for u in dense}
    for r in got.orderBy("user_id", "rank").collect():
        lists[r.user_id].append(r.movie_id)
    assert lists == _brute(dense, dense, set(), 4)


def test_knn_recall(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), v.tolist()) for i, v in enumerate(rng.normal(size=(40, 6)).repeat(3, axis=0) + rng.normal(0, 0.05, (120, 6)))]
    items = features.unit_vectors(spark.createDataFrame(rows, "movie_id bigint, vec array<double>"))
    near = features.approx_knn(items.withColumnRenamed("movie_id", "query_id"), items, radius=0.3)
    found = {(r.query_id, r.movie_id) for r in near.collect()}
    wanted = {(a, b) for a in range(120) for b in range(120) if a // 3 == b // 3}
    assert len(found & wanted) / len(wanted) > 0.9


def test_bucket_pairs_are_those_of_a_similarity_join(spark):
    """Same pairs and distances as Spark's own join of the buckets, whatever the blocks; no join or regrouping of pairs."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(8)
    rows = [(int(i), v.tolist()) for i, v in enumerate(rng.normal(size=(90, 5)))]
    rows += rows[:3] + [(200, rows[0][1]), (None, rows[1][1])]  # equal rows, a copy under another id, no id
    items = features.unit_vectors(spark.createDataFrame(rows, "movie_id bigint, vec array<double>"))
    queries = items.where("movie_id % 3 = 0").withColumnRenamed("movie_id", "query_id")
    sides = [df.select(key, array_to_vector("vec").alias("features")) for df, key in ((queries, "query_id"), (items, "movie_id"))]
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="h", bucketLength=0.2, numHashTables=2, seed=42)
    joined = model.fit(sides[1]).approxSimilarityJoin(*sides, 0.7, distCol="distance")
    want = sorted(map(str, joined.select("datasetA.query_id", "datasetB.movie_id", "distance").collect()))
    got = features.approx_knn(queries, items, 0.7, bucket_length=0.2, tables=2)
    assert sorted(map(str, got.collect())) == want and len(want) > 60
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.strip().startswith("MapInArrow")

    from filmloom.operators.scoring import bucket_pairs

    hashed = [df.withColumn("hashes", F.array(F.floor(F.col("vec")[0] * 2).cast("double"))) for df in (queries, items)]
    cut = {tuple(r) for r in bucket_pairs(*hashed, 0.7, block_rows=4).collect()}
    assert cut == {tuple(r) for r in bucket_pairs(*hashed, 0.7).collect()} and len(cut) > 30


def test_approximate_search_asks_for_every_fiftieth_row(spark, tmp_path):
    from filmloom.workload import QUERIES

    rng = np.random.default_rng(12)
    vectors = rng.normal(size=(400, 64)) + 0.6 * rng.normal(size=(8, 64)).repeat(50, axis=0)
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = {(r.query_id, r.movie_id) for r in QUERIES["approx_knn"](spark, str(tmp_path)).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = {(q, i) for q in range(0, 400, 50) for i in range(400) if np.linalg.norm(unit[q] - unit[i]) < 1.2}
    assert found <= near and len(found) >= 0.9 * len(near) > 50


def test_tfidf_formula(spark):
    docs = spark.createDataFrame([(1, "Red red ring"), (2, "red bolt"), (3, "the of"), (4, None)], "id int, text string")
    rows = {(r.id, r.term): r.weight for r in features.tfidf(docs, "id", F.col("text")).collect()}
    idf = lambda df: math.log(5 / (1 + df)) + 1
    length = math.hypot(2 * idf(2), idf(1))
    assert rows[1, "red"] == pytest.approx(2 * idf(2) / length) and set(k for k, _ in rows) == {1, 2}


def test_checks(spark):
    movies = spark.createDataFrame([(1, "a"), (2, None), (2, "c")], "movie_id int, title string")
    ratings = spark.createDataFrame([(1, 1, 5.5), (1, 3, 3.3), (1, None, 4.0)], "user_id int, movie_id int, rating double")
    fk = {r.relation: r for r in quality.check_foreign_keys({"movies": movies, "ratings": ratings}).collect()}
    assert fk["ratings.movie_id -> movies.movie_id"].n_invalid == 2
    assert fk["ratings.movie_id -> movies.movie_id"].examples == "3"
    assert fk["cast_members.movie_id -> movies.movie_id"].examples.startswith("skipped, missing tables cast_members")
    broken = {(r.table, r.check): r.n_violations for r in quality.check_constraints({"movies": movies}).collect()}
    assert broken == {("movies", "unique movie_id"): 1, ("movies", "not null movie_id"): 0, ("movies", "not null title"): 1}
    off = quality.check_half_star(ratings).first()
    assert (off.n_off_grid, off.n_out_of_range) == (1, 1)
    found = {(r.table, r.column, r.problem) for r in quality.check_columns({"movies": movies, "ratings": ratings}).collect()}
    assert {("ratings", "movielens_id", "missing"), ("ratings", "timestamp", "missing")} <= found
    words = spark.createDataFrame([(1, 7), (9, 8)], "movie_id int, keyword_id int")
    with pytest.raises(ValueError):
        quality.check_keyword_links(movies, words.select("keyword_id"), words)


def test_tiles_return_no_seen_items(spark):
    rng = np.random.default_rng(9)
    items = {i: rng.normal(size=4) for i in range(400)}
    queries = {1: rng.normal(size=4), 2: rng.normal(size=4), 3: rng.normal(size=4)}

    def frame(vectors, name):
        return spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], f"{name} bigint, vec array<double>")

    order = sorted(items, key=lambda i: -float(queries[1] @ items[i]))
    seen = {(1, i) for i in order[:390]} | {(2, i) for i in items}
    got = score_all_pairs(
        frame(queries, "user_id"), frame(items, "movie_id"), 5, block_rows=50,
        seen=spark.createDataFrame(sorted(seen), "user_id bigint, movie_id bigint"),
    )
    lists = {}
    for r in got.orderBy("user_id", "rank").collect():
        lists.setdefault(r.user_id, []).append(r.movie_id)
    assert lists[1] == order[390:395] and 2 not in lists and len(lists[3]) == 5
    assert "LeftAnti" not in got._jdf.queryExecution().toString()


def test_masked_cells_never_leave_a_tile():
    from filmloom.operators.scoring import _best_mask

    scores = np.array([[3.0, -np.inf, 1.0, 1.0], [-np.inf] * 4, [2.0, 2.0, 2.0, -np.inf]])
    assert _best_mask(scores, 2).tolist() == [[True, False, True, False], [False] * 4, [True, True, False, False]]


@pytest.mark.parametrize("options", [{}, {"block_rows": 7}, {"block_rows": 16, "broadcast_bytes": 0}])
def test_factor_auc_against_all_pairs(spark, options):
    rng = np.random.default_rng(4)
    u, v = rng.integers(-3, 4, (9, 3)).astype(float), rng.integers(-3, 4, (50, 3)).astype(float)
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "user_id bigint, vec array<double>")
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "movie_id bigint, vec array<double>")
    train = {(int(a), int(b)) for a, b in rng.integers(0, 50, (80, 2)) % [9, 50]}
    test = {(int(a), int(b)) for a, b in rng.integers(0, 60, (60, 2)) % [8, 60]} - train
    train |= {(7, i) for i in range(50)} - test  # no negatives left
    frames = [spark.createDataFrame(sorted(x), "user_id bigint, movie_id bigint") for x in (train, test)]
    got = {r.user_id: (r.n_pos, r.n_neg, r.auc) for r in metrics.factor_auc(users, items, frames[1], frames[0], **options).collect()}
    for user in range(9):
        liked = [i for i in range(50) if (user, i) in test]
        others = [i for i in range(50) if (user, i) not in test and (user, i) not in train]
        if not liked:
            assert user not in got
            continue
        scores = v @ u[user]
        won = sum((scores[p] > scores[n]) + 0.5 * (scores[p] == scores[n]) for p in liked for n in others)
        assert got[user][:2] == (len(liked), len(others))
        assert got[user][2] == pytest.approx(won / (len(liked) * len(others)) if others else 0.5)
