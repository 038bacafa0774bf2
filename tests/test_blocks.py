"""Block files: products, solves and fits over them against plain versions on rows of their own."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from filmloom.models import blocks, explicit, graph, linear
from filmloom.operators import scoring
from filmloom.operators.relational import index_ids

PAIR = "user_id bigint, movie_id bigint"


@pytest.fixture(scope="module")
def edges():
    """40 targets and 30 sources; target 3 has very many edges, target 7 none."""
    rng = np.random.default_rng(5)
    rows = [(int(t), int(s), float(v)) for t, s, v in zip(rng.integers(0, 40, 500), rng.integers(0, 30, 500), rng.normal(size=500)) if t != 7]
    return rows + [(3, int(s), float(v)) for s, v in zip(rng.integers(0, 30, 300), rng.normal(size=300))]


def stored(spark, edges, vectors, rows=9):
    store = blocks.BlockStore(spark)
    frame = spark.createDataFrame(edges, "t bigint, s bigint, v double").repartition(3)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "s bigint, vec array<double>").repartition(4)
    return store, store.write_edges(frame, "t", "s", "v", rows, 40), store.write_factors(table, "s", vectors.shape[1], 7, 30)


@pytest.mark.parametrize("most", [1 << 26, 1 << 10])
def test_row_sums_and_solves_match_plain_ones(spark, edges, monkeypatch, most):
    """The same in one piece and in pieces smaller than a row's edges."""
    vectors = np.random.default_rng(6).normal(size=(30, 4))
    store, held, sources = stored(spark, edges, vectors)
    assert len(held.paths) == 5 and len(sources.paths) == 5
    monkeypatch.setattr(blocks, "PIECE_BYTES", most)
    monkeypatch.setattr(explicit, "PIECE_BYTES", most)
    sums = np.concatenate([blocks.row_sums(*held.block(b), sources) for b in range(5)])
    solved, _ = store.solve(held, lambda b: (blocks.row_sums(*held.block(b), sources), None), 4)
    kept = {r.t: r.vec for r in store.frame(solved, "t").collect()}
    found = explicit.solve_rows(store, held, sources, 0.1)
    rows = np.concatenate([found.block(b) for b in range(5)])
    for target in range(40):
        own = [(s, v) for t, s, v in edges if t == target]
        x, y = vectors[[s for s, _ in own]].reshape(-1, 4), np.array([v for _, v in own])
        assert np.allclose(sums[target], y @ x) and np.allclose(kept[target], y @ x)
        ridge = np.linalg.solve(x.T @ x + 0.1 * max(1, len(own)) * np.eye(4), x.T @ y)
        assert np.allclose(rows[target], ridge, atol=1e-5)
    store.close()


def test_short_runs_are_solved_by_their_own_products():
    rng = np.random.default_rng(7)
    x, y, ends = rng.normal(size=(25, 6)), rng.normal(size=25), np.array([0, 2, 2, 5, 16, 25])
    got = explicit.ridge_rows(x, ends, y, 0.05)
    for row, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        want = np.linalg.solve(x[a:b].T @ x[a:b] + 0.05 * max(1, b - a) * np.eye(6), x[a:b].T @ y[a:b])
        assert np.allclose(got[row], want)


def test_rounds_are_those_of_spark(spark):
    """The factors of Spark's own ALS on the residuals of a fit."""
    rng = np.random.default_rng(8)
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(30) for i in range(20) if rng.random() < 0.4]
    ratings = spark.createDataFrame(rows, PAIR + ", rating double")
    held, als = [], explicit.ALS

    class Kept:
        def __init__(self, **params):
            self.params = params

        def fit(self, residual):
            held.append(als(**{**self.params, "maxIter": 4}).fit(residual))
            return als(**self.params).fit(residual)

    explicit.ALS = Kept
    try:
        model = explicit.train_explicit_mf(ratings, rank=3, epochs=4)
    finally:
        explicit.ALS = als
    for ours, theirs in ((model.users, held[0].userFactors), (model.items, held[0].itemFactors)):
        a = sorted([round(x, 4) for x in r.vec[:3]] for r in ours.collect())
        b = sorted([round(x, 4) for x in r.features] for r in theirs.collect())
        assert np.allclose(a, b, atol=2e-4)


def test_every_size_is_a_whole_fit(spark):
    """The lists of a new user are those of a model fitted on all ratings and its own ones."""
    rng = np.random.default_rng(9)
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(20) for i in range(15) if rng.random() < 0.5]
    ratings = spark.createDataFrame(rows, PAIR + ", rating double")
    films = spark.range(18).withColumnRenamed("id", "movie_id")
    new = max(u for u, _, _ in rows) + 1
    got = explicit.refit_with_user(ratings, films, (1, 6), 4, rank=3, epochs=3).collect()
    for n in (1, 6):
        own = explicit.synthetic_ratings(films, new, n)
        model = explicit.train_explicit_mf(ratings.unionByName(own), rank=3, epochs=3)
        pairs = model.items.select(F.lit(new).alias("user_id"), "movie_id").join(own, "movie_id", "left_anti")
        estimates = {r.movie_id: r.estimate for r in explicit.predict_ratings(model, pairs).collect()}
        lists = {r.movie_id: r.estimate for r in got if r.n_reviews == n}
        assert len(lists) == 4 and all(r.user_id == new for r in got)
        assert sorted(lists.values()) == pytest.approx(sorted(estimates.values())[-4:], abs=1e-5)
        assert all(estimates[m] == pytest.approx(e, abs=1e-5) for m, e in lists.items())


def test_svd_rounds_shuffle_nothing(spark, monkeypatch):
    """Products of the rounds are jobs over block files, not sparse products by shuffle; values as in numpy."""
    rng = np.random.default_rng(10)
    matrix = (rng.random((40, 25)) < 0.3).astype(float)
    matrix[0], matrix[:, 0] = 1, 1
    pairs = spark.createDataFrame([(3 * int(u) + 10**10, int(i)) for u, i in np.argwhere(matrix)], PAIR)
    monkeypatch.setattr(linear, "spread", None)
    users, items, values = linear.train_svd(pairs, k=3, tol=1e-6)
    assert np.allclose(values, np.linalg.svd(matrix)[1][:3], rtol=1e-5)
    left, right = (np.array([r.vec for r in t.orderBy(key).collect()]) for t, key in ((users, "user_id"), (items, "movie_id")))
    u, s, vt = np.linalg.svd(matrix)
    assert np.allclose(left @ right.T, (u[:, :3] * s[:3]) @ vt[:3], atol=1e-3)


def test_block_draws_are_those_of_the_joins(spark):
    """Each block's negatives against ``sample_negatives``: nearly sated users and one with every film among them."""
    rng = np.random.default_rng(11)
    rows = [(u, 2 * i + 5) for u in range(12) for i in range(40) if rng.random() < 0.2]
    rows += [(50, 2 * i + 5) for i in range(39)] + [(51, 2 * i + 5) for i in range(40)]
    pairs = spark.createDataFrame(rows, PAIR).distinct()
    users, films = index_ids(pairs, "user_id", "_user"), index_ids(pairs, "movie_id", "_item")
    numbered = pairs.join(users, "user_id").join(films, "movie_id")
    store, n = blocks.BlockStore(spark), users.count()
    held = store.write_edges(numbered, "_user", "_item", None, 5, n)
    names = store.write_keys(users, "_user", "user_id", 5, n), store.write_keys(films, "_item", "movie_id", 9, 40)
    user = {r._user: r.user_id for r in users.collect()}
    film = {r._item: r.movie_id for r in films.collect()}
    for epoch in (0, 3):
        want = {tuple(r) for r in graph.sample_negatives(pairs, films.select("movie_id"), epoch, 42).select("user_id", "movie_id", "neg_id").collect()}
        found = [graph.draw_block(held, b, *names, epoch, 42, 3) for b in range(len(held.paths))]
        got = {(user[u], film[i], film[j]) for own in found for u, i, j, _ in zip(*own)}
        assert got == want and len(want) == len(set(rows)) - 40
        assert all((np.diff(own[3]) >= 0).all() for own in found)
    store.close()


def test_an_epoch_has_a_step_for_each_batch_of_triples(spark, monkeypatch):
    rng = np.random.default_rng(12)
    pairs = spark.createDataFrame([(u, i) for u in range(30) for i in range(20) if rng.random() < 0.5], PAIR)
    asked, epoch = [], graph._epoch
    monkeypatch.setattr(graph, "_epoch", lambda walk, start, triples, steps, *more: asked.append(steps) or epoch(walk, start, triples, steps, *more))
    model = graph.train_graph(pairs, dim=4, layers=1, lr=0.05, epochs=2, batch_size=40)
    n = math.ceil(pairs.count() / 40)
    assert n > 5 and [len(steps) for steps in asked] == [n, n] and asked[1][-1][1] == 2 * n
    assert model.losses[1] < model.losses[0] and model.users.count() == 30
    from filmloom.workload import models

    monkeypatch.setattr(models, "split", lambda spark, d: (pairs, None))
    made = []
    monkeypatch.setattr(graph, "train_graph", lambda pairs, **settings: made.append(settings) or model)
    models.train_graph_bpr(spark, "")
    assert made[0].get("batches") is None and made[0]["batch_size"] == 8192 and made[0]["epochs"] == 10


def test_rows_of_unknown_items_are_left_out_before_any_shuffle(spark, monkeypatch):
    """Ratings of films without a vector go at the scan; lists and vectors stay the same."""
    rng = np.random.default_rng(13)
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(12) for i in range(60) if rng.random() < 0.5]
    raw = spark.createDataFrame(rows, PAIR + ", rating double").cache()
    items = spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(0, 20, 2)], "movie_id bigint, vec array<double>").cache()
    ratings = raw.groupBy("user_id", "movie_id").agg(F.max("rating").alias("rating"))
    plan = scoring.of_known(ratings, items, "movie_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join LeftSemi")

    def found():
        vectors = linear.fold_in(ratings, items, size=3)
        lists = scoring.score_all_pairs(vectors, items, 4, seen=ratings.select("user_id", "movie_id"))
        return {(r.user_id, r.movie_id, r.rank, r.score) for r in lists.collect()}

    few = found()
    monkeypatch.setattr(scoring, "KNOWN_ITEMS", 0)
    assert few and few == found()
