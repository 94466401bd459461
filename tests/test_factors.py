"""Factor models on ratings of known rank: held-out error, repeatability, strata and odd rows."""

import math
import tracemalloc

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from millrace.models import alternating, factors, fits, metrics


def planted(n_users=120, n_items=80, rank=3, share=0.4, seed=1, hot=None):
    """Ratings of a matrix of low rank, some of them held out; ``hot`` is an item that every user rates."""
    rng = np.random.default_rng(seed)
    p, q = rng.uniform(0.5, 2, (n_users, rank)), rng.uniform(0.5, 2, (n_items, rank))
    rated = rng.random((n_users, n_items)) < share
    if hot is not None:
        rated[:, hot] = True
    rows = [(f"u{u}", int(i) * 10, float(p[u] @ q[i])) for u, i in zip(*np.nonzero(rated))]
    held = rng.random(len(rows)) < 0.15
    return [r for r, h in zip(rows, held) if not h], [r for r, h in zip(rows, held) if h]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "who string, what long, stars double").repartition(parts)


def rmse(scored):
    return scored.agg(F.sqrt(F.avg((F.col("stars") - F.col("prediction")) ** 2))).first()[0]


def vectors(model):
    return [sorted((r["id"], tuple(r["features"])) for r in t.collect()) for t in model.tables()]


def test_held_out_error_beats_the_mean_and_the_alternating_fit(spark):
    train, held = planted(hot=0)
    mean = np.mean([s for _, _, s in train])
    of_mean = math.sqrt(np.mean([(s - mean) ** 2 for _, _, s in held]))
    model = factors.factorize_blocks(frame(spark, train), "who", "what", "stars", rank=4, epochs=6, blocks=3, seed=5)
    mine = rmse(model.predict(frame(spark, held)).where("prediction is not null"))
    als, users, items = fits.factorize(frame(spark, train), "who", "what", "stars", rank=4, seed=5)
    numbered = frame(spark, held).join(users, "who").join(items, "what").withColumns(
        {"user_id": F.col("user_id").cast("int"), "item_id": F.col("item_id").cast("int")})
    alternating = rmse(als.transform(numbered))
    assert mine < 0.5 * of_mean
    assert mine <= alternating


def test_same_vectors_under_any_partitioning(spark):
    train, _ = planted(30, 20, seed=2)
    fit = lambda parts, seed: vectors(factors.factorize_blocks(
        frame(spark, train, parts), "who", "what", "stars", rank=2, epochs=2, blocks=2, seed=seed))
    once = fit(1, 3)
    assert once == fit(7, 3)
    assert once != fit(1, 4)


def test_steps_are_damped_sums_of_single_steps():
    rng = np.random.default_rng(4)
    users, items = rng.random((4, 3)), rng.random((5, 3))
    u, i, r = rng.integers(0, 4, 40), rng.integers(0, 5, 40), rng.random(40)
    p, q = users.copy(), items.copy()
    moves = {}
    for a, b, s in zip(u, i, r):
        gap = s - p[a] @ q[b]
        moves.setdefault(("u", a), []).append((gap * q[b] - 0.01 * p[a], q[b] @ q[b] + 0.01))
        moves.setdefault(("i", b), []).append((gap * p[a] - 0.01 * q[b], p[a] @ p[a] + 0.01))
    for (side, k), steps in moves.items():
        (p if side == "u" else q)[k] += 0.1 * sum(s for s, _ in steps) / (1 + 0.1 * sum(w for _, w in steps))
    factors.descend(users, items, u, i, r, 0.1, 0.01)
    assert np.allclose(users, p) and np.allclose(items, q)


def test_block_count_bounds_a_task():
    for n, widest in ((0, 0), (10**6, 10**5), (10**10, 10**8), (10**12, 10**6)):
        b = factors.block_count(n, widest)
        assert n / b**2 <= factors.BLOCK_RATINGS and widest / b <= factors.BLOCK_VECTORS


def test_odd_rows_take_no_part(spark):
    train, _ = planted(12, 9, seed=3)
    odd = [(None, 10, 3.0), ("u1", None, 3.0), ("u1", 10, None), ("u2", 10, float("nan")), ("ghost", 99999, float("inf"))]
    fit = lambda rows: factors.factorize_blocks(frame(spark, rows), "who", "what", "stars", rank=2, epochs=1, blocks=2)
    model = fit(train + odd)
    assert vectors(model) == vectors(fit(train))
    unknown = model.predict(frame(spark, [("ghost", 10, 1.0), (None, 10, 1.0), ("u1", 10, 1.0)], 1)).collect()
    assert [r["prediction"] is None for r in sorted(unknown, key=lambda r: str(r["who"]))] == [True, True, False]


@pytest.mark.parametrize("value", [0.0, -4.0])
def test_ratings_of_one_value(spark, value):
    rows = [(f"u{u}", i, value) for u in range(6) for i in range(5)]
    model = factors.factorize_blocks(frame(spark, rows), "who", "what", "stars", rank=2, epochs=4, blocks=2)
    assert rmse(model.predict(frame(spark, rows))) < 0.5


def test_no_ratings(spark):
    model = factors.factorize_blocks(frame(spark, [], 1), "who", "what", "stars", rank=2, epochs=2)
    assert [t.count() for t in model.tables()] == [0, 0]


def test_alternating_fit_computes_its_ratings_once(spark, tmp_path):
    train, _ = planted(12, 9, seed=3)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    rows = frame(spark, train).withColumn("stars", counted.asNondeterministic()("stars"))
    model, users, items = fits.factorize(rows, "who", "what", "stars", rank=2, iterations=2, base=str(tmp_path / "kept"))
    assert [users.count(), items.count()] == [model.userFactors.count(), model.itemFactors.count()] == [12, 9]
    assert seen.value == len(train)
    kept = spark.read.parquet(str(tmp_path / "kept" / "numbered")).join(users, "user_id").join(items, "item_id")
    assert sorted(map(tuple, kept.select("who", "what", "rating").collect())) == sorted(train)


def test_regression_counts_predictions_in_the_same_pass(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (2.0, 2.5), (3.0, None), (None, 4.0)], "y double, p double")
    found = metrics.regression(rows, "y", "p", count="n").first()
    assert found["n"] == 3 and found["r2"] == metrics.regression(rows, "y", "p").first()["r2"]


def test_alternating_fit_sends_vectors_to_few_blocks(spark):
    train, _ = planted(12, 9, seed=3)
    model, _, _ = fits.factorize(frame(spark, train), "who", "what", "stars", rank=2, iterations=1)
    assert model.userFactors.rdd.getNumPartitions() == model.itemFactors.rdd.getNumPartitions() == fits.als_blocks(len(train)) == 4
    for n in (10**6, 10**9, 10**11):
        assert n / fits.als_blocks(n) <= fits.ALS_BLOCK_RATINGS


def test_blocks_fit_computes_its_ratings_once(spark):
    train, _ = planted(12, 9, seed=3)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    rows = frame(spark, train).withColumn("stars", counted.asNondeterministic()("stars"))
    factors.factorize_blocks(rows, "who", "what", "stars", rank=2, epochs=1, blocks=2)
    assert seen.value == len(train)


def test_blocks_stay_few_as_vectors_grow():
    assert factors.block_count(36_000_000, 1_200_000) == 4  # six blocks of 200,000 vectors
    assert factors.block_count(216_000_000, 7_200_000) == 8
    assert factors.block_count(0, 1_000_000, rank=100) == 10


def test_alternating_fit_reads_its_block_chunk_by_chunk():
    rng, others, each, per = np.random.default_rng(2), 500, 100, 40
    half = alternating.Half(rank=4, reg=0.1, blocks=2, others=others, seed=0)
    known = rng.normal(size=(others, 4)).astype(np.float32)

    def peak(chunks):
        read, ahead = [], []

        def rows():
            yield 0, (alternating.VECTORS, np.diff(np.arange(others, dtype=np.int32), prepend=np.int32(0)).tobytes(), known.tobytes())
            for c in range(chunks):
                read.append(c)
                ids = np.arange(c * each, (c + 1) * each, dtype=np.int32)
                yield 0, (alternating.RATINGS, ids.tobytes(), np.full(each, per, np.int32).tobytes(),
                          rng.integers(0, others, each * per).astype(np.int32).tobytes(), rng.random(each * per).astype(np.float32).tobytes())

        tracemalloc.start()
        found = 0
        for _, (kind, steps, _) in alternating._fit(half)(0, rows()):
            numbers = np.cumsum(np.frombuffer(steps, np.int32))
            ahead.append(len(read) - 1 - int(numbers[1]) // each if len(numbers) > 2 * chunks else 0)
            found += len(numbers)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert max(ahead) == 0 and found == 2 * chunks * each  # every vector to both blocks, before the next chunk is read
        return most

    assert peak(60) < 1.5 * peak(6)


def test_unknown_ratings_are_refused(spark):
    for wrong in (None, math.nan, math.inf):
        with pytest.raises(ValueError, match="1 ratings"):
            fits.factorize(frame(spark, [("a", 1, 2.0), ("b", 1, wrong)]), "who", "what", "stars", rank=2, iterations=1)
    with pytest.raises(ValueError, match="no ratings"):
        fits.factorize(frame(spark, [], 1), "who", "what", "stars", rank=2)


def test_alternating_fit_solves_the_least_squares_of_hot_vectors_too(spark):
    """As plain loops do, with a rating that comes twice and an item whose ratings lie in many chunks."""
    rng, n_users, n_items, rank, reg = np.random.default_rng(6), 60, 25, 3, 0.2
    rated = [(u, i, float(rng.integers(1, 9))) for u in range(n_users) for i in range(n_items) if i == 0 or rng.random() < 0.2]
    rated.append(rated[0])
    users, items = alternating.first_vectors(np.arange(n_users), rank, 4).astype(float), np.zeros((n_items, rank))
    for _ in range(2):
        for mine, other, a, b in ((items, users, 1, 0), (users, items, 0, 1)):
            for x in range(len(mine)):
                own = [r for r in rated if r[a] == x]
                seen = np.array([other[r[b]] for r in own]).reshape(-1, rank)
                if own:
                    mine[x] = np.linalg.solve(seen.T @ seen + reg * len(own) * np.eye(rank), seen.T @ [r[2] for r in own])
    rows = spark.createDataFrame(rated, "u int, i int, r double")
    for parts, blocks, chunk in ((1, 3, 8), (5, 2, 1000)):
        found = alternating.fit(rows.repartition(parts), "u", "i", "r", rank, iterations=2, reg=reg, seed=4, blocks=blocks, chunk=chunk)
        for frame_, expected in zip(found, (users, items)):
            got = dict(frame_.collect())
            assert sorted(got) == sorted({r[0 if expected is users else 1] for r in rated})
            for x, v in got.items():
                assert np.allclose(v, expected[x], rtol=1e-3, atol=1e-4)


def test_factor_tables_of_the_alternating_fit_have_all_labels(spark):
    train, held = planted(30, 20, seed=4, hot=0)
    model, users, items = fits.factorize(frame(spark, train), "who", "what", "stars", rank=3, iterations=4)
    assert isinstance(model, ALSModel) and model.rank == 3
    by_user, by_item = fits.factor_tables(model, users, items, "who", "what")
    p, q = dict(by_user.collect()), dict(by_item.collect())
    assert set(p) == {r[0] for r in train} and set(q) == {r[1] for r in train}
    numbered = frame(spark, held).join(users, "who").join(items, "what").withColumns(
        {"user_id": F.col("user_id").cast("int"), "item_id": F.col("item_id").cast("int")})
    scored = model.transform(numbered).collect()
    assert scored and all(np.isclose(r["prediction"], np.dot(p[r["who"]], q[r["what"]]), rtol=1e-3) for r in scored)
    assert model.recommendForAllUsers(2).count() == len(p)


def test_alternating_fit_over_more_partitions_than_blocks(spark, monkeypatch):
    rows = spark.createDataFrame([(u, i, float(u * i % 5)) for u in range(9) for i in range(6)], "u int, i int, r double")
    fit = lambda: [dict(t.collect()) for t in alternating.fit(rows, "u", "i", "r", rank=2, iterations=2, blocks=3)]
    usual, deal = fit(), RDD.partitionBy
    monkeypatch.setattr(RDD, "partitionBy", lambda self, n, *a, **b: deal(self, max(n, 7), *a, **b))
    for was, now in zip(usual, fit()):
        assert sorted(was) == sorted(now) and all(np.allclose(was[x], now[x], rtol=1e-4, atol=1e-5) for x in was)
