"""As-of join against a nested loop, with a heavy key, ties, NULLs and copies."""

import random
from datetime import datetime, timedelta

import pytest

from millrace.operators.asof import join_asof, point_in_time

START = datetime(2024, 1, 1)
LEFT = "id int, k string, t timestamp_ntz"
RIGHT = "k string, rt timestamp_ntz, v int"


def _tables(seed, n=400):
    rnd = random.Random(seed)

    def moment():
        return START + timedelta(minutes=rnd.randrange(300))

    def key():
        return rnd.choice(["hot"] * 6 + ["a", "b", "c", None])

    left = [(i, key(), moment() if rnd.random() > 0.05 else None) for i in range(n)]
    left += [(n + i, "hot", START + timedelta(minutes=150)) for i in range(100)]  # copies of one probe
    right = list({(k, t): (k, t, rnd.randrange(1000)) for k, t in ((key(), moment()) for _ in range(n))}.values())
    right.append(("hot", None, 5))
    return left, right


def _expected(left, right, direction, allow_equal, tolerance):
    out = {}
    for i, k, t in left:
        best = None
        for rk, rt, v in right:
            if k is None or t is None or rt is None or rk != k:
                continue
            ok = rt <= t if direction == "backward" else rt >= t if direction == "forward" else rt == t
            if not ok or (rt == t and not allow_equal) or (tolerance and abs(rt - t) > tolerance):
                continue
            near = (abs(rt - t), -v)
            if best is None or near < best[0]:
                best = (near, v)
        out[i] = best[1] if best else None
    return out


@pytest.mark.parametrize("direction,allow_equal,tolerance", [
    ("backward", True, None), ("backward", False, None), ("forward", True, None), ("forward", False, None),
    ("equal", True, None), ("backward", True, timedelta(minutes=5)), ("forward", True, timedelta(minutes=5)),
])
@pytest.mark.parametrize("heavy_rows,buckets", [(10**6, 1), (200, 1), (200, 7), (0, 7)])
def test_same_as_nested_loop(spark, direction, allow_equal, tolerance, heavy_rows, buckets):
    """All keys light, only the hot key heavy, or all keys heavy."""
    left, right = _tables(seed=len(direction) + buckets)
    out = join_asof(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", "t", "rt", columns=["v"],
        direction=direction, allow_equal=allow_equal, tolerance="5 minutes" if tolerance else None, buckets=buckets, heavy_rows=heavy_rows)
    rows = out.collect()
    assert out.columns == ["id", "k", "t", "v"]
    assert len(rows) == len(left)
    assert {r["id"]: r["v"] for r in rows} == _expected(left, right, direction, allow_equal, tolerance)


def test_equal_times_take_the_greatest(spark):
    left = spark.createDataFrame([(1, "a", START + timedelta(minutes=9))], LEFT)
    right = spark.createDataFrame([("a", START, 3), ("a", START, 8), ("a", START, 5)], RIGHT)
    for direction, t in (("backward", 9), ("forward", -9)):
        probe = left.selectExpr("id", "k", f"t + INTERVAL {t - 9} MINUTES AS t")
        for heavy_rows in (0, 10**6):
            assert join_asof(probe, right, "k", "t", "rt", ["v"], direction=direction, heavy_rows=heavy_rows).first()["v"] == 8


def test_empty_right_side(spark):
    left = spark.createDataFrame([(1, "a", START)], LEFT)
    right = spark.createDataFrame([], RIGHT)
    assert join_asof(left, right, "k", "t", "rt", ["v"]).first()["v"] is None


def test_several_views(spark):
    spine = spark.createDataFrame([(1, "a", START + timedelta(hours=2))], LEFT)
    one = spark.createDataFrame([("a", START, 1), ("a", START + timedelta(hours=3), 2)], "k string, at timestamp_ntz, x int")
    two = spark.createDataFrame([("a", START + timedelta(hours=1), 7)], "k string, at timestamp_ntz, y int")
    row = point_in_time(spine, [(one, ["k"], "at", ["x"]), (two, ["k"], "at", ["y"])], "t").first()
    assert (row["x"], row["y"]) == (1, 7)


@pytest.mark.parametrize("direction", ["backward", "forward", "equal"])
@pytest.mark.parametrize("heavy_rows", [10**6, 200, 0])
def test_views_in_one_pass_as_one_by_one(spark, direction, heavy_rows):
    """Views of one key share the pass; ties and empty views do not disturb the others, columns keep the views' order."""
    left, right = _tables(seed=11)
    other = [(k, t, v + 10_000) for k, t, v in _tables(seed=12)[1]] + [("hot", START, 1), ("hot", START, 2)]
    spine = spark.createDataFrame(left, LEFT)
    named = [spark.createDataFrame(rows, RIGHT).withColumnRenamed("v", name) for name, rows in (("x", right), ("y", other), ("z", []))]
    by_id = spark.createDataFrame([(i, START, i) for i in range(50)], "id int, rt timestamp_ntz, w int")
    views = [(named[0], ["k"], "rt", ["x"]), (by_id, ["id"], "rt", ["w"]), (named[1], ["k"], "rt", ["y"]), (named[2], ["k"], "rt", ["z"])]
    out = point_in_time(spine, views, "t", direction=direction, heavy_rows=heavy_rows, buckets=3)
    assert out.columns == ["id", "k", "t", "x", "w", "y", "z"]
    rows = out.collect()
    assert len(rows) == len(left)
    assert {r["id"]: r["x"] for r in rows} == _expected(left, right, direction, True, None)
    assert {r["id"]: r["y"] for r in rows} == _expected(left, other, direction, True, None)
    assert {r["z"] for r in rows} == {None}
    after = {"backward": lambda t: t >= START, "forward": lambda t: t <= START, "equal": lambda t: t == START}[direction]
    assert {r["id"]: r["w"] for r in rows} == {i: i if i < 50 and t and after(t) else None for i, _, t in left}


def test_views_of_one_key_share_the_sort(spark):
    left, right = _tables(seed=3)
    views = [(spark.createDataFrame(right, RIGHT).withColumnRenamed("v", n), ["k"], "rt", [n]) for n in "abc"]
    plan = point_in_time(spark.createDataFrame(left, LEFT), views, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [last(_hit") == 1


def test_inner(spark):
    left, right = _tables(seed=9)
    frames = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    expected = {i for i, v in _expected(left, right, "backward", True, None).items() if v is not None}
    for heavy_rows in (0, 10**6):
        rows = join_asof(*frames, "k", "t", "rt", ["v"], how="inner", heavy_rows=heavy_rows).collect()
        assert {r["id"] for r in rows} == expected


def test_heavy_key_is_spread(spark):
    """For a heavy key, the sort is partitioned by key and time bucket; light keys need one window only."""
    left, right = _tables(seed=3)
    frames = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)

    def walks(heavy_rows):
        out = join_asof(*frames, "k", "t", "rt", ["v"], buckets=6, heavy_rows=heavy_rows)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        return [line for line in plan.splitlines() if "Window [last(_hit" in line and "_side#" in line]

    assert len(walks(10**6)) == 1
    assert any("_b#" in w.split("windowspecdefinition")[1] for w in walks(200))


@pytest.mark.parametrize("direction", ["backward", "equal"])
def test_right_columns_named_like_left_ones(spark, direction):
    left = spark.createDataFrame([(1, 10, "l")], "k int, t int, v string")
    right = spark.createDataFrame([(1, 10, "r", 5)], "k int, t int, V string, w int")
    with pytest.raises(ValueError, match="suffix"):
        join_asof(left, right, "k", "t", "t", direction=direction)
    found = join_asof(left, right, "k", "t", "t", direction=direction, suffix="_seen")
    assert found.columns == ["k", "t", "v", "t_seen", "V_seen", "w"] and [tuple(r) for r in found.collect()] == [(1, 10, "l", 10, "r", 5)]
    with pytest.raises(ValueError, match="suffix"):
        join_asof(left.withColumn("t_seen", left["t"]), right, "k", "t", "t", direction=direction, suffix="_seen")
    assert join_asof(left, right, "k", "t", "t", columns=["w"], direction=direction).columns == ["k", "t", "v", "w"]
