"""Hard negatives against brute force."""

import math

import numpy as np
import pytest

from millrace.llm.hard_negatives import mine_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=10):
    usable = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = tuple(math.floor(256 * float(np.float32(x))) for x in v)
            usable[i, label, q] = None
    out = []
    for i, label, q in usable:
        if i % 10:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, r)), j, other) for j, other, r in usable)
        for s, j, other in [x for x in scored if x[2] == label and x[1] != i][:positives]:
            hard = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out += [(i, j, rank + 1, n, -s, -t) for rank, (t, n, _) in enumerate(hard[:negatives])]
    return sorted(out)


def vectors(seed, n, width=6, spread=0.3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(5, width))
    made = centre[rng.integers(0, 5, n)] + rng.normal(scale=spread, size=(n, width))
    rows = [(i, [float(np.float32(x)) for x in v], int(rng.integers(0, 4)) if i % 3 else 2) for i, v in enumerate(made)]
    return rows + rows[:15] + [
        (1000, None, 1), (1010, [0.0] * width, 1), (1020, [1.0, None], 1), (1030, [float("nan")] * width, 1), (1040, [float("inf")] * width, 1),
        (1050, rows[0][1], None), (None, rows[1][1], 1), (1060, rows[2][1][:2], 1), (1070, [], 1), (20, rows[4][1], 3), (1080, rows[2][1], 9)]


@pytest.mark.parametrize("how", [{}, {"centres": 7, "shard_rows": 13, "anchor_rows": 4}, {"centres": 1}, {"sample_anchors": 2, "positives": 2, "negatives": 3}])
def test_against_brute_force(spark, how):
    rows = vectors(len(how), 260)
    frame = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA + ", id long, cell string").repartition(5)
    got = mine_hard_negatives(frame, "vec_id % 10 = 0", **how)
    limits = {k: v for k, v in how.items() if k in ("positives", "negatives")}
    assert sorted(map(tuple, got.collect())) == brute(rows, **limits)
    assert got.schema.simpleString() == "struct<anchor_id:bigint,positive_id:bigint,rank:int,negative_id:bigint,positive_score:bigint,negative_score:bigint>"


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.integers(-2**17, 2**17, 8)], i % 3) for i in range(80)]
    got = mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), "vec_id % 10 = 0", centres=3)
    assert sorted(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(10, [1.0], 1)], [(10, [1.0], 1), (20, [1.0], 1)], [(10, None, 1)]])
def test_few_rows(spark, rows):
    assert mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), "vec_id % 10 = 0").collect() == []


def test_walks_stop_early():
    """With rows in tight clusters a member reads a small share of a list; with the bound off it would read all."""
    from millrace.llm import hard_negatives as hn

    rng = np.random.default_rng(1)
    centre = rng.normal(size=(20, 32)) * 200
    rows = np.floor(centre[rng.integers(0, 20, 40_000)] + rng.normal(scale=5, size=(40_000, 32))).astype(np.int64)
    units, norms = hn._units(rows)
    own = centre[0] / np.linalg.norm(centre[0])
    member = rows[(units @ own) > 0.99][:50]
    angles = np.arccos(hn._units(member)[0] @ own)
    bounds = norms * hn._bound(np.arccos(np.clip(units @ own, -1, 1)), angles.max())
    order = np.argsort(-bounds)
    read = []
    products = hn._products

    def counted(a, b):
        read.append(len(b))
        return products(a, b)

    hn._products = counted
    try:
        whole = np.full((50, 1), hn.LOWEST)
        best = hn._walk(
            {"vector": rows[order], "id": order, "label": np.zeros(len(rows), int)}, bounds[order],
            {"vector": member, "id": np.full(50, -1), "label": np.zeros(50, int), "norm": np.linalg.norm(member, axis=1), "low": whole, "high": -whole, "bar": whole}, True, 5)
    finally:
        hn._products = products
    assert sum(read) < 4000
    want = np.sort(member @ rows.T, axis=1)[:, :-6:-1]
    assert (best.score.reshape(50, 5) == want).all()
