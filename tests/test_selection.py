"""Feature tests against direct sums and numerical integrals."""

import math

import numpy as np
import pytest

from millrace.features.selection import anova_scores, chi_tail, contingency_scores, f_tail, regression_scores, select_by


def _integral(density, low, high, points=400_001):
    x = np.linspace(low, high, points)
    y = density(x)
    return float(((y[1:] + y[:-1]) / 2 * np.diff(x)).sum())


@pytest.mark.parametrize("f, a, b", [(0.3, 2, 9), (1.0, 3, 40), (2.5, 4, 4), (4.2, 5, 200), (9.0, 2, 12), (1.0, 2, 2)])
def test_f_tail(f, a, b):
    scale = math.exp(math.lgamma((a + b) / 2) - math.lgamma(a / 2) - math.lgamma(b / 2)) * (a / b) ** (a / 2)
    inside = _integral(lambda x: scale * x ** (a / 2 - 1) * (1 + a * x / b) ** (-(a + b) / 2), 0, f)
    assert f_tail(f, a, b) == pytest.approx(1 - inside, abs=1e-6)


@pytest.mark.parametrize("x, df", [(0.5, 2), (3.0, 4), (20.0, 4), (7.0, 9), (40.0, 30), (100.0, 120)])
def test_chi_tail(x, df):
    inside = _integral(lambda t: t ** (df / 2 - 1) * np.exp(-t / 2) / (2 ** (df / 2) * math.gamma(df / 2)), 0, x)
    assert chi_tail(x, df) == pytest.approx(1 - inside, abs=1e-6)


def test_far_tails_keep_their_scale():
    assert chi_tail(600.0, 2) == pytest.approx(math.exp(-300), rel=1e-9)
    assert f_tail(400.0, 2, 1000) == pytest.approx((1 + 2 * 400 / 1000) ** -500, rel=1e-9)
    assert f_tail(0.0, 3, 5) == 1.0 and chi_tail(0.0, 3) == 1.0


def _rows(n=600):
    draw = np.random.default_rng(5)
    kind = draw.integers(0, 3, n)
    return [(int(k), float(draw.normal()), float(draw.normal() + 0.5 * k), float(1e9 + draw.normal() + 0.2 * k), 7.0, float(k),
             str(int(draw.integers(0, 4))), str(int((k + draw.integers(0, 2)) % 3)), None) for k in kind]


SCHEMA = "kind int, noise double, strong double, offset double, same double, copy double, chance string, related string, nothing double"


@pytest.fixture(scope="module")
def frame(spark):
    rows = _rows()
    extra = [(None, 1.0, 1.0, 1e9, 7.0, 1.0, "0", "0", None), (1, None, float("nan"), None, None, None, None, None, None)]
    return spark.createDataFrame(rows + extra, SCHEMA).repartition(7), rows


def test_anova(frame):
    df, rows = frame
    found = {r["feature"]: r for r in anova_scores(df, ["noise", "strong", "offset", "same", "copy", "nothing"], "kind").collect()}
    kinds = np.array([r[0] for r in rows])
    for name, at in (("noise", 1), ("strong", 2), ("offset", 3)):
        x = np.array([r[at] for r in rows])
        x = x - x.mean()
        groups = [x[kinds == k] for k in range(3)]
        within = sum(((g - g.mean()) ** 2).sum() for g in groups)
        f = sum(len(g) * g.mean() ** 2 for g in groups) / 2 / (within / (len(x) - 3))
        assert found[name]["statistic"] == pytest.approx(f, rel=1e-5)
        assert (found[name]["df1"], found[name]["df2"]) == (2, 597)
        assert found[name]["p_value"] == pytest.approx(float(f_tail(f, 2, 597)), rel=1e-4)
    assert found["strong"]["p_value"] < 1e-10 < found["noise"]["p_value"]
    assert found["same"]["statistic"] is None and found["same"]["p_value"] is None
    assert found["copy"]["statistic"] == math.inf and found["copy"]["p_value"] == 0.0
    assert "nothing" not in found


def test_regression(frame):
    df, rows = frame
    found = {r["feature"]: r for r in regression_scores(df, ["noise", "strong", "same", "nothing"], "kind").collect()}
    r = np.corrcoef([r[2] for r in rows], [r[0] for r in rows])[0, 1]
    assert found["strong"]["statistic"] == pytest.approx(r * r / (1 - r * r) * 598)
    assert found["strong"]["p_value"] < 1e-10 < found["noise"]["p_value"]
    assert found["same"]["statistic"] is None and found["nothing"]["statistic"] is None


def test_contingency(frame):
    df, rows = frame
    found = {r["feature"]: r for r in contingency_scores(df, ["chance", "related", "same"], "kind").collect()}
    for name, at in (("chance", 6), ("related", 7)):
        values, kinds = sorted({r[at] for r in rows}), sorted({r[0] for r in rows})
        table = np.array([[sum(r[at] == v and r[0] == k for r in rows) for k in kinds] for v in values], dtype=float)
        expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
        seen = table > 0
        assert found[name]["statistic"] == pytest.approx(((table - expected) ** 2 / expected).sum())
        information = (table[seen] * np.log(table[seen] / expected[seen])).sum() / table.sum()
        assert found[name]["mutual_information"] == pytest.approx(information)
        assert found[name]["df"] == (len(values) - 1) * (len(kinds) - 1)
    assert found["related"]["p_value"] < 1e-20 < found["chance"]["p_value"]
    assert found["same"]["df"] == 0 and found["same"]["p_value"] == 1.0


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert anova_scores(none, ["noise"], "kind").count() == 0
    assert contingency_scores(none, ["chance"], "kind").count() == 0
    assert [r["statistic"] for r in regression_scores(none, ["noise"], "kind").collect()] == [None]


def test_selections(spark):
    scores = spark.createDataFrame(
        [("a", 9.0, 0.001), ("b", 5.0, 0.02), ("c", 4.0, 0.03), ("d", 1.0, 0.2), ("e", 4.0, 0.03), ("f", None, None)],
        "feature string, statistic double, p_value double")
    assert select_by(scores, "k_best", 3) == ["a", "b", "c"]
    assert select_by(scores, "percentile", 50) == ["a", "b", "c"]
    assert select_by(scores, "fpr", 0.025) == ["a", "b"]
    assert select_by(scores, "fwe", 0.05) == ["a"]
    assert select_by(scores, "fdr", 0.05) == ["a", "b", "c", "e"]  # 0.03 is under 0.05 * 4 / 6, so all up to it
    assert select_by(scores, "fdr", 0.0005) == []
    with pytest.raises(ValueError):
        select_by(scores, "best", 1)
