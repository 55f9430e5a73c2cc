import math
import random

import numpy as np
import pytest

from ledgerline.functions.student import slope_p_value
from ledgerline.operators.regression import ols, ols_long, with_trend_line


def series_p(n, r2):
    """Finite trigonometric series of the t distribution."""
    nu = n - 2
    s, c2 = math.sqrt(r2), 1 - r2
    if nu % 2 == 0:
        total, term = 0.0, 1.0
        for j in range(nu // 2):
            total += term
            term *= c2 * (2 * j + 1) / (2 * j + 2)
        return 1 - s * total
    total, term = 0.0, 1.0
    for j in range((nu - 1) // 2):
        total += term
        term *= c2 * (2 * j + 2) / (2 * j + 3)
    return 1 - 2 / math.pi * (math.asin(s) + s * math.sqrt(c2) * total)


@pytest.fixture
def p_values(spark):
    """The p-values of some (n, R^2), in order."""

    def compute(n, r2):
        pairs = [(k, float(a), None if b is None else float(b)) for k, (a, b) in enumerate(zip(n, r2, strict=True))]
        df = spark.createDataFrame(pairs, "k int, n double, r2 double").select("k", slope_p_value("n", "r2").alias("p"))
        return [r["p"] for r in df.orderBy("k").collect()]

    return compute


def test_p_value_against_series(p_values):
    points = [(n, r2) for n in (3, 4, 6, 7, 20, 67, 131, 335, 8158, 81466) for r2 in (1e-9, 1e-6, 0.0001, 0.007, 0.1, 0.5, 0.9, 0.999)]
    got = p_values(*zip(*points, strict=True))
    assert got == pytest.approx([series_p(n, r2) for n, r2 in points], abs=2e-10)


def test_p_value_table_points(p_values):
    nus = {2.2281: 10, 12.706: 1}
    for t, nu in nus.items():
        assert p_values([nu + 2], [t * t / (t * t + nu)])[0] == pytest.approx(0.05, abs=1e-4)
    assert p_values([335], [0.007])[0] == pytest.approx(0.126, abs=1e-3)
    assert p_values([10, 10, 10**9], [0.0, 1.0, 4e-9]) == pytest.approx([1.0, 0.0, 0.0455], abs=1e-4)
    assert p_values([2, 1, 0, 10], [0.5, 0.5, 0.5, None]) == [None] * 4


def fit(spark, points, **kw):
    df = spark.createDataFrame(points, "x double, y double")
    return ols(df, "x", {"m": "y"}, **kw).first().asDict()


def test_exact_and_minimum_pairs(spark):
    five = [(float(i), 2.0 * i + 1) for i in range(5)]
    assert fit(spark, five) == {"m_n": 5, "m_beta": None, "m_r2": None, "m_pvalue": None}
    got = fit(spark, five + [(5.0, 11.0), (None, 1.0), (2.0, None)])
    assert got["m_n"] == 6 and got["m_beta"] == pytest.approx(2) and got["m_r2"] == pytest.approx(1)
    assert got["m_pvalue"] == pytest.approx(0, abs=1e-6)


def test_degenerate_regressor_and_response(spark):
    assert fit(spark, [(1.0, float(i)) for i in range(8)]) == {"m_n": 8, "m_beta": None, "m_r2": None, "m_pvalue": None}
    flat = fit(spark, [(float(i), 3.0) for i in range(8)])
    assert flat["m_beta"] == pytest.approx(0) and flat["m_r2"] is None and flat["m_pvalue"] is None


def test_groups_long_form_and_trend(spark):
    rnd = random.Random(1)
    points = [(k, rnd.random(), rnd.random(), rnd.random()) for k in "ab" for _ in range(30)]
    df = spark.createDataFrame(points, "k string, x double, y double, z double")
    wide = {r.k: r for r in ols(df, "x", {"m": "y", "q": "z"}, by=["k"]).collect()}
    for k in "ab":
        xs, ys = [p[1] for p in points if p[0] == k], [p[2] for p in points if p[0] == k]
        mx, my = sum(xs) / 30, sum(ys) / 30
        sxy = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
        sxx, syy = sum((x - mx) ** 2 for x in xs), sum((y - my) ** 2 for y in ys)
        assert wide[k].m_beta == pytest.approx(sxy / sxx)
        assert wide[k].m_r2 == pytest.approx(sxy**2 / sxx / syy)
        assert wide[k].m_pvalue == pytest.approx(series_p(30, sxy**2 / sxx / syy), abs=1e-9)
    pooled = ols_long(ols(df, "x", {"m": "y", "q": "z"}), ["m", "q"])
    assert [(r.response, r.n) for r in pooled.orderBy("response").collect()] == [("m", 60), ("q", 60)]
    line = with_trend_line(df, "x", "y").select("x", "trend").distinct().collect()
    slopes = {round((b.trend - a.trend) / (b.x - a.x), 6) for a, b in zip(line, line[1:]) if abs(a.x - b.x) > 0.05}
    assert len(slopes) == 1


@pytest.mark.parametrize("n", [1e7, 1e9, 1e12])
def test_p_value_meets_the_normal_limit(p_values, n):
    ts = [0.01, 1.7, 1.96, 5.0]
    # The t tail is the normal tail with its first correction in 1/n.
    density = [math.exp(-t * t / 2) / math.sqrt(2 * math.pi) for t in ts]
    expected = [math.erfc(t / math.sqrt(2)) + 2 * d * (t**3 + t) / (4 * (n - 2)) for t, d in zip(ts, density, strict=True)]
    assert p_values([n] * 4, [t * t / (t * t + n - 2) for t in ts]) == pytest.approx(expected, rel=1e-9)


@pytest.mark.parametrize("t", [0.01, 1.0, 1.96, 3.0, 5.0, 10.0, 20.0, 30.0])
def test_p_value_has_no_seam(p_values, t):
    """One formula for every sample size: p falls evenly with n, at a million as elsewhere."""
    for middle in (64, 130, 1000, 10**6):
        ns = [middle - 1, middle, middle + 1, middle + 2]
        p = p_values(ns, [t * t / (t * t + n - 2) for n in ns])
        ratios = [math.log(b / a) for a, b in zip(p, p[1:], strict=False)]
        assert all(-1 < r < 1e-10 for r in ratios)
        assert max(ratios) - min(ratios) <= 0.1 * abs(ratios[0]) + 1e-10


def test_p_value_keeps_its_digits_in_far_tails(p_values):
    """For two degrees of freedom the tail is 1 - sqrt(R^2) exactly; for four it is a cubic of it."""
    r2 = [1e-12, 1e-6, 0.3, 0.999999, 1 - 1e-12]
    two = [(1 - x) / (1 + math.sqrt(x)) for x in r2]
    four = [(1 - math.sqrt(x)) ** 2 * (2 + math.sqrt(x)) / 2 for x in r2]
    assert p_values([4] * 5, r2) == pytest.approx(two, rel=1e-9, abs=0)
    assert p_values([6] * 4, r2[:4]) == pytest.approx(four[:4], rel=1e-8, abs=0)


def test_p_value_is_smooth_in_small_samples(p_values):
    n = np.arange(3, 400)
    p = np.array(p_values(n, 4.0 / (4.0 + n - 2)))
    assert (np.diff(p) < 0).all() and (np.diff(p, 2) > 0).all()


def test_fits_run_without_python(spark):
    df = spark.range(50).selectExpr("cast(id as double) as x", "cast(id * id as double) as y")
    assert "Python" not in ols(df, "x", {"m": "y"})._jdf.queryExecution().executedPlan().toString()
