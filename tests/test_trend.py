import numpy as np
import pytest
from pyspark.sql import functions as F

from test_operators import days
from vitalgrid.operators import forecast as FC, trend as TR

KNOTS = 12
PLACES = TR.KNOT_RANGE * np.arange(1, KNOTS + 1) / KNOTS


def series(seed, n=200):
    rng = np.random.default_rng(seed)
    u = np.arange(n) / (n - 1)
    bends = np.zeros(KNOTS)
    bends[rng.choice(KNOTS, 2, replace=False)] = rng.choice([-3.0, 3.0], 2)
    return 20 + 5 * u + np.maximum(u[:, None] - PLACES, 0) @ bends * 10 + rng.normal(0, 0.05, n), bends


def brute(y, prior=TR.PRIOR, rounds=200_000):
    """Level, slope and bends by proximal gradient steps on all rows, and the objective as a function."""
    u, scale = np.arange(len(y)) / (len(y) - 1), np.abs(y).max()
    v = y / scale
    noise = (np.diff(v) ** 2).sum() / (2 * (len(v) - 1))
    x = np.column_stack([np.ones_like(u), u, np.maximum(u[:, None] - PLACES, 0)])
    lam = noise / prior

    def objective(b):
        return ((v - x @ b) ** 2).sum() / 2 + lam * np.abs(b[2:]).sum()

    step, b, z, k = 1 / np.linalg.eigvalsh(x.T @ x)[-1], np.zeros(KNOTS + 2), np.zeros(KNOTS + 2), 1.0
    g, c = x.T @ x, x.T @ v
    for _ in range(rounds):
        new = z - step * (g @ z - c)
        new[2:] = np.sign(new[2:]) * np.maximum(np.abs(new[2:]) - lam * step, 0)
        ahead = (1 + np.sqrt(1 + 4 * k * k)) / 2
        z, b, k = new + (k - 1) / ahead * (new - b), new, ahead
    return b, objective


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_gradient_steps(spark, seed):
    y, planted = series(seed)
    got = TR.sparse_trend(days(spark, y), KNOTS).first()
    want, objective = brute(y, rounds=30_000)
    own = np.array([got.level, got.slope, *got.bends])
    assert objective(own) <= objective(want) * (1 + 1e-6)
    assert np.allclose(own, want, atol=5e-3)
    assert sum(abs(b) < 1e-9 for b in got.bends) >= 4  # most places do not bend
    size = np.abs(np.array(got.bends))
    for k in np.flatnonzero(planted):  # each planted bend is found within one knot
        assert size[max(0, k - 1) : k + 2].max() > 0.5 * size.max()


def test_short_and_constant_series(spark):
    for values, level in (([5.0], 1.0), ([7.0] * 30, 1.0), ([0.0] * 5, 0.0)):
        got = TR.sparse_trend(days(spark, values)).first()
        assert got.level == pytest.approx(level) and got.slope == pytest.approx(0, abs=1e-9) and np.allclose(got.bends, 0, atol=1e-9)
    holed = days(spark, [-1.0, 3.0, -1.0, 4.0]).withColumn("y", F.when(F.col("y") > 0, F.col("y")))
    assert TR.sparse_trend(holed).first().span == 2
    assert TR.sparse_trend(holed.where("y is null")).count() == 0


def test_band_widens_like_simulated_bends(spark):
    y, _ = series(4)
    fc = FC.bending_forecast(days(spark, y), FC.Model(weekly=False, yearly=False), 60).orderBy("ds").collect()
    width = np.array([r.yhat_upper - r.yhat_lower for r in fc[-60:]]) / (2 * FC.Z80)
    assert (np.diff(width) > 0).all()
    t = TR.sparse_trend(days(spark, y), KNOTS).first()
    rng, h = np.random.default_rng(1), 60 / t.span
    size = np.abs(t.bends).mean()
    ends = []
    for _ in range(20_000):
        at = rng.uniform(0, h, rng.poisson(KNOTS * h))
        ends.append((rng.laplace(0, size, len(at)) * (h - at)).sum())
    sigma = (fc[0].yhat_upper - fc[0].yhat_lower) / (2 * FC.Z80)
    assert width[-1] == pytest.approx(np.sqrt(sigma**2 + (t.scale * np.std(ends)) ** 2), rel=0.05)


def test_sums_by_stretch_give_the_whole_system(spark):
    """The sums of a series do not depend on how its rows are dealt, and add up to those of all rows."""
    y, _ = series(5)
    df = days(spark, y)
    a, b = TR.sparse_trend(df.repartition(7)).first(), TR.sparse_trend(df.coalesce(1)).first()
    assert np.allclose(a.bends, b.bends, atol=1e-9)
    sums = TR.stretch_sums(df, KNOTS).agg(*[F.sum(c).alias(c) for c in ("n", "u", "v", "steps")]).first()
    assert (sums.n, sums.steps) == (200, 199) and sums.u == pytest.approx(100) and sums.v == pytest.approx((y / np.abs(y).max()).sum())
