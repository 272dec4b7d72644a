import math

import numpy as np
import pandas as pd
import pytest

from vitalgrid.operators import window_features as WF

RNG = np.random.default_rng(5)
WINDOWS = {
    1: RNG.normal(50, 9, 30), 2: np.full(30, 7.0), 3: np.tile([1.0, 2.0, 2.0], 10), 4: np.cumsum(RNG.normal(size=30)),
    5: RNG.integers(0, 4, 30).astype(float), 6: np.arange(30.0), 7: RNG.normal(size=7), 8: RNG.normal(size=64), 9: np.array([3.0, 1.0]),
    10: 1e6 + RNG.normal(size=30), 11: np.array([4.0])}


@pytest.fixture(scope="module")
def windowed(spark):
    rows = [(1, "m", k, t, float(v)) for k, x in WINDOWS.items() for t, v in enumerate(x)]
    return spark.createDataFrame(rows, "user_id long, metric string, win int, t int, value double").repartition(3)


def by_window(df):
    return {r.win: r for r in df.collect()}


def same(a, b, tolerance=1e-9):
    return a is b is None or (a is not None and b is not None and abs(a - b) <= tolerance * max(1.0, abs(b)))


def test_autoregression_solves_yule_walker(windowed):
    for adjusted in (True, False):
        got = by_window(WF.autoregression(windowed, 3, adjusted))
        assert set(got) == set(WINDOWS)
        for k, x in WINDOWS.items():
            c, n = x - x.mean(), len(x)
            if n < 7 or c.std() == 0:
                assert got[k].pacf_3 is None
                continue
            r = [(c[: n - h] * c[h:]).sum() / (n - h if adjusted else n) for h in range(4)]
            for order in (1, 2, 3):
                toeplitz = np.array([[r[abs(i - j)] for j in range(order)] for i in range(order)])
                want = np.linalg.solve(toeplitz, r[1 : order + 1])
                assert same(got[k][f"pacf_{order}"], want[-1], 1e-7)
            assert all(same(got[k][f"ar_{j + 1}"], want[j], 1e-7) for j in range(3))


def entropy(codes):
    _, counts = np.unique(codes, return_counts=True)
    p = counts / counts.sum()
    return float(-(p * np.log(p)).sum())


def matches(x, m):
    """Sub-sequences of m values within the tolerance of each, itself among them, comparing all pairs."""
    tolerance = WF.TOLERANCE * x.std() * (1 + WF.HAIR)
    parts = np.array([x[i : i + m] for i in range(len(x) - m + 1)])
    return (np.abs(parts[:, None] - parts[None]).max(-1) <= tolerance).sum(1) if len(parts) else np.zeros(0)


def test_entropies_against_all_pairs(windowed):
    got = by_window(WF.entropies(windowed))
    for k, x in WINDOWS.items():
        low, high = x.min(), x.max()
        bins = np.minimum(np.floor((x - low) / (high - low) * 10), 9) if high > low else np.zeros(len(x))
        assert same(got[k].binned_entropy, entropy(bins))
        for order in WF.ORDERS:
            codes = [hash(tuple(np.argsort(x[i : i + order], kind="stable"))) for i in range(len(x) - order + 1)]
            assert same(got[k][f"permutation_entropy_{order}"], entropy(codes) if codes else None)
        two, three = matches(x, 2), matches(x, 3)
        b, a = (two - 1).sum(), (three - 1).sum()
        assert same(got[k].sample_entropy, -math.log(a / b) if a > 0 and b > 0 else None)
        if len(three):
            phi = [np.log(c / len(c)).mean() for c in (two, three)]
            assert same(got[k].approximate_entropy, abs(phi[0] - phi[1]))
    assert got[2].binned_entropy == got[2].permutation_entropy_3 == 0


def test_spectra_against_direct_sums(windowed):
    got = by_window(WF.spectral(windowed))
    for k, x in WINDOWS.items():
        n = len(x)
        direct = [abs(sum(v * np.exp(-2j * np.pi * f * t / n) for t, v in enumerate(x))) for f in range(n // 2 + 1)]
        assert np.allclose(got[k].fft_abs, direct, rtol=1e-9, atol=1e-6 if k == 10 else 1e-9)
        share = np.array(direct) / sum(direct)
        centroid = (share * np.arange(len(share))).sum()
        assert same(got[k].spectral_centroid, centroid, 1e-8)
        variance = (share * (np.arange(len(share)) - centroid) ** 2).sum()
        if variance > 0.51:
            assert same(got[k].spectral_skew, (share * (np.arange(len(share)) - centroid) ** 3).sum() / variance**1.5, 1e-6)
            assert same(got[k].spectral_kurtosis, (share * (np.arange(len(share)) - centroid) ** 4).sum() / variance**2, 1e-6)
        elif variance < 0.49:
            assert got[k].spectral_skew is None


def test_density_of_overlapping_segments():
    x = RNG.normal(size=(3, 100))
    for segment in (100, 40, 7):
        got = WF.welch(x, segment)
        hann = np.array([0.5 - 0.5 * math.cos(2 * math.pi * t / segment) for t in range(segment)])
        for row, power in zip(x, got):
            parts = []
            for lo in range(0, 100 - segment + 1, segment - segment // 2):
                part = (row[lo : lo + segment] - row[lo : lo + segment].mean()) * hann
                p = np.array([abs(sum(v * np.exp(-2j * np.pi * f * t / segment) for t, v in enumerate(part))) ** 2 for f in range(segment // 2 + 1)])
                p[1 : (segment + 1) // 2] *= 2
                parts.append(p / (hann**2).sum())
            assert np.allclose(power, np.mean(parts, axis=0))


def solution(design, y):
    """Coefficients and t of the last column by numpy; None where singular or without error."""
    if len(y) < design.shape[1] or np.linalg.matrix_rank(design, 1e-5 * np.linalg.norm(design)) < design.shape[1]:
        return None, None
    b, *_ = np.linalg.lstsq(design, y, rcond=None)
    rss, free = ((y - design @ b) ** 2).sum(), len(y) - design.shape[1]
    if free <= 0 or rss <= 1e-12 * (y**2).sum():
        return b, None
    return b, b[-1] / math.sqrt(rss / free * np.linalg.inv(design.T @ design)[-1, -1])


def test_unit_root_against_numpy(windowed):
    for lags in (1, 2):
        got = by_window(WF.unit_root(windowed, lags))
        assert set(got) == set(WINDOWS)
        for k, x in WINDOWS.items():
            if len(x) < 4 or x.std() == 0:
                assert got[k].adf_t is None
                continue
            z = (x - x.mean()) / x.std()
            step = np.diff(z)
            design = np.column_stack([np.ones(len(step) - lags), *[step[lags - h : len(step) - h] for h in range(1, lags + 1)], z[lags:-1]])
            b, t = solution(design, step[lags:])
            assert same(got[k].adf_t, t, 1e-6) and same(got[k].adf_level, None if b is None else b[-1], 1e-6)
    assert got[6].adf_t is None  # a straight line: its steps are constant


def test_drift_against_numpy(windowed):
    got = by_window(WF.drift(windowed))
    for k, x in WINDOWS.items():
        if len(x) < 7 or x.std() == 0:
            assert got[k].drift_0 is None
            continue
        z = (x - x.mean()) / x.std()
        rows = pd.DataFrame({"v": x[:-1], "z": z[:-1], "step": np.diff(z)}).sort_values("v", kind="stable")
        rows["bin"] = [b for b, part in enumerate(np.array_split(np.arange(len(rows)), 10)) for _ in part]
        u = rows.groupby("bin")[["z", "step"]].mean()
        b, _ = solution(np.vander(u["z"].to_numpy(), 4, increasing=True), u["step"].to_numpy())
        assert all(same(got[k][f"drift_{p}"], None if b is None else b[p], 1e-6) for p in range(4))
    assert got[3].drift_0 is None  # two values cannot determine a cubic


def test_empty_input(spark, windowed):
    none = windowed.limit(0)
    for f in (WF.autoregression, WF.entropies, WF.spectral, WF.unit_root, WF.drift):
        assert f(none).count() == 0
