"""Features of windows that need more than sums: autoregression, entropies, spectra, small regressions.

All take the long windows of ``features.windows`` (keys, win, t, value) and return one row a window. Windows cluster on
the series key, so that each family costs no shuffle beyond the one that built the windows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.schema import KEYS

DOUBLES = "array<double>"


def gathered(windowed: DataFrame, keys=KEYS) -> DataFrame:
    """Each window's values as an array ``x`` in order of ``t``."""
    rows = F.array_sort(F.collect_list(F.struct("t", "value")))
    return windowed.groupBy(*keys, "win").agg(F.transform(rows, lambda r: r["value"]).alias("x"))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


# --- autoregression -------------------------------------------------------------------------------

def autocovariances(c: Column, lags: int, adjusted: bool = True) -> Column:
    """Covariances of a centred array with itself at lag 0 .. ``lags``; divided by the pairs, or by all values."""
    n = F.size(c)

    def at(h: Column) -> Column:
        left = F.greatest(n - h, F.lit(0))
        products = F.zip_with(F.slice(c, F.lit(1), left), F.slice(c, h + 1, left), lambda a, b: a * b)
        return F.when(n > h, total(products) / (n - h if adjusted else n).cast("double"))

    return F.transform(F.sequence(F.lit(0), F.lit(lags)), at)


def levinson(r: Column, order: int) -> Column:
    """Levinson-Durbin recursion over autocovariances: struct of coefficients ``a`` and partial autocorrelations ``p``.

    Null from the order on at which nothing is left to explain, so always for constant windows.
    """
    none = F.array().cast(DOUBLES)

    def step(s: Column, h: Column) -> Column:
        known = total(F.zip_with(s["a"], F.reverse(F.slice(r, F.lit(2), h - 1)), lambda a, b: a * b))
        k = F.when(F.abs(s["v"]) > 1e-12 * r[0], (r[h] - known) / s["v"])
        a = F.concat(F.zip_with(s["a"], F.reverse(s["a"]), lambda x, y: x - k * y), F.array(k))
        return F.struct(a.alias("a"), (s["v"] * (1.0 - k * k)).alias("v"), F.concat(s["p"], F.array(k)).alias("p"))

    start = F.struct(none.alias("a"), r[0].alias("v"), none.alias("p"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(order)), start, step)


def autoregression(windowed: DataFrame, order: int = 4, adjusted: bool = True, keys=KEYS) -> DataFrame:
    """``ar_1`` .. and ``pacf_1`` .. up to ``order`` (Yule-Walker); null where a window has no such lag or no spread."""
    mean = total(F.col("x")) / F.size("x")
    centred = gathered(windowed, keys).withColumn("_mu", mean).withColumn("_c", F.transform("x", lambda v: v - F.col("_mu")))
    fitted = centred.withColumn("_r", autocovariances(F.col("_c"), order, adjusted)).withColumn("_f", levinson(F.col("_r"), order))
    return fitted.select(*keys, "win", *[F.col("_f.a")[h].alias(f"ar_{h + 1}") for h in range(order)],
                         *[F.col("_f.p")[h].alias(f"pacf_{h + 1}") for h in range(order)])


# --- entropies ------------------------------------------------------------------------------------

#: Tolerance of matches in deviations; a hair more, so that exact ties fall alike everywhere.
TOLERANCE, HAIR = 0.2, 1e-9
BINS, ORDERS = 10, (3, 5)


def code_entropy(codes: Column) -> Column:
    """Entropy of a sorted array of integer codes, from its runs."""
    n = F.size(codes).cast("double")

    def part(run: Column) -> Column:
        return F.when(run > 0, run / n * F.log(run / n)).otherwise(0.0)

    def step(s: Column, code: Column) -> Column:
        return F.when(code == s["code"], F.struct(s["code"].alias("code"), (s["run"] + 1).alias("run"), s["sum"].alias("sum"))).otherwise(
            F.struct(code.alias("code"), F.lit(1).alias("run"), (s["sum"] + part(s["run"])).alias("sum")))

    start = F.struct(F.lit(-1).cast("long").alias("code"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"))
    return F.aggregate(codes, start, step, lambda s: -(s["sum"] + part(s["run"])))


def order_codes(x: Column, order: int) -> Column:
    """Integer code of the order pattern of ``order`` neighbours; of equal values the earlier counts as smaller."""
    pairs = [(a, b) for a in range(order) for b in range(a + 1, order)]

    def code(i: Column) -> Column:
        bits = [F.when(F.element_at(x, i + a) <= F.element_at(x, i + b), 1 << k).otherwise(0) for k, (a, b) in enumerate(pairs)]
        return reduce(lambda p, q: p + q, bits).cast("long")

    return F.when(F.size(x) >= order, F.transform(F.sequence(F.lit(1), F.size(x) - (order - 1)), code))


def bin_codes(x: Column, low: Column, high: Column, bins: int = BINS) -> Column:
    """Number of the equal-width bin of each value; one bin where all are equal."""
    return F.transform(x, lambda v: F.when(high > low, F.least(F.floor((v - low) / (high - low) * bins), F.lit(bins - 1))).otherwise(0).cast("long"))


def match_entropies(windowed: DataFrame, keys=KEYS) -> DataFrame:
    """``sample_entropy`` and ``approximate_entropy`` of two and three neighbours.

    Values are cells of the tolerance's width; a sub-sequence is only compared with those whose first value lies in its
    own or a neighbouring cell, found through the sorted cells. Null where a window is too short or nothing matches twice.
    """
    part = [*keys, "win"]
    w = Window.partitionBy(*part)
    seq = w.orderBy("t")
    tolerance = TOLERANCE * F.stddev_pop("value").over(w) * (1 + HAIR)
    cell = F.when(F.col("tol") > 0, F.floor((F.col("a") - F.col("_low")) / (F.col("tol") * (1 + 1e-6)))).otherwise(0).cast("long")
    runs = (windowed.select(*part, F.col("value").alias("a"), F.lead("value", 1).over(seq).alias("b"), F.lead("value", 2).over(seq).alias("c"),
                            tolerance.alias("tol"), F.min("value").over(w).alias("_low"))
            .where(F.col("b").isNotNull()).withColumn("cell", cell))
    cells = runs.groupBy(*part, "cell").agg(F.max("tol").alias("tol"), F.collect_list(F.struct("a", "b", "c")).alias("own"))
    by_cell = Window.partitionBy(*part).orderBy("cell")
    none = F.slice("own", 1, 0)
    cells = cells.withColumns({
        "_before": F.when(F.lag("cell").over(by_cell) == F.col("cell") - 1, F.lag("own").over(by_cell)),
        "_after": F.when(F.lead("cell").over(by_cell) == F.col("cell") + 1, F.lead("own").over(by_cell))})
    cells = cells.withColumn("near", F.concat(F.coalesce("_before", none), "own", F.coalesce("_after", none)))

    def close(s: Column, o: Column, *names: str) -> Column:
        return reduce(lambda p, q: p & q, [F.abs(s[k] - o[k]) <= F.col("tol") for k in names])

    counted = F.transform("own", lambda s: F.struct(
        F.size(F.filter("near", lambda o: close(s, o, "a", "b"))).alias("two"),
        F.when(s["c"].isNotNull(), F.size(F.filter("near", lambda o: o["c"].isNotNull() & close(s, o, "a", "b", "c")))).alias("three")))
    each = cells.select(*part, F.inline(counted))

    def phi(c: str) -> Column:
        return F.avg(F.log(c)) - F.log(F.count(c))

    matched = each.groupBy(*part).agg(F.sum(F.col("two") - 1).alias("_b"), F.sum(F.col("three") - 1).alias("_a"), F.abs(phi("two") - phi("three")).alias("approximate_entropy"))
    sample = F.when((F.col("_a") > 0) & (F.col("_b") > 0), -F.log(F.col("_a") / F.col("_b")))
    return matched.select(*part, sample.alias("sample_entropy"), "approximate_entropy")


def entropies(windowed: DataFrame, keys=KEYS) -> DataFrame:
    """``match_entropies``, ``binned_entropy`` and ``permutation_entropy`` of each order; 0 for constant windows."""
    # columns of their own, as a lambda evaluates whatever else it holds for every value
    x = gathered(windowed, keys).withColumns({"low": F.array_min("x"), "high": F.array_max("x")})
    codes = {"binned_entropy": bin_codes(F.col("x"), F.col("low"), F.col("high"))} | {f"permutation_entropy_{k}": order_codes(F.col("x"), k) for k in ORDERS}
    x = x.select(*keys, "win", *[F.array_sort(c).alias(name) for name, c in codes.items()])
    coded = x.select(*keys, "win", *[code_entropy(F.col(name)).alias(name) for name in codes])
    return coded.join(match_entropies(windowed, keys), [*keys, "win"], "left")


# --- spectra --------------------------------------------------------------------------------------

SPECTRUM = "centroid double, variance double, skew double, kurtosis double, magnitude array<double>, density array<double>"
#: Values of a segment of the density estimate; longer windows are cut into half overlapping segments.
SEGMENT = 256
#: Below this variance of the spectrum its higher moments say nothing.
LEAST_VARIANCE = 0.5


def welch(x: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """One-sided power density of each row: centred Hann segments that overlap by half, averaged."""
    n = min(segment, x.shape[1])
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n) if n > 1 else np.ones(1)
    starts = range(0, x.shape[1] - n + 1, max(1, n - n // 2))
    parts = np.stack([x[:, s : s + n] for s in starts], axis=1)
    power = np.abs(np.fft.rfft((parts - parts.mean(axis=2, keepdims=True)) * hann, axis=2)) ** 2 / (hann**2).sum()
    power[:, :, 1 : (n + 1) // 2] *= 2
    return power.mean(axis=1)


def spectra(x: np.ndarray) -> pd.DataFrame:
    """Spectral moments, magnitudes and density of rows of one length, which may be any: numpy splits it into its factors."""
    size = np.abs(np.fft.rfft(x, axis=1))
    k = np.arange(size.shape[1])
    weight = size.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        m = [(size * k**p).sum(axis=1) / weight for p in range(5)]
        variance = m[2] - m[1] ** 2
        wide = variance >= LEAST_VARIANCE
        skew = np.where(wide, (m[3] - 3 * m[1] * variance - m[1] ** 3) / np.abs(variance) ** 1.5, np.nan)
        kurtosis = np.where(wide, (m[4] - 4 * m[1] * m[3] + 6 * m[2] * m[1] ** 2 - 3 * m[1] ** 4) / variance**2, np.nan)
    out = pd.DataFrame({"centroid": m[1], "variance": variance, "skew": skew, "kurtosis": kurtosis})
    return out.assign(magnitude=list(size), density=list(welch(x)))


def spectrum(x: pd.Series) -> pd.DataFrame:
    """``spectra`` of arrays of any lengths; null for empty ones."""
    lengths = x.map(len)
    out = pd.DataFrame(index=x.index, columns=["centroid", "variance", "skew", "kurtosis", "magnitude", "density"], dtype=object)
    for n in lengths.unique():
        if n:
            rows = lengths == n
            out[rows] = spectra(np.stack(x[rows].to_list()).astype(float)).set_index(x.index[rows]).astype(object)
    reals = ["centroid", "variance", "skew", "kurtosis"]
    return out.assign(**{c: out[c].astype(float) for c in reals})


DENSITIES = (2, 5, 8)


def spectral(windowed: DataFrame, keys=KEYS) -> DataFrame:
    """``spectral_*`` moments of the magnitudes, all magnitudes as ``fft_abs`` and ``welch_density_*`` at a few frequencies."""
    s = gathered(windowed, keys).select(*keys, "win", F.pandas_udf(spectrum, SPECTRUM)("x").alias("_s"))
    return s.select(*keys, "win", *[F.nanvl(F.col(f"_s.{c}"), F.lit(None).cast("double")).alias(f"spectral_{c}") for c in ("centroid", "variance", "skew", "kurtosis")],
                    F.col("_s.magnitude").alias("fft_abs"), *[F.get(F.col("_s.density"), F.lit(k)).alias(f"welch_density_{k}") for k in DENSITIES])


# --- small regressions ----------------------------------------------------------------------------

#: Share of its own sum of squares below which a column counts as explained by the ones before it, and a fit as perfect.
SINGULAR, PERFECT = 1e-10, 1e-12


def least_squares(rows: DataFrame, by, design, target: str) -> DataFrame:
    """Least squares by group: ``b_<column>`` of the design, ``rss``, ``rows`` and ``t_last``, the t statistic of the last one.

    Sums of products are added up where rows are read; the normal equations are then solved by Cholesky factors in
    column expressions. Rows with a null are left out. Singular groups, and those without a degree of freedom, give null.
    """
    k, by = len(design), list(by)
    whole = rows.dropna(subset=[*design, target])
    sums = [F.sum(F.col(design[i]) * F.col(design[j])).alias(f"_s{i}{j}") for i in range(k) for j in range(i + 1)]
    sums += [F.sum(F.col(d) * F.col(target)).alias(f"_c{i}") for i, d in enumerate(design)]
    out = whole.groupBy(*by).agg(*sums, F.sum(F.col(target) * F.col(target)).alias("_yy"), F.count(F.lit(1)).alias("rows"))

    def less(first: Column, *products: tuple[str, str]) -> Column:
        return reduce(lambda s, p: s - F.col(p[0]) * F.col(p[1]), products, first)

    for j in range(k):
        pivot = less(F.col(f"_s{j}{j}"), *[(f"_l{j}{p}", f"_l{j}{p}") for p in range(j)])
        out = out.withColumn(f"_l{j}{j}", F.when((pivot > SINGULAR * F.col(f"_s{j}{j}")) & (F.col("rows") >= k), F.sqrt(F.greatest(pivot, F.lit(0.0)))))
        out = out.withColumns({f"_l{i}{j}": less(F.col(f"_s{i}{j}"), *[(f"_l{i}{p}", f"_l{j}{p}") for p in range(j)]) / F.col(f"_l{j}{j}")
                               for i in range(j + 1, k)} | {
            f"_z{j}": less(F.col(f"_c{j}"), *[(f"_l{j}{p}", f"_z{p}") for p in range(j)]) / F.col(f"_l{j}{j}")})
    for j in reversed(range(k)):
        out = out.withColumn(f"_b{j}", less(F.col(f"_z{j}"), *[(f"_l{p}{j}", f"_b{p}") for p in range(j + 1, k)]) / F.col(f"_l{j}{j}"))
    rss = less(F.col("_yy"), *[(f"_z{j}", f"_z{j}") for j in range(k)])
    error = F.when((F.col("rss") > PERFECT * F.col("_yy")) & (F.col("rows") > k), F.sqrt(F.col("rss") / (F.col("rows") - k)))
    return (out.withColumn("rss", rss).withColumn("t_last", F.col(f"_b{k - 1}") * F.col(f"_l{k - 1}{k - 1}") / error)
            .select(*by, "rows", *[F.col(f"_b{j}").alias(f"b_{d}") for j, d in enumerate(design)], "rss", "t_last"))


def standard(windowed: DataFrame, keys=KEYS) -> DataFrame:
    """Windows with standardised values ``z``; null for constant ones."""
    w = Window.partitionBy(*keys, "win")
    sd = F.stddev_pop("value").over(w)
    return windowed.withColumn("z", F.when(sd > 0, (F.col("value") - F.avg("value").over(w)) / sd))


def unit_root(windowed: DataFrame, lags: int = 1, keys=KEYS) -> DataFrame:
    """Augmented Dickey-Fuller ``adf_t``: t statistic of the level in a regression of steps on constant, earlier steps, level.

    Very negative where a window returns to its mean. Null for constant, singular or too short windows.
    """
    part = [*keys, "win"]
    seq = Window.partitionBy(*part).orderBy("t")
    steps = standard(windowed, keys).withColumn("_step", F.col("z") - F.lag("z").over(seq))
    past = {f"step_{h}": F.lag("_step", h).over(seq) for h in range(1, lags + 1)}
    rows = steps.withColumns(past | {"level": F.lag("z").over(seq), "one": F.lit(1.0)})
    fitted = least_squares(rows, part, ["one", *past, "level"], "_step")
    windows = windowed.select(*part).distinct()
    return windows.join(fitted.select(*part, F.col("t_last").alias("adf_t"), F.col("b_level").alias("adf_level")), part, "left")


def drift(windowed: DataFrame, degree: int = 3, bins: int = 10, keys=KEYS) -> DataFrame:
    """``drift_0`` ..: polynomial by which a window's steps depend on where it stands, both standardised.

    Steps are averaged in ``bins`` of equal numbers of values first (a Langevin drift estimate). Null where bins do not
    determine the polynomial.
    """
    part = [*keys, "win"]
    w = Window.partitionBy(*part)
    steps = standard(windowed, keys).withColumn("_step", F.lead("z").over(w.orderBy("t")) - F.col("z")).where(F.col("_step").isNotNull())
    binned = (steps.withColumn("_bin", F.ntile(bins).over(w.orderBy("value", "t"))).groupBy(*part, "_bin")
              .agg(F.avg("z").alias("u"), F.avg("_step").alias("_step")))
    powers = {f"u{p}": reduce(lambda a, _: a * F.col("u"), range(p), F.lit(1.0)) for p in range(degree + 1)}
    fitted = least_squares(binned.withColumns(powers), part, list(powers), "_step")
    windows = windowed.select(*part).distinct()
    return windows.join(fitted.select(*part, *[F.col(f"b_u{p}").alias(f"drift_{p}") for p in range(degree + 1)]), part, "left")
