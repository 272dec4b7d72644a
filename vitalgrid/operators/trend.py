"""Piecewise linear trends with sparse bends, from sums per stretch of time.

The model of a series is level + slope * u + the sum of bend_j * max(u - knot_j, 0) over scaled time u, least squares with an
absolute penalty on bends (a Laplace prior), so that most are exactly zero. All sums of the normal equations follow from
five sums for each stretch between knots, which are added up where rows are read; level and slope are projected out, and
coordinate descent with thresholds solves the small systems that are left, a batch of series at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.schema import KEYS

#: Bends possible in the first part of a series, scale of the prior on bends, and passes over the bends.
KNOTS, KNOT_RANGE, PRIOR, SWEEPS = 12, 0.8, 0.05, 100
#: Mean square a row below which what is left of a hinge, or of the difference of two, counts as nothing.
NOTHING = 1e-9


def stretch_sums(daily_df: DataFrame, knots: int, keys=KEYS) -> DataFrame:
    """Per series and stretch between knots: n and sums of u, u*u, v, u*v, and of squared steps between neighbouring values."""
    w = Window.partitionBy(*keys)
    known = daily_df.where(F.col("y").isNotNull()).withColumn("_t", F.datediff("ds", F.min("ds").over(w)).cast("double"))
    known = known.withColumns({"span": F.max("_t").over(w), "scale": F.coalesce(F.nullif(F.max(F.abs("y")).over(w), F.lit(0.0)), F.lit(1.0))})
    u, v = F.when(F.col("span") > 0, F.col("_t") / F.col("span")).otherwise(0.0), F.col("y") / F.col("scale")
    known = known.withColumns({"u": u, "v": v}).withColumns({
        "seg": F.least(F.lit(knots), F.floor(F.col("u") * knots / KNOT_RANGE)).cast("int"), "step": F.col("v") - F.lag("v").over(w.orderBy("ds"))})
    return known.groupBy(*keys, "seg").agg(
        F.max("span").alias("span"), F.max("scale").alias("scale"), F.count(F.lit(1)).cast("double").alias("n"), F.sum("u").alias("u"),
        F.sum(F.col("u") * F.col("u")).alias("uu"), F.sum("v").alias("v"), F.sum(F.col("u") * F.col("v")).alias("uv"),
        F.coalesce(F.sum(F.col("step") * F.col("step")), F.lit(0.0)).alias("ss"), F.count("step").alias("steps"))


def best_move(a, r, penalty, low, high, least):
    """t that minimises a*t*t/2 - r*t plus a penalty whose slope is -penalty below ``low``, 0 between, +penalty above ``high``."""
    a, works = np.where(a > least, a, 1.0), a > least
    below, free, above = (r + penalty) / a, r / a, (r - penalty) / a
    return np.where(works, np.select([below < low, free < low, free <= high, above <= high], [below, low, free, high], above), 0.0)


def descend(g: np.ndarray, c: np.ndarray, threshold: np.ndarray, least: np.ndarray, sweeps: int) -> np.ndarray:
    """Minimisers of b'Gb/2 - c'b + threshold * |b| by coordinate descent, for many small systems at once.

    A pass changes every coordinate, then moves weight between every two neighbours: neighbouring hinges are nearly alike,
    and single coordinates would shift a bend from one knot to the next only in tiny steps. Moves along which the square
    term is at most ``least`` are left out.
    """
    size, b, r = c.shape[1], np.zeros_like(c), c.copy()
    for _ in range(sweeps):
        for j in range(size):
            t = best_move(g[:, j, j], r[:, j], threshold, -b[:, j], -b[:, j], least)
            b[:, j] += t
            r -= t[:, None] * g[:, j]
        for j in range(size - 1):
            k = j + 1
            low, high = np.minimum(-b[:, j], b[:, k]), np.maximum(-b[:, j], b[:, k])
            t = best_move(g[:, j, j] - 2 * g[:, j, k] + g[:, k, k], r[:, j] - r[:, k], 2 * threshold, low, high, least)
            b[:, j] += t
            b[:, k] -= t
            r -= t[:, None] * (g[:, j] - g[:, k])
    return b


def fitted(keep: list[str], sweeps: int):
    """Bends of the series of a batch, and level and slope with the bends' own lines taken out."""
    def fit(batches):
        for pdf in batches:
            if len(pdf):
                c, level, slope = (np.stack(pdf[k].to_list()) for k in ("c", "levels", "slopes"))
                g = np.stack(pdf["g"].to_list()).reshape(len(pdf), c.shape[1], c.shape[1])
                bends = descend(g, c, pdf["threshold"].to_numpy(), pdf["least"].to_numpy(), sweeps)
                yield pdf[keep].assign(level=pdf["level"] - (bends * level).sum(1), slope=pdf["slope"] - (bends * slope).sum(1), bends=list(bends))
    return fit


def sparse_trend(daily_df: DataFrame, knots: int = KNOTS, prior: float = PRIOR, sweeps: int = SWEEPS, keys=KEYS) -> DataFrame:
    """One row a series: ``span`` (days), ``scale``, ``level``, ``slope``, ``bends`` (all in scaled units) and ``noise``.

    ``noise`` is the variance of values about their neighbours, and noise / ``prior`` the penalty of a bend. Null values
    are left out; a series of one day has its mean as level and no slope.
    """
    parts = ("n", "u", "uu", "v", "uv")
    sums = stretch_sums(daily_df, knots, keys).groupBy(*keys).agg(
        F.max("span").alias("span"), F.max("scale").alias("scale"), (F.sum("ss") / F.greatest(2 * F.sum("steps"), F.lit(1))).alias("noise"),
        F.collect_list(F.struct("seg", *parts)).alias("_segs"))
    zero = F.struct(*[F.lit(0.0).alias(p) for p in parts])
    later = F.transform(F.sequence(F.lit(0), F.lit(knots)), lambda k: F.aggregate(
        F.filter("_segs", lambda s: s["seg"] >= k), zero, lambda a, s: F.struct(*[(a[p] + s[p]).alias(p) for p in parts])))
    df = sums.withColumn("_s", later).withColumn("_all", F.col("_s")[0])
    n, su, suu = (F.col(f"_all.{p}") for p in ("n", "u", "uu"))
    det = n * suu - su * su
    df = df.withColumn("_det", F.when(det > 1e-12 * n * suu, det))

    def line(p: Column, q: Column) -> tuple[Column, Column]:
        """Level and slope of whatever has sum p, and sum q with u."""
        return (suu * p - su * q) / F.col("_det"), (n * q - su * p) / F.col("_det")

    def hinge(j: Column) -> Column:
        s, at = F.col("_s")[j], KNOT_RANGE * j / knots
        p, q = s["u"] - at * s["n"], s["uu"] - at * s["u"]
        level, slope = line(p, q)
        return F.struct(at.alias("at"), p.alias("p"), q.alias("q"), (s["uv"] - at * s["v"]).alias("c"), level.alias("level"), slope.alias("slope"))

    df = df.withColumn("_h", F.transform(F.sequence(F.lit(1), F.lit(knots)), hinge))

    def product(a: Column, b: Column, j: Column, k: Column) -> Column:
        s = F.col("_s")[F.greatest(j, k) + 1]
        whole = s["uu"] - (a["at"] + b["at"]) * s["u"] + a["at"] * b["at"] * s["n"]
        return whole - a["level"] * b["p"] - a["slope"] * b["q"]

    level, slope = line(F.col("_all.v"), F.col("_all.uv"))

    def known(value: Column) -> Column:
        """Series of one day have nothing to solve: zeros in, zeros out."""
        return F.coalesce(value, F.lit(0.0))

    keep = [*keys, "span", "scale", "noise"]
    systems = df.select(
        *keep, F.coalesce(level, F.col("_all.v") / n).alias("level"), known(slope).alias("slope"),
        F.transform("_h", lambda a: known(a["level"])).alias("levels"), F.transform("_h", lambda a: known(a["slope"])).alias("slopes"),
        F.flatten(F.transform("_h", lambda a, j: F.transform(F.col("_h"), lambda b, k: known(product(a, b, j, k))))).alias("g"),
        F.transform("_h", lambda a: known(a["c"] - a["level"] * F.col("_all.v") - a["slope"] * F.col("_all.uv"))).alias("c"),
        (F.col("noise") / prior).alias("threshold"), (NOTHING * n).alias("least"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in systems.schema if f.name in keep)
    return systems.mapInPandas(fitted(keep, sweeps), f"{fields}, level double, slope double, bends array<double>")


def value_at(t: Column, knots: int) -> Column:
    """Trend on day ``t`` of a row that holds the columns of ``sparse_trend``."""
    u = F.when(F.col("span") > 0, t / F.col("span")).otherwise(0.0)
    bent = F.aggregate(F.transform("bends", lambda b, j: b * F.greatest(u - KNOT_RANGE * (j + 1) / knots, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)
    return F.col("scale") * (F.col("level") + F.col("slope") * u + bent)


def future_variance(days: Column, knots: int) -> Column:
    """Variance that unknown future bends add ``days`` after the end.

    Bends come as often as there are knots, Laplace distributed with the mean size of the past ones: the variance over
    all such futures, of which a simulation would draw some.
    """
    size = F.aggregate("bends", F.lit(0.0), lambda s, b: s + F.abs(b)) / knots
    h = F.when(F.col("span") > 0, days / F.col("span")).otherwise(0.0)
    return F.pow(F.col("scale") * size, F.lit(2.0)) * 2.0 * knots * h * h * h / 3.0
