"""Window features: 30-row windows, feature vectors, imputation, scaling."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from vitalgrid.operators.stats import skew_kurtosis
from vitalgrid.schema import KEYS

WINDOW_ROWS = 30


def in_windows(daily_df: DataFrame, rows: int = WINDOW_ROWS, keys=KEYS) -> DataFrame:
    """Number ``win`` of each known row's window of ``rows`` rows and its place ``t`` in it; ``win`` is null in the ragged tail."""
    all_of = Window.partitionBy(*keys)
    known = daily_df.where(F.col("y").isNotNull())
    numbered = (known.withColumn("_i", F.row_number().over(all_of.orderBy("ds")) - 1)
                .withColumn("_n", F.count(F.lit(1)).over(all_of)))
    win = F.floor(F.col("_i") / rows)
    return (numbered.withColumn("win", F.when(win < F.floor(F.col("_n") / rows), win))
            .withColumn("t", F.col("_i") % rows).drop("_i", "_n"))


def windows(daily_df: DataFrame, rows: int = WINDOW_ROWS, keys=KEYS) -> DataFrame:
    """Consecutive windows of ``rows`` rows per series; the ragged tail is dropped."""
    return (in_windows(daily_df, rows, keys).where(F.col("win").isNotNull())
            .select(*keys, "win", "t", F.col("y").alias("value"), "ds"))


def windows_of_samples(samples: DataFrame, rows: int = WINDOW_ROWS, keys=KEYS, order=("ts",), ts: str = "ts", value: str = "value") -> DataFrame:
    """``win`` of ``in_windows`` for the day of each sample with a value: its place among the days of its series that have one.

    ``order`` begins with ``ts``; its other columns save later windows a sort.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    known = F.col(value).isNotNull()
    # days without a date come first
    day = F.when(known, F.coalesce(F.unix_date(F.to_date(ts)), F.lit(-(1 << 31))))
    before = F.last("_day", True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    placed = (samples.withColumn("_day", day).withColumn("_before", before)
              .withColumn("_new", (known & (F.col("_before").isNull() | (F.col("_before") != F.col("_day")))).cast("long"))
              .withColumn("_i", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
              .withColumn("_n", F.sum("_new").over(Window.partitionBy(*keys))))
    win = F.floor(F.col("_i") / rows)
    return placed.withColumn("win", F.when(known & (win < F.floor(F.col("_n") / rows)), win)).drop("_day", "_before", "_new", "_i", "_n")


HANDCRAFTED = ("mean", "std", "median", "min", "max", "skew", "kurtosis", "pct_25", "pct_75", "num_peaks")


def handcrafted(df: DataFrame, keys=KEYS, order: str = "ds", y: str = "y") -> DataFrame:
    """Ten summary features per group; a peak is a jump above 1.5 deviations."""
    w = Window.partitionBy(*keys)
    known = (df.where(F.col(y).isNotNull())
             .withColumn("_step", F.abs(F.col(y) - F.lag(y).over(w.orderBy(order))))
             .withColumn("_std", F.stddev_samp(y).over(w)))
    skew, kurt = skew_kurtosis(y)
    # one aggregate for all quantiles: each counts the group's values anew
    grouped = known.groupBy(*keys).agg(
        F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"), F.percentile(y, [0.25, 0.5, 0.75]).alias("_q"),
        F.min(y).alias("min"), F.max(y).alias("max"), skew.alias("skew"), kurt.alias("kurtosis"),
        F.count_if(F.col("_step") > 1.5 * F.col("_std")).alias("num_peaks"))
    quantiles = {"pct_25": F.col("_q")[0], "median": F.col("_q")[1], "pct_75": F.col("_q")[2]}
    return grouped.select(*keys, *[quantiles.get(c, F.col(c)).alias(c) for c in HANDCRAFTED])


FOURIER_TERMS = 3
AUTOMATIC = (
    "sum_values", "abs_energy", "mean_abs_change", "mean_change", "cid_ce", "c3_lag1", "autocorr_lag1",
    "count_above_mean", "count_below_mean", "longest_above_mean", "longest_below_mean", "number_peaks",
    "quantile_10", "quantile_90", "variation_coefficient", "trend_slope", "trend_r2", "first_loc_max",
    "last_loc_max", "first_loc_min", "last_loc_min", "ratio_beyond_1_sigma", "has_duplicate_max",
    *(f"fft_abs_{k}" for k in range(1, FOURIER_TERMS + 1)))


def automatic(windowed: DataFrame, keys=KEYS) -> DataFrame:
    """The declared feature list per window, in one grouping.

    The helper windows and the grouping all cluster on the series key, so
    features cost no shuffle beyond the one that built the windows.
    """
    part = [*keys, "win"]
    w = Window.partitionBy(*part)
    seq, so_far = w.orderBy("t"), w.orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    v, t, mu = F.col("value"), F.col("t"), F.col("_mu")
    df = (windowed.withColumn("_mu", F.avg(v).over(w)).withColumn("_sd", F.stddev_pop(v).over(w))
          .withColumn("_top", F.max(v).over(w)).withColumn("_low", F.min(v).over(w))
          .withColumn("_prev", F.lag(v).over(seq)).withColumn("_next", F.lead(v).over(seq))
          .withColumn("_next2", F.lead(v, 2).over(seq))
          .withColumn("_up", t - F.coalesce(F.max(F.when(~(v > mu), t)).over(so_far), F.lit(-1)))
          .withColumn("_down", t - F.coalesce(F.max(F.when(~(v < mu), t)).over(so_far), F.lit(-1))))
    n = F.count(F.lit(1)).cast("double")
    step = v - F.col("_prev")

    def wave(k: int):
        angle = -2.0 * math.pi * k / WINDOW_ROWS * t
        re, im = F.sum(v * F.cos(angle)), F.sum(v * F.sin(angle))
        return F.sqrt(re * re + im * im)

    return df.groupBy(*part).agg(
        F.sum(v).alias("sum_values"), F.sum(v * v).alias("abs_energy"),
        F.avg(F.abs(step)).alias("mean_abs_change"), F.avg(step).alias("mean_change"),
        F.sqrt(F.sum(step * step)).alias("cid_ce"),
        F.avg(F.col("_next2") * F.col("_next") * v).alias("c3_lag1"),
        F.try_divide(F.sum((v - mu) * (F.col("_next") - mu)),
                     F.nullif((n - 1) * F.max(F.col("_sd") * F.col("_sd")), F.lit(0.0))).alias("autocorr_lag1"),
        F.count_if(v > mu).alias("count_above_mean"), F.count_if(v < mu).alias("count_below_mean"),
        F.max("_up").cast("long").alias("longest_above_mean"), F.max("_down").cast("long").alias("longest_below_mean"),
        F.count_if((v > F.col("_prev")) & (v > F.col("_next"))).alias("number_peaks"),
        F.percentile(v, 0.1).alias("quantile_10"), F.percentile(v, 0.9).alias("quantile_90"),
        F.try_divide(F.max("_sd"), F.nullif(F.max("_mu"), F.lit(0.0))).alias("variation_coefficient"),
        F.regr_slope(v, t).alias("trend_slope"), F.regr_r2(v, t).alias("trend_r2"),
        (F.min(F.when(v == F.col("_top"), t)) / n).alias("first_loc_max"),
        ((F.max(F.when(v == F.col("_top"), t)) + 1) / n).alias("last_loc_max"),
        (F.min(F.when(v == F.col("_low"), t)) / n).alias("first_loc_min"),
        ((F.max(F.when(v == F.col("_low"), t)) + 1) / n).alias("last_loc_min"),
        (F.count_if(F.abs(v - mu) > F.col("_sd")) / n).alias("ratio_beyond_1_sigma"),
        F.when(F.count_if(v == F.col("_top")) > 1, 1.0).otherwise(0.0).alias("has_duplicate_max"),
        *[wave(k).alias(f"fft_abs_{k}") for k in range(1, FOURIER_TERMS + 1)])


def impute(matrix: DataFrame, columns, by=("user_id",)) -> DataFrame:
    """Infinities become the group's finite extreme, missing values its median."""
    def finite(c):
        return F.when(~F.isnan(c) & (F.abs(F.col(c)) != float("inf")), F.col(c))

    aggs = []
    for c in columns:
        aggs += [F.percentile(finite(c), 0.5).alias(f"_md_{c}"), F.max(finite(c)).alias(f"_hi_{c}"),
                 F.min(finite(c)).alias(f"_lo_{c}")]
    stats = matrix.groupBy(*by).agg(*aggs)
    rest = [c for c in matrix.columns if c not in columns]
    fill = [F.when(F.col(c) == float("inf"), F.col(f"_hi_{c}")).when(F.col(c) == float("-inf"), F.col(f"_lo_{c}"))
            .when(F.col(c).isNull() | F.isnan(c), F.col(f"_md_{c}")).otherwise(F.col(c)).cast("double").alias(c)
            for c in columns]
    return matrix.join(stats, list(by)).select(*rest, *fill)


def all_null_columns(matrix: DataFrame, columns) -> list[str]:
    """Features no row has a value for, from one aggregate row."""
    counts = matrix.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] == 0]


def fill_median(matrix: DataFrame, columns, by=("user_id",)) -> DataFrame:
    """Drop all-null features, fill the rest with the group's median."""
    empty = set(all_null_columns(matrix, columns))
    return impute(matrix.drop(*empty), [c for c in columns if c not in empty], by)


def standardise(matrix: DataFrame, columns, by=("user_id",)) -> DataFrame:
    """Zero mean and unit population deviation per group; constant features become 0."""
    stats = matrix.groupBy(*by).agg(*[e for c in columns for e in (
        F.avg(c).alias(f"_mu_{c}"), F.stddev_pop(c).alias(f"_sd_{c}"))])
    rest = [c for c in matrix.columns if c not in columns]
    scaled = [F.when(F.col(f"_sd_{c}") > 1e-12, (F.col(c) - F.col(f"_mu_{c}")) / F.col(f"_sd_{c}"))
              .otherwise(0.0).alias(c) for c in columns]
    return matrix.join(stats, list(by)).select(*rest, *scaled)


def standardise_vectors(matrix: DataFrame, x: str, by) -> DataFrame:
    """``standardise`` for all dimensions of an array column: statistics by group and dimension, then back in place."""
    long = matrix.select(*by, F.posexplode(x).alias("_d", "_x"))
    stats = (long.groupBy(*by, "_d").agg(F.avg("_x").alias("mu"), F.stddev_pop("_x").alias("sd"))
             .groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_d", "mu", "sd"))).alias("_s")))

    def scale(v, s):
        return F.when(s["sd"] > 1e-12, (v - s["mu"]) / s["sd"]).otherwise(0.0)

    return matrix.join(stats, list(by)).withColumn(x, F.zip_with(F.col(x).cast("array<double>"), "_s", scale)).drop("_s")


def number_windows(matrix: DataFrame, by: str = "user_id", name: str = "rid") -> DataFrame:
    """Number the windows of each user; a user has one per metric and 30 calendar days."""
    return matrix.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy("metric", "win")).cast("long"))


def vectors(matrix: DataFrame, columns, name: str = "x") -> DataFrame:
    rest = [c for c in matrix.columns if c not in columns]
    return matrix.select(*rest, F.array(*[F.col(c).cast("double") for c in columns]).alias(name))
