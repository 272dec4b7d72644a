"""Statistical detection on daily series: deviations from the mean, jumps, band breaches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vitalgrid.operators import forecast as FC
from vitalgrid.schema import KEYS

# Deviations that make an outlier, a jump.
OUTLIER_STDS, SPIKE_STDS = 2.5, 2.0


def moments(daily_df: DataFrame, keys=KEYS) -> DataFrame:
    """Add count, mean and sample standard deviation of each series."""
    w = Window.partitionBy(*keys)
    return (daily_df.withColumn("n", F.count("y").over(w)).withColumn("mean", F.avg("y").over(w))
            .withColumn("std", F.stddev_samp("y").over(w)))


def outliers(df: DataFrame, stds: float = OUTLIER_STDS) -> DataFrame:
    """``is_outlier``: outside mean +- ``stds`` deviations. Needs ``moments``."""
    away = (F.col("y") < F.col("mean") - stds * F.col("std")) | (F.col("y") > F.col("mean") + stds * F.col("std"))
    return df.withColumn("is_outlier", F.coalesce(away, F.lit(False)))


def deviation(df: DataFrame) -> DataFrame:
    """``deviation`` in standard deviations, 0 for a constant series."""
    return df.withColumn("deviation", F.coalesce(
        F.try_divide(F.col("y") - F.col("mean"), F.nullif("std", F.lit(0.0))), F.lit(0.0)))


def differences(df: DataFrame, keys=KEYS) -> DataFrame:
    """Change from the previous row and its size; the first row has 0."""
    change = F.col("y") - F.lag("y").over(Window.partitionBy(*keys).orderBy("ds"))
    return (df.withColumn("change", F.coalesce(change, F.lit(0.0)))
            .withColumn("abs_change", F.abs("change")))


def spikes(df: DataFrame, stds: float = SPIKE_STDS, keys=KEYS) -> DataFrame:
    """``is_spike`` with the direction of the jump. Needs ``moments``."""
    hit = F.coalesce(F.col("abs_change") > stds * F.col("std"), F.lit(False))
    return (differences(df, keys).withColumn("is_spike", hit)
            .withColumn("spike_direction", F.when(F.col("is_spike"), F.when(F.col("change") > 0, "up")
                                                  .otherwise("drop"))))


def band_breaches(df: DataFrame, min_points: int = 20, keys=KEYS) -> DataFrame:
    """``is_breach``: outside the 95 % band of the series' own forecast."""
    n = F.count("y").over(Window.partitionBy(*keys))
    fitted = FC.components(df.withColumn("_points", n), FC.DETECTION, keys)
    out = (F.col("y") < F.col("fit_lower")) | (F.col("y") > F.col("fit_upper"))
    return (fitted.withColumn("is_breach", F.coalesce(out, F.lit(False)) & (F.col("_points") >= min_points))
            .select(*df.columns, "yhat", "fit_lower", "fit_upper", "is_breach"))
