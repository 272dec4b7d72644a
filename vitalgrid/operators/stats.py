"""Aggregates over daily series and detector output."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vitalgrid.functions.scalars import hours_if_minutes, weekday_name
from vitalgrid.schema import KEYS


def summary(daily_df: DataFrame, keys=KEYS, y: str = "y") -> DataFrame:
    """Count, mean, median, sample standard deviation, min, max, range."""
    return daily_df.groupBy(*keys).agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"), F.percentile(y, 0.5).alias("median"),
        F.stddev_samp(y).alias("std"), F.min(y).alias("min"), F.max(y).alias("max"),
        (F.max(y) - F.min(y)).alias("range"))


def skew_kurtosis(y: str = "y"):
    """Bias-corrected sample skewness and excess kurtosis as two columns."""
    n = F.count(y).cast("double")
    g1, g2 = F.skewness(y), F.kurtosis(y)
    skew = F.when(n >= 3, F.when(F.stddev_pop(y) == 0, 0.0).otherwise(
        F.try_divide(g1 * F.sqrt(n * (n - 1)), n - 2)))
    kurt = F.when(n >= 4, F.when(F.stddev_pop(y) == 0, 0.0).otherwise(
        F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * g2 + 6)))
    return skew, kurt


def quantile_lines(daily_df: DataFrame, keys=KEYS) -> DataFrame:
    """Reference lines at the 10 % and 90 % quantiles."""
    return daily_df.groupBy(*keys).agg(
        F.percentile("y", 0.1).alias("q10"), F.percentile("y", 0.9).alias("q90"))


def histogram(daily_df: DataFrame, bins: int = 30, keys=KEYS) -> DataFrame:
    """Equal-width frequency histogram; the largest value belongs to the last bin."""
    lo, hi = (f("y").over(Window.partitionBy(*keys)) for f in (F.min, F.max))
    bounded = daily_df.withColumn("_lo", lo).withColumn("_hi", hi)
    share = F.try_divide(F.col("y") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    bin_no = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins) + 1, F.lit(bins)).cast("long")
    return bounded.groupBy(*keys, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def weekday_pattern(daily_df: DataFrame, keys=KEYS) -> DataFrame:
    """Weekday with the highest and lowest mean, in hours if the data are minutes."""
    by_day = daily_df.groupBy(*keys, weekday_name(F.col("ds")).alias("weekday")).agg(F.avg("y").alias("m"))
    best = by_day.groupBy(*keys).agg(
        F.min_by("weekday", F.struct(-F.col("m"), F.col("weekday"))).alias("max_weekday"),
        F.min_by("weekday", F.struct(F.col("m"), F.col("weekday"))).alias("min_weekday"),
        F.max("m").alias("_hi"), F.min("m").alias("_lo"))
    return best.select(
        *keys, "max_weekday", "min_weekday",
        hours_if_minutes(F.col("_hi"), F.col("_hi")).alias("max_hours"),
        hours_if_minutes(F.col("_lo"), F.col("_hi")).alias("min_hours"))


def recent_extremes(daily_df: DataFrame, days: int = 7, keys=KEYS) -> DataFrame:
    """Highest and lowest of the last ``days`` rows; ties go to the earliest day."""
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("ds").desc()))
    recent = daily_df.withColumn("_back", back).where(F.col("_back") <= days)
    return recent.groupBy(*keys).agg(
        F.min_by("ds", F.struct(-F.col("y"), F.col("ds"))).alias("max_ds"), F.max("y").alias("max_y"),
        F.min_by("ds", F.struct(F.col("y"), F.col("ds"))).alias("min_ds"), F.min("y").alias("min_y"),
        F.count(F.lit(1)).alias("days"))


def recent_trend(daily_df: DataFrame, keys=KEYS) -> DataFrame:
    """Mean of the last 7 rows minus mean of the 7 before; 0 below 14 rows."""
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("ds").desc()))
    ranked = daily_df.withColumn("_back", back)
    sums = ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(F.col("_back") <= 7, F.col("y"))).alias("_last"),
        F.avg(F.when(F.col("_back").between(8, 14), F.col("y"))).alias("_prev"))
    diff = F.when(F.col("n") >= 14, F.col("_last") - F.col("_prev")).otherwise(0.0)
    return sums.select(*keys, "n", diff.alias("recent_trend"))


def first_last_trend(df: DataFrame, value: str = "trend", rows: int = 14, keys=KEYS) -> DataFrame:
    """Direction of a series by the means of its first and last ``rows`` rows."""
    w = Window.partitionBy(*keys)
    ranked = (df.withColumn("_fwd", F.row_number().over(w.orderBy("ds")))
              .withColumn("_back", F.row_number().over(w.orderBy(F.col("ds").desc()))))
    means = ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(F.col("_fwd") <= rows, F.col(value))).alias("first_avg"),
        F.avg(F.when(F.col("_back") <= rows, F.col(value))).alias("last_avg"))
    return means.withColumn(
        "trend_dir",
        F.when(F.col("n") < 2 * rows, "no clear trend (insufficient data)")
        .when(F.col("last_avg") > F.col("first_avg"), "increasing").otherwise("decreasing"))


def detector_report(df: DataFrame, flag: str, keys=KEYS) -> DataFrame:
    """Rows, flagged rows and their share in percent."""
    n, a = F.count(F.lit(1)), F.count_if(F.col(flag))
    return df.groupBy(*keys).agg(
        n.alias("total_records"), a.alias("anomalies_detected"),
        (a / F.greatest(n, F.lit(1)) * 100).alias("anomaly_percentage"))


def residual_report(df: DataFrame, threshold_std: float = 3.0, keys=KEYS) -> DataFrame:
    base = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("residual_anomaly").alias("anomalies_detected"),
        F.avg("residual").alias("residual_mean"), F.stddev_samp("residual").alias("residual_std"))
    return base.withColumn("residual_threshold", F.coalesce(F.col("residual_std"), F.lit(0.0)) * threshold_std)


def ensemble_summary(df: DataFrame, keys=KEYS) -> DataFrame:
    """Totals, mean confidence and severity counts of a voted ensemble."""

    def severe(label: str):
        return F.count_if(F.col("ensemble_anomaly") & (F.col("severity") == label))

    return df.groupBy(*keys).agg(
        F.count_if("ensemble_anomaly").alias("total_anomalies"),
        F.avg("confidence_score").alias("avg_confidence"),
        severe("Low").alias("low"), severe("Medium").alias("medium"), severe("High").alias("high"))


def overall_summary(per_series: DataFrame) -> DataFrame:
    """All series together: total, mean of the means, number of High."""
    return per_series.agg(
        F.sum("total_anomalies").alias("total_anomalies"),
        F.avg("avg_confidence").alias("avg_confidence"),
        F.count(F.lit(1)).alias("series"), F.sum("high").alias("high"))


def method_counts(df: DataFrame, keys=KEYS) -> DataFrame:
    """Flag counts of the four methods side by side."""
    return df.groupBy(*keys).agg(
        F.count_if("threshold_anomaly").alias("threshold"), F.count_if("residual_anomaly").alias("model"),
        F.count_if("cluster_anomaly").alias("cluster"), F.count_if("ensemble_anomaly").alias("ensemble"))
