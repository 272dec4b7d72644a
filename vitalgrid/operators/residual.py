"""Model-based detection: distance from a forecast and its band."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vitalgrid.operators import forecast as FC, series as S
from vitalgrid.schema import KEYS
from vitalgrid.session import stored


def rolling_band(df: DataFrame, part, order, value: str = "value") -> DataFrame:
    """Rolling median of 15 rows with a band of two rolling deviations of 30 rows."""
    w = Window.partitionBy(*part).orderBy(*order)
    return (df.withColumn("predicted", F.percentile(value, 0.5).over(w.rowsBetween(-14, 0)))
            .withColumn("_spread", 2 * F.coalesce(F.stddev_samp(value).over(w.rowsBetween(-29, 0)), F.lit(0.0)))
            .withColumn("yhat_lower", F.col("predicted") - F.col("_spread"))
            .withColumn("yhat_upper", F.col("predicted") + F.col("_spread"))
            .drop("_spread"))


def rolling_forecast(df: DataFrame, keys=KEYS, order=("ts",), ts: str = "ts", value: str = "value",
                     unit: str = "hour", block_rows: int = 100_000) -> DataFrame:
    """``rolling_band`` for long series: blocks of rows with a 29-row lead-in."""
    numbered = S.number_rows(df.where(F.col(value).isNotNull()), order, keys, ts, unit)
    blocks = S.row_blocks(numbered, halo_before=29, size=block_rows)
    return S.drop_halo(rolling_band(blocks, [*keys, "_block"], ["rn"], value)).drop("rn", "n_rows")


def daily_forecast(daily_df: DataFrame, keys=KEYS, min_points: int = 10) -> DataFrame:
    """Additive forecast of a daily series, or the rolling band if it is too short. Keeps ``y`` and other columns.

    The band only reads values of short series, as others never use it and its median is the dearest step.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    rest = [c for c in daily_df.columns if c not in (*keys, "ds", "y")]
    enough = F.col("_n") >= min_points
    counted = daily_df.where(F.col("y").isNotNull()).withColumn("_n", n).withColumn("_short", F.when(~enough, F.col("y")))
    fitted = FC.components(rolling_band(counted, keys, ["ds"], "_short"), FC.DEFAULT, keys)
    return fitted.select(
        *keys, "ds", "y", *rest,
        F.when(enough, F.col("yhat")).otherwise(F.col("predicted")).alias("predicted"),
        F.when(enough, F.col("fit_lower")).otherwise(F.col("yhat_lower")).alias("yhat_lower"),
        F.when(enough, F.col("fit_upper")).otherwise(F.col("yhat_upper")).alias("yhat_upper"))


def with_forecast(df: DataFrame, forecast: DataFrame, on) -> DataFrame:
    """Left join of a forecast; several forecasts for one time fan out."""
    return df.join(forecast, list(on), "left")


def flag(df: DataFrame, spread, value: str = "y", threshold_std: float = 3.0) -> DataFrame:
    """Flag residuals beyond ``threshold_std`` deviations or outside the band."""
    limit = threshold_std * F.coalesce(spread, F.lit(0.0))
    outside = (F.col(value) > F.col("yhat_upper")) | (F.col(value) < F.col("yhat_lower"))
    hit = F.coalesce(F.abs("residual") > limit, F.lit(False)) | F.coalesce(outside, F.lit(False))
    return (df.withColumn("residual_anomaly", hit)
            .withColumn("residual_anomaly_reason",
                        F.when(F.col("residual_anomaly"), "Deviates from predicted trend").otherwise("")))


def detect(daily_df: DataFrame, forecast: DataFrame | None = None, threshold_std: float = 3.0,
           keys=KEYS) -> DataFrame:
    """Residual detector on daily series, with a given forecast or its own; other columns are kept."""
    if forecast is None:
        missing = daily_df.where(F.col("y").isNull())
        joined = daily_forecast(daily_df, keys).unionByName(missing, allowMissingColumns=True)
    else:
        joined = with_forecast(daily_df, forecast, [*keys, "ds"])
    joined = joined.withColumn("residual", F.col("y") - F.col("predicted"))
    spread = F.stddev_samp("residual").over(Window.partitionBy(*keys))
    return flag(joined.withColumn("_std", spread), F.col("_std"), "y", threshold_std).drop("_std")


def detect_samples(df: DataFrame, threshold_std: float = 3.0, keys=KEYS, order=("ts",), ts: str = "ts",
                   value: str = "value", unit: str | None = "hour") -> DataFrame:
    """Residual detector on long series against the rolling band.

    The deviation of all residuals of a series is put together from one
    (count, mean, squared distance) summary per chunk. The band is read for
    these and once more for the flags, so it is stored. Without ``unit`` whole
    series are scanned where they are: for rows that are dealt by ``keys`` to
    tasks that hold them.
    """
    if unit is None:
        known = df.where(F.col(value).isNotNull()).dropna(subset=[*keys, ts])
        rows = rolling_band(known, keys, order, value).withColumn("residual", F.col(value) - F.col("predicted"))
        return flag(rows.withColumn("_std", F.stddev_samp("residual").over(S.whole(keys))), F.col("_std"), value, threshold_std).drop("_std")
    rows = S.chunked(stored(rolling_forecast(df, keys, order, ts, value, unit), "band"), ts, unit)
    rows = rows.withColumn("residual", F.col(value) - F.col("predicted"))
    chunks = S.summaries(rows, {"_n": F.count("residual"), "_m": F.avg("residual"),
                                "_s": F.var_pop("residual") * F.count("residual")}, keys)
    all_of = S.whole(keys)
    chunks = chunks.withColumn("_mean", F.sum(F.col("_n") * F.col("_m")).over(all_of) / F.sum("_n").over(all_of))
    apart = F.sum(F.col("_s") + F.col("_n") * F.pow(F.col("_m") - F.col("_mean"), 2)).over(all_of)
    led = S.hand_over(rows, chunks, {
        "_std": F.sqrt(F.try_divide(apart, F.nullif(F.sum("_n").over(all_of) - 1, F.lit(0)))),
    }, keys)
    return flag(led, F.col("_std"), value, threshold_std).drop("_std", S.CHUNK)
