"""Daily series: aggregation, merging, dense views, calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.functions.ladders import health_status
from vitalgrid.schema import HEART_RATE, HOLIDAY_DAYS, KEYS, MEAN_METRICS, SLEEP, STEPS


def daily(samples: DataFrame, keys=KEYS, ts: str = "ts", value: str = "value") -> DataFrame:
    """Mean per day for mean metrics, sum for all others; nulls are ignored.

    Both aggregates combine map-side, so a busy series is already small when
    it is shuffled.
    """
    known = samples.where(F.col(value).isNotNull())
    both = known.groupBy(*keys, F.to_date(ts).alias("ds")).agg(
        F.avg(value).alias("_avg"), F.sum(value).alias("_sum"))
    is_mean = F.col("metric").isin(*MEAN_METRICS)
    return both.select(*keys, "ds", F.when(is_mean, F.col("_avg")).otherwise(F.col("_sum")).alias("y"))


def canonical(df: DataFrame, keys=KEYS, ds: str = "ds", y: str = "y") -> DataFrame:
    """``ds, y`` as text or mixed types -> clean ``date, value`` rows."""
    from vitalgrid.functions.scalars import to_number

    day = F.col(ds).cast("string").try_cast("timestamp").cast("date")
    return (df.select(*keys, day.alias("date"), to_number(F.col(y)).alias("value"))
            .dropna(subset=["date", "value"]))


def first_file_wins(files: DataFrame, ordinal: str = "file_ordinal", keys=KEYS) -> DataFrame:
    """One value per day: that of the earliest file holding the day, however many files there are."""
    return files.groupBy(*keys, "ds").agg(F.min_by("y", ordinal).alias("y"))


def last_of_day(df: DataFrame, ts: str = "ts", tie: str = "event_id", keys=KEYS) -> DataFrame:
    """The last value of every calendar day."""
    return (df.groupBy(*keys, F.to_date(ts).alias("ds"))
            .agg(F.max_by("value", F.struct(ts, tie)).alias("y")))


def dense_week(daily_df: DataFrame, as_of, keys=KEYS, days: int = 7) -> DataFrame:
    """The ``days`` days up to ``as_of`` of each series, missing days as 0."""
    last = F.lit(as_of).cast("date")
    first = F.date_sub(last, days - 1)
    have = (daily_df.groupBy(*keys)
            .agg(F.map_from_entries(F.collect_list(
                F.when(F.col("ds").between(first, last), F.struct("ds", "y")))).alias("_y")))
    return (have.select(*keys, "_y", F.explode(F.sequence(first, last)).alias("ds"))
            .select(*keys, "ds", F.coalesce(F.try_element_at("_y", F.col("ds")), F.lit(0.0)).alias("y")))


def value_on(daily_df: DataFrame, as_of, keys=KEYS) -> DataFrame:
    """Each series' value on one day, null if it has none."""
    at = F.lit(as_of).cast("date")
    return daily_df.groupBy(*keys).agg(
        F.max(F.when(F.col("ds") == at, F.col("y"))).alias("y"))


def rows_on(df: DataFrame, as_of, keys=KEYS, flag: str | None = None) -> DataFrame:
    """How many (flagged) rows of each series fall on one day; a series without any has 0."""
    hit = F.col("ds") == F.lit(as_of).cast("date")
    return df.groupBy(*keys).agg(F.count_if(hit & F.col(flag) if flag else hit).alias("n"))


def event_of(day_number: Column, calendar=HOLIDAY_DAYS) -> Column:
    """Name of the planted event on the n-th day of a series (1-based), else null."""
    out = F.lit(None).cast("string")
    for name, first, last in reversed(calendar):
        out = F.when(day_number.between(first, last), name).otherwise(out)
    return out


def holiday_calendar(daily_df: DataFrame, keys=KEYS, calendar=HOLIDAY_DAYS) -> DataFrame:
    """Event days of each series, counted from its first day."""
    def days_of(name: str, first: int, last: int) -> Column:
        return F.transform(F.sequence(F.lit(first), F.lit(last)),
                           lambda d: F.struct(F.lit(name).alias("holiday"), d.alias("day")))

    offsets = F.flatten(F.array(*[days_of(*event) for event in calendar]))
    return (daily_df.groupBy(*keys).agg(F.min("ds").alias("_start"))
            .select(*keys, "_start", F.explode(offsets).alias("_e"))
            .select(*keys, F.col("_e.holiday").alias("holiday"),
                    F.date_add("_start", F.col("_e.day") - 1).alias("ds")))


def status_per_day(daily_df: DataFrame, missing: str = "Syncing Data") -> DataFrame:
    """Health status of every user and day."""

    def of(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("y")))

    days = daily_df.groupBy("user_id", "ds").agg(
        of(HEART_RATE).alias("hr"), of(STEPS).alias("steps"), of(SLEEP).alias("sleep"))
    status = health_status(F.col("hr"), F.col("steps"), F.col("sleep"), missing)
    return (days.withColumn("_s", status)
            .select("user_id", "ds", "hr", "steps", "sleep",
                    F.col("_s.label").alias("status"), F.col("_s.mood").alias("mood")))


def latest_status(daily_df: DataFrame, missing: str = "Syncing Data") -> DataFrame:
    """Health status on each user's latest day."""
    days = status_per_day(daily_df, missing)
    newest = F.max_by(F.struct("ds", "status", "mood"), "ds")
    return days.groupBy("user_id").agg(newest.alias("_l")).select("user_id", "_l.*")


def dedupe_first(df: DataFrame, keys, order) -> DataFrame:
    """First row of each key in a given order, by aggregation."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
            .select(*keys, "_r.*"))
