"""Small coercions, filters and formats used across operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.schema import HEART_RATE_RANGE, KEYS


def to_number(value: Column) -> Column:
    """Number or null; NaN and infinities are nulls too."""
    number = value.try_cast("double")
    return F.when(F.isnan(number) | (F.abs(number) == float("inf")), None).otherwise(number)


def to_number_or_zero(value: Column) -> Column:
    return F.coalesce(to_number(value), F.lit(0.0))


def physiological(df: DataFrame, value: str = "value") -> DataFrame:
    """Keep heart-rate readings a body can produce; nulls fall out too."""
    return df.where(F.col(value).between(*HEART_RATE_RANGE))


def day(ts: Column) -> Column:
    return F.to_date(ts)


def date_range(df: DataFrame, start=None, end=None, ds: str = "ds") -> DataFrame:
    """Rows between two dates, both included; no bounds means all data."""
    if start is not None:
        df = df.where(F.col(ds) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(ds) <= F.lit(end).cast("date"))
    return df


def recent_days(daily: DataFrame, days: int = 120, keys=KEYS, ds: str = "ds") -> DataFrame:
    """The last ``days`` calendar days of each daily series."""
    last = F.max(ds).over(Window.partitionBy(*keys))
    return (daily.withColumn("_last", last)
            .where(F.col(ds) >= F.date_sub("_last", days - 1))
            .drop("_last"))


def weekday_name(ds: Column) -> Column:
    return F.date_format(ds, "EEEE")


def week_start(ds: Column) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", ds))


def hours_if_minutes(value: Column, largest: Column) -> Column:
    """Sleep in hours: a largest mean above 24 can only be minutes."""
    return F.when(largest > 24, value / 60.0).otherwise(value)


# Nudge exact decimal ties upward, so that text does not depend on how ties round.
_TIE = 1e-9


def fixed(value: Column, decimals: int) -> Column:
    return F.format_string(f"%.{decimals}f", value + F.lit(_TIE))


def thousands(value: Column) -> Column:
    return F.format_number(F.floor(value + F.lit(0.5 + _TIE)), 0)


def percent_label(score: Column) -> Column:
    """0.4286 -> ``42.9%``."""
    return F.concat(fixed(score * 100, 1), F.lit("%"))


def time_range(df: DataFrame, start=None, end=None, ts: str = "ts") -> DataFrame:
    """Rows from day ``start`` to the end of day ``end``.

    The time column is compared as it is, so the filter reaches the scan.
    """
    kind = df.schema[ts].dataType
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.where(F.col(ts) < F.date_add(F.lit(end).cast("date"), 1).cast(kind))
    return df
