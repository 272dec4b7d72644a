"""Schema detection by column and file names, and canonical long frames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vitalgrid.functions.scalars import to_number
from vitalgrid.schema import HEART_RATE, SLEEP, STEPS

# Name patterns in the order they are tried.
DATE_PATTERNS = ("ds", "timestamp", "date", "datetime", "activitydate", "logdate", "sleepdate", "time",
                 "starttime", "endtime", "startdate", "enddate")
VALUE_PATTERNS = ("y", "value", "steps", "step_count", "heart_rate", "heartrate", "duration", "duration_minutes",
                  "metric", "val", "sleep_hours", "hr", "bpm", "count", "minutesasleep", "minutes_asleep")
METRIC_PATTERNS = {
    HEART_RATE: ("heart_rate", "heartrate", "hr", "bpm"),
    STEPS: ("steps", "step_count", "step"),
    SLEEP: ("sleep_hours", "minutesasleep", "minutes_asleep", "sleepduration", "sleep_duration", "totalsleep"),
}


def _clean(name: str) -> str:
    return name.strip().lower()


def date_column(names) -> str | None:
    """First column whose name is, or ends with, a date pattern."""
    return next((n for n in names if _clean(n).endswith(DATE_PATTERNS)), None)


def value_column(names) -> str | None:
    """An exact name in pattern order, else a name containing a pattern in column order."""
    by_name = {}
    for n in names:
        by_name.setdefault(_clean(n), n)
    exact = next((by_name[p] for p in VALUE_PATTERNS if p in by_name), None)
    if exact is not None:
        return exact
    loose = [n for n in names if "date" not in _clean(n) and _clean(n) != "timestamp"]
    return next((n for n in loose if any(p in _clean(n) for p in VALUE_PATTERNS)), None)


def tokens(name: str) -> set[str]:
    """Words of a name, split at underscores, digits and case changes, plus joined forms."""
    words = [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", name.strip())]
    return set(words) | {"_".join(words), "".join(words)} | {"_".join(words[i:i + 2]) for i in range(len(words))}


def metric_columns(names, date_col: str | None) -> dict[str, str]:
    """Column of each metric: whole-word match first, long patterns also inside a word.

    Short patterns such as ``hr`` only count as words, so ``threshold`` is no heart rate.
    """
    found = {}
    candidates = [n for n in names if n != date_col and _clean(n) != "ds"]
    for metric, patterns in METRIC_PATTERNS.items():
        words = (n for n in candidates if tokens(n) & set(patterns))
        inside = (n for n in candidates if any(p in _clean(n) for p in patterns if len(p) > 3))
        column = next(words, None) or next(inside, None)
        if column is not None:
            found[metric] = column
    return found


def metric_of_file(name: Column) -> Column:
    """Metric a file name speaks of, else null."""
    low = F.lower(name)
    return (F.when(low.contains("heart") | low.contains("hr"), HEART_RATE).when(low.contains("step"), STEPS)
            .when(low.contains("sleep"), SLEEP))


def to_timestamp(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(column).cast("timestamp")
    return F.col(column).cast("string").try_cast("timestamp")


def extract_samples(df: DataFrame, keep=(), file_name: Column | None = None) -> DataFrame:
    """Any table with a date column and metric columns -> long ``(keep, metric, ts, value)``.

    Sleep in minutes becomes hours. Without metric columns, ``y`` counts as the
    metric named by the file.
    """
    names = [n for n in df.columns if n not in keep]
    date_col = date_column(names)
    if date_col is None:
        raise ValueError(f"no date column among {names}")
    columns = metric_columns(names, date_col)
    ts = to_timestamp(df, date_col).alias("ts")
    if not columns:
        if "y" not in names or file_name is None:
            raise ValueError(f"no metric column among {names}")
        long = df.select(*keep, metric_of_file(file_name).alias("metric"), ts, to_number(F.col("y")).alias("value"))
        return long.where(F.col("metric").isNotNull()).dropna(subset=["ts", "value"])

    def scaled(metric: str, column: str) -> Column:
        number = to_number(F.col(column))
        return number / 60.0 if metric == SLEEP and "minute" in _clean(column) else number

    rows = F.array(*[F.struct(F.lit(m).alias("metric"), scaled(m, c).alias("value")) for m, c in columns.items()])
    return (df.select(*keep, ts, F.inline(rows))
            .select(*keep, "metric", "ts", "value").dropna(subset=["ts", "value"]))


def extract_series(df: DataFrame, keep=()) -> DataFrame:
    """Any table with one date and one value column -> ``(keep, ts, value)``."""
    names = [n for n in df.columns if n not in keep]
    date_col, value_col = date_column(names), value_column(names)
    if date_col is None or value_col is None:
        raise ValueError(f"no date or value column among {names}")
    return (df.select(*keep, to_timestamp(df, date_col).alias("ts"), to_number(F.col(value_col)).alias("value"))
            .dropna(subset=["ts", "value"]))


def raw_columns(df: DataFrame, value_names) -> tuple[str, str | None]:
    """``timestamp`` or the first column; the named value, ``value``, or the first numeric column."""
    names = df.columns
    ts = "timestamp" if "timestamp" in names else names[0]
    named = next((n for n in (*value_names, "value") if n in names), None)
    numeric = (f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name != ts)
    return ts, named or next(numeric, None)


def interval_columns(names) -> tuple[str, str] | None:
    """Start and end column of an interval table."""
    start = next((n for n in ("startTime", "start_time") if n in names), None)
    end = next((n for n in ("endTime", "end_time") if n in names), None)
    if start and end:
        return start, end
    timely = [n for n in names if "time" in n.lower() or "date" in n.lower()]
    return (timely[0], timely[1]) if len(timely) >= 2 else None


def timestamp_column(names) -> str:
    """``timestamp``, else the first name that speaks of time; none is an error."""
    if "timestamp" in names:
        return "timestamp"
    for n in names:
        if any(word in n.lower() for word in ("time", "date")):
            return n
    raise ValueError("no timestamp-like column")


def strict_timestamps(df: DataFrame, column: str) -> DataFrame:
    """Parse a column to timestamps; raises with the number of values that do not parse."""
    bad = bad_timestamps(df, column).first().bad
    if bad:
        raise ValueError(f"{bad} values of {column} are no timestamps")
    return df.withColumn(column, to_timestamp(df, column))


def bad_timestamps(df: DataFrame, column: str) -> DataFrame:
    """How many values of a column do not parse."""
    return df.agg(F.count_if(to_timestamp(df, column).isNull()).alias("bad"))


def missing_metrics(selected: DataFrame, available: DataFrame) -> DataFrame:
    """Selected metrics without any data."""
    return selected.join(available.select("metric").distinct(), "metric", "left_anti")
