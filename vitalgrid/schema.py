"""Column names, table schemas and the fixed values shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

KEYS = ("user_id", "metric")

HEART_RATE, STEPS, SLEEP = "heart_rate", "steps", "sleep"
MEAN_METRICS = (HEART_RATE,)

RAW_HEART_RATE = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("heart_rate", T.DoubleType()),
    T.StructField("source_type", T.StringType()),
])
RAW_STEPS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("steps", T.LongType()),
    T.StructField("source_type", T.StringType()),
])
RAW_SLEEP = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("startTime", T.StringType()),
    T.StructField("endTime", T.StringType()),
    T.StructField("minutesAsleep", T.DoubleType()),
    T.StructField("source_type", T.StringType()),
])
DAILY = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("metric", T.StringType()),
    T.StructField("ds", T.DateType()),
    T.StructField("y", T.DoubleType()),
])
FORECAST = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("metric", T.StringType()),
    T.StructField("ds", T.DateType()),
    T.StructField("yhat", T.DoubleType()),
])
EVENT_IMPACT = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("metric", T.StringType()),
    T.StructField("ds", T.DateType()),
    T.StructField("event", T.StringType()),
])


@dataclass(frozen=True)
class Rule:
    """Allowed range of one metric and how long it must be left to count."""

    metric: str
    value_name: str
    low: float
    high: float
    sustained_minutes: int
    description: str


# Default threshold rules.
DEFAULT_RULES = (
    Rule(HEART_RATE, "heart_rate", 40, 120, 10, "Heart rate outside normal resting range"),
    Rule(STEPS, "step_count", 0, 1000, 5, "Unrealistic step count detected"),
    Rule(SLEEP, "duration_minutes", 180, 720, 0, "Unusual sleep duration"),
)

# Physiological limits of a heart-rate reading, bpm.
HEART_RATE_RANGE = (30, 220)

# Planted events as (name, first day, last day), days counted from 1.
HOLIDAY_DAYS = (("vacation", 30, 37), ("sick", 60, 62), ("marathon", 90, 90))


def metric_title(metric: Column) -> Column:
    """``heart_rate`` -> ``Heart Rate``."""
    return F.initcap(F.translate(metric, "_", " "))


def metric_unit(metric: Column) -> Column:
    """Display unit of a metric, by the kind its name contains."""
    name = F.lower(metric)
    return (F.when(name.contains("heart"), "bpm")
            .when(name.contains("step"), "steps")
            .when(name.contains("sleep"), "hours")
            .otherwise("units"))
