"""Parsing, coercion, text and label ladders on literal rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vitalgrid.functions import ladders as L, scalars as X, text, timeparse as TP


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("raw, want", [
    ("09/24/21 08:15:30", datetime(2021, 9, 24, 8, 15, 30)),
    ("2021-09-24T08:15:30", datetime(2021, 9, 24, 8, 15, 30)),
    ("2021-09-24T08:15:30.250000", datetime(2021, 9, 24, 8, 15, 30, 250000)),
    ("24-09-2021 08:15", datetime(2021, 9, 24, 8, 15)),
    ("2021-09-24 08:15:30", datetime(2021, 9, 24, 8, 15, 30)),
    ("yesterday", None), ("", None)])
def test_parse(spark, raw, want):
    assert one(spark, TP.parse_timestamp(F.col("t")).cast("timestamp_ntz"), t=raw) == want


@pytest.mark.parametrize("raw, zone, want", [
    ("2021-09-24T00:00:00", "Asia/Kolkata", datetime(2021, 9, 23, 18, 30)),
    ("2021-03-14T02:30:00", "America/New_York", datetime(2021, 3, 14, 7, 0)),
    ("2021-11-07T01:30:00", "America/New_York", None),
    ("2021-11-07T03:00:00", "America/New_York", datetime(2021, 11, 7, 8, 0)),
    ("2021-09-24T00:00:00Z", "Asia/Kolkata", datetime(2021, 9, 24, 0, 0)),
    ("2021-09-24T00:00:00+02:00", "Asia/Kolkata", datetime(2021, 9, 23, 22, 0))])
def test_local_to_utc(spark, raw, zone, want):
    assert one(spark, TP.parse_to_utc(F.col("t"), zone=zone).cast("timestamp_ntz"), t=raw) == want


@pytest.mark.parametrize("raw, want", [("12.5", 12.5), ("abc", None), ("", None), ("NaN", None), ("inf", None), (" 7 ", 7.0)])
def test_numbers(spark, raw, want):
    assert one(spark, X.to_number(F.col("t")), t=raw) == want
    assert one(spark, X.to_number_or_zero(F.col("t")), t=raw) == (want or 0.0)


@pytest.mark.parametrize("raw, want", [
    ("plain", "plain"), ("⚠️ 2σ", "[ALERT] 2std_dev"), ("⚠ a → b", "[ALERT] a [RIGHT] b"), ("é±3", " +/- 3"),
    ("☀ ≥5°", "  >= 5 deg"), ("a—b…", "a-b...")])
def test_ascii(spark, raw, want):
    assert one(spark, text.to_ascii(F.col("t")), t=raw) == want


@pytest.mark.parametrize("hr, steps, sleep, want", [
    (None, 5000.0, 8.0, "Syncing Data"), (70.0, None, 8.0, "Syncing Data"), (70.0, 12000.0, 5.0, "Needs Rest"),
    (96.0, 12000.0, 8.0, "Needs Rest"), (70.0, 2000.0, 8.0, "Low Activity"), (70.0, 12000.0, 8.0, "Great Balance"),
    (70.0, 12000.0, None, "On Track"), (70.0, 8000.0, 8.0, "On Track")])
def test_status(spark, hr, steps, sleep, want):
    cast = lambda c: F.col(c).cast("double")
    assert one(spark, L.health_status(cast("h"), cast("s"), cast("z")), h=hr, s=steps, z=sleep)["label"] == want


def test_zero_trend_is_decreasing(spark):
    assert one(spark, L.trend_label(F.col("t")), t=0.0) == "Decreasing"


def test_formats(spark):
    assert one(spark, X.percent_label(F.col("t")), t=0.4286) == "42.9%"
    assert one(spark, X.thousands(F.col("t")), t=1234567.5) == "1,234,568"
    assert one(spark, X.fixed(F.col("t"), 2), t=1.235) == "1.24"
