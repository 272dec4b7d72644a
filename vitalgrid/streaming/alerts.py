"""Sustained rule violations on a stream: alerts are final once the watermark has passed their minute."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from vitalgrid.schema import DEFAULT_RULES, MEAN_METRICS

MINUTE_US = 60_000_000
ALERTS = "user_id string, metric string, ts timestamp, value double, threshold_anomaly boolean, severity string"
#: Readings that wait for the watermark, and for how many minutes the series has been too high or too low.
STATE = "ts array<long>, value array<double>, high long, low long"


def judge(rule, value: float, high: int, low: int) -> tuple[int, int, bool, bool]:
    """Lengths of both violations after one more minute, and whether each has lasted long enough."""
    if rule is None:
        return 0, 0, False, False
    high, low = high + 1 if value > rule[1] else 0, low + 1 if value < rule[0] else 0
    return high, low, high >= rule[2], low >= rule[2]


def watcher(rules: dict, means: tuple, period_us: int):
    def watch(key, batches, state):
        user, metric = key
        ts, value, high, low = state.get if state.exists else ([], [], 0, 0)
        done = state.getCurrentWatermarkMs() * 1000
        pending = dict(zip(ts, value))
        for pdf in batches:
            at = pdf["at"].to_numpy()
            for t, v in zip(at, pdf["value"].to_numpy()):
                if t // period_us * period_us + period_us > done:  # else its minute is already told
                    pending.setdefault(int(t), float(v))  # a repeated reading counts once
        minutes: dict = {}
        for t in sorted(pending):
            minutes.setdefault(t // period_us * period_us, []).append(t)
        rows = []
        for start in sorted(m for m in minutes if m + period_us <= done):
            readings = [pending.pop(t) for t in minutes[start]]
            v = sum(readings) / len(readings) if metric in means else sum(readings)
            high, low, is_high, is_low = judge(rules.get(metric), v, high, low)
            rows.append((user, metric, pd.Timestamp(start, unit="us", tz="UTC"), v, is_high or is_low, "Medium" if is_low else "High" if is_high else "Normal"))
        left = sorted(pending)
        state.update((left, [pending[t] for t in left], high, low))
        if left:
            state.setTimeoutTimestamp(max((left[0] // period_us + 1) * period_us // 1000, done // 1000 + 1))
        yield pd.DataFrame(rows, columns=["user_id", "metric", "ts", "value", "threshold_anomaly", "severity"])
    return watch


def sustained(samples: DataFrame, rules=DEFAULT_RULES, delay: str = "10 minutes", period_us: int = MINUTE_US) -> DataFrame:
    """One row a finished minute and series, flagged as the batch detector flags it.

    State of a series: the readings of minutes that are not final yet, and two run lengths. Readings of a minute that is
    final are late and dropped; readings with the same time count once. A minute without readings does not end a run, as
    in the batch detector, which counts rows.
    """
    needs = {r.metric: (r.low, r.high, max(1, r.sustained_minutes * 60_000_000 // period_us)) for r in rules}
    slim = samples.withWatermark("ts", delay).select(
        F.col("user_id").cast("string").alias("user_id"), "metric", "ts", F.unix_micros("ts").alias("at"), F.col("value").cast("double").alias("value"))
    known = slim.where(F.col("value").isNotNull())
    return known.groupBy("user_id", "metric").applyInPandasWithState(
        watcher(needs, tuple(MEAN_METRICS), period_us), ALERTS, STATE, "append", GroupStateTimeout.EventTimeTimeout)
