"""One-minute timelines: resampling, interval expansion, gap filling, alignment.

A timeline is a frame of minutes, or of runs (``_start``, ``_until``) of minutes that follow one rule: a constant
``value``, or the line through the known values around them. Runs hold what minutes hold in as many rows as were observed,
so timelines are filled and put side by side as runs and their minutes are made once, behind every shuffle and sort.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.operators import series as S
from vitalgrid.schema import HEART_RATE, KEYS, SLEEP, STEPS

MINUTE_US = 60_000_000
DAY_US = 1440 * MINUTE_US

#: The known values (t, v) before and after a minute, as ``dense_minutes`` hands them on.
P0, P1 = "_p0", "_p1"

#: First and last minute of a run.
START, UNTIL = "_start", "_until"

#: What a minute of sleep adds, in hours.
SLEEP_MINUTE = 1.0 / 60.0


def minute_mean(samples: DataFrame, keys=KEYS, ts: str = "ts", value: str = "value") -> DataFrame:
    """Mean per observed minute."""
    return (samples.groupBy(*keys, F.date_trunc("minute", ts).alias("ts"))
            .agg(F.avg(value).alias("value")))


def minute_sum(samples: DataFrame, keys=KEYS, ts: str = "ts", value: str = "value") -> DataFrame:
    """Sum per observed minute."""
    return (samples.groupBy(*keys, F.date_trunc("minute", ts).alias("ts"))
            .agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("value")))


#: Days of one-minute rows a task works on when whole timelines are put side by side.
TASK_DAYS = 1_000


def day_tasks(samples: DataFrame, key: str = "user_id", ts: str = "ts") -> int:
    """Tasks to deal the days of all timelines to, so that what a task holds does not grow with the input."""
    spans = samples.groupBy(key).agg((F.datediff(F.max(ts), F.min(ts)) + 1).alias("_days"))
    days = spans.agg(F.sum("_days")).first()[0] or 0
    return max(_tasks(samples), math.ceil(days / TASK_DAYS))


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def every_minute(df: DataFrame, first: str, last: str, name: str = "ts", by=("user_id",), tasks: int | None = None) -> DataFrame:
    """One row a minute from ``first`` to ``last``, and its day: days first, then the at most 1,440 minutes of each.

    So a single reading far off makes many rows, never one huge array. Days are dealt to a fixed number of tasks, as few
    bytes are many minutes; the minutes are made behind that shuffle.
    """
    days = df.withColumn(S.CHUNK, F.explode(F.sequence(F.date_trunc("day", first), F.col(last), F.expr("INTERVAL 1 DAY"))))
    dealt = days.repartition(tasks or _tasks(df), *by, S.CHUNK)
    start, end, day = (F.unix_micros(F.col(c)) for c in (first, last, S.CHUNK))
    minutes = F.sequence(F.greatest(start, day), F.least(end, day + (DAY_US - 1_000_000)), F.lit(MINUTE_US))
    return dealt.withColumn(name, F.explode(minutes)).withColumn(name, F.timestamp_micros(name))


def by_day(runs: DataFrame) -> DataFrame:
    """Runs cut at midnight: the day, and the first and last minute in it (``_a``, ``_b``, in microseconds)."""
    days = runs.withColumn(S.CHUNK, F.explode(F.sequence(F.date_trunc("day", START), F.col(UNTIL), F.expr("INTERVAL 1 DAY"))))
    day = F.unix_micros(S.CHUNK)
    return (days.withColumn("_a", F.greatest(F.unix_micros(START), day))
            .withColumn("_b", F.least(F.unix_micros(UNTIL), day + (DAY_US - MINUTE_US))).drop(START, UNTIL))


def _steps_of(edges: DataFrame, by) -> DataFrame:
    """The last minute ``_b`` before the next edge of the day for the edges ``_a`` of each day."""
    until = F.coalesce(F.lead("_a").over(Window.partitionBy(*by, S.CHUNK).orderBy("_a")) - MINUTE_US, F.unix_micros(S.CHUNK) + (DAY_US - MINUTE_US))
    return edges.withColumn("_b", until)


def _ends(pieces: DataFrame) -> DataFrame:
    """The minute after each piece that ends before its day does."""
    return pieces.where(F.col("_b") < F.unix_micros(S.CHUNK) + (DAY_US - MINUTE_US)).withColumn("_a", F.col("_b") + MINUTE_US)


def dense_minutes(observed: DataFrame, fill=None, keys=KEYS, around: bool = False, tasks: int | None = None,
                  runs: bool = False) -> DataFrame:
    """Every minute between the first and last observed one.

    Each observed minute expands over the gap up to the next one, so no grid is
    built or joined. Added minutes get ``fill`` (null by default). ``around``
    adds the known values before and after each minute, found among the observed
    rows, so that ``interpolate`` need not look for them among the minutes.
    ``tasks`` keeps the day and deals the days of a user to so many tasks.
    ``runs`` gives the runs of these minutes instead: with ``around`` for
    ``interpolate``, else with the constant value of each run.
    """
    local = S.chunked(observed, unit="day")
    known = F.when(F.col("value").isNotNull(), F.struct(F.col("ts").alias("t"), F.col("value").alias("v")))
    aggs, context = {"_first": F.min("ts")}, {"_next_day": F.min("_first").over(S.after(keys))}
    if around:
        aggs |= {"_head": F.min(known), "_tail": F.max(known)}
        context |= {"_before": F.max("_tail").over(S.before(keys)), "_after": F.min("_head").over(S.after(keys))}
    led = S.hand_over(local, S.summaries(local, aggs, keys), context, keys)
    w = Window.partitionBy(*keys, S.CHUNK)
    end = F.coalesce(F.lead("ts").over(w.orderBy("ts")), "_next_day")
    until = F.when(end.isNull(), F.col("ts")).otherwise(end - F.expr("INTERVAL 1 MINUTE"))
    points = {}
    if around:
        back_from = w.orderBy(F.desc("ts")).rowsBetween(Window.unboundedPreceding, -1)
        points = {P0: F.coalesce(F.last(known, True).over(w.orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)), "_before"),
                  P1: F.coalesce(F.last(known, True).over(back_from), "_after")}
    spread = led.select(*keys, "value", F.col("ts").alias(START), until.alias(UNTIL), *[c.alias(n) for n, c in points.items()])
    if runs:
        return spread if around else _constant_runs(spread, fill)
    value = F.when(F.col("ts") == F.col("_start"), F.col("value")).otherwise(F.lit(fill).cast("double"))
    return (every_minute(spread, "_start", "_until", by=keys[:1], tasks=tasks)
            .select(*keys, "ts", value.alias("value"), *points, *([S.CHUNK] if tasks else [])))


def _constant_runs(spread: DataFrame, fill) -> DataFrame:
    """The observed minute of each run, and the minutes after it with ``fill``."""
    rest = [c for c in spread.columns if c not in ("value", START, UNTIL)]
    here = F.struct(F.col("value").cast("double").alias("value"), F.col(START).alias(START), F.col(START).alias(UNTIL))
    after = F.col(START) + F.expr("INTERVAL 1 MINUTE")
    filled = F.when(after <= F.col(UNTIL), F.struct(F.lit(fill).cast("double").alias("value"), after.alias(START), F.col(UNTIL).alias(UNTIL)))
    return spread.select(*rest, F.inline(F.array_compact(F.array(here, filled))))


def sleep_minutes(intervals: DataFrame, start: str = "start", end: str = "end",
                  keys=("user_id",), tasks: int | None = None, runs: bool = False) -> DataFrame:
    """One row of 1/60 hour per minute of ``[start, end)``.

    Starts are floored to the minute; an empty or reversed interval yields its
    start only; intervals with a missing end or start are dropped. ``tasks``
    keeps the day and deals the days of a user to so many tasks. ``runs`` gives
    the intervals as runs instead.
    """
    first = F.date_trunc("minute", start)
    last = F.greatest(first, F.timestamp_micros(F.unix_micros(end) - 1))
    spans = intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(*keys, first.alias(START), last.alias(UNTIL))
    if runs:
        return spans.withColumn(UNTIL, F.date_trunc("minute", UNTIL))
    return (spans.transform(every_minute, START, UNTIL, by=keys[:1], tasks=tasks)
            .select(*keys, "ts", F.lit(SLEEP_MINUTE).alias("value"), *([S.CHUNK] if tasks else [])))


def sleep_per_minute(minutes: DataFrame, keys=("user_id",)) -> DataFrame:
    """Overlapping intervals add up; of runs, each stretch of minutes with as many intervals becomes a run."""
    if UNTIL in minutes.columns:
        cut = by_day(minutes.select(*keys, START, UNTIL))
        turns = cut.withColumn("_d", F.lit(1)).unionByName(_ends(cut).withColumn("_d", F.lit(-1)))
        turns = turns.groupBy(*keys, S.CHUNK, "_a").agg(F.sum("_d").alias("_d"))
        asleep = F.sum("_d").over(Window.partitionBy(*keys, S.CHUNK).orderBy("_a").rowsBetween(Window.unboundedPreceding, 0))
        return (_steps_of(turns.withColumn("_n", asleep), keys).where(F.col("_n") > 0)
                .select(*keys, F.timestamp_micros("_a").alias(START), F.timestamp_micros("_b").alias(UNTIL),
                        (F.col("_n") * SLEEP_MINUTE).alias("value")))
    return minutes.groupBy(*keys, *_day_of(minutes), "ts").agg(F.sum("value").alias("value"))


def _day_of(*frames: DataFrame) -> list[str]:
    """The day as a column to group by, if all frames have kept it: then their minutes need no further shuffle."""
    return [S.CHUNK] if all(S.CHUNK in f.columns for f in frames) else []


def _estimate(p0: str, p1: str) -> Column:
    """The line between two known points at ``ts``; the first value if there is no second."""
    t, t0, t1 = (F.unix_micros(F.col(c)) for c in ("ts", f"{p0}.t", f"{p1}.t"))
    on_line = F.col(f"{p0}.v") + (F.col(f"{p1}.v") - F.col(f"{p0}.v")) * (t - t0) / F.nullif(t1 - t0, F.lit(0))
    return F.when(F.col(f"{p1}.t").isNull(), F.col(f"{p0}.v")).otherwise(on_line)


def interpolate(df: DataFrame, value: str = "value", limit: int = 5, keys=KEYS) -> DataFrame:
    """Time-weighted linear interpolation, forward only, at most ``limit`` rows per gap.

    Leading nulls stay; trailing nulls repeat the last value within the limit.
    Minutes of ``dense_minutes`` that come with the values around them are
    filled where they are: there, rows since the last value are minutes. Such
    runs are cut where the limit ends; those that stay null lose their line.
    """
    known = F.col(value).isNotNull()
    if UNTIL in df.columns:
        return _fill_runs(df, value, limit)
    if P0 in df.columns:
        gap = F.unix_micros("ts") - F.unix_micros(F.col(f"{P0}.t"))
        return df.withColumn(value, F.when(known, F.col(value)).when(gap <= limit * MINUTE_US, _estimate(P0, P1))).drop(P0, P1)
    parts = [*keys, S.CHUNK]
    up_to = Window.partitionBy(*parts).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    back_from = Window.partitionBy(*parts).orderBy(F.desc("ts")).rowsBetween(Window.unboundedPreceding, 0)
    local = (df if _day_of(df) else S.chunked(df, unit="day")).withColumn(
        "_rn", F.row_number().over(Window.partitionBy(*parts).orderBy("ts")))
    point = F.when(known, F.struct(F.col("ts").alias("t"), F.col(value).alias("v"), F.col("_rn").alias("rn")))
    per_chunk = S.summaries(local, {
        "_n": F.count(F.lit(1)),
        "_head": F.min(point),
        "_tail": F.max(point),
    }, keys)
    offset = F.coalesce(F.sum("_n").over(S.before(keys)), F.lit(0))
    per_chunk = (per_chunk.withColumn("_offset", offset)
                 .withColumn("_tail", F.when(F.col("_tail").isNotNull(), F.struct(
                     F.col("_tail.t").alias("t"), F.col("_tail.v").alias("v"),
                     (F.col("_tail.rn") + F.col("_offset")).alias("rn")))))
    # Spark knows the size of what made the minutes, not theirs: left to itself it would broadcast them.
    led = S.hand_over(local.hint("merge"), per_chunk, {
        "_offset": F.col("_offset"),
        "_before": F.max("_tail").over(S.before(keys)),
        "_after": F.min("_head").over(S.after(keys)),
    }, keys)
    here = F.when(known, F.struct(F.col("ts").alias("t"), F.col(value).alias("v"),
                                  (F.col("_rn") + F.col("_offset")).alias("rn")))
    filled = (led
              .withColumn("_p0", F.coalesce(F.last(here, True).over(up_to), F.col("_before")))
              .withColumn("_p1", F.coalesce(
                  F.last(F.when(known, F.struct(F.col("ts").alias("t"), F.col(value).alias("v"))), True)
                  .over(back_from),
                  F.struct(F.col("_after.t").alias("t"), F.col("_after.v").alias("v")))))
    gap_row = F.col("_rn") + F.col("_offset") - F.col("_p0.rn")
    return filled.select(
        *[c for c in df.columns if c != value],
        F.when(known, F.col(value)).when(gap_row <= limit, _estimate("_p0", "_p1")).alias(value))


def _fill_runs(runs: DataFrame, value: str, limit: int) -> DataFrame:
    rest = [c for c in runs.columns if c not in (value, START, UNTIL, P0, P1)]
    last = F.timestamp_micros(F.least(F.unix_micros(UNTIL), F.unix_micros(F.col(f"{P0}.t")) + limit * MINUTE_US))
    nothing = F.lit(None).cast(runs.schema[P0].dataType)

    def run(start, until, p0, p1):
        return F.struct(start.alias(START), until.alias(UNTIL), p0.alias(P0), p1.alias(P1))

    filled = F.when(last >= F.col(START), run(F.col(START), last, F.col(P0), F.col(P1)))
    begin = F.when(last >= F.col(START), last + F.expr("INTERVAL 1 MINUTE")).otherwise(F.col(START))
    empty = F.when(begin <= F.col(UNTIL), run(begin, F.col(UNTIL), nothing, nothing))
    return runs.select(*rest, F.inline(F.array_compact(F.array(filled, empty))))


def _on_line(us: Column, p0: str, p1: str) -> Column:
    """The value at ``us`` (microseconds) of the line through two known points; the first value if there is no second."""
    t0, t1, v0, v1 = (F.col(c) for c in (f"{p0}.t", f"{p1}.t", f"{p0}.v", f"{p1}.v"))
    return F.when(t1.isNull() | (us == t0), v0).otherwise(v0 + (v1 - v0) * (us - t0) / F.nullif(t1 - t0, F.lit(0)))


def _align_runs(heart_rate: DataFrame, steps: DataFrame, sleep: DataFrame, limit: int, key: str, tasks: int | None) -> DataFrame:
    """``align`` of runs: pieces in which no timeline changes its rule, then the minutes of each piece."""
    def point(p: str) -> Column:
        at = F.struct(F.unix_micros(F.col(f"{p}.t")).alias("t"), F.col(f"{p}.v").cast("double").alias("v"))
        return F.when(F.col(p).isNotNull(), at)

    def state(on: bool, **of: Column) -> Column:
        return F.struct(F.lit(on).alias("on"), *[F.when(F.lit(on), c).alias(n) for n, c in of.items()])

    names, edges = (HEART_RATE, STEPS, SLEEP), None
    rules = ({"p0": point(P0), "p1": point(P1)}, *[{"v": F.col("value").cast("double")}] * 2)
    for name, frame, rule in zip(names, (heart_rate, steps, sleep), rules, strict=True):
        cut = by_day(frame)
        both = cut.withColumn(name, state(True, **rule)).unionByName(_ends(cut).withColumn(name, state(False, **rule))).select(key, S.CHUNK, "_a", name)
        edges = both if edges is None else edges.unionByName(both, allowMissingColumns=True)
    # where a run ends and the next one starts, the one that is on is the greater
    edges = (edges.repartition(tasks or _tasks(edges), key, S.CHUNK).groupBy(key, S.CHUNK, "_a")
             .agg(*[F.max(n).alias(n) for n in names]))
    up_to = Window.partitionBy(key, S.CHUNK).orderBy("_a").rowsBetween(Window.unboundedPreceding, 0)
    alive = F.coalesce(F.col(f"{HEART_RATE}.on"), F.lit(False))
    for n in (STEPS, SLEEP):
        alive = alive | F.coalesce(F.col(f"{n}.on"), F.lit(False))
    pieces = (_steps_of(edges.select(key, S.CHUNK, "_a", *[F.last(n, True).over(up_to).alias(n) for n in names]), (key,))
              .where(alive)
              .select(key, S.CHUNK, "_a", "_b", F.col(f"{HEART_RATE}.p0").alias(P0), F.col(f"{HEART_RATE}.p1").alias(P1),
                      F.coalesce(f"{STEPS}.v", F.lit(0.0)).alias("steps"), F.coalesce(f"{SLEEP}.v", F.lit(0.0)).alias("sleep_hours")))
    us = F.explode(F.sequence("_a", "_b", F.lit(MINUTE_US)))
    minutes = _refilled(pieces, limit, key).withColumn("_us", us)
    heart = F.when(F.col("_us") <= F.col("_filled"), _on_line(F.col("_us"), P0, P1))
    return minutes.select(key, *([S.CHUNK] if tasks else []), F.timestamp_micros("_us").alias("ts"),
                          "steps", "sleep_hours", heart.alias("heart_rate"))


def _refilled(pieces: DataFrame, limit: int, key: str) -> DataFrame:
    """``interpolate`` of pieces that are known or unknown throughout: the line of each and ``_filled``, the last minute it is for."""
    first, last = (_on_line(F.col(c), P0, P1) for c in ("_a", "_b"))
    known = F.col(P0).isNotNull()
    rows = (F.col("_b") - F.col("_a")) / MINUTE_US + 1
    before = Window.partitionBy(key, S.CHUNK).orderBy("_a").rowsBetween(Window.unboundedPreceding, -1)
    local = (pieces.withColumn("_n", rows.cast("long"))
             .withColumn("_rn", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .withColumn("_head", F.when(known, F.struct(F.col("_a").alias("t"), first.alias("v"))))
             .withColumn("_tail", F.when(known, F.struct(F.col("_b").alias("t"), last.alias("v"), (F.col("_rn") + F.col("_n")).alias("rn")))))
    per_day = S.summaries(local, {"_n": F.sum("_n"), "_head": F.min("_head"), "_tail": F.max("_tail")}, (key,))
    offset = F.coalesce(F.sum("_n").over(S.before((key,))), F.lit(0))
    per_day = (per_day.withColumn("_offset", offset)
               .withColumn("_tail", F.when(F.col("_tail").isNotNull(), F.struct(
                   F.col("_tail.t").alias("t"), F.col("_tail.v").alias("v"), (F.col("_tail.rn") + F.col("_offset")).alias("rn")))))
    led = S.hand_over(local.drop("_n"), per_day, {
        "_offset": F.col("_offset"),
        "_before": F.max("_tail").over(S.before((key,))),
        "_after": F.min("_head").over(S.after((key,))),
    }, (key,))
    ahead = Window.partitionBy(key, S.CHUNK).orderBy(F.desc("_a")).rowsBetween(Window.unboundedPreceding, -1)
    here = F.struct(F.col("_tail.t").alias("t"), F.col("_tail.v").alias("v"), (F.col("_tail.rn") + F.col("_offset")).alias("rn"))
    led = (led.withColumn("_q0", F.coalesce(F.last(F.when(F.col("_tail").isNotNull(), here), True).over(before), F.col("_before")))
           .withColumn("_q1", F.coalesce(F.last("_head", True).over(ahead), F.col("_after"))))
    left = limit + F.col("_q0.rn") - F.col("_rn") - F.col("_offset")
    q0 = F.when(F.col("_q0").isNotNull(), F.struct(F.col("_q0.t").alias("t"), F.col("_q0.v").alias("v")))
    return led.select(
        key, S.CHUNK, "_a", "_b", "steps", "sleep_hours",
        F.when(known, F.col(P0)).otherwise(q0).alias(P0), F.when(known, F.col(P1)).otherwise(F.col("_q1")).alias(P1),
        F.when(known, F.col("_b")).otherwise(F.col("_a") + (left - 1) * MINUTE_US).alias("_filled"))


def align(heart_rate: DataFrame, steps: DataFrame, sleep: DataFrame, limit: int = 5,
          key: str = "user_id", tasks: int | None = None) -> DataFrame:
    """Union of the three timelines as one wide row per minute.

    Missing steps and sleep become 0, heart-rate gaps are interpolated once more.
    Timelines that were dealt to tasks by user and day meet there, without
    another shuffle of their minutes. Runs meet as runs; ``tasks`` keeps their
    day and deals the days of a user to so many tasks.
    """
    if UNTIL in heart_rate.columns:
        return _align_runs(heart_rate, steps, sleep, limit, key, tasks)
    day = _day_of(heart_rate, steps, sleep)
    long = None
    for metric, frame in ((HEART_RATE, heart_rate), (STEPS, steps), (SLEEP, sleep)):
        part = frame.select(key, *day, F.lit(metric).alias("metric"), "ts", F.col("value").cast("double").alias("value"))
        long = part if long is None else long.unionByName(part)

    def pick(metric: str):
        return F.max(F.when(F.col("metric") == metric, F.col("value")))

    wide = long.groupBy(key, *day, "ts").agg(
        pick(HEART_RATE).alias("heart_rate"),
        F.coalesce(pick(STEPS), F.lit(0.0)).alias("steps"),
        F.coalesce(pick(SLEEP), F.lit(0.0)).alias("sleep_hours"))
    return interpolate(wide, "heart_rate", limit, keys=(key,)).drop(*day)


def chronological_split(df: DataFrame, test_ratio: float = 0.2, keys=KEYS, ts: str = "ts",
                        order=None, unit: str = "hour") -> DataFrame:
    """Add ``split``: the last ``int(n * ratio)`` rows of each series are ``test``."""
    numbered = S.number_rows(df, order or [ts], keys, ts, unit)
    n_test = F.floor(F.col("n_rows") * F.lit(test_ratio))
    return (numbered.withColumn("split", F.when(F.col("rn") > F.col("n_rows") - n_test, "test").otherwise("train"))
            .drop("rn", "n_rows"))
