"""Minutes are made where they are used: what is shuffled are observed rows and days."""

import random
from datetime import datetime, timedelta

import pytest

from vitalgrid.operators import timeline as TL
from vitalgrid.schema import KEYS

START = datetime(2024, 1, 1, 23, 50)
SCHEMA = "user_id long, metric string, ts timestamp, value double"
# minutes from the start with their values; one observed minute without a value, gaps over midnight and a whole day
POINTS = [(0, None), (2, 5.0), (6, 9.0), (9, None), (12, 3.0), (40, 1.0), (3000, 7.0), (3003, None), (3020, None)]


def samples(spark, metric="heart_rate"):
    rows = [(u, metric, START + timedelta(minutes=m + u), v) for u in (1, 2) for m, v in POINTS]
    rows += [(None, metric, START, 1.0), (1, metric, None, 2.0)]
    return spark.createDataFrame(rows, SCHEMA)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def above_the_minutes(df) -> str:
    """The plan from its end down to where minutes are made."""
    return plan(df).split("explode(sequence(greatest(")[0]


def table(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("limit", [1, 5, 10])
def test_filled_in_place_as_by_search(spark, limit):
    around = TL.interpolate(TL.dense_minutes(samples(spark), around=True), limit=limit).select(*KEYS, "ts", "value")
    plain = TL.interpolate(TL.dense_minutes(samples(spark)), limit=limit).select(*KEYS, "ts", "value")
    assert table(around) == table(plain)
    assert around.count() == 2 * 3021
    assert "Exchange" not in above_the_minutes(around)


def test_minutes_are_dealt_whatever_their_bytes(spark):
    dense = TL.dense_minutes(samples(spark), fill=0.0)
    assert dense.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def timelines(spark, tasks):
    asleep = spark.createDataFrame([(1, START, START + timedelta(minutes=30, seconds=5)), (1, START, START), (3, START, START + timedelta(minutes=3))],
                                   "user_id long, start timestamp, end timestamp")
    heart = TL.interpolate(TL.dense_minutes(samples(spark), around=bool(tasks), tasks=tasks))
    steps = TL.dense_minutes(TL.minute_sum(samples(spark, "steps")), fill=0.0, tasks=tasks)
    return TL.align(heart, steps, TL.sleep_per_minute(TL.sleep_minutes(asleep, tasks=tasks)))


def test_timelines_meet_by_day(spark):
    dealt, plain = timelines(spark, 7), timelines(spark, None)
    assert dealt.columns == plain.columns
    assert table(dealt) == table(plain)
    assert "BroadcastExchange" not in above_the_minutes(dealt)
    assert "hashpartitioning(user_id" not in above_the_minutes(dealt)


def test_days_of_a_task(spark):
    assert TL.day_tasks(samples(spark)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    far = spark.createDataFrame([(1, "steps", START, 1.0), (1, "steps", START + timedelta(days=9 * TL.TASK_DAYS), 1.0)], SCHEMA)
    assert TL.day_tasks(far) == 10


def test_daily_summary_needs_no_shuffle_behind_the_minutes(spark):
    from vitalgrid.plans.q_series import per_day

    rows = samples(spark, "steps")
    dealt = per_day(TL.dense_minutes(TL.minute_sum(rows), fill=0.0, tasks=5), "value")
    assert table(dealt) == table(per_day(TL.dense_minutes(TL.minute_sum(rows), fill=0.0), "value"))
    assert "Exchange" not in above_the_minutes(dealt)


def scattered(spark, users=6):
    """Readings with and without values, whose timelines start, end and pause apart, and nights that overlap."""
    draw = random.Random(4)
    rows = [(u, m, START + timedelta(minutes=at + draw.randrange(span), seconds=draw.randrange(60)), draw.choice([None, float(draw.randrange(90))]))
            for u in range(users) for m, at, span in (("heart_rate", 0, 60 + 40 * u), ("steps", 40 * u - 60, 90), ("heart_rate", 2000, 5)) for _ in range(7)]
    rows += [(None, "steps", START, 1.0), (1, "heart_rate", None, 2.0)]
    nights = [(u, start, start + timedelta(seconds=draw.choice([-5, 0, 1, 90, 600, 100_000])))
              for u in [*range(users + 1), None] for start in [START + timedelta(minutes=draw.randrange(-200, 2500), seconds=draw.randrange(60)) for _ in range(5)]]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([*nights, (1, None, START), (1, START, None)], "user_id long, start timestamp, end timestamp")


def side_by_side(spark, limit, **how):
    rows, asleep = scattered(spark)
    heart = TL.interpolate(TL.dense_minutes(TL.minute_mean(rows.where("metric = 'heart_rate'")), around=bool(how), **how), limit=limit)
    steps = TL.dense_minutes(TL.minute_sum(rows.where("metric = 'steps'")), fill=0.0, **how)
    return TL.align(heart, steps, TL.sleep_per_minute(TL.sleep_minutes(asleep, **how)), limit=limit)


@pytest.mark.parametrize("limit", [1, 5, 10])
def test_runs_meet_as_minutes_do(spark, limit):
    def seen(df):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select("user_id", "ts", "heart_rate", "steps", "sleep_hours").collect()), key=repr)

    minutes, runs = seen(side_by_side(spark, limit)), seen(side_by_side(spark, limit, runs=True))
    assert runs == minutes
    assert len({r[0] for r in runs}) == 7 and any(r[2] is not None for r in runs) and any(r[4] > 0.02 for r in runs)


def test_aligned_minutes_are_made_last(spark):
    from vitalgrid.plans import canonical as C
    from vitalgrid.plans.q_series import per_day

    days = per_day(C.aligned(*scattered(spark)), "heart_rate", "steps", "sleep_hours")
    made = plan(days).split("explode(sequence(_a")
    assert len(made) == 2
    assert not any(word in made[0] for word in ("Exchange", "Sort", "Join", "Window"))
