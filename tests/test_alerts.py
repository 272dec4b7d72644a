import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import Observation, functions as F

from vitalgrid.operators import threshold as T, timeline as TL
from vitalgrid.schema import Rule
from vitalgrid.sources import records
from vitalgrid.streaming import alerts, ingest

START = datetime(2021, 9, 24, 8, tzinfo=timezone.utc)
RULES = (Rule("heart_rate", "heart_rate", 40, 120, 3, ""), Rule("steps", "steps", 0, 100, 0, ""))


def reading(minute, value, user="u", metric="heart_rate", second=10):
    return {"user_id": user, "metric": metric, "ts": (START + timedelta(minutes=minute, seconds=second)).isoformat(), "value": value}


@pytest.fixture
def stream(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    src.mkdir()
    schema = "user_id string, metric string, ts timestamp, value double"
    sent = []

    def push(rows, delay="5 minutes"):
        sent.append(rows)
        (src / f"{len(sent):03d}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
        df = alerts.sustained(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src)), RULES, delay)
        query = (df.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", state)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        return {(r.user_id, r.metric, r.ts): (round(r.value, 9), r.threshold_anomaly, r.severity) for r in spark.read.schema(alerts.ALERTS).parquet(out).collect()}

    def batch(until):
        """The batch detector on all distinct readings of the minutes before."""
        rows = spark.createDataFrame([(r["user_id"], r["metric"], datetime.fromisoformat(r["ts"]), float(r["value"])) for rs in sent for r in rs], schema).distinct()
        rows = rows.where(F.col("ts") < F.lit(until))
        minutes = TL.minute_mean(rows.where("metric = 'heart_rate'")).unionByName(TL.minute_sum(rows.where("metric <> 'heart_rate'")))
        return {(r.user_id, r.metric, r.ts): (round(r.value, 9), r.threshold_anomaly, r.severity) for r in T.detect(minutes, T.rules_table(spark, RULES)).collect()}

    return push, batch


def test_alerts_equal_the_batch_detector(stream):
    """Several runs on one checkpoint, records out of order and repeated; flags are those of the batch before the watermark."""
    push, batch = stream
    high = [reading(m, 130 if 3 <= m < 9 or m in (12, 13) else 70) for m in range(20)]
    low = [reading(m, 30 if m >= 5 else 80, user="v") for m in range(20)]
    steps = [reading(m, 40 * (m % 4), metric="steps", second=s) for m in range(20) for s in (1, 30)]
    rows = [*high, *low, *steps]
    push(rows[::2], "30 minutes")
    push([*rows[1::2][::-1], *rows[:7]], "30 minutes")  # within the watermark's delay, or repeated
    got = push([reading(65, 70), reading(65, 70, user="v"), reading(65, 1, metric="steps")], "30 minutes")
    want = batch(START + timedelta(minutes=35))
    late = {k for k in want if k not in got or got[k] != want[k]}
    assert len(want) == 60 and not late
    assert sum(v[1] for v in got.values()) > 10 and {v[2] for v in got.values()} == {"Normal", "High", "Medium"}


def test_late_readings_are_left_out(stream):
    push, _ = stream
    push([reading(m, 70) for m in range(10)])
    push([reading(30, 70)])
    before = push([reading(31, 70)])
    after = push([reading(2, 500), reading(60, 70)])  # minute 2 is final
    final = push([reading(61, 70)])
    assert all(after[k] == v for k, v in before.items()) and all(final[k] == v for k, v in before.items())
    assert not any(v[1] for v in final.values())


def test_counters_ride_along(spark, tmp_path):
    docs = [{"user_id": "u", "data": {"time": "2021-09-24T08:00:10", "bpm": 60}}, {"user_id": "u", "data": {"time": "x", "bpm": 61}},
            {"user_id": "u", "payload": {"ts": "2021-09-24T08:01:10", "steps": 5}}, {"other": 1}]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("".join(json.dumps(d) + "\n" for d in docs))
    samples = ingest.samples_from_records(ingest.read_records(spark, str(tmp_path / "in")))
    query = ingest.append(ingest.minute_table(samples), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    found = ingest.counters(query)
    assert (found["total"], found["heart_rate"], found["steps"], found["sleep"], found["without_time"], found["late"]) == (4, 2, 1, 0, 1, 0)
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "record string")
    read, matched = Observation(), Observation()
    assert records.counted(records.route(records.counted(df, read, False)), matched, True).count() == 3
    assert read.get == {"total": 4} and matched.get == {"heart_rate": 2, "steps": 1, "sleep": 0}
