"""Record routing, schema detection, readers."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from vitalgrid.schema import RAW_HEART_RATE, RAW_SLEEP, RAW_STEPS
from vitalgrid.sources import files, profile, records, sniff


def route(spark, *docs):
    rows = [(d if isinstance(d, str) else json.dumps(d),) for d in docs]
    return records.route(spark.createDataFrame(rows, "record string")).collect()


def test_payload_and_precedence(spark):
    (a,) = route(spark, {"user_id": "u", "type": "hr", "data": {"time": "t1", "hr": "72", "steps": 5}})
    assert (a.user_id, a.metric, a.timestamp, a.value, a.source_type) == ("u", "heart_rate", "t1", 72.0, "hr")
    (b,) = route(spark, {"owner": 3, "data": 5, "payload": {"ts": "", "date": "d", "stepCount": "12.7"}})
    assert (b.user_id, b.metric, b.timestamp, b.value) == ("3", "steps", "d", 0.0)
    (c,) = route(spark, {"data": {"userid": "n", "start": "", "startTime": "s", "endTime": "e"}})
    assert (c.user_id, c.metric, c.startTime, c.endTime, c.value) == ("n", "sleep", "s", "e", None)


def test_value_key_is_heart_rate_and_rest_is_dropped(spark):
    (a,) = route(spark, {"id": None, "user_id": None, "value": 61, "steps": 9})
    assert (a.metric, a.value, a.user_id) == ("heart_rate", 61.0, None)
    assert route(spark, {"user_id": 1, "note": "x"}, "not json", "[1, 2]") == []
    (s,) = route(spark, {"steps": 12.7, "type": 4})
    assert (s.metric, s.value, s.source_type) == ("steps", 12.0, None)


def test_nulls_count_as_present(spark):
    (a,) = route(spark, {"data": {"heart_rate": None, "hr": 80}})
    assert (a.metric, a.value) == ("heart_rate", None)


def test_key_types(spark):
    docs = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 2.5}',), ("bad",)], "record string")
    got = {(r.key, r.type, r.n) for r in records.key_types(docs).collect()}
    assert ("b", "STRING", 1) in got and {k for k, _, _ in got} == {"a", "b"}


def test_date_and_value_columns():
    assert sniff.date_column(["id", " activityDate ", "ds"]) == " activityDate "
    assert sniff.date_column(["a", "b"]) is None
    assert sniff.value_column(["date", "steps", "value"]) == "value"
    assert sniff.value_column(["update", "my_bpm"]) == "my_bpm"


def test_metric_columns():
    found = sniff.metric_columns(["ds", "threshold", "restHR", "step_count", "minutesAsleep"], "ds")
    assert found == {"heart_rate": "restHR", "steps": "step_count", "sleep": "minutesAsleep"}
    assert sniff.metric_columns(["ds", "threshold"], "ds") == {}
    assert sniff.metric_columns(["ds", "avgheartrate"], "ds") == {"heart_rate": "avgheartrate"}


def test_interval_and_timestamp_columns():
    assert sniff.interval_columns(["id", "startTime", "endTime"]) == ("startTime", "endTime")
    assert sniff.interval_columns(["bedtime", "wake_date"]) == ("bedtime", "wake_date")
    assert sniff.interval_columns(["bedtime"]) is None
    with pytest.raises(ValueError):
        sniff.timestamp_column(["a"])


def test_strict_timestamps_fail(spark):
    df = spark.createDataFrame([("2021-01-01",), ("bad",)], "ts string")
    assert sniff.bad_timestamps(df, "ts").first()["bad"] == 1
    with pytest.raises(ValueError, match="1 values of ts"):
        sniff.strict_timestamps(df, "ts").collect()


def test_generic_file_by_name(spark):
    df = spark.createDataFrame([("2021-01-01", "5"), ("x", "6"), ("2021-01-02", "y")], "ds string, y string")
    rows = sniff.extract_samples(df, file_name=F.lit("My_Sleep.csv")).collect()
    assert [(r.metric, r.value) for r in rows] == [("sleep", 5.0)]


def test_csv_pruning_and_missing(spark, tmp_path):
    (tmp_path / "hr.csv").write_text("extra,Timestamp,heart_rate,user_id\n1,09/24/21 08:00:00,72,u\n2,bad,80,u\n3,09/24/21 08:01:00,500,u\n")
    df = files.read_csv(spark, str(tmp_path / "hr.csv"), RAW_HEART_RATE)
    assert df.columns == ["Timestamp", "heart_rate", "user_id"]
    rows = files.clean_heart_rate(df.withColumnRenamed("Timestamp", "timestamp")).collect()
    assert [(r.ts.replace(tzinfo=None), r.value) for r in rows] == [(datetime(2021, 9, 24, 2, 30), 72.0)]
    missing = files.read_csv(spark, str(tmp_path / "none.csv"), RAW_STEPS)
    assert missing.count() == 0 and missing.schema == RAW_STEPS
    assert files.read_processed(spark, str(tmp_path / "none")) is None


def test_clean_steps_and_sleep(spark):
    raw = spark.createDataFrame([("u", "04-06-2021 00:29", "x", "s"), (None, "04-06-2021 00:30", "7", "s")],
                                "user_id string, timestamp string, steps string, source_type string")
    assert {(r.user_id, r.value) for r in files.clean_steps(raw).collect()} == {("u", 0.0), ("unknown", 7.0)}
    assert files.clean_sleep(spark.createDataFrame([], "a string")).count() == 0
    nights = spark.createDataFrame([("u", "04-06-2021 00:29", "04-06-2021 07:00", 391.0, "sleep"),
                                    ("u", "04-06-2021 00:29", None, 1.0, "sleep")], RAW_SLEEP)
    assert files.clean_sleep(nights).count() == 1


def test_sample_is_stable_and_complete(spark):
    df = spark.range(1000).withColumn("src", F.when(F.col("id") < 900, "big").otherwise("small"))
    pick = lambda parts: {r.id for r in files.sample_rows(
        df.repartition(parts), 150, "src", F.xxhash64("id", F.lit(42)), "id").collect()}
    assert pick(1) == pick(7) and len(pick(3)) == 250


def test_bundle(spark):
    good = spark.createDataFrame([("2021-01-01", 1.0), ("bad", 2.0)], "ds string, yhat double")
    out = files.forecast_bundle({"with_holidays": good, "actual": good, "events": None})
    assert out["actual"] is None and out["events"] is None and out["with_holidays"].count() == 1


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, "x")], "a int, b string")
    assert [(r.column, r.nulls) for r in profile.null_counts(df).collect()] == [("b", 2), ("a", 1)]
    assert profile.overview(df).first().asDict() == {"total_rows": 3, "columns": "a, b", "n_columns": 2}
    assert isinstance(df.schema, T.StructType)


def test_csv_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.csv").write_text("user_id,timestamp,steps\nu1,2024-01-01,5\n")
    (tmp_path / "in" / "b c.csv").write_text("steps,user_id,timestamp\n7,u2,2024-01-02\n")
    (tmp_path / "in" / "deep" / "c.csv").write_text("Steps,user_id,noise\n9,u3,x\n")
    (tmp_path / "in" / "empty.csv").write_text("")
    schema = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("timestamp", T.StringType()),
                           T.StructField("steps", T.LongType())])
    got = files.read_csv(spark, str(tmp_path / "in"), schema).select("user_id", "timestamp", "steps").collect()
    assert {tuple(r) for r in got} == {("u1", "2024-01-01", 5), ("u2", "2024-01-02", 7), ("u3", None, 9)}
    many = files.read_many(spark, str(tmp_path / "in")).select("user_id", "steps").collect()
    assert ("u2", "7") in {tuple(r) for r in many}
