"""What is read more than once is computed once."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from vitalgrid.operators import daily as D, features as FT, residual as R, series as S, threshold as T
from vitalgrid.plans import q_detect as QD
from vitalgrid.session import stored_by


def test_rolling_band_is_computed_once(spark):
    rows = [(1, "m", datetime(2024, 1, 1) + timedelta(hours=h), float(h % 7), h) for h in range(100)]
    df = spark.createDataFrame(rows, "user_id long, metric string, ts timestamp, value double, event_id long")
    flagged = R.detect_samples(df, order=("ts", "event_id"))
    assert flagged.count() == 100
    assert "percentile" not in flagged._jdf.queryExecution().executedPlan().toString()


def test_windows_of_clusters_are_computed_once(spark):
    days = [(1, "m", datetime(2024, 1, 1) + timedelta(days=d), float(d % 5)) for d in range(95)]
    daily = spark.createDataFrame(days, "user_id long, metric string, ds timestamp, y double").selectExpr("user_id", "metric", "cast(ds as date) as ds", "y")
    wins, labelled = QD.window_clusters(daily)
    assert wins.count() == 90 and labelled.count() == 3
    assert "Window" not in wins._jdf.queryExecution().executedPlan().toString()


def tables(spark, folder):
    """A month and a half of lines of four suppliers, some of it far off, and events of short series."""
    lines = [(s, "ANR"[s % 3], datetime(2024, 1, 1) + timedelta(days=d), 900.0 if d in (20, 21, 22) and s == 1 else float(d % 7 + s)) for s in range(1, 5) for d in range(45)]
    spark.createDataFrame(lines, "l_suppkey long, l_returnflag string, l_shipdate timestamp, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    events = [(d, 9, "view", datetime(2024, 1, 1) + timedelta(days=d), 150.0 if d == 3 else 60.0 + d) for d in range(8)] + [(8, 9, "view", None, 70.0), (9, None, "view", datetime(2024, 1, 9), 70.0)]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, ts timestamp, value double").write.parquet(f"{folder}/events.parquet")
    orders = [(f"{p}-X", datetime(2024, 1, 1) + timedelta(days=d), 100.0 + d) for p in (1, 2) for d in range(12)]
    spark.createDataFrame(orders, "o_orderpriority string, o_orderdate timestamp, o_totalprice double").write.parquet(f"{folder}/orders.parquet")


def test_vote_joins_no_days(spark, tmp_path):
    """Verdicts of days travel with the days: only windows and series are joined."""
    tables(spark, tmp_path)
    voted = QD.voted(spark, str(tmp_path))
    rows = voted.collect()
    # all dated days of known users, all users together, and orders; the day without a date and the one without a user only weigh
    assert len(rows) == 4 * 45 + 8 + 9 + 2 * 12
    assert [(r.user_id, r.ds.day) for r in rows if r.threshold_anomaly and r.user_id == 9] == [(9, 4)]
    assert {r.ds.day for r in rows if r.residual_anomaly and r.user_id == 1} >= {22}
    plan = voted._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any("ds#" in line for line in joins)


def test_series_are_dealt_by_rows(spark):
    df = spark.range(1_000).selectExpr("id % 50 as user_id", "'m' as metric", "id as y")
    assert S.by_series(df, 1_000, task_rows=100).rdd.getNumPartitions() == 10
    assert S.by_series(df, 1_000).rdd.getNumPartitions() == 4


def test_metrics_without_rule_pass_by(spark):
    start = datetime(2024, 1, 1)
    rows = [(u, m, start + timedelta(days=d), float(40 * d)) for u in (1, None) for m in ("heart_rate", "steps", "other", None) for d in range(6)]
    df = spark.createDataFrame([*rows, (1, "other", None, 1.0)], "user_id long, metric string, ts timestamp, value double")
    rules = T.rules_table(spark)
    found = lambda out: sorted(out.collect(), key=repr)
    assert found(T.detect_stored(df, rules, unit="year")) == found(T.detect(df, rules, unit="year"))
    assert "other" not in str(T.detect_stored(df, rules).where("threshold_anomaly").select("metric").distinct().collect())


def test_band_reads_short_series_only(spark):
    days = [(u, "m", datetime(2024, 1, 1) + timedelta(days=d), float(d * d % 11), f"{u}-{d}") for u, n in ((1, 9), (2, 40)) for d in range(n)]
    daily = spark.createDataFrame(days, "user_id long, metric string, ds timestamp, y double, note string").withColumn("ds", F.to_date("ds"))
    flagged = R.detect(daily)
    assert sum(r.note == f"{r.user_id}-{(r.ds.day - 1) + 31 * (r.ds.month - 1)}" for r in flagged.collect()) == 49
    band = {(r.user_id, r.ds): r.predicted for r in R.rolling_band(daily, ["user_id", "metric"], ["ds"], "y").where("user_id = 1").collect()}
    assert {(r.user_id, r.ds): r.predicted for r in flagged.where("user_id = 1").collect()} == band
    assert "percentile(_short" in flagged._jdf.queryExecution().optimizedPlan().toString()


def odd_tables(spark, folder, repeats=True):
    """Readings and lines with nulls, series of two sources, users that stand for others, and ids that come again."""
    start = datetime(2024, 1, 1)
    lines = [(s, "ANR"[s % 3], start + timedelta(days=d, hours=5 * (d % 11 == 0)), 2.0 if d % 17 == s else None if d % 19 == s else 10.0 * (1 + d % 4)) for s in range(1, 5) for d in range(70)]
    lines += [(None, "A", start, 4.0), (2, None, start, 4.0), (2, "R", None, 4.0)]
    spark.createDataFrame(lines, "l_suppkey long, l_returnflag string, l_shipdate timestamp, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    def value(kind, k):
        return None if k % 29 == 7 else 150.0 if k % 13 < 4 else 60.0 + k % 9

    kinds = [("view", u) for u in (1, 2, 3)] + [("click", 1), ("purchase", 2), ("error", 2), ("A", 3), (None, 1), ("view", -2), ("view", None)]
    events = [(1000 * n + k, u, kind, start + timedelta(hours=7 * k, minutes=n), value(kind, k)) for n, (kind, u) in enumerate(kinds) for k in range(110)]
    events += [(90_000 + k, 1, "view", None, 70.0) for k in range(3)] + [(None, 2, "click", start + timedelta(hours=k), 80.0 + k) for k in range(4)]
    if repeats:
        events += [(5, 9, "signup", start, 1.0), (6, 1, "view", start + timedelta(hours=1), None), (2007, 3, "view", start + timedelta(hours=2), 3.0), (6003, 8, "view", start, 3.0)]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, ts timestamp, value double").write.parquet(f"{folder}/events.parquet")
    orders = [(f"{p}-X", start + timedelta(days=d), 100.0 + d) for p in (1, 2) for d in range(40)]
    spark.createDataFrame(orders, "o_orderpriority string, o_orderdate timestamp, o_totalprice double").write.parquet(f"{folder}/orders.parquet")


def test_votes_of_whole_series_as_of_cut_ones(spark, tmp_path):
    odd_tables(spark, tmp_path)
    columns = ["event_id", *QD.KEYS, "ts", "votes", "near2", "near3", "severity", "anomaly_type", "ensemble_reason"]
    whole, cut = (sorted(map(tuple, QD.sample_votes(spark, str(tmp_path), **how).select(*columns).collect()), key=repr) for how in ({}, {"whole_rows": 0, "block_rows": 40}))
    assert whole == cut
    assert len({r[7] for r in whole}) == 4 and any("Cluster-Based" in r[9] for r in whole)
    ids = [r[0] for r in whole]
    # a day that both sources have counts twice
    assert (ids.count(5), ids.count(6), ids.count(6003)) == (4, 2, 6) and None not in ids


def test_samples_stay_where_they_are_dealt(spark, tmp_path):
    odd_tables(spark, tmp_path, repeats=False)
    source = QD.C.samples(spark, str(tmp_path)).where("user_id > 0").repartition(3, *QD.KEYS)
    samples = stored_by(source, "samples", 3, QD.KEYS)
    votes = QD._whole_votes(samples, spark.createDataFrame([(1, "steps", [0])], "user_id long, metric string, _odd array<long>"))
    plan = votes._jdf.queryExecution().executedPlan().toString()
    # only the few odd windows are shuffled; one order serves the windows and all detectors, and one the neighbours after the join
    kept, dealt = plan.split("Exchange hashpartitioning")
    assert "Bucketed: true" in kept and "parquet" not in dealt
    assert sum("Sort [" in line and "ts#" in line for line in plan.splitlines()) == 2
    assert {r.votes > 0 for r in votes.where("user_id = 1 and metric = 'steps' and ts < '2024-01-31'").collect()} == {True}


def test_whole_series_as_chunks(spark, tmp_path):
    odd_tables(spark, tmp_path)
    df = QD.C.samples(spark, str(tmp_path))
    rules = T.rules_table(spark, QD.VOTE_RULES)
    found = lambda out: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in out.collect()), key=repr)
    assert found(T.detect(df, rules, unit=None)) == found(T.detect(df, rules, unit="day"))
    order = ("ts", "event_id")
    assert found(R.detect_samples(df, order=order, unit=None)) == found(R.detect_samples(df, order=order, unit="month"))
    days = FT.in_windows(D.daily(df)).select(*QD.KEYS, "ds", "win").where("ds is not null")
    own = FT.windows_of_samples(df).where("value is not null and ts is not null").select(*QD.KEYS, F.to_date("ts").alias("ds"), "win").distinct()
    assert found(own) == found(days)


def test_long_series_and_repeated_ids(spark):
    df = spark.range(100).selectExpr("case when id < 60 then 1 when id < 90 then id % 3 + 2 end as user_id", "'m' as metric", "id + 5000 as rid")
    assert sorted(r.user_id or 0 for r in S.long_series(df, rows=9).collect()) == [0, 1, 2, 3, 4]
    assert [tuple(r) for r in S.long_series(df, rows=30).collect()] == [(1, "m")]
    assert S.long_series(df, rows=60) is None
    null = df.where("user_id is null").select("user_id", "metric").distinct()
    assert S.of_series(df, null).count() == 10 and S.of_series(df, null, kind="left_anti").count() == 90
    assert S.series_with_repeated_ids(df, "rid") is None
    again = df.unionByName(spark.sql("select 7 as user_id, 'm' as metric, 5001L as rid union all select 8, 'm', 1L union all select 8, 'm', 1L union all select 9, 'm', null union all select 9, 'm', null"))
    assert sorted(r.user_id for r in S.series_with_repeated_ids(again, "rid").collect()) == [1, 7, 8]
