"""Timelines, detectors, ensembles, forecasts and clusters on small frames."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import cluster as CL, daily as D, ensemble as E, features as FT, forecast as FC, report as RP
from vitalgrid.operators import residual as R, series as S, sigma, stats, threshold as T, timeline as TL
from vitalgrid.schema import KEYS, Rule

START = datetime(2021, 9, 24, 8, 0)
LONG = "user_id long, metric string, ts timestamp, value double"
DAY = "user_id long, metric string, ds date, y double"


def minutes(spark, values, metric="heart_rate", step=1, start=START):
    rows = [(1, metric, start + timedelta(minutes=step * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, LONG)


def days(spark, values, metric="steps", user=1, start=date(2021, 9, 24)):
    return spark.createDataFrame([(user, metric, start + timedelta(days=i), float(v)) for i, v in enumerate(values)], DAY)


def in_order(df, column, order="ts"):
    return [r[column] for r in df.orderBy(order).collect()]


# --- timelines ---

HOLES = [1.0] + [None] * 7 + [9.0] + [None] * 7


@pytest.mark.parametrize("limit, want", [
    (5, [1, 2, 3, 4, 5, 6, None, None, 9, 9, 9, 9, 9, 9, None, None]),
    (10, [1, 2, 3, 4, 5, 6, 7, 8, 9] + [9] * 7)])
@pytest.mark.parametrize("start", [START, datetime(2021, 9, 24, 23, 56)])
def test_interpolate(spark, limit, want, start):
    df = minutes(spark, HOLES, start=start)
    assert in_order(TL.interpolate(df, limit=limit), "value") == want


def test_interpolate_keeps_leading_nulls(spark):
    assert in_order(TL.interpolate(minutes(spark, [None, None, 4.0, None, 6.0])), "value") == [None, None, 4, 5, 6]


def test_dense_minutes_across_midnight(spark):
    rows = [(1, "steps", datetime(2021, 9, 24, 23, 58), 3.0), (1, "steps", datetime(2021, 9, 25, 0, 1), 4.0)]
    dense = TL.dense_minutes(spark.createDataFrame(rows, LONG), fill=0.0)
    assert in_order(dense, "value") == [3.0, 0.0, 0.0, 4.0]


def test_sleep_minutes(spark):
    t = lambda *a: datetime(2021, 9, 24, *a)
    rows = [(1, t(23, 58, 30), t(23, 59, 30) + timedelta(minutes=2)), (2, t(5, 0), t(5, 0)), (3, t(5, 0), t(4, 0)),
            (4, t(5, 0), None), (5, t(5, 0), t(5, 2)), (5, t(5, 1), t(5, 3))]
    df = TL.sleep_minutes(spark.createDataFrame(rows, "user_id long, start timestamp, end timestamp"))
    counts = {r.user_id: r.n for r in df.groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {1: 4, 2: 1, 3: 1, 5: 4}
    overlap = TL.sleep_per_minute(df).where("user_id = 5")
    assert in_order(overlap, "value") == pytest.approx([1 / 60, 2 / 60, 1 / 60])


def test_align(spark):
    heart = minutes(spark, [60.0, None, 62.0])
    steps = minutes(spark, [5.0] * 2, start=START + timedelta(minutes=2))
    sleep = minutes(spark, [1 / 60], start=START - timedelta(minutes=1))
    rows = TL.align(heart, steps, sleep).orderBy("ts").collect()
    assert [r.heart_rate for r in rows] == [None, 60, 61, 62, 62]
    assert [r.steps for r in rows] == [0, 0, 0, 5, 5] and rows[0].sleep_hours == pytest.approx(1 / 60)


@pytest.mark.parametrize("n, tests", [(4, 0), (5, 1), (14, 2), (20, 4)])
def test_split(spark, n, tests):
    got = in_order(TL.chronological_split(minutes(spark, [1.0] * n, step=40)), "split")
    assert got == ["train"] * (n - tests) + ["test"] * tests


def test_row_blocks_equal_plain_windows(spark):
    rng = np.random.default_rng(3)
    df = minutes(spark, [float(v) for v in rng.integers(0, 90, 257)], step=13)
    plain = R.rolling_band(df, KEYS, ["ts"])
    for unit, size in (("hour", 29), ("day", 40), ("year", 1000)):
        blocks = R.rolling_forecast(df, unit=unit, block_rows=size)
        assert in_order(blocks, "predicted") == in_order(plain, "predicted")
        assert in_order(blocks, "yhat_upper") == pytest.approx(in_order(plain, "yhat_upper"))


# --- rules ---

def planted_heart(spark):
    values = [70.0] * 721
    for lo, hi, v in ((60, 119, 110), (210, 239, 135), (480, 497, 35), (630, 635, 150)):
        values[lo:hi + 1] = [float(v)] * (hi - lo + 1)
    return minutes(spark, values)


@pytest.mark.parametrize("unit", ["minute", "hour", "day", "year"])
def test_sustained_heart_rate(spark, unit):
    flagged = T.detect(planted_heart(spark), T.rules_table(spark), unit=unit).where("threshold_anomaly").orderBy("ts").collect()
    clock = lambda r: r.ts.strftime("%H:%M")
    high = [clock(r) for r in flagged if r.severity == "High"]
    low = [clock(r) for r in flagged if r.severity == "Medium"]
    assert (high[0], high[-1], len(high)) == ("11:39", "11:59", 21)
    assert (low[0], low[-1], len(low)) == ("16:09", "16:17", 9)
    assert {r.anomaly_reason for r in flagged} == {"High heart_rate (>120)", "Low heart_rate (<40)"}


def test_single_row_rules(spark):
    values = [20.0] * 145
    values[84:87] = [1200.0] * 3
    flagged = T.detect(minutes(spark, values, "steps", 5), T.rules_table(spark))
    assert flagged.where("threshold_anomaly").count() == 3
    nights = T.detect(minutes(spark, [420.0, 200.0, 100.0], "sleep", 1440), T.rules_table(spark))
    assert in_order(nights, "severity") == ["Normal", "Normal", "Medium"]
    other = T.detect(minutes(spark, [1e9], "weight"), T.rules_table(spark)).first()
    assert (other.threshold_anomaly, other.severity) == (False, "Normal")


def test_sampling_period(spark):
    irregular = spark.createDataFrame([(1, "m", START + timedelta(minutes=i), 1.0) for i in (0, 5, 10, 70, 130)], LONG)
    assert T.sampling_period(irregular).first().period_us == 300_000_000
    assert T.sampling_period(minutes(spark, [1.0])).first().period_us == 60_000_000


def test_rules_are_data(spark):
    rules = T.rules_table(spark, (Rule("steps", "steps", 5, 10, 0, ""),))
    assert in_order(T.detect(minutes(spark, [4.0, 7.0, 11.0, None], "steps"), rules), "threshold_anomaly") == [True, False, True, False]


# --- statistics ---

def test_sigma_and_spikes(spark):
    df = sigma.moments(days(spark, [10] * 20 + [50] + [10] * 5))
    assert [str(r.ds) for r in sigma.outliers(df).where("is_outlier").collect()] == ["2021-10-14"]
    spikes = sigma.spikes(df).where("is_spike").orderBy("ds").collect()
    assert [r.spike_direction for r in spikes] == ["up", "drop"]


@pytest.mark.parametrize("values", [[5], [5, 5, 5], []])
def test_degenerate_series(spark, values):
    df = days(spark, values)
    assert sigma.outliers(sigma.moments(df)).where("is_outlier").count() == 0
    judged = E.detect(df).collect()
    assert len(judged) == len(values) and not any(r.is_anom for r in judged)
    assert {r.method_status for r in judged} <= {"too few points", "constant series"}
    assert len(stats.summary(df).collect()) == bool(values)


def test_recent_trend_and_extremes(spark):
    df = days(spark, list(range(14)))
    assert stats.recent_trend(df).first().recent_trend == 7.0
    assert stats.recent_trend(days(spark, range(13))).first().recent_trend == 0.0
    tied = stats.recent_extremes(days(spark, [9, 9, 1, 1])).first()
    assert (str(tied.max_ds), str(tied.min_ds), tied.days) == ("2021-09-24", "2021-09-26", 4)


def test_first_file_and_last_of_day(spark):
    d = date(2021, 9, 24)
    rows = [(1, "m", d, 2.0, 1), (1, "m", d, 1.0, 0), (1, "m", d, 9.0, 7)]
    files = spark.createDataFrame(rows, DAY + ", file_ordinal int")
    assert D.first_file_wins(files).first().y == 1.0
    late = spark.createDataFrame([(1, "m", d, 9.0, 7)], "user_id long, metric string, ds date, y double, file_ordinal int")
    assert D.first_file_wins(late).first().y == 9.0
    late = minutes(spark, [1.0, 2.0]).withColumn("event_id", F.lit(0))
    assert D.last_of_day(late).first().y == 2.0


def test_dense_week(spark):
    got = D.dense_week(days(spark, [5, 6]), "2021-09-26").orderBy("ds").collect()
    assert [r.y for r in got] == [0, 0, 0, 0, 5, 6, 0]


# --- ensembles ---

def flags(spark, votes):
    rows = [(1, "m", date(2021, 1, 1) + timedelta(days=i), v >= 1, v >= 2, v >= 3) for i, v in enumerate(votes)]
    return spark.createDataFrame(rows, "user_id long, metric string, ds date, threshold_anomaly boolean, "
                                       "residual_anomaly boolean, cluster_anomaly boolean")


def test_votes_severity_type(spark):
    scored = E.score(flags(spark, [0, 2, 0, 2, 0, 0, 0, 0, 3, 0, 0, 0, 0, 1, 2])).orderBy("ds").collect()
    assert [r.severity for r in scored if r.ensemble_anomaly] == ["High", "High", "High", "Medium"]
    assert [r.anomaly_type for r in scored if r.ensemble_anomaly] == ["Contextual", "Contextual", "Point", "Point"]
    assert scored[1].ensemble_reason == "Detected by: Rule-Based, Model-Based"
    strict = E.score(flags(spark, [2, 3]), min_votes=3).orderBy("ds").collect()
    assert [r.ensemble_anomaly for r in strict] == [False, True]


def test_missing_method_has_no_vote(spark):
    scored = E.vote(flags(spark, [3]).drop("cluster_anomaly")).first()
    assert scored.votes == 2 and scored.confidence_score == pytest.approx(2 / 3)


def test_scored_ensemble(spark):
    rng = np.random.default_rng(1)
    values = 100 + rng.normal(0, 2, 90)
    values[40] = 160
    got = {r.ds: r for r in E.detect(days(spark, values)).collect()}
    hit = got[date(2021, 9, 24) + timedelta(days=40)]
    assert hit.is_anom and hit.severity == "High" and hit.type == "Collective" and hit.score == 1.0
    assert hit.explanation.startswith(E.TEXT_OUTLIER) and hit.explanation.endswith("(Severity: High).")
    calm = [r for r in got.values() if not r.is_anom]
    assert len(calm) > 80 and {r.explanation for r in calm} == {E.TEXT_UNFLAGGED}
    short = E.detect(days(spark, values[:19])).collect()
    assert len(short) == 19 and {r.method_status for r in short} == {"outliers and spikes only"}
    assert not any(r.is_breach or r.is_small or r.is_noise for r in short)


def test_steps_always_include_band_breaches(spark):
    rows = flags(spark, [0]).select(*KEYS, "ds", F.lit(0).alias("votes"), F.lit(0.0).alias("score"), F.lit(True).alias("is_breach"))
    assert E.flag(rows.withColumn("metric", F.lit("steps")), E.ONLY_STRONG).first().is_anom
    assert not E.flag(rows, E.ONLY_STRONG).first().is_anom


# --- clusters ---

def brute_noise(pts, eps, need):
    near = ((pts[:, None] - pts[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= need
    return ~core & ~(near & core[None]).any(1)


def test_noise_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 1, 120), [9, 9.1, -7, 4, 4.2, 4.1]])
    points = CL.plane(sigma.moments(days(spark, values)))
    got = CL.flag_noise(points).orderBy("ds").collect()
    pts = np.array([[r.z, r.p] for r in got])
    assert [r.is_noise for r in got] == list(brute_noise(pts, 0.5, 3))


def brute_labels(pts, eps, need):
    near = ((pts[:, None] - pts[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= need
    label = np.where(core, np.arange(len(pts)), 10 ** 6)
    for _ in range(len(pts)):
        label = np.where(core, np.where(near & core[None], label[None], 10 ** 6).min(1), 10 ** 6)
    edge = np.where(near & core[None], label[None], 10 ** 6).min(1)
    return np.where(core, label, np.where(edge < 10 ** 6, edge, -1))


@pytest.mark.parametrize("parts, need", [(1, 2), (16, 2), (3, 4)])
def test_density_labels_match_brute_force(spark, parts, need):
    rng = np.random.default_rng(11)
    pts = np.concatenate([rng.normal(0, 0.6, (40, 3)), rng.normal(5, 0.6, (30, 3)), rng.uniform(-9, 9, (20, 3)),
                          np.zeros((15, 3)), np.column_stack([np.arange(20) * 0.9 + 20, np.zeros(20), np.zeros(20)])])
    rows = [(1, i, [float(v) for v in p]) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "user_id long, rid long, x array<double>").repartition(parts)
    got = CL.density_labels(df, ("user_id",), "rid", eps=1.0, min_samples=need).orderBy("rid").collect()
    assert [r.dbscan for r in got] == list(brute_labels(pts, 1.0, need))


def test_kmeans_isolates_small_cluster(spark):
    values = [1.0] * 50 + [40.0, 41.0] + [1.0] * 50
    got = CL.small_clusters(CL.plane(sigma.moments(days(spark, values))))
    assert got.agg(F.countDistinct("cluster")).first()[0] <= 4
    assert {r.y for r in got.where("is_small").collect()} <= {40.0, 41.0}


def test_lof_on_grid_and_outlier(spark):
    grid = [[float(a), float(b)] for a in range(6) for b in range(6)] + [[40.0, 40.0]]
    rows = [(1, "m", i, p) for i, p in enumerate(grid)]
    df = spark.createDataFrame(rows, "user_id long, metric string, win long, x array<double>")
    got = {r.win: r for r in CL.local_outlier_factor(df).collect()}
    assert got[36].lof_label == -1 and got[36].lof > 3 and got[14].lof == pytest.approx(1, abs=0.2)


def test_flag_small_needs_three_rows(spark):
    df = spark.createDataFrame([(1, -1), (1, 0), (2, 0), (2, 0), (2, -1)], "user_id long, label int")
    got = CL.flag_small(df, ("user_id",), "label").collect()
    assert {(r.user_id, r.cluster, r.cluster_anomaly) for r in got} == {(1, -999, False), (2, 0, False), (2, -1, True)}


# --- forecasts ---

def test_additive_recovers_plan(spark):
    week = np.array([0, 5, -5, 2, -2, 3, -3.0])
    n = 105
    values = 50 + 0.5 * np.arange(n) + np.tile(week, 15)
    values[29:37] += 40
    model = FC.Model(yearly=False, events=True)
    rows = FC.forecast(days(spark, values), model, 7).orderBy("ds").collect()
    assert len(rows) == n + 7
    assert [r.weekly for r in rows[50:57]] == pytest.approx(list(np.tile(week, 20)[50:57]), abs=4)
    assert np.mean([r.holiday_effect for r in rows[29:37]]) > 25
    for r in FC.bending_forecast(days(spark, values), model, 7).collect():
        assert r.yhat_lower <= r.yhat <= r.yhat_upper


def test_bending_follows_a_bend(spark):
    values = np.concatenate([np.linspace(0, 100, 100), np.linspace(100, 40, 60)])
    straight = FC.forecast(days(spark, values), FC.Model(yearly=False)).toPandas()
    bent = FC.bending_forecast(days(spark, values), FC.Model(yearly=False)).toPandas()
    error = lambda f: np.abs(f.sort_values("ds").yhat.to_numpy() - values).mean()
    assert error(bent) < 0.35 * error(straight)


def test_event_impact(spark):
    plain = days(spark, [10] * 100).withColumnRenamed("y", "yhat")
    eventful = plain.withColumn("yhat", F.when(F.col("ds") == F.lit("2021-10-27").cast("date"), 2.0).otherwise(11.0))
    eventful = eventful.withColumn("holiday_effect", F.col("yhat") - 10.0)
    impact = FC.event_impact(D.holiday_calendar(days(spark, [1] * 95)), eventful)
    assert impact.count() == 12
    top = FC.largest_event(impact).first()
    assert (top.event, str(top.ds), top.diff) == ("vacation", "2021-10-27", -8.0)


def test_comparison_equals_two_fits(spark):
    rng = np.random.default_rng(6)
    df = days(spark, rng.normal(50, 5, 100))
    both = {r.ds: r for r in FC.compare_events(df).collect()}
    plain = {r.ds: r for r in FC.components(df, FC.DETECTION).collect()}
    for ds, r in plain.items():
        assert [both[ds].yhat_without, both[ds].lower_without, both[ds].upper_without] == pytest.approx([r.yhat, r.fit_lower, r.fit_upper])


def test_tasks(spark):
    df = days(spark, 50 + 0.1 * np.arange(130))
    hr = FC.heart_rate_task(df).first()
    assert hr.mae == pytest.approx(0, abs=1e-6) and hr.day67_yhat == pytest.approx(50 + 0.1 * (70 + 66))
    assert FC.sleep_task(df).first().trend_dir == "increasing"
    assert FC.steps_task(df).where("largest").count() == 1


# --- features and reports ---

def test_windows_drop_the_tail(spark):
    wins = FT.windows(days(spark, range(65)))
    assert wins.count() == 60 and wins.agg(F.max("win")).first()[0] == 1


def test_handcrafted(spark):
    import pandas as pd

    values = [1.0, 4.0, 2.0, 8.0, 5.0, 7.0]
    got, s = FT.handcrafted(days(spark, values)).first(), pd.Series(values)
    assert [got.mean, got.std, got.skew, got.kurtosis, got.pct_25] == pytest.approx(
        [s.mean(), s.std(), s.skew(), s.kurtosis(), s.quantile(0.25)])
    assert got.num_peaks == int((s.diff().abs() > 1.5 * s.std()).sum())


def test_standardise_constant(spark):
    m = spark.createDataFrame([(1, 2.0, 1.0), (1, 2.0, 3.0)], "user_id long, a double, b double")
    assert [(r.a, r.b) for r in FT.standardise(m, ("a", "b")).orderBy("b").collect()] == [(0.0, -1.0), (0.0, 1.0)]


def test_report(spark):
    df = days(spark, [60] * 30 + [200], "heart_rate").unionByName(days(spark, [7.5] * 31, "sleep"))
    report = RP.user_report(df).first().report
    assert report.isascii() and "Metric: Heart Rate" in report and "Metric: Sleep" in report
    assert "1. Date: 2021-10-24, Value: 200.00 bpm" in report and "No day stands out." in report
    only = RP.user_report(df, metrics=("sleep",), anomalies=False).first().report
    assert "Heart Rate" not in only and "ANOMALIES" not in only


def test_partition_invariance(spark):
    rng = np.random.default_rng(2)
    df = days(spark, rng.normal(100, 20, 80)).unionByName(days(spark, rng.normal(5, 1, 40), "sleep", 2))
    runs = [sorted(map(tuple, E.detect(df.repartition(n)).select(*KEYS, "ds", "score", "explanation").collect())) for n in (1, 16)]
    assert [r[:3] + r[4:] for r in runs[0]] == [r[:3] + r[4:] for r in runs[1]]


def test_kmeans_of_windows_is_the_same_on_every_run(spark):
    rows = [(u, "m", w, [float(w % 3 * 10 + u), float(w)]) for u in (1, 2) for w in range(9)] + [(3, "m", 0, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "user_id long, metric string, win long, x array<double>")
    one, two = (sorted(map(tuple, CL.kmeans_labels(d).collect())) for d in (df, df.repartition(5)))
    assert one == two and len(one) == 19 and [r[-1] for r in one if r[0] == 3] == [0]


def test_vectors_are_standardised_in_every_dimension(spark):
    df = spark.createDataFrame([(1, "a", [1.0, 5.0, 2.0]), (2, "a", [3.0, 5.0, 4.0]), (3, "b", [9.0, 9.0, 9.0])], "id long, g string, v array<double>")
    got = {r.id: r.v for r in FT.standardise_vectors(df, "v", ("g",)).collect()}
    assert got == {1: [-1.0, 0.0, -1.0], 2: [1.0, 0.0, 1.0], 3: [0.0, 0.0, 0.0]}


def test_far_off_readings_make_rows_not_huge_arrays(spark):
    rows = [(1, "m", datetime(1999, 12, 31, 23, 58), 1.0), (1, "m", datetime(2002, 1, 1, 0, 1), 2.0)]
    dense = TL.dense_minutes(spark.createDataFrame(rows, "user_id long, metric string, ts timestamp, value double"))
    days = 366 + 365
    assert dense.count() == days * 1440 + 4 and dense.select("ts").distinct().count() == days * 1440 + 4
    late = spark.createDataFrame([(1, datetime(2024, 1, 1, 22, 30, 30), datetime(2025, 1, 1, 0, 0, 0))], "user_id long, start timestamp, end timestamp")
    assert TL.sleep_minutes(late).count() == 365 * 1440 + 90
