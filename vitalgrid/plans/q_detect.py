"""Detectors and ensembles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from vitalgrid.operators import cluster as CL, daily as D, ensemble as E, features as FT, forecast as FC, report as RP, residual as R
from vitalgrid.operators import series as S, sigma, stats, threshold as T
from vitalgrid.plans import canonical as C, sql as Q
from vitalgrid.plans.q_series import _GAPS, _HANDCRAFTED, threshold_sql
from vitalgrid.plans.registry import plain_time, query, r, rounded, sr
from vitalgrid.schema import DEFAULT_RULES, KEYS, Rule
from vitalgrid.session import stored, stored_by

MOMENTS = """moments as (select *, count(y) over w as n, avg(y) over w as mean, stddev_samp(y) over w as std
  from {t} window w as (partition by user_id, metric))"""


def fit_sql(source: str, name: str, z: float, weekly: bool = True, yearly: str = "n_rows > 365",
            events: bool = False) -> str:
    """Twin of the additive model: CTEs ending in ``name``."""
    w = "partition by user_id, metric"
    week = "avg(y - trend) over (partition by user_id, metric, dow)"
    event = """case when t + 1 between 30 and 37 then 'vacation' when t + 1 between 60 and 62 then 'sick'
      when t + 1 = 90 then 'marathon' end"""
    return f"""{name}_0 as (select *, cast(date_diff('day', min(ds) over ({w}), ds) as double) as t,
      count(*) over ({w}) as n_rows, dayofweek(ds) as dow, month(ds) as mon, min(ds) over ({w}) as start_ds from {source}),
    {name}_c as (select user_id, metric, case when count(*) > 1 then coalesce(regr_slope(y, t), 0) else 0 end as slope,
      case when count(*) > 1 then coalesce(regr_intercept(y, t), avg(y)) else avg(y) end as intercept from {name}_0 group by all),
    {name}_1 as (select f.*, slope, intercept, intercept + slope * t as trend, {event} as event
      from {name}_0 f join {name}_c using (user_id, metric)),
    {name}_2 as (select *, {week if weekly else '0.0'} as raw_w, count(*) over (partition by user_id, metric, dow) as cw from {name}_1),
    {name}_3 as (select *, raw_w - sum(raw_w / cw) over ({w}) / sum(1.0 / cw) over ({w}) as weekly from {name}_2),
    {name}_4 as (select *, avg(y - trend - weekly) over (partition by user_id, metric, mon) as raw_m,
      count(*) over (partition by user_id, metric, mon) as cm from {name}_3),
    {name}_5 as (select *, case when {yearly} then raw_m - sum(raw_m / cm) over ({w}) / sum(1.0 / cm) over ({w}) else 0 end
      as yearly from {name}_4),
    {name}_6 as (select *, {"case when event is not null then avg(y - trend - weekly - yearly) over (partition by user_id, metric, event) else 0 end"
                            if events else '0.0'} as holiday_effect from {name}_5),
    {name}_7 as (select *, trend + weekly + yearly + holiday_effect as yhat from {name}_6),
    {name} as (select *, yhat - {z} * coalesce(sigma, 0) as lo, yhat + {z} * coalesce(sigma, 0) as hi
      from (select *, stddev_samp(y - yhat) over ({w}) as sigma from {name}_7))"""


def kmeans_sql(source: str, name: str, clusters: int = 4, iterations: int = 10) -> str:
    """Unrolled k-means per series over ``source(z, p, n)``: CTEs ending in ``name``."""
    w = "partition by user_id, metric"
    starts = ", ".join(f"max(case when {j} < k and rk = floor({j + 0.5} * n / k) + 1 then {c} end) over ({w}) as {c}{j}"
                       for j in range(clusters) for c in "zp")
    dist = [f"coalesce((z - z{j}) * (z - z{j}) + (p - p{j}) * (p - p{j}), 'inf'::double)" for j in range(clusters)]
    assign = f"""*, case {" ".join(f"when {d} = least({', '.join(dist)}) then {j}" for j, d in enumerate(dist))} end as cl"""
    keep = "user_id, metric, ds, y, z, p, n, k"
    out = f"""{name}_r as (select *, row_number() over ({w} order by z, ds) as rk, least({clusters}, n // 2) as k from {source}),
    {name}_0 as (select {assign} from (select {keep}, {starts} from {name}_r))"""
    for i in range(1, iterations + 1):
        moved = ", ".join(f"coalesce(avg(case when cl = {j} then {c} end) over ({w}), {c}{j}) as {c}{j}"
                          for j in range(clusters) for c in "zp")
        out += f""",
    {name}_{i} as materialized (select {assign} from (select {keep}, {moved} from {name}_{i - 1}))"""
    return out + f""",
    {name} as (select user_id, metric, ds, cl as cluster, count(*) over ({w}, cl) as cluster_size,
      count(*) over ({w}, cl) < n * 0.05 as is_small from {name}_{iterations})"""


NOISE = """near as (select a.user_id, a.metric, a.ds, b.ds as other from {t} a join {t} b on a.user_id = b.user_id
    and a.metric = b.metric and (a.z - b.z) * (a.z - b.z) + (a.p - b.p) * (a.p - b.p) <= 0.25),
  core as (select user_id, metric, ds from near group by all having count(*) >= 3),
  noise as (select distinct user_id, metric, ds from near where (user_id, metric, ds) not in (
    select (n.user_id, n.metric, n.ds) from near n join core c on n.user_id = c.user_id and n.metric = c.metric and n.other = c.ds))"""

POINTS = """points as (select *, (y - mean) / (std + 1e-6) as z,
  (row_number() over (partition by user_id, metric order by ds) - 1) / n as p from base where n >= 20 and std > 0)"""


# --- rule based ---------------------------------------------------------------------------------

@query("h1_threshold_detector", f"""with {Q.MINUTES}, {_GAPS}, {threshold_sql(DEFAULT_RULES)}
  select user_id, metric, ts, {sr('value')} as value, threshold_anomaly, anomaly_reason, severity from flagged""")
def h1(spark, sf):
    flagged = T.detect(C.observed_minutes(spark, sf), T.rules_table(spark))
    return plain_time(rounded(flagged, "value"), "ts")


@query("e10_detector_report", f"""with {Q.MINUTES}, {_GAPS}, {threshold_sql(DEFAULT_RULES)}
  select user_id, metric, count(*) as total_records, count(*) filter (where threshold_anomaly) as anomalies_detected,
   {sr('100.0 * count(*) filter (where threshold_anomaly) / greatest(1, count(*))')} as anomaly_percentage
  from flagged group by 1, 2""")
def e10(spark, sf):
    flagged = T.detect(C.observed_minutes(spark, sf), T.rules_table(spark))
    report = stats.detector_report(flagged, "threshold_anomaly")
    return rounded(report, "anomaly_percentage")


# --- residuals ----------------------------------------------------------------------------------

ROLLING = """rolled as (select *, quantile_cont(y, 0.5) over (w rows between 14 preceding and current row) as med,
   2 * coalesce(stddev_samp(y) over (w rows between 29 preceding and current row), 0) as spread
  from daily window w as (partition by user_id, metric order by ds))"""

RESIDUAL = f"""{ROLLING}, {fit_sql('rolled', 'fit', FC.Z80)},
  guess as (select user_id, metric, ds, y, case when n_rows >= 10 then yhat else med end as predicted,
    case when n_rows >= 10 then lo else med - spread end as lower, case when n_rows >= 10 then hi else med + spread end as upper from fit),
  judged as (select *, y - predicted as residual, stddev_samp(y - predicted) over (partition by user_id, metric) as sd from guess),
  residual as (select *, abs(residual) > 3 * coalesce(sd, 0) or y > upper or y < lower as residual_anomaly from judged)"""


@query("h2_residual_detector", f"""with {Q.DAILY}, {RESIDUAL} select user_id, metric, ds, {sr('predicted', 2)} as predicted,
  {sr('residual', 2)} as residual, residual_anomaly,
  case when residual_anomaly then 'Deviates from predicted trend' else '' end as residual_anomaly_reason from residual""")
def h2(spark, sf):
    flagged = R.detect(C.daily(spark, sf))
    return rounded(flagged, "predicted", "residual", n=2).select(
        *KEYS, "ds", "predicted", "residual", "residual_anomaly", "residual_anomaly_reason")


@query("h2_residual_detector_samples", f"""with {Q.USERS}, b as (select *, quantile_cont(value, 0.5) over (w rows between 14
   preceding and current row) as p, 2 * coalesce(stddev_samp(value) over (w rows between 29 preceding and current row), 0) as s
   from pooled where value is not null window w as (partition by user_id, metric order by ts, event_id)),
  j as (select *, value - p as residual, stddev_samp(value - p) over (partition by user_id, metric) as sd from b)
  select event_id, metric, {sr('residual', 4)} as residual,
    abs(residual) > 3 * coalesce(sd, 0) or value > p + s or value < p - s as residual_anomaly from j""")
def h2_samples(spark, sf):
    flagged = R.detect_samples(C.samples(spark, sf), order=("ts", "event_id"))
    return rounded(flagged.select("event_id", "metric", "residual", "residual_anomaly"), "residual", n=4)


@query("e10_residual_report", f"""with {Q.DAILY}, {RESIDUAL} select user_id, metric, count(*) as total_records,
  count(*) filter (where residual_anomaly) as anomalies_detected, {sr('avg(residual)', 2)} as residual_mean,
  {sr('stddev_samp(residual)', 2)} as residual_std, {sr('3 * coalesce(stddev_samp(residual), 0)', 2)} as residual_threshold
  from residual group by all""")
def e10_residual(spark, sf):
    report = stats.residual_report(R.detect(C.daily(spark, sf)))
    return rounded(report, "residual_mean", "residual_std", "residual_threshold", n=2)


@query("d2_forecast_left_join", f"""with {Q.DAILY}, f as (select user_id, metric, ds, y + 1 as predicted from daily
   where ds >= '2024-01-10' union all select user_id, metric, ds, y + 2 from daily where ds >= '2024-01-20')
  select user_id, metric, ds, {sr('y', 3)} as y, {sr('predicted', 3)} as predicted from daily left join f using (user_id, metric, ds)""")
def d2(spark, sf):
    d = C.daily(spark, sf)

    def later(day, shift):
        return d.where(F.col("ds") >= F.lit(day).cast("date")).select(*KEYS, "ds", (F.col("y") + shift).alias("predicted"))

    forecast = later("2024-01-10", 1).unionByName(later("2024-01-20", 2))
    return rounded(R.with_forecast(d, forecast, [*KEYS, "ds"]), "y", "predicted", n=3)


# --- statistics ---------------------------------------------------------------------------------

@query("h3_daily_sigma_outliers", f"""with {Q.DAILY}, {MOMENTS.format(t='daily')}, o as (select *, row_number() over (
   partition by user_id, metric order by ds desc) as rank from moments where y < mean - 2.5 * std or y > mean + 2.5 * std)
  select user_id, metric, rank, ds, {sr('y', 2)} as y, {sr('(y - mean) / std')} as deviation from o""")
def h3(spark, sf):
    top = RP.recent_outliers(C.daily(spark, sf), top=None)
    return rounded(rounded(top.withColumn("rank", F.col("rank").cast("long")), "y", n=2), "deviation").orderBy(*KEYS, "rank")


@query("h3_sigma_flags", f"""with {Q.DAILY}, {MOMENTS.format(t='daily')} select user_id, metric, ds,
  coalesce(y < mean - 2.5 * std or y > mean + 2.5 * std, false) as is_outlier from moments""")
def h3_flags(spark, sf):
    return sigma.outliers(sigma.moments(C.daily(spark, sf))).select(*KEYS, "ds", "is_outlier")


@query("h4_spikes", f"""with {Q.DAILY}, {MOMENTS.format(t='daily')}, d as (select *, coalesce(y - lag(y) over (
   partition by user_id, metric order by ds), 0) as change from moments)
  select user_id, metric, ds, coalesce(abs(change) > 2 * std, false) as is_spike,
   case when abs(change) > 2 * std then case when change > 0 then 'up' else 'drop' end end as spike_direction from d""")
def h4(spark, sf):
    d = sigma.spikes(sigma.moments(C.daily(spark, sf)))
    return d.select(*KEYS, "ds", "is_spike", "spike_direction")


@query("h5_forecast_band_breach", f"""with {Q.DAILY}, {fit_sql('daily', 'fit', FC.Z95)} select user_id, metric, ds,
  {sr('yhat', 2)} as yhat, (y < lo or y > hi) and n_rows >= 20 as is_breach from fit""")
def h5(spark, sf):
    d = sigma.band_breaches(C.daily(spark, sf))
    return rounded(d.select(*KEYS, "ds", "yhat", "is_breach"), "yhat", n=2)


BASE = f"""{MOMENTS.format(t='daily')}, base as (select * from moments), {POINTS}"""
STATUS = """case when n < 3 then 'too few points' when coalesce(std, 0) <= 0 then 'constant series'
  when n < 20 then 'outliers and spikes only' else 'all methods' end"""


def _points(spark, sf):
    """All days as points; the clustering methods leave short and constant series without a verdict."""
    return CL.plane(sigma.moments(C.daily(spark, sf)))


@query("h6_kmeans_small_clusters", f"""with {Q.DAILY}, {BASE}, {kmeans_sql('points', 'km')}
  select user_id, metric, ds, cluster, coalesce(cluster_size, n) as cluster_size, coalesce(is_small, false) as is_small
  from base left join km using (user_id, metric, ds)""")
def h6(spark, sf):
    return CL.small_clusters(_points(spark, sf), min_points=E.ENOUGH).select(
        *KEYS, "ds", "cluster", "cluster_size", "is_small")


@query("h7_dbscan_noise", f"""with {Q.DAILY}, {BASE}, {NOISE.format(t='points')} select user_id, metric, ds,
  (user_id, metric, ds) in (select (user_id, metric, ds) from noise) as is_noise, {STATUS} as method_status from base""")
def h7(spark, sf):
    points = _points(spark, sf).withColumn("method_status", E.method_status(F.col("n"), F.col("std")))
    noise = CL.noise_points(points.where("method_status = 'all methods'"))
    return CL.mark_noise(points, noise).select(*KEYS, "ds", "is_noise", "method_status")


# --- voted ensemble -----------------------------------------------------------------------------

WINDOW_FEATURES = f"""wins as (select *, i // 30 as win from (select *,
    row_number() over (partition by user_id, metric order by ds) - 1 as i, count(*) over (partition by user_id, metric) as c
    from {{t}}) where i // 30 < c // 30),
  hand as ({_HANDCRAFTED.format(k='user_id, metric, win', t='wins')})"""

SCALED = """scaled as (select user_id, metric, win, {cols} from hand window w as (partition by {by}))""".format(
    by="user_id", cols=", ".join(
        f"case when stddev_pop(coalesce({c}, 0)) over w > 1e-12 then (coalesce({c}, 0) - avg(coalesce({c}, 0)) over w) / "
        f"stddev_pop(coalesce({c}, 0)) over w else 0.0 end as {c}" for c in FT.HANDCRAFTED))


def density_sql(source: str, name: str, by: str, eps: float, columns, min_samples: int = 2) -> str:
    """Density clusters over rows ``rid``: CTEs ending in ``name(rid, dbscan)``. Needs ``with recursive``."""
    on = " and ".join(f"a.{b} = b.{b}" for b in by.split(", "))
    d2 = " + ".join(f"pow(a.{c} - b.{c}, 2)" for c in columns)
    return f"""{name}_e as materialized (select a.rid as a, b.rid as b from {source} a join {source} b on {on} where {d2} <= {eps * eps}),
  {name}_k as materialized (select a as rid from {name}_e group by 1 having count(*) >= {min_samples}),
  {name}_l as materialized (select e.a, e.b from {name}_e e where a in (select rid from {name}_k) and b in (select rid from {name}_k)),
  {name}_r(rid, label) as (select rid, rid from {name}_k union
    select l.b, r.label from {name}_r r join {name}_l l on l.a = r.rid where r.label < l.b),
  {name}_c as (select rid, min(label) as label from {name}_r group by 1),
  {name}_b as (select e.a as rid, min(c.label) as label from {name}_e e join {name}_c c on e.b = c.rid group by 1),
  {name} as (select s.rid, coalesce(c.label, b.label, -1) as dbscan from {source} s left join {name}_c c using (rid)
    left join {name}_b b using (rid))"""


ROW_ID = "dense_rank() over (order by user_id, metric, win)"
VECTOR = FT.HANDCRAFTED


def window_clusters(daily_df, eps: float = 0.5):
    """Density labels of the handcrafted features of each 30-day window, and who is anomalous.

    Windows and features are read more than once, so they are stored.
    """
    wins = stored(FT.windows(daily_df), "windows")
    return wins, window_labels(wins, eps)


def window_labels(wins, eps: float = 0.5):
    """Density labels of the handcrafted features of windows."""
    return feature_labels(window_features(wins), eps)


def window_features(wins):
    return FT.handcrafted(wins.withColumnRenamed("value", "y"), (*KEYS, "win"))


def feature_labels(features, eps: float = 0.5):
    feats = stored(features, "features")
    scaled = FT.standardise(feats.fillna(0.0, list(FT.HANDCRAFTED)), FT.HANDCRAFTED).select(*KEYS, "win", *VECTOR)
    matrix = FT.number_windows(FT.vectors(scaled, VECTOR))
    return CL.density_labels(matrix, ("user_id",), "rid", eps=eps)


CLUSTERED = f"""{WINDOW_FEATURES.format(t='daily')}, {SCALED},
  numbered as (select *, {ROW_ID} as rid from scaled), {density_sql('numbered', 'db', 'user_id', 0.5, VECTOR)},
  sized as (select user_id, metric, win, dbscan, count(*) over (partition by user_id, dbscan) as size,
    count(*) over (partition by user_id) as total from numbered join db using (rid)),
  cluster_flags as (select user_id, metric, win, dbscan, size,
    (size / total < 0.05 or dbscan = -1) and total >= 3 as cluster_anomaly from sized)"""


METHOD_SHARE = "case when total >= 3 then size / total < 0.05 or label = -1 else false end"


def lof_sql(source: str, name: str, by: str, rid: str, columns) -> str:
    """Local outlier factor within ``by``: CTEs ending in ``name`` (by, rid, lof, cut)."""
    on = lambda a, b: " and ".join(f"{a}.{c.strip()} = {b}.{c.strip()}" for c in by.split(","))
    keys = lambda a: ", ".join(f"{a}.{c.strip()}" for c in by.split(","))
    d2 = " + ".join(f"pow(a.{c} - b.{c}, 2)" for c in columns)
    return f"""{name}_s as (select *, count(*) over (partition by {by}) as c from {source}),
  {name}_p as (select {keys('a')}, a.{rid} as a, b.{rid} as b, a.c, sqrt({d2}) as d, row_number() over (partition by {keys('a')}, a.{rid} order by sqrt({d2}), b.{rid}) as rk
    from {name}_s a join {name}_s b on {on('a', 'b')} and a.{rid} <> b.{rid} where a.c >= 3),
  {name}_nn as (select * from {name}_p where rk <= least(20, greatest(2, c - 1), c - 1)),
  {name}_kd as (select {by}, a as rid, max(d) as kdist from {name}_nn group by all),
  {name}_lrd as (select {keys('n')}, n.a as rid, 1.0 / (avg(greatest(d, kdist)) + 1e-10) as lrd from {name}_nn n join {name}_kd k on {on('n', 'k')} and n.b = k.rid group by all),
  {name}_f as (select {keys('n')}, n.a as rid, avg(o.lrd) / max(m.lrd) as lof from {name}_nn n join {name}_lrd o on {on('n', 'o')} and n.b = o.rid
    join {name}_lrd m on {on('n', 'm')} and n.a = m.rid group by all),
  {name} as (select s.*, lof, quantile_cont(-lof, 0.05) over (partition by {keys('s')}) as cut from {name}_s s left join {name}_f f on {on('s', 'f')} and s.{rid} = f.rid)"""


def methods_sql() -> str:
    """Labels of all three methods: CTEs ending in ``judged_`` (user_id, metric, win, method, label, size, total)."""
    from vitalgrid.plans.q_features import lloyd_sql

    return f"""{lloyd_sql('scaled', 'km', VECTOR)}, {lof_sql('numbered', 'lof_', 'user_id', 'rid', VECTOR)},
  labels_ as (select user_id, metric, win, 'kmeans' as method, kmeans::bigint as label from km union all
    select user_id, metric, win, 'dbscan', dbscan from numbered join db using (rid) union all
    select user_id, metric, win, 'lof', case when -lof < cut then -1 else 0 end from lof_),
  judged_ as (select *, count(*) over (partition by user_id, method, label) as size, count(*) over (partition by user_id, method) as total from labels_)"""


def cluster_methods(daily_df) -> dict:
    """The windows' labels by k-means, density and local outlier factor, each with its flags; all from one matrix."""
    _, labelled = window_clusters(daily_df)
    matrix = stored(labelled, "window-labels")
    by = ("user_id",)
    lof = CL.local_outlier_factor(matrix.select("user_id", "rid", "x"), by, "rid").select("user_id", "rid", "lof_label")
    labels = {"kmeans": CL.kmeans_labels(matrix).withColumnRenamed("kmeans", "label"), "dbscan": matrix.withColumnRenamed("dbscan", "label"),
              "lof": matrix.join(lof, ["user_id", "rid"]).withColumnRenamed("lof_label", "label")}
    return {m: CL.flag_small(df.withColumn("label", F.col("label").cast("long")).select(*KEYS, "win", "label"), by, "label") for m, df in labels.items()}


@query("h8_cluster_outliers", f"""with recursive {Q.DAILY_LINES}, {CLUSTERED}, {methods_sql()} select user_id, metric, win, method, size as cluster_size,
  label = -1 as is_noise, {METHOD_SHARE} as cluster_anomaly from judged_""")
def h8(spark, sf):
    """One row a window and method."""
    from pyspark.sql import Window

    size = F.count(F.lit(1)).over(Window.partitionBy("user_id", "label"))
    out = None
    for method, flagged in cluster_methods(C.window_daily(spark, sf)).items():
        part = flagged.select(*KEYS, "win", F.lit(method).alias("method"), size.alias("cluster_size"), (F.col("label") == -1).alias("is_noise"), "cluster_anomaly")
        out = part if out is None else out.unionByName(part)
    return out


@query("h8_cluster_report", f"""with recursive {Q.DAILY_LINES}, {CLUSTERED}, {methods_sql()}, f as (select *, {METHOD_SHARE} as cluster_anomaly from judged_)
  select user_id, method, count(distinct label) as total_clusters, count(*) filter (where cluster_anomaly) as anomalies_detected,
  {sr('100.0 * count(*) filter (where cluster_anomaly) / count(*)')} as anomaly_percentage,
  (select string_agg(s::varchar, ',' order by s) from (select count(*) as s from f x
    where x.user_id = c.user_id and x.method = c.method group by label)) as cluster_sizes from f c group by 1, 2 having count(*) >= 3
  union all select user_id, method, 0, 0, 0.0, '' from f group by 1, 2 having count(*) < 3""")
def h8_report(spark, sf):
    out = None
    for method, flagged in cluster_methods(C.window_daily(spark, sf)).items():
        part = CL.cluster_report(flagged, ("user_id",)).withColumn("method", F.lit(method))
        out = part if out is None else out.unionByName(part)
    # the labels' numbers are free, the sizes are not
    sizes = F.array_sort(F.map_values(F.from_json("cluster_distribution", "map<string,bigint>")))
    return rounded(out.withColumn("cluster_sizes", F.array_join(sizes.cast("array<string>"), ","))
                   .drop("cluster_distribution"), "anomaly_percentage")


@query("h9_local_outlier_factor", f"""with {Q.WINDOW_DAILY}, {WINDOW_FEATURES.format(t='window_daily')}, {SCALED}, {lof_sql('scaled', 'g', 'user_id, metric', 'win', VECTOR)}
  select user_id, metric, win, {sr('lof')} as lof, case when -lof < cut then -1 else 0 end::bigint as lof_label from g""")
def h9(spark, sf):
    wins = FT.windows(C.window_daily(spark, sf))
    feats = FT.handcrafted(wins.withColumnRenamed("value", "y"), (*KEYS, "win"))
    scaled = FT.standardise(feats.fillna(0.0, list(FT.HANDCRAFTED)), FT.HANDCRAFTED).select(*KEYS, "win", *VECTOR)
    scores = CL.local_outlier_factor(FT.vectors(scaled, VECTOR)).select(*KEYS, "win", "lof", "lof_label")
    return scores.withColumn("lof", r(F.nanvl("lof", F.lit(None))))


RULED = f"""daily_rules(metric, low, high) as (values ('heart_rate', 40.0, 120.0), ('steps', 0.0, 1000.0), ('sleep', 180.0, 720.0)),
  ruled as (select user_id, metric, ds, coalesce(y > high or y < low, false) as threshold_anomaly
    from daily left join daily_rules using (metric))"""

NUMBERED_WINS = "placed as (select user_id, metric, ds, win from wins)"

VOTED = f"""{RESIDUAL}, {RULED}, {CLUSTERED}, {NUMBERED_WINS},
  votes as (select r.user_id, r.metric, r.ds, r.y, threshold_anomaly, residual_anomaly,
      coalesce(cluster_anomaly, false) as cluster_anomaly,
      threshold_anomaly::int + residual_anomaly::int + coalesce(cluster_anomaly, false)::int as votes
    from residual r join ruled using (user_id, metric, ds) left join placed using (user_id, metric, ds)
    left join cluster_flags using (user_id, metric, win)),
  near_ as (select *, votes / 3.0 as confidence_score, votes >= 2 as ensemble_anomaly,
      sum((votes >= 2)::int) over (w rows between 2 preceding and 2 following) as near2,
      sum((votes >= 2)::int) over (w rows between 3 preceding and 3 following) as near3
    from votes window w as (partition by user_id, metric order by ds)),
  voted as (select *, case when not ensemble_anomaly then 'Normal' when votes = 3 or near2 > 1 then 'High' else 'Medium' end as severity,
      case when not ensemble_anomaly then 'None' when near3 >= 3 then 'Collective' when near3 = 1 then 'Point' else 'Contextual' end as anomaly_type,
      case when ensemble_anomaly then 'Detected by: ' || concat_ws(', ', case when threshold_anomaly then 'Rule-Based' end,
        case when residual_anomaly then 'Model-Based' end, case when cluster_anomaly then 'Cluster-Based' end) else '' end as ensemble_reason
    from near_)"""


def voted(spark, sf, min_votes: int = 2):
    """All three detectors on daily series, then the vote.

    The daily table is read more than once, so it is stored: it is what is
    left of the raw samples after the one pass over them. A day carries the
    verdicts of one detector through the next, and each series gets its odd
    windows as one row, so that days are shuffled once to be judged.
    """
    d = stored(C.window_daily(spark, sf), "daily")
    days = d.count()
    odd = odd_windows(window_labels(FT.windows(S.by_series(d, days))))
    as_rows = d.select(*KEYS, F.col("ds").cast("timestamp").alias("ts"), F.col("y").alias("value"))
    ruled = T.detect_stored(as_rows, T.rules_table(spark), unit="year").select(
        *KEYS, F.to_date("ts").alias("ds"), F.col("value").alias("y"), "threshold_anomaly")
    # a day without a date has no rule, but weighs on its series' forecast
    ruled = ruled.unionByName(d.where(F.col("ds").isNull()).withColumn("threshold_anomaly", F.lit(None).cast("boolean")))
    placed = FT.in_windows(S.by_series(ruled, days)).drop("t")
    residual = (R.detect(placed).dropna(subset=[*KEYS, "ds"])
                .select(*KEYS, "ds", "y", "win", "threshold_anomaly", "residual_anomaly"))
    joined = residual.join(odd, list(KEYS), "left").withColumn(
        "cluster_anomaly", F.when(F.col("win").isNotNull(), F.array_contains("_odd", F.col("win")))).drop("win", "_odd")
    return E.score(joined, min_votes)


def odd_windows(labelled):
    """``_odd``: the anomalous windows of each series, of which it has one in 30 days."""
    flags = CL.flag_small(labelled, ("user_id",), "dbscan")
    return flags.groupBy(*KEYS).agg(F.collect_list(F.when(F.col("cluster_anomaly"), F.col("win"))).alias("_odd"))


@query("h10_vote_ensemble", f"""with recursive {Q.DAILY_LINES}, {VOTED} select user_id, metric, ds, votes,
  {sr('confidence_score')} as confidence_score, ensemble_anomaly from voted""")
def h10(spark, sf):
    return rounded(voted(spark, sf).select(*KEYS, "ds", "votes", "confidence_score", "ensemble_anomaly"), "confidence_score")


@query("h19_detector_chain", f"""with recursive {Q.DAILY_LINES}, {VOTED} select user_id, metric, ds, {sr('y', 2)} as y,
  threshold_anomaly, residual_anomaly, cluster_anomaly, ensemble_anomaly, severity, anomaly_type, ensemble_reason from voted""")
def h19(spark, sf):
    return rounded(voted(spark, sf), "y", n=2).select(
        *KEYS, "ds", "y", "threshold_anomaly", "residual_anomaly", F.coalesce("cluster_anomaly", F.lit(False)).alias("cluster_anomaly"),
        "ensemble_anomaly", "severity", "anomaly_type", "ensemble_reason")


# The vote over samples: rules with their sustained times, the rolling band, and the clusters of the windows a day is in.
VOTE_RULES = (*DEFAULT_RULES, *[Rule(m, "quantity", 3, 48, 0, "Unusual quantity") for m in ("A", "N", "R")])

SAMPLE_VOTES = f"""{CLUSTERED}, {NUMBERED_WINS},
  minutes as (select user_id, metric, ts, value, event_id from samples union all
    select l_suppkey, l_returnflag, cast(l_shipdate as timestamp), sum(l_quantity),
      -((l_suppkey * 1000 + ascii(l_returnflag)) * 100000 + date_diff('day', date '1970-01-01', cast(l_shipdate as date))) from lineitem group by l_suppkey, l_returnflag, l_shipdate),
  {_GAPS}, {threshold_sql(VOTE_RULES)},
  b as (select *, quantile_cont(value, 0.5) over (w rows between 14 preceding and current row) as p,
    2 * coalesce(stddev_samp(value) over (w rows between 29 preceding and current row), 0) as s
   from minutes window w as (partition by user_id, metric order by ts, event_id)),
  j as (select *, value - p as residual, stddev_samp(value - p) over (partition by user_id, metric) as sd from b),
  v as (select j.event_id, j.user_id, j.metric, j.ts, r.h or r.l as threshold_anomaly,
     abs(residual) > 3 * coalesce(sd, 0) or j.value > p + s or j.value < p - s as residual_anomaly, coalesce(c.cluster_anomaly, false) as cluster_anomaly
   from j join runs r on j.event_id = r.event_id left join (select * from placed join cluster_flags using (user_id, metric, win)) c
     on j.user_id = c.user_id and j.metric = c.metric and cast(j.ts as date) = c.ds),
  x as (select *, threshold_anomaly::int + residual_anomaly::int + cluster_anomaly::int as votes from v),
  near_ as (select *, votes >= 1 as ensemble_anomaly,
     sum((votes >= 1)::int) over (w rows between 2 preceding and 2 following) as near2,
     sum((votes >= 1)::int) over (w rows between 3 preceding and 3 following) as near3
    from x window w as (partition by user_id, metric order by ts, event_id))"""


def sample_votes(spark, sf, block_rows: int = 700, whole_rows: int = S.WHOLE_ROWS):
    """Vote of three detectors on all samples, one vote is enough.

    Samples are dealt by series once and kept so: days, windows, detectors and neighbours are found where the samples are.
    Series of more than ``whole_rows`` rows, with an id that repeats or with days of several sources are voted on in blocks
    of ``block_rows`` rows.
    """
    lines, events = (df.where(F.col("user_id").isNotNull()) for df in (C.line_samples(spark, sf), C.samples(spark, sf)))
    raw = lines.select(*KEYS).unionByName(events.select(*KEYS))
    apart = _apart(lines, events, raw, S.long_series(raw, rows=whole_rows))
    tasks = S.tasks_for(raw)

    def of(source, kind):
        return source if apart is None else S.of_series(source, apart, kind=kind)

    shipments = C.shipped(of(lines, "left_anti").repartition(tasks, *KEYS)).withColumn("lines", F.lit(True))
    readings = of(events, "left_anti").withColumn("lines", F.lit(False)).repartition(tasks, *KEYS)
    samples = stored_by(shipments.unionByName(readings), "samples", tasks, KEYS)
    days_by = (*KEYS, "lines")
    days = [D.daily(samples, days_by), C.everyone_daily(spark, sf).unionByName(D.daily(C.order_samples(spark, sf)))]
    if apart is not None:
        long = stored(C.shipped(of(lines, "left_semi")).withColumn("lines", F.lit(True)).unionByName(of(events, "left_semi").withColumn("lines", F.lit(False))), "long-samples")
        days[1] = days[1].unionByName(D.daily(long, days_by).drop("lines"))
    wins = [FT.windows(d.select(*KEYS, "ds", "y")) for d in days]
    # one after the other, as a union would deal the days of samples anew
    labelled = feature_labels(window_features(wins[0]).unionByName(window_features(wins[1])))
    again = S.series_with_repeated_ids(samples, "event_id", others=None if apart is None else long)
    alone = samples if again is None else S.of_series(samples, again, kind="left_anti")
    scored = _whole_votes(alone.drop("lines"), odd_windows(labelled))
    special = [df for df in (apart if apart is None else long, again if again is None else S.of_series(samples, again)) if df is not None]
    if not special:
        return scored
    cut = stored(reduce(DataFrame.unionByName, special).drop("lines"), "cut-samples")
    flags = CL.flag_small(labelled, ("user_id",), "dbscan").select(*KEYS, "win", "cluster_anomaly")
    placed = reduce(DataFrame.unionByName, [w.select(*KEYS, "win", "ds") for w in wins])
    clustered = S.of_series(placed, cut.select(*KEYS).distinct()).join(flags, [*KEYS, "win"]).drop("win")
    return scored.unionByName(_cut_votes(cut, clustered, block_rows).select(*scored.columns))


def _apart(lines, events, raw, long):
    """Series to leave out of the whole ones: long ones, and those whose days come from more than one source."""
    found = raw.where(F.col("user_id").isin(C.ORDERS, C.EVERYONE))
    kinds = stored(events.select("metric").distinct().join(lines.select("metric").distinct(), "metric"), "both")
    if not kinds.isEmpty():
        found = found.unionByName(lines.select(*KEYS).join(kinds, "metric", "left_semi").select(*KEYS))
    if long is not None:
        found = found.unionByName(long)
    found = stored(found.distinct(), "apart")
    return None if found.isEmpty() else found


SAMPLE_COLUMNS = ("event_id", *KEYS, "ts", *[c for c, _ in E.METHODS], "votes", "confidence_score", "ensemble_anomaly")


def _whole_votes(samples, odd):
    """The vote on whole series that are dealt by their keys, with ids that do not repeat."""
    order = ("ts", "event_id")
    placed = FT.windows_of_samples(samples, order=order)
    ruled = T.detect(placed, T.rules_table(samples.sparkSession, VOTE_RULES), unit=None).drop("anomaly_reason", "severity")
    rows = R.detect_samples(ruled, order=order, unit=None).where(F.col("event_id").isNotNull())
    clustered = rows.join(odd, list(KEYS), "left").withColumn(
        "cluster_anomaly", F.when(F.col("win").isNotNull(), F.array_contains("_odd", F.col("win"))))
    votes = E.vote(clustered, 1).select(*SAMPLE_COLUMNS)
    return E.reason(E.anomaly_type(E.severity(E.neighbours(votes, KEYS, order))))


def _cut_votes(samples, clustered, block_rows: int):
    """The vote on series of any length, in chunks and in blocks of rows with a 3-row margin."""
    ruled = T.detect(samples, T.rules_table(samples.sparkSession, VOTE_RULES)).select("event_id", "threshold_anomaly")
    rows = (R.detect_samples(samples, order=("ts", "event_id"), unit="month").join(ruled, "event_id")
            .withColumn("ds", F.to_date("ts")).join(clustered, [*KEYS, "ds"], "left"))
    # numbering reads its rows twice
    votes = stored(E.vote(rows, 1).select(*SAMPLE_COLUMNS), "votes")
    numbered = S.number_rows(votes, ("ts", "event_id"), unit="month")
    blocks = S.row_blocks(numbered, halo_before=3, halo_after=3, size=block_rows)
    scored = E.reason(E.anomaly_type(E.severity(E.neighbours(blocks, [*KEYS, "_block"], ["rn"]))))
    return S.drop_halo(scored)


@query("f7_neighbourhood_counts", f"""with recursive {Q.DAILY_LINES}, {SAMPLE_VOTES} select event_id, metric, votes, near2::bigint as near2,
  near3::bigint as near3 from near_""")
def f7(spark, sf):
    return sample_votes(spark, sf).select("event_id", "metric", "votes", "near2", "near3")


@query("h11_severity", f"""with recursive {Q.DAILY_LINES}, {SAMPLE_VOTES} select event_id, case when not ensemble_anomaly then 'Normal' else
  ['Low', 'Medium', 'High'][least(3, votes + (near2 > 1)::int)] end as severity from near_""")
def h11(spark, sf):
    return sample_votes(spark, sf).select("event_id", "severity")


@query("h12_anomaly_type", f"""with recursive {Q.DAILY_LINES}, {SAMPLE_VOTES} select event_id, case when not ensemble_anomaly then 'None'
  when near3 >= 3 then 'Collective' when near3 = 1 then 'Point' else 'Contextual' end as anomaly_type from near_""")
def h12(spark, sf):
    return sample_votes(spark, sf).select("event_id", "anomaly_type")


@query("h13_reason_text", f"""with recursive {Q.DAILY_LINES}, {SAMPLE_VOTES} select event_id, case when ensemble_anomaly then
  'Detected by: ' || concat_ws(', ', case when threshold_anomaly then 'Rule-Based' end, case when residual_anomaly then 'Model-Based' end,
    case when cluster_anomaly then 'Cluster-Based' end) else '' end as ensemble_reason from near_""")
def h13(spark, sf):
    return sample_votes(spark, sf).select("event_id", "ensemble_reason")


@query("d6_cluster_flags_by_key", f"""with recursive {Q.DAILY_LINES}, {CLUSTERED}, {NUMBERED_WINS} select user_id, metric, ds, win,
  cluster_anomaly from placed join cluster_flags using (user_id, metric, win)""")
def d6(spark, sf):
    wins, labelled = window_clusters(C.window_daily(spark, sf))
    flags = CL.flag_small(labelled, ("user_id",), "dbscan").select(*KEYS, "win", "cluster_anomaly")
    return wins.select(*KEYS, "win", "ds").join(flags, [*KEYS, "win"])


@query("e7_weekly_confidence", f"""with recursive {Q.DAILY_LINES}, {VOTED} select metric, cast(date_trunc('week', ds) as date) as week,
  {sr('avg(confidence_score)')} as confidence, count(*) filter (where ensemble_anomaly) as anomalies from voted group by all""")
def e7(spark, sf):
    from vitalgrid.functions.scalars import week_start

    weekly = voted(spark, sf).groupBy("metric", week_start(F.col("ds")).alias("week")).agg(
        r(F.avg("confidence_score")).alias("confidence"), F.count_if("ensemble_anomaly").alias("anomalies"))
    return weekly


@query("e8_severity_distribution", f"""with recursive {Q.DAILY_LINES}, {VOTED} select metric, severity, count(*) as n from voted
  where ensemble_anomaly group by all""")
def e8(spark, sf):
    return voted(spark, sf).where("ensemble_anomaly").groupBy("metric", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("e9_anomalies_per_date", f"""with recursive {Q.DAILY_LINES}, {VOTED} select ds, count(*) filter (where ensemble_anomaly) as n
  from voted group by all""")
def e9(spark, sf):
    return voted(spark, sf).groupBy("ds").agg(F.count_if("ensemble_anomaly").alias("n"))


SUMMARY = """summary as (select user_id, metric, count(*) filter (where ensemble_anomaly) as total_anomalies,
   avg(confidence_score) as avg_confidence, 0::bigint as low,
   count(*) filter (where ensemble_anomaly and severity = 'Medium') as medium,
   count(*) filter (where ensemble_anomaly and severity = 'High') as high from voted group by all)"""


@query("e11_ensemble_summary", f"""with recursive {Q.DAILY_LINES}, {VOTED}, {SUMMARY} select user_id, metric, total_anomalies,
  {sr('avg_confidence')} as avg_confidence, low, medium, high from summary""")
def e11(spark, sf):
    return rounded(stats.ensemble_summary(voted(spark, sf)), "avg_confidence")


@query("e11_overall_summary", f"""with recursive {Q.DAILY_LINES}, {VOTED}, {SUMMARY} select sum(total_anomalies)::bigint as
  total_anomalies, {sr('avg(avg_confidence)')} as avg_confidence, count(*) as series, sum(high)::bigint as high from summary""")
def e11_overall(spark, sf):
    return rounded(stats.overall_summary(stats.ensemble_summary(voted(spark, sf))), "avg_confidence")


@query("e12_method_comparison", f"""with recursive {Q.DAILY_LINES}, {VOTED} select user_id, metric,
  count(*) filter (where threshold_anomaly) as threshold, count(*) filter (where residual_anomaly) as model,
  count(*) filter (where cluster_anomaly) as cluster, count(*) filter (where ensemble_anomaly) as ensemble
  from voted group by all""")
def e12(spark, sf):
    return stats.method_counts(voted(spark, sf))


@query("g3_top_by_confidence", f"""with recursive {Q.DAILY_LINES}, {VOTED} select user_id, metric,
  row_number() over (partition by user_id, metric order by votes desc, ds) as rank, ds, {sr('confidence_score')} as confidence_score,
  severity, anomaly_type, ensemble_reason from voted where ensemble_anomaly qualify rank <= 10""")
def g3(spark, sf):
    top = RP.top_ensemble(voted(spark, sf))
    return rounded(top.withColumn("rank", F.col("rank").cast("long")), "confidence_score")


@query("g4_anomaly_details", f"""with recursive {Q.DAILY_LINES}, {VOTED} select user_id, metric, ds, {sr('y', 2)} as y,
  {sr('confidence_score')} as confidence_score, severity, anomaly_type, ensemble_reason from voted where ensemble_anomaly""")
def g4(spark, sf):
    details = voted(spark, sf).where("ensemble_anomaly").select(
        *KEYS, "ds", "y", "confidence_score", "severity", "anomaly_type", "ensemble_reason")
    return rounded(rounded(details, "y", n=2), "confidence_score")


# --- scored ensemble ----------------------------------------------------------------------------

def scored_sql() -> str:
    return f"""{BASE}, {fit_sql('base', 'fit', FC.Z95)}, {kmeans_sql('points', 'km')}, {NOISE.format(t='points')},
  five as (select b.user_id, b.metric, b.ds, b.y, {STATUS} as method_status,
      n >= 3 and coalesce(b.y < b.mean - 2.5 * b.std or b.y > b.mean + 2.5 * b.std, false) as is_outlier,
      coalesce(b.y - lag(b.y) over w, 0) as change,
      n >= 3 and coalesce(abs(coalesce(b.y - lag(b.y) over w, 0)) > 2 * b.std, false) as is_spike,
      n >= 20 and b.std > 0 and (b.y < lo or b.y > hi) as is_breach, coalesce(is_small, false) as is_small, noise.ds is not null as is_noise
    from (select * from base) b join (select user_id, metric, ds, lo, hi from fit) fit using (user_id, metric, ds) left join km using (user_id, metric, ds) left join noise using (user_id, metric, ds)
    window w as (partition by b.user_id, b.metric order by b.ds)),
  rated as (select *, is_outlier::int + is_spike::int + is_breach::int + is_small::int + is_noise::int as votes,
      0.4 * is_outlier::int + 0.3 * is_spike::int + 0.4 * is_breach::int + 0.3 * is_small::int + 0.4 * is_noise::int as raw from five),
  scored as (select *, case when max(raw) over (partition by user_id, metric) > 0
      then cast(raw / max(raw) over (partition by user_id, metric) as double) else 0.0 end as score,
      case when is_noise or is_small then 'Collective' when is_spike then 'Contextual' when is_outlier then 'Point' else 'Normal' end as type
    from rated)"""


def mode_sql(name: str, mode) -> str:
    return f"""{name}_f as (select *, (votes >= {mode.min_votes} and score >= {mode.min_score} - 1e-9)
      or (contains(lower(metric), 'step') and is_breach) as is_anom from scored),
  {name}_g as (select *, case when not is_anom then 'Normal' when score < {mode.medium} - 1e-9 then 'Low'
      when score < {mode.high} - 1e-9 then 'Medium' else 'High' end as severity from {name}_f),
  {name} as (select *, case when not is_anom then '{E.TEXT_UNFLAGGED}' else concat_ws('; ',
      case when is_outlier then '{E.TEXT_OUTLIER}' end, case when is_spike then case when change > 0 then '{E.TEXT_JUMP_UP}'
      else '{E.TEXT_DROP}' end end, case when is_breach then '{E.TEXT_BREACH}' end, case when is_small then '{E.TEXT_SMALL}' end,
      case when is_noise then '{E.TEXT_NOISE}' end) || ' (Severity: ' || severity || ').' end as explanation from {name}_g)"""


@query("h14_scored_ensemble", f"""with {Q.DAILY}, {scored_sql()} select user_id, metric, ds, is_outlier, is_spike, is_breach,
  is_small, is_noise, votes, {sr('score')} as score, type, method_status from scored""")
def h14(spark, sf):
    scored = E.weigh(E.detect_methods(C.daily(spark, sf)))
    return rounded(scored.select(*KEYS, "ds", *E.WEIGHTS, "votes", "score", "type", "method_status"), "score")


@query("h15_sensitivity_modes", f"""with {Q.DAILY}, {scored_sql()}, {mode_sql('bal', E.BALANCED)}, {mode_sql('more', E.CATCH_MORE)},
  {mode_sql('strong', E.ONLY_STRONG)} select user_id, metric, ds, b.is_anom as balanced, m.is_anom as more, s.is_anom as strong
  from bal b join more m using (user_id, metric, ds) join strong s using (user_id, metric, ds)""")
def h15(spark, sf):
    scored = E.weigh(E.detect_methods(C.daily(spark, sf)))
    for name, mode in (("balanced", E.BALANCED), ("more", E.CATCH_MORE), ("strong", E.ONLY_STRONG)):
        scored = E.flag(scored, mode).withColumnRenamed("is_anom", name)
    return scored.select(*KEYS, "ds", "balanced", "more", "strong")


@query("h16_graded_severity", f"""with {Q.DAILY}, {scored_sql()}, {mode_sql('more', E.CATCH_MORE)} select user_id, metric, ds,
  severity from more""")
def h16(spark, sf):
    return E.detect(C.daily(spark, sf), E.CATCH_MORE).select(*KEYS, "ds", "severity")


@query("h17_explanations", f"""with {Q.DAILY}, {scored_sql()}, {mode_sql('bal', E.BALANCED)} select user_id, metric, ds,
  explanation from bal""")
def h17(spark, sf):
    return E.detect(C.daily(spark, sf)).select(*KEYS, "ds", "explanation")


@query("h18_window_gate", f"""with {Q.DAILY}, g as (select *, count(*) over (partition by user_id, metric) as n from daily
   where ds between '2024-01-05' and '2024-01-20') select user_id, metric, ds from g where n >= 5""")
def h18(spark, sf):
    return E.gate(C.daily(spark, sf), "2024-01-05", "2024-01-20").select(*KEYS, "ds")


@query("g1_recent_anomalies", f"""with {Q.DAILY}, {scored_sql()}, {mode_sql('bal', E.BALANCED)} select user_id, metric, ds,
  {sr('y', 2)} as y, printf('%.1f', score * 100 + 1e-9) || '%' as score, type, severity from bal where is_anom
  qualify row_number() over (partition by user_id, metric order by ds desc) <= 15""")
def g1(spark, sf):
    return rounded(RP.recent_anomalies(E.detect(C.daily(spark, sf))), "y", n=2)


@query("g2_recent_outliers", f"""with {Q.DAILY}, {MOMENTS.format(t='daily')} select user_id, metric,
  row_number() over (partition by user_id, metric order by ds desc) as rank, ds, {sr('y', 2)} as y,
  {sr('(y - mean) / std')} as deviation from moments where y < mean - 2.5 * std or y > mean + 2.5 * std qualify rank <= 5""")
def g2(spark, sf):
    top = RP.recent_outliers(C.daily(spark, sf)).withColumn("rank", F.col("rank").cast("long"))
    return rounded(rounded(top, "y", n=2), "deviation")


@query("e23_anomalies_on_day", f"""with {Q.DAILY}, {MOMENTS.format(t='daily')}, o as (select *, coalesce(
   y < mean - 2.5 * std or y > mean + 2.5 * std, false) as hit from moments) select user_id, metric,
   count(*) filter (where hit and ds = date '2000-01-15') as n from o group by all""")
def e23(spark, sf):
    from vitalgrid.operators.daily import rows_on

    return rows_on(sigma.outliers(sigma.moments(C.daily(spark, sf))), "2000-01-15", flag="is_outlier")
