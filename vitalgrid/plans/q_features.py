"""Window features and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.operators import cluster as CL, features as FT
from vitalgrid.plans import canonical as C, sql as Q
from vitalgrid.plans.q_detect import ROW_ID, density_sql
from vitalgrid.plans.registry import query, rounded, sr
from vitalgrid.schema import KEYS
from vitalgrid.session import stored

WINS = f"""{Q.WINDOW_DAILY}, wins as (select user_id, metric, win, i % 30 as t, y from (select *, i // 30 as win from (select *,
    row_number() over (partition by user_id, metric order by ds) - 1 as i, count(*) over (partition by user_id, metric) as c
    from window_daily) where i // 30 < c // 30))"""


def _auto_sql() -> str:
    wave = ", ".join(f"sqrt(pow(sum(y * cos(-2 * pi() * {k} / 30 * t)), 2) + pow(sum(y * sin(-2 * pi() * {k} / 30 * t)), 2)) as fft_abs_{k}"
                     for k in range(1, FT.FOURIER_TERMS + 1))
    w = "partition by user_id, metric, win"
    return f"""x as (select *, avg(y) over ({w}) as mu, stddev_pop(y) over ({w}) as sd, max(y) over ({w}) as top, min(y) over ({w}) as low,
      lag(y) over ({w} order by t) as prev, lead(y) over ({w} order by t) as nxt, lead(y, 2) over ({w} order by t) as nxt2 from wins),
  isles as (select *, count(*) filter (where not y > mu) over ({w} order by t) as ga, count(*) filter (where not y < mu) over ({w} order by t) as gb from x),
  runs as (select *, count(*) filter (where y > mu) over ({w}, ga order by t) as up, count(*) filter (where y < mu) over ({w}, gb order by t) as down from isles),
  auto as (select user_id, metric, win, sum(y) as sum_values, sum(y * y) as abs_energy, avg(abs(y - prev)) as mean_abs_change,
    avg(y - prev) as mean_change, sqrt(sum(pow(y - prev, 2))) as cid_ce, avg(nxt2 * nxt * y) as c3_lag1,
    case when max(sd) > 0 then sum((y - mu) * (nxt - mu)) / ((count(*) - 1) * max(sd * sd)) end as autocorr_lag1,
    count(*) filter (where y > mu) as count_above_mean, count(*) filter (where y < mu) as count_below_mean,
    max(up) as longest_above_mean, max(down) as longest_below_mean, count(*) filter (where y > prev and y > nxt) as number_peaks,
    quantile_cont(y, 0.1) as quantile_10, quantile_cont(y, 0.9) as quantile_90, max(sd) / nullif(max(mu), 0) as variation_coefficient,
    regr_slope(y, t) as trend_slope, regr_r2(y, t) as trend_r2, min(t) filter (where y = top) / 30.0::double as first_loc_max,
    (max(t) filter (where y = top) + 1) / 30.0::double as last_loc_max, min(t) filter (where y = low) / 30.0::double as first_loc_min,
    (max(t) filter (where y = low) + 1) / 30.0::double as last_loc_min,
    count(*) filter (where abs(y - mu) > sd) / 30.0::double as ratio_beyond_1_sigma,
    case when count(*) filter (where y = top) > 1 then 1.0::double else 0.0::double end as has_duplicate_max, {wave} from runs group by 1, 2, 3)"""


COUNTS = ("count_above_mean", "count_below_mean", "longest_above_mean", "longest_below_mean", "number_peaks")
REALS = tuple(c for c in FT.AUTOMATIC if c not in COUNTS)


def windows(spark, sf):
    return FT.windows(C.window_daily(spark, sf))


def automatic(spark, sf):
    return FT.automatic(windows(spark, sf))


@query("j1_windows_long", f"""with {WINS} select user_id, metric, win, t, {sr('y', 2)} as value from wins""")
def j1(spark, sf):
    long = windows(spark, sf).select(*KEYS, "win", F.col("t").cast("long").alias("t"), "value")
    return rounded(long, "value", n=2)


def digits_sql(c: str) -> str:
    """Six significant digits, zero below 1e-9."""
    return f"case when abs({c}) < 1e-9 then 0.0 else round({c} / pow(10, floor(log10(abs({c})) + 1e-9)) + 1e-9, 5) * pow(10, floor(log10(abs({c})) + 1e-9)) end"


def to_digits(df, names):
    size = lambda c: F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c)) + 1e-9))
    return df.withColumns({c: F.when(F.abs(c) < 1e-9, 0.0).otherwise(F.round(F.col(c) / size(c) + 1e-9, 5) * size(c)) for c in names})


@query("j2_automatic_features", f"""with {WINS}, {_auto_sql()} select user_id, metric, win, {", ".join(COUNTS)},
  {", ".join(f"{sr(f'cast({digits_sql(c)} as double)', 6)} as {c}" for c in REALS)} from auto""")
def j2(spark, sf):
    """The features themselves, to six significant digits."""
    return rounded(to_digits(automatic(spark, sf), REALS), *REALS, n=6)


HOLED = """holed as (select user_id, metric, win, case when win % 5 = 0 then null when win % 7 = 1 then 'inf'::double else trend_r2 end as a,
   case when win % 4 = 2 then '-inf'::double else variation_coefficient end as b, null::double as gone from auto)"""


def _holed(spark, sf):
    inf = float("inf")
    w = F.col("win")
    return automatic(spark, sf).select(
        *KEYS, "win", F.when(w % 5 == 0, None).when(w % 7 == 1, inf).otherwise(F.col("trend_r2")).alias("a"),
        F.when(w % 4 == 2, -inf).otherwise(F.col("variation_coefficient")).alias("b"),
        F.lit(None).cast("double").alias("gone"))


IMPUTED = """st as (select user_id, quantile_cont(a, 0.5) filter (where isfinite(a)) as ma, max(a) filter (where isfinite(a)) as ha,
    min(b) filter (where isfinite(b)) as lb from holed group by 1),
  imputed as (select user_id, metric, win, case when a is null then ma when a = 'inf' then ha else a end as a,
    case when b = '-inf' then lb else b end as b from holed join st using (user_id))"""


@query("j3_impute", f"""with {WINS}, {_auto_sql()}, {HOLED}, {IMPUTED} select user_id, metric, win, {sr('a')} as a, {sr('b')} as b from imputed""")
def j3(spark, sf):
    return rounded(FT.impute(_holed(spark, sf).drop("gone"), ("a", "b")), "a", "b")


@query("j4_fill_median", f"""with {WINS}, {_auto_sql()}, {HOLED}, {IMPUTED} select user_id, metric, win, {sr('a')} as a, {sr('b')} as b from imputed""")
def j4(spark, sf):
    return rounded(FT.fill_median(_holed(spark, sf), ("a", "b", "gone")), "a", "b")


SCALED = "filled as (select user_id, metric, win, {} from auto window w as (partition by user_id)), ".format(", ".join(
    f"coalesce({c}, quantile_cont({c}, 0.5) over w)::double as {c}" for c in FT.AUTOMATIC)) + (
    "scaled as (select user_id, metric, win, {} from filled window w as (partition by user_id))".format(", ".join(
        f"case when stddev_pop({c}) over w > 1e-12 then ({c} - avg({c}) over w) / stddev_pop({c}) over w else 0.0 end as {c}"
        for c in FT.AUTOMATIC)))


def scaled(spark, sf):
    """All automatic features, imputed, then standardised per user: the matrix that is clustered."""
    filled = FT.fill_median(stored(automatic(spark, sf), "features"), FT.AUTOMATIC)
    kept = [c for c in FT.AUTOMATIC if c in filled.columns]
    return FT.standardise(filled, kept).select(*KEYS, "win", *kept)


def features_of(matrix):
    return [c for c in FT.AUTOMATIC if c in matrix.columns]


@query("j5_standardise", f"""with {WINS}, {_auto_sql()}, {SCALED} select user_id, metric, win,
  {", ".join(f"{sr(c)} as {c}" for c in FT.AUTOMATIC)} from scaled""")
def j5(spark, sf):
    matrix = scaled(spark, sf)
    return rounded(matrix, *features_of(matrix))


@query("j5_standardise_embeddings", f"""with e as (select vec_id, label, unnest(generate_series(1, len(embedding))) as d,
    unnest(embedding)::double as x from embeddings), s as (select *, avg(x) over w as mu, stddev_pop(x) over w as sd from e
    window w as (partition by label, d))
  select vec_id, label, d - 1 as dim, {sr('case when sd > 1e-12 then (x - mu) / sd else 0.0 end')} as x from s""")
def j5_embeddings(spark, sf):
    scaled = FT.standardise_vectors(C.table(spark, sf, "embeddings").select("vec_id", "label", "embedding"), "embedding", ("label",))
    long = scaled.select("vec_id", "label", F.posexplode("embedding").alias("dim", "x"))
    return rounded(long.withColumn("dim", F.col("dim").cast("long")), "x")


def labelled(spark, sf, eps: float = 1.0):
    """Window features with density labels; ids follow the order of the windows' keys."""
    wide = scaled(spark, sf)
    matrix = FT.number_windows(FT.vectors(wide, features_of(wide)))
    return CL.density_labels(matrix, ("user_id",), "rid", eps=eps)


def lloyd_sql(source: str, name: str, columns, clusters: int = 4, iterations: int = 10) -> str:
    """Unrolled k-means per user over ``source``: CTEs ending in ``name(user_id, metric, win, kmeans)``.

    Centres are rows of their own, so that all columns fit: long form (rid, d, x), distances summed by centre.
    """
    values = ", ".join(f"('{c}', {c})" for c in columns)
    out = f"""{name}_n as (select *, {ROW_ID} as rid, row_number() over (partition by user_id order by metric, win) as rk,
      count(*) over (partition by user_id) as n from {source}),
    {name}_x as materialized (select user_id, rid, n, rk, least({clusters}, n) as k, u.d, u.x from {name}_n,
      lateral (select unnest([{", ".join(f"'{c}'" for c in columns)}]) as d, unnest([{", ".join(columns)}]) as x) u),
    {name}_c0 as materialized (select user_id, j, d, max(x) as x from {name}_x, (select unnest(generate_series(0, {clusters - 1})) as j)
      where j < k and rk = floor((j + 0.5) * n / k) + 1 group by all)"""
    for i in range(iterations + 1):
        out += f""",
    {name}_a{i} as materialized (select user_id, rid, first(j order by dist, j) as j from (select a.user_id, a.rid, c.j,
      round(sum((a.x - c.x) * (a.x - c.x)), 9) as dist from {name}_x a join {name}_c{i} c on a.user_id = c.user_id and a.d = c.d group by all) group by all)"""
        if i < iterations:
            out += f""",
    {name}_c{i + 1} as materialized (select c.user_id, c.j, c.d, coalesce(m.x, c.x) as x from {name}_c{i} c left join
      (select a.user_id, l.j, a.d, avg(a.x) as x from {name}_x a join {name}_a{i} l using (user_id, rid) group by all) m using (user_id, j, d))"""
    return out + f""",
    {name} as (select user_id, metric, win, j as kmeans from {name}_n join {name}_a{iterations} using (user_id, rid))"""


@query("j6_kmeans_labels", f"""with {WINS}, {_auto_sql()}, {SCALED}, {lloyd_sql('scaled', 'km', FT.AUTOMATIC)}
  select user_id, metric, win, kmeans::int as kmeans from km""")
def j6(spark, sf):
    matrix = scaled(spark, sf)
    return CL.kmeans_labels(FT.vectors(matrix, features_of(matrix))).select(*KEYS, "win", "kmeans")


@query("j6_pooled_kmeans", f"""with {WINS}, {_auto_sql()}, {SCALED}, pooled as (select *, user_id as own, metric as own_metric, win as own_win from scaled),
  all_windows as (select 0 as user_id, own || '/' || own_metric as metric, own_win as win, {", ".join(FT.AUTOMATIC)} from pooled), {lloyd_sql('all_windows', 'km', FT.AUTOMATIC)}
  select split_part(metric, '/', 1)::bigint as user_id, split_part(metric, '/', 2) as metric, win, kmeans::int as kmeans from km""")
def j6_pooled(spark, sf):
    """One model of all users' windows, whose centres are a table."""
    wide = scaled(spark, sf)
    matrix = stored(FT.vectors(wide, features_of(wide)).withColumn("name", F.concat_ws("/", F.col("user_id").cast("string"), "metric")), "windows")
    numbered = matrix.withColumn("all_", F.lit(0))
    centres = CL.spaced_centres(numbered, ("all_",), ("name", "win"), "x", 4).drop("all_")
    return CL.lloyd(matrix, stored(centres, "centres"), ())[0].select(*KEYS, "win", "kmeans")


DENSITY = f"""numbered as (select *, {ROW_ID} as rid from scaled), {density_sql('numbered', 'db', 'user_id', 1.0, FT.AUTOMATIC)}"""


@query("j7_density_clusters", f"""with recursive {WINS}, {_auto_sql()}, {SCALED}, {DENSITY} select n.user_id, n.metric, n.win,
  dbscan = -1 as is_noise, count(*) over (partition by n.user_id, dbscan) as cluster_size,
  min(n.metric || '/' || lpad(n.win::varchar, 5, '0')) over (partition by n.user_id, dbscan) as first_window
  from numbered n join db using (rid)""")
def j7(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id", "dbscan")
    name = F.concat_ws("/", "metric", F.lpad(F.col("win").cast("string"), 5, "0"))
    return labelled(spark, sf).select(
        *KEYS, "win", (F.col("dbscan") == -1).alias("is_noise"), F.count(F.lit(1)).over(w).alias("cluster_size"),
        F.min(name).over(w).alias("first_window"))


@query("j8_clusters_table", f"""with recursive {WINS}, {_auto_sql()}, {SCALED}, {DENSITY}, {lloyd_sql('scaled', 'km', FT.AUTOMATIC)}
  select n.user_id, n.metric, n.win, {", ".join(f"{sr(f'n.{c}')} as {c}" for c in FT.AUTOMATIC)}, kmeans::int as kmeans,
   dbscan = -1 as is_noise, n.metric as source from numbered n join db using (rid) join km on n.user_id = km.user_id
   and n.metric = km.metric and n.win = km.win""")
def j8(spark, sf):
    wide = stored(scaled(spark, sf), "scaled")
    names = features_of(wide)
    matrix = FT.number_windows(FT.vectors(wide, names))
    both = CL.kmeans_labels(CL.density_labels(matrix, ("user_id",), "rid", eps=1.0))
    table = both.select(*KEYS, "win", "kmeans", (F.col("dbscan") == -1).alias("is_noise"), F.col("metric").alias("source"))
    return rounded(wide.join(table, [*KEYS, "win"]), *names)
