"""Scalar functions, timelines, daily series, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.functions import ladders as L, scalars as X, text, timeparse as TP
from vitalgrid.operators import daily as D, features as FT, residual as R, series as S, sigma, stats, threshold as T
from vitalgrid.operators import timeline as TL
from vitalgrid.plans import canonical as C, sql as Q
from vitalgrid.plans.registry import plain_time, query, r, rounded, sr
from vitalgrid.schema import HEART_RATE, KEYS, STEPS, Rule

AS_OF = "2024-01-15"


# --- scalar functions ---------------------------------------------------------------------------

@query("c1_parse_timestamps", """select event_id, case event_type
  when 'view' then date_trunc('second', ts) when 'click' then date_trunc('second', ts)
  when 'purchase' then ts when 'signup' then date_trunc('minute', ts) end as parsed from events""")
def c1(spark, sf):
    e = C.table(spark, sf, "events")
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
    as_text = (F.when(kind == "view", F.date_format(ts, TP.HEART_RATE_FORMAT))
               .when(kind == "click", F.date_format(ts, TP.STEPS_FORMAT))
               .when(kind == "purchase", F.date_format(ts, TP.SLEEP_FORMAT))
               .when(kind == "signup", F.date_format(ts, TP.SAMPLE_FORMAT))
               .otherwise(F.concat(F.lit("not a time: "), F.col("props"))))
    return plain_time(e.select("event_id", TP.parse_timestamp(as_text).alias("parsed")), "parsed")


@query("c2_local_to_utc", """with d as (select distinct cast(o_orderdate as date) as ds from orders),
 k as (select event_id, ts - interval 330 minute as utc from events),
 y as (select ds, make_date(year(ds), 4, 1) as apr, make_date(year(ds), 10, 31) as oct from d),
 s as (select ds, apr + cast((7 - dayofweek(apr)) % 7 as int) as spring,
              oct - cast(dayofweek(oct) as int) as fall from y),
 n as (select ds, ds = spring as is_gap, ds = fall as is_twice, ds > spring and ds < fall as summer_all,
              ds >= spring and ds < fall as summer_noon from s)
select 'kolkata' as zone, event_id as id, utc as early, utc as late, utc as noon from k
union all
select 'new_york', epoch(ds)::bigint // 86400,
  case when is_twice then null when summer_all then ds + interval 330 minute else ds + interval 390 minute end,
  case when is_gap then ds + interval 420 minute when summer_all then ds + interval 390 minute
       else ds + interval 450 minute end,
  case when summer_noon then ds + interval 960 minute else ds + interval 1020 minute end from n""")
def c2(spark, sf):
    e = C.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    utc = TP.local_to_utc(F.col("ts"))
    kolkata = e.select(F.lit("kolkata").alias("zone"), F.col("event_id").alias("id"), utc.alias("early"),
                       utc.alias("late"), utc.alias("noon"))
    days = C.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("ds")).distinct()
    midnight = F.col("ds").cast("timestamp")

    def ny(minutes):
        return TP.local_to_utc(midnight + F.expr(f"INTERVAL {minutes} MINUTES"), "America/New_York")

    york = days.select(F.lit("new_york").alias("zone"), F.unix_date("ds").cast("long").alias("id"),
                       ny(90).alias("early"), ny(150).alias("late"), ny(720).alias("noon"))
    return plain_time(kolkata.unionByName(york), "early", "late", "noon")


_TEXT_NUMBER = """case event_type when 'view' then cast(value as varchar) when 'click' then 'abc'
  when 'purchase' then 'NaN' when 'signup' then '' else cast(cast(floor(value) as bigint) as varchar) end"""


@query("c3_number_coercion", """select event_id, case event_type when 'view' then value
  when 'error' then floor(value) end as number, case event_type when 'view' then value
  when 'error' then floor(value) else 0.0 end as number_or_zero from events""")
def c3(spark, sf):
    as_text = F.expr(_TEXT_NUMBER.replace("varchar", "string"))
    return C.table(spark, sf, "events").select(
        "event_id", X.to_number(as_text).alias("number"), X.to_number_or_zero(as_text).alias("number_or_zero"))


@query("c4_physiological_filter", f"""with {Q.SAMPLES} select event_id, value from samples
  where metric = 'heart_rate' and value between 30 and 220""")
def c4(spark, sf):
    heart = C.samples(spark, sf).where(F.col("metric") == HEART_RATE)
    return X.physiological(heart).select("event_id", "value")


@query("c5_day_floor", "select event_id, cast(ts as date) as ds from events")
def c5(spark, sf):
    return C.samples(spark, sf).select("event_id", X.day(F.col("ts")).alias("ds"))


@query("c6_date_range", """select cast(o_orderdate as date) as ds, count(*) as n from orders
  where o_orderdate >= '1996-03-01' and o_orderdate < '1997-02-16' group by 1""")
def c6(spark, sf):
    orders = X.time_range(C.table(spark, sf, "orders"), "1996-03-01", "1997-02-15", "o_orderdate")
    return orders.groupBy(F.to_date("o_orderdate").alias("ds")).agg(F.count(F.lit(1)).alias("n"))


@query("c7_recent_days", f"""with {Q.DAILY}, m as (select user_id, metric, max(ds) as last from daily group by all)
  select user_id, metric, ds, {sr('y', 3)} as y from daily join m using (user_id, metric) where ds >= last - 119""")
def c7(spark, sf):
    return rounded(X.recent_days(C.daily(spark, sf)), "y", n=3)


@query("c8_weekday_and_week", f"""with {Q.DAILY} select metric, dayname(ds) as weekday,
  cast(date_trunc('week', ds) as date) as week, count(*) as n from daily group by all""")
def c8(spark, sf):
    days = C.daily(spark, sf).select("metric", X.weekday_name(F.col("ds")).alias("weekday"),
                                     X.week_start(F.col("ds")).alias("week"))
    return days.groupBy("metric", "weekday", "week").agg(F.count(F.lit(1)).alias("n"))


@query("c9_hours_if_minutes", f"""with {Q.DAILY} select user_id, ds, {sr('''case when
  top > 24 then y / 60.0 else y end''')} as hours from daily join (select user_id, max(m) as top from (select user_id,
  dayofweek(ds) as wd, avg(y) as m from daily where metric = 'sleep' group by all) group by 1) using (user_id) where metric = 'sleep'""")
def c9(spark, sf):
    from pyspark.sql import Window

    slept = C.daily(spark, sf).where(F.col("metric") == "sleep")
    weekday = F.avg("y").over(Window.partitionBy("user_id", F.dayofweek("ds")))
    largest = F.max("_mean").over(Window.partitionBy("user_id"))
    hours = slept.withColumn("_mean", weekday).withColumn("_top", largest).select(
        "user_id", "ds", X.hours_if_minutes(F.col("y"), F.col("_top")).alias("hours"))
    return rounded(hours, "hours")


def _ascii_sql() -> str:
    out = "t"
    for symbol, word in text.SYMBOLS:
        out = "replace({}, '{}', '{}')".format(out, symbol, word.replace("'", "''"))
    return out


@query("c10_ascii_text", f"""with d as (select doc_id, text || ' ⚠️ 2σ ± 3° → ≥ 5 ⚠ é €' as t from documents
   union all select -1 - page_id, html from pages)
  select doc_id, regexp_replace({_ascii_sql()}, '[^\\x00-\\x7F]', '', 'g') as ascii from d""")
def c10(spark, sf):
    docs = C.table(spark, sf, "documents").select(
        "doc_id", F.concat("text", F.lit(" ⚠️ 2σ ± 3° → ≥ 5 ⚠ é €")).alias("t"))
    pages = C.table(spark, sf, "pages").select((-1 - F.col("page_id")).alias("doc_id"), F.col("html").alias("t"))
    return docs.unionByName(pages).select("doc_id", text.to_ascii(F.col("t")).alias("ascii"))


@query("c11_display_formats", """select event_id, printf('%.1f', value / 600 * 100 + 1e-9) || '%' as score,
  printf('%.2f', value + 1e-9) as two, format('{:,}', cast(floor(value * 100 + 0.5 + 1e-9) as bigint)) as grouped
  from events""")
def c11(spark, sf):
    v = F.col("value")
    return C.table(spark, sf, "events").select(
        "event_id", X.percent_label(v / 600).alias("score"), X.fixed(v, 2).alias("two"),
        X.thousands(v * 100).alias("grouped"))


@query("c12_label_ladders", f"""with {Q.DAILY}, s as ({Q.STATS})
  select user_id, metric, case when mean > 100 then 'Elevated' when mean >= 60 then 'Normal' else 'Low' end as heart,
    mean > 120 or mean < 40 as emergency,
    case when mean < 5000 then 'Sedentary' when mean < 7500 then 'Low Active' when mean < 10000 then 'Somewhat Active'
         when mean < 12500 then 'Active' else 'Very Active' end as activity,
    case when mean < 6 then 'Poor' when mean < 7 then 'Good' when mean <= 9 then 'Excellent' else 'Too Much' end as sleep,
    std < mean * 0.15 as stable15, std < mean * 0.25 as stable25,
    {sr('100 - std / greatest(mean, 1) * 100', 4)} as consistency from s""")
def c12(spark, sf):
    s = stats.summary(C.daily(spark, sf))
    mean, std = F.col("mean"), F.col("std")
    return s.select(*KEYS, L.heart_status(mean).alias("heart"), L.heart_emergency(mean).alias("emergency"),
                    L.activity_level(mean).alias("activity"), L.sleep_quality(mean).alias("sleep"),
                    L.is_stable(std, mean, 0.15).alias("stable15"), L.is_stable(std, mean, 0.25).alias("stable25"),
                    r(L.consistency_score(std, mean), 4).alias("consistency"))


@query("c13_sleep_hours", f"""with {Q.SAMPLES} select event_id, {sr('value / 60.0')} as hours,
  value / 60.0 < 3 as below_minimum, value / 60.0 > 12 as above_maximum, value / 60.0 >= 7 as recommended
  from samples where metric = 'sleep'""")
def c13(spark, sf):
    hours = F.col("value") / 60.0
    slept = C.samples(spark, sf).where(F.col("metric") == "sleep")
    return slept.select("event_id", r(hours).alias("hours"), (hours < 3).alias("below_minimum"),
                        (hours > 12).alias("above_maximum"), (hours >= 7).alias("recommended"))


# --- timelines ----------------------------------------------------------------------------------

@query("d1_timeline_alignment", f"""with {Q.GRID}, hr as ({Q.interpolated("(select * from grid where metric = 'heart_rate')", 5, 'user_id')}),
  st as (select ts, coalesce(value, 0) as value from grid where metric = 'steps'),
  iv as (select ts as start_ts, make_timestamp(epoch_us(ts) + cast(round(value * 60000000) as bigint)) as end_ts
         from pooled where metric = 'sleep'),
  sl as (select ts, sum(v) as value from (select unnest(generate_series(date_trunc('minute', start_ts),
           greatest(date_trunc('minute', start_ts), end_ts - interval 1 microsecond), interval 1 minute)) as ts,
           1.0 / 60.0 as v from iv) group by ts),
  wide as (select -2::bigint as user_id, ts, max(h) as heart_rate, coalesce(max(s), 0) as steps, coalesce(max(z), 0) as sleep_hours
    from (select ts, value as h, null as s, null as z from hr union all select ts, null, value, null from st
          union all select ts, null, null, value from sl) group by ts)
  select user_id, ts, {sr('heart_rate')} as heart_rate, {sr('steps')} as steps, {sr('sleep_hours')} as sleep_hours
  from ({Q.interpolated('wide', 5, 'user_id', 'heart_rate')})""")
def d1(spark, sf):
    return plain_time(rounded(C.wide_minutes(spark, sf), "heart_rate", "steps", "sleep_hours"), "ts")


@query("d8_dense_week", f"""with {Q.DAILY}, k as (select distinct user_id, metric from daily),
  g as (select user_id, metric, cast(unnest(generate_series(date '{AS_OF}' - interval 6 day, date '{AS_OF}',
        interval 1 day)) as date) as ds from k)
  select user_id, metric, ds, {sr('coalesce(y, 0)', 3)} as y from g left join daily using (user_id, metric, ds)""")
def d8(spark, sf):
    return rounded(D.dense_week(C.daily(spark, sf), AS_OF), "y", n=3)


@query("d9_chronological_split", f"""with {Q.SAMPLES}, n as (select *,
   row_number() over (partition by user_id, metric order by ts, event_id) as rn,
   count(*) over (partition by user_id, metric) as c from samples)
  select event_id, user_id, metric, case when rn > c - floor(c * 0.2) then 'test' else 'train' end as split from n""")
def d9(spark, sf):
    split = TL.chronological_split(C.samples(spark, sf), order=["ts", "event_id"])
    return split.select("event_id", *KEYS, "split")


@query("d10_fixed_windows", f"""with {Q.WINDOW_DAILY}, n as (select *,
   row_number() over (partition by user_id, metric order by ds) - 1 as i,
   count(*) over (partition by user_id, metric) as c from window_daily)
  select user_id, metric, i // 30 as win, i % 30 as t, ds, {sr('y', 3)} as value from n where i // 30 < c // 30""")
def d10(spark, sf):
    return rounded(FT.windows(C.window_daily(spark, sf)).withColumn("t", F.col("t").cast("long")), "value", n=3)


@query("d11_sleep_to_minutes", f"""with {Q.INTERVALS} select user_id, ts, count(*) as n,
  {sr('sum(value)')} as hours from asleep group by all""")
def d11(spark, sf):
    minutes = TL.sleep_minutes(C.intervals(spark, sf))
    return plain_time(minutes.groupBy("user_id", "ts").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("value")).alias("hours")), "ts")


@query("d12_holiday_calendar", f"""with {Q.DAILY}, s as (select user_id, metric, min(ds) as d0 from daily group by all)
  select user_id, metric, holiday, d0 + cast(d - 1 as int) as ds from s,
   (select 'vacation' as holiday, unnest(range(30, 38)) as d union all select 'sick', unnest([60, 61, 62])
    union all select 'marathon', 90)""")
def d12(spark, sf):
    return D.holiday_calendar(C.daily(spark, sf))


@query("d13_last_of_day", f"""with {Q.SAMPLES}, n as (select *, row_number() over (
   partition by user_id, metric, cast(ts as date) order by ts desc, event_id desc) as rn from samples)
  select user_id, metric, cast(ts as date) as ds, {sr('value')} as y from n where rn = 1""")
def d13(spark, sf):
    return rounded(D.last_of_day(C.samples(spark, sf)), "y")


@query("e1_minute_mean", f"""with {Q.GRID} select user_id, metric, ts, {sr('value')} as value from grid
  where metric = 'heart_rate'""")
def e1(spark, sf):
    heart = C.pooled_samples(spark, sf).where(F.col("metric") == HEART_RATE)
    return plain_time(rounded(TL.dense_minutes(TL.minute_mean(heart)), "value"), "ts")


@query("e2_minute_sum", f"""with {Q.GRID} select user_id, metric, ts, {sr('coalesce(value, 0)')} as value from grid
  where metric <> 'heart_rate'""")
def e2(spark, sf):
    rest = C.pooled_samples(spark, sf).where(F.col("metric") != HEART_RATE)
    return plain_time(rounded(TL.dense_minutes(TL.minute_sum(rest), fill=0.0), "value"), "ts")


@query("e3_sleep_per_minute", f"""with {Q.INTERVALS} select ts, {sr('sum(value)')} as value from asleep group by ts""")
def e3(spark, sf):
    per_minute = TL.sleep_per_minute(TL.sleep_minutes(C.intervals(spark, sf)), keys=())
    return plain_time(rounded(per_minute, "value"), "ts")


@query("e4_daily_aggregate", f"""with {Q.SAMPLES} select user_id, metric, cast(ts as date) as ds,
  {sr("case when metric = 'heart_rate' then avg(value) else sum(value) end")} as y
  from samples where value is not null group by 1, 2, 3""")
def e4(spark, sf):
    return rounded(C.user_daily(spark, sf), "y")


@query("e5_summary_statistics", f"""with {Q.DAILY} select user_id, metric, n, {sr('mean', 3)} as mean,
  {sr('median', 3)} as median, {sr('std', 3)} as std, {sr('min', 3)} as min, {sr('max', 3)} as max,
  {sr('range', 3)} as range from ({Q.STATS})""")
def e5(spark, sf):
    return rounded(stats.summary(C.daily(spark, sf)), "mean", "median", "std", "min", "max", "range", n=3)


_HANDCRAFTED = """select {k}, avg(y) as mean, stddev_samp(y) as std, quantile_cont(y, 0.5) as median, min(y) as min,
   max(y) as max, case when count(*) >= 3 then case when stddev_pop(y) = 0 then 0.0 else skewness(y) end end as skew,
   case when count(*) >= 4 then case when stddev_pop(y) = 0 then 0.0 else kurtosis(y) end end as kurtosis,
   quantile_cont(y, 0.25) as pct_25, quantile_cont(y, 0.75) as pct_75,
   count(*) filter (where step > 1.5 * sd) as num_peaks
  from (select *, abs(y - lag(y) over (partition by {k} order by ds)) as step,
               stddev_samp(y) over (partition by {k}) as sd from {t}) group by all"""


@query("e6_handcrafted_features", f"""with {Q.DAILY} select user_id, metric,
  {", ".join(f"{sr(c, 3)} as {c}" for c in FT.HANDCRAFTED if c != "num_peaks")}, num_peaks
  from ({_HANDCRAFTED.format(k="user_id, metric", t="daily")})""")
def e6(spark, sf):
    cols = [c for c in FT.HANDCRAFTED if c != "num_peaks"]
    return rounded(FT.handcrafted(C.daily(spark, sf)), *cols, n=3)


@query("e13_quantile_lines", f"""with {Q.DAILY} select user_id, metric, {sr('quantile_cont(y, 0.1)', 3)} as q10,
  {sr('quantile_cont(y, 0.9)', 3)} as q90 from daily group by all""")
def e13(spark, sf):
    return rounded(stats.quantile_lines(C.daily(spark, sf)), "q10", "q90", n=3)


@query("e14_histogram", f"""with {Q.DAILY}, b as (select user_id, metric, y, min(y) over w as lo, max(y) over w as hi
   from daily window w as (partition by user_id, metric))
  select user_id, metric, cast(least(floor(case when hi > lo then (y - lo) / (hi - lo) else 0 end * 30) + 1, 30) as bigint)
  as bin, count(*) as n from b group by all""")
def e14(spark, sf):
    return stats.histogram(C.daily(spark, sf))


@query("e15_weekday_pattern", f"""with {Q.DAILY}, w as (select user_id, metric, dayname(ds) as weekday, avg(y) as m
   from daily where metric = 'sleep' group by all),
  x as (select *, row_number() over (partition by user_id order by m desc, weekday) as a,
          row_number() over (partition by user_id order by m, weekday) as b,
          max(m) over (partition by user_id) as hi, min(m) over (partition by user_id) as lo from w)
  select user_id, metric, max(weekday) filter (where a = 1) as max_weekday,
    max(weekday) filter (where b = 1) as min_weekday,
    {sr('max(case when hi > 24 then hi / 60 else hi end)')} as max_hours,
    {sr('max(case when hi > 24 then lo / 60 else lo end)')} as min_hours from x group by all""")
def e15(spark, sf):
    slept = C.daily(spark, sf).where(F.col("metric") == "sleep")
    return rounded(stats.weekday_pattern(slept), "max_hours", "min_hours")


@query("e16_recent_extremes", f"""with {Q.DAILY}, k as ({Q.RANKED}),
  x as (select *, row_number() over (partition by user_id, metric order by y desc, ds) as a,
          row_number() over (partition by user_id, metric order by y, ds) as b from k where back <= 7)
  select user_id, metric, max(ds) filter (where a = 1) as max_ds, {sr('max(y)', 3)} as max_y,
    max(ds) filter (where b = 1) as min_ds, {sr('min(y)', 3)} as min_y, count(*) as days from x group by all""")
def e16(spark, sf):
    return rounded(stats.recent_extremes(C.daily(spark, sf)), "max_y", "min_y", n=3)


@query("e17_recent_trend", f"""with {Q.DAILY}, k as ({Q.RANKED}), t as (select user_id, metric, count(*) as n,
   case when count(*) >= 14 then avg(y) filter (where back <= 7) - avg(y) filter (where back between 8 and 14)
        else 0.0 end as d from k group by all)
  select user_id, metric, n, {sr('d', 3)} as recent_trend, case when d > 0 then 'Increasing' else 'Decreasing' end as label
  from t""")
def e17(spark, sf):
    trend = stats.recent_trend(C.daily(spark, sf))
    return rounded(trend.withColumn("label", L.trend_label(F.col("recent_trend"))), "recent_trend", n=3)


_STATUS = """select user_id, ds, hr, steps, sleep,
  case when hr is null or steps is null then 'Syncing Data'
       when coalesce(sleep < 5.5, false) or hr > 95 then 'Needs Rest' when steps < 3000 then 'Low Activity'
       when steps >= 10000 and coalesce(sleep between 7 and 9, false) and hr between 55 and 85 then 'Great Balance'
       else 'On Track' end as status,
  case when hr is null or steps is null then 'neutral' when coalesce(sleep < 5.5, false) or hr > 95 then 'tired'
       when steps < 3000 then 'sleepy'
       when steps >= 10000 and coalesce(sleep between 7 and 9, false) and hr between 55 and 85 then 'happy'
       else 'calm' end as mood
  from (select user_id, ds, max(y) filter (where metric = 'heart_rate') as hr,
          max(y * {scale}) filter (where metric = 'steps') as steps, max(y / 60) filter (where metric = 'sleep') as sleep
        from daily group by all)"""


def _body_daily(spark, sf):
    """Sleep minutes as hours, clicks scaled to plausible step counts, so that every rung is reached."""
    y = (F.when(F.col("metric") == "sleep", F.col("y") / 60).when(F.col("metric") == STEPS, F.col("y") * 40)
         .otherwise(F.col("y")))
    return C.daily(spark, sf).withColumn("y", y)


@query("e21_daily_health_status", f"""with {Q.DAILY} select user_id, ds, {sr('hr')} as hr, {sr('steps', 3)} as steps,
  {sr('sleep')} as sleep, status, mood from ({_STATUS.format(scale=40)})""")
def e21(spark, sf):
    days = D.status_per_day(_body_daily(spark, sf))
    return rounded(rounded(days, "hr", "sleep"), "steps", n=3)


@query("e21_latest_health_status", f"""with {Q.DAILY}, s as ({_STATUS.format(scale=40)}) select user_id, ds,
  case when status = 'Syncing Data' then 'Status Unknown' else status end as status, mood
  from s qualify row_number() over (partition by user_id order by ds desc) = 1""")
def e21_latest(spark, sf):
    return D.latest_status(_body_daily(spark, sf), missing="Status Unknown")


@query("e22_value_on_day", f"""with {Q.DAILY} select user_id, metric,
  {sr(f"max(y) filter (where ds = date '{AS_OF}')", 3)} as y from daily group by all""")
def e22(spark, sf):
    return rounded(D.value_on(C.daily(spark, sf), AS_OF), "y", n=3)


@query("e24_distinct_windows", f"""with {Q.WINDOW_DAILY}, n as (select user_id, metric, count(*) as c
   from window_daily group by all) select user_id, cast(sum(c // 30) as bigint) as windows from n where c >= 30 group by 1""")
def e24(spark, sf):
    wins = FT.windows(C.window_daily(spark, sf))
    return wins.groupBy("user_id").agg(F.countDistinct("metric", "win").alias("windows"))


# --- windows ------------------------------------------------------------------------------------

@query("f1_time_interpolation", f"""with {Q.GRID} select user_id, metric, ts, {sr('value')} as value from
  ({Q.interpolated("(select * from grid where metric = 'heart_rate')", 5, 'user_id, metric')})""")
def f1(spark, sf):
    heart = C.pooled_samples(spark, sf).where(F.col("metric") == HEART_RATE)
    return plain_time(rounded(TL.interpolate(TL.dense_minutes(TL.minute_mean(heart), around=True)), "value"), "ts")


@query("f2_first_difference", f"""with {Q.DAILY} select user_id, metric, ds,
  {sr('coalesce(y - lag(y) over w, 0)', 3)} as change, {sr('abs(coalesce(y - lag(y) over w, 0))', 3)} as abs_change
  from daily window w as (partition by user_id, metric order by ds)""")
def f2(spark, sf):
    d = sigma.differences(C.daily(spark, sf)).select(*KEYS, "ds", "change", "abs_change")
    return rounded(d, "change", "abs_change", n=3)


_GAPS = """gaps as (select user_id, metric, epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id, metric order by ts)) as gap
  from minutes),
periods as (select user_id, metric, gap as period_us from (select user_id, metric, gap, count(*) as c from gaps
  where gap is not null group by all) qualify row_number() over (partition by user_id, metric order by c desc, gap) = 1)"""

SHORT_RULES = tuple(Rule(m, m, 15.0, 60.0, 3, "") for m in ("heart_rate", "steps", "sleep", "signup", "error"))


def threshold_sql(rules, source: str = "minutes") -> str:
    """Gaps-and-islands twin of the threshold detector, as CTEs ending in ``flagged``."""
    values = ", ".join(f"('{x.metric}', '{x.value_name}', {float(x.low)}, {float(x.high)}, {x.sustained_minutes})"
                       for x in rules)
    return f"""rules(metric, value_name, low, high, sustained) as (values {values}),
  marked as (select m.*, value_name, low, high, sustained, coalesce(value > high, false) as hi,
      coalesce(value < low, false) as lo, case when sustained > 0 then case when coalesce(period_us, 60000000) <= 0
        then sustained else greatest(1, floor(sustained * 60000000.0 / coalesce(period_us, 60000000))) end else 1 end as need
    from {source} m left join rules using (metric) left join periods using (user_id, metric)),
  isles as (select *, count(*) filter (where not hi) over (partition by user_id, metric order by ts) as hg,
      count(*) filter (where not lo) over (partition by user_id, metric order by ts) as lg from marked),
  runs as (select *, hi and count(*) filter (where hi) over (partition by user_id, metric, hg order by ts) >= need as h,
      lo and count(*) filter (where lo) over (partition by user_id, metric, lg order by ts) >= need as l from isles),
  flagged as (select user_id, metric, ts, value, h or l as threshold_anomaly,
      case when l then 'Low ' || value_name || ' (<' || regexp_replace(low::double::varchar, '[.]0$', '') || ')'
           when h then 'High ' || value_name || ' (>' || regexp_replace(high::double::varchar, '[.]0$', '') || ')' else '' end as anomaly_reason,
      case when l then 'Medium' when h then 'High' else 'Normal' end as severity from runs)"""


@query("f3_sustained_condition", f"""with {Q.MINUTES}, {_GAPS}, {threshold_sql(SHORT_RULES)}
  select user_id, metric, ts, threshold_anomaly, severity from flagged""")
def f3(spark, sf):
    flagged = T.detect(C.observed_minutes(spark, sf), T.rules_table(spark, SHORT_RULES))
    return plain_time(flagged.select(*KEYS, "ts", "threshold_anomaly", "severity"), "ts")


@query("f4_sampling_period", f"""with {Q.MINUTES}, {_GAPS} select user_id, metric, period_us from periods""")
def f4(spark, sf):
    return T.sampling_period(C.observed_minutes(spark, sf))


@query("f5_minutes_to_rows", f"""with {Q.MINUTES}, {_GAPS} select user_id, metric, m as minutes,
  cast(greatest(1, floor(m * 60000000.0 / period_us)) as bigint) as n from periods, (select unnest([0, 1, 5, 10, 90]) as m)""")
def f5(spark, sf):
    periods = T.sampling_period(C.observed_minutes(spark, sf))
    minutes = periods.withColumn("minutes", F.explode(F.array(*[F.lit(m) for m in (0, 1, 5, 10, 90)])))
    return minutes.select(*KEYS, "minutes", T.rows_in(F.col("minutes"), F.col("period_us")).alias("n"))


@query("f6_rolling_band", f"""with {Q.USERS}, b as (select event_id, metric, quantile_cont(value, 0.5) over (w rows between 14
   preceding and current row) as p, coalesce(stddev_samp(value) over (w rows between 29 preceding and current row), 0) as s
   from pooled where value is not null window w as (partition by user_id, metric order by ts, event_id))
  select event_id, metric, {sr('p', 4)} as predicted, {sr('p - 2 * s', 4)} as yhat_lower, {sr('p + 2 * s', 4)} as yhat_upper from b""")
def f6(spark, sf):
    band = R.rolling_forecast(C.samples(spark, sf), order=("ts", "event_id"), block_rows=500)
    return rounded(band.select("event_id", "metric", "predicted", "yhat_lower", "yhat_upper"),
                   "predicted", "yhat_lower", "yhat_upper", n=4)


@query("f8_row_fraction", f"""with {Q.DAILY}, k as ({Q.RANKED}) select user_id, metric, ds,
  {sr('(fwd - 1) / n')} as p from k""")
def f8(spark, sf):
    from vitalgrid.operators import cluster

    points = cluster.plane(sigma.moments(C.daily(spark, sf)))
    return rounded(points.select(*KEYS, "ds", "p"), "p")


@query("f9_latest_rows", f"""with {Q.DAILY}, k as ({Q.RANKED}) select user_id, metric, ds, {sr('y', 3)} as y from k
  where back <= 60""")
def f9(spark, sf):
    return rounded(S.latest_rows(C.daily(spark, sf), 60), "y", n=3)


@query("f10_first_last_trend", f"""with {Q.DAILY}, k as ({Q.RANKED}), m as (select user_id, metric, count(*) as n,
   avg(y) filter (where fwd <= 14) as first_avg, avg(y) filter (where back <= 14) as last_avg from k group by all)
  select user_id, metric, n, {sr('first_avg', 3)} as first_avg, {sr('last_avg', 3)} as last_avg,
   case when n < 28 then 'no clear trend (insufficient data)' when last_avg > first_avg then 'increasing'
        else 'decreasing' end as trend_dir from m""")
def f10(spark, sf):
    return rounded(stats.first_last_trend(C.daily(spark, sf), "y"), "first_avg", "last_avg", n=3)


# --- minutes of every user, compared by user and day --------------------------------------------

def per_day(minutes, *names):
    """Minutes, missing values, sum, first and last known value of each user, metric and day."""
    def of(c):
        known = F.when(F.col(c).isNotNull(), F.col("ts"))
        return [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"), r(F.sum(c), 4).alias(f"{c}_sum"),
                r(F.min_by(c, known), 4).alias(f"{c}_first"), r(F.max_by(c, known), 4).alias(f"{c}_last")]

    keys = [k for k in KEYS if k in minutes.columns]
    day = F.col(S.CHUNK) if S.CHUNK in minutes.columns else F.to_date("ts")
    days = minutes.groupBy(*keys, day.alias("ds")).agg(F.count(F.lit(1)).alias("minutes"), *[a for c in names for a in of(c)])
    return days.withColumn("ds", F.col("ds").cast("date"))


def per_day_sql(source: str, keys: str, *names) -> str:
    def of(c: str) -> str:
        return (f"count(*) filter (where {c} is null) as {c}_nulls, {sr(f'sum({c})', 4)} as {c}_sum, {sr(f'arg_min({c}, ts) filter (where {c} is not null)', 4)} as {c}_first, "
                f"{sr(f'arg_max({c}, ts) filter (where {c} is not null)', 4)} as {c}_last")

    return f"select {keys}, cast(ts as date) as ds, count(*) as minutes, {', '.join(map(of, names))} from {source} group by all"


@query("e1_user_minute_mean", f"""with {Q.USER_GRID}, g as (select * from grid where metric = 'heart_rate') {per_day_sql('g', 'user_id, metric', 'value')}""")
def e1_user(spark, sf):
    """The dense mean grid of each user."""
    heart = C.samples(spark, sf).where(F.col("metric") == HEART_RATE)
    return per_day(TL.dense_minutes(TL.minute_mean(heart), tasks=TL.day_tasks(heart)), "value")


@query("e2_user_minute_sum", f"""with {Q.USER_GRID}, g as (select user_id, metric, ts, coalesce(value, 0) as value from grid where metric <> 'heart_rate')
  {per_day_sql('g', 'user_id, metric', 'value')}""")
def e2_user(spark, sf):
    """The dense sum grids of each user."""
    rest = C.samples(spark, sf).where(F.col("metric") != HEART_RATE)
    return per_day(TL.dense_minutes(TL.minute_sum(rest), fill=0.0, tasks=TL.day_tasks(rest)), "value")


@query("e3_user_sleep", f"""with {Q.INTERVALS}, z as (select user_id, ts, sum(value) as value from asleep group by 1, 2) {per_day_sql('z', 'user_id', 'value')}""")
def e3_user(spark, sf):
    """Sleep per minute of each user."""
    return per_day(TL.sleep_per_minute(TL.sleep_minutes(C.intervals(spark, sf))), "value")


@query("f1_user_interpolation", f"""with {Q.USER_GRID}, f as ({Q.interpolated("(select * from grid where metric = 'heart_rate')", 10, 'user_id, metric')})
  {per_day_sql('f', 'user_id, metric', 'value')}""")
def f1_user(spark, sf):
    """Gaps of each user filled up to ten minutes."""
    heart = C.samples(spark, sf).where(F.col("metric") == HEART_RATE)
    return per_day(TL.interpolate(TL.dense_minutes(TL.minute_mean(heart), around=True, tasks=TL.day_tasks(heart)), limit=10), "value")


@query("d1_user_timelines", f"""with {Q.USER_GRID}, hr as ({Q.interpolated("(select * from grid where metric = 'heart_rate')", 5, 'user_id')}),
  iv as (select user_id, ts as start_ts, make_timestamp(epoch_us(ts) + cast(round(value * 60000000) as bigint)) as end_ts from pooled where metric = 'sleep'),
  sl as (select user_id, ts, sum(v) as value from (select user_id, unnest(generate_series(date_trunc('minute', start_ts),
      greatest(date_trunc('minute', start_ts), end_ts - interval 1 microsecond), interval 1 minute)) as ts, 1.0 / 60.0 as v from iv) group by 1, 2),
  wide as (select user_id, ts, max(h) as heart_rate, coalesce(max(s), 0) as steps, coalesce(max(z), 0) as sleep_hours
    from (select user_id, ts, value as h, null as s, null as z from hr union all
      select user_id, ts, null, coalesce(value, 0), null from grid where metric = 'steps' union all select user_id, ts, null, null, value from sl) group by 1, 2),
  f as ({Q.interpolated('wide', 5, 'user_id', 'heart_rate')}) {per_day_sql('f', 'user_id', 'heart_rate', 'steps', 'sleep_hours')}""")
def d1_user(spark, sf):
    """The aligned timeline of each user."""
    return per_day(C.user_wide_minutes(spark, sf), "heart_rate", "steps", "sleep_hours")
