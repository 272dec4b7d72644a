"""Forecasts, tasks and event effects."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from vitalgrid.operators import daily as D, ensemble as E, forecast as FC, trend as TR
from vitalgrid.operators.series import latest_rows
from vitalgrid.plans import canonical as C, sql as Q
from vitalgrid.plans.q_detect import fit_sql, mode_sql, scored_sql
from vitalgrid.plans.registry import query, r, rounded, sr
from vitalgrid.schema import KEYS

COLS = ("trend", "weekly", "yearly", "holiday_effect", "yhat", "yhat_lower", "yhat_upper")
RECENT = """recent as (select user_id, metric, ds, y from daily qualify row_number() over (
  partition by user_id, metric order by ds desc) <= {n})"""
TASK_EVENTS = replace(FC.TASK, weekly=True, events=True)


def future_sql(fit: str, name: str, periods: int, z: float, events: bool = False) -> str:
    """Days after the history of ``fit``, and both together in ``name``."""
    effect = "coalesce(max_e, 0)" if events else "0.0"
    return f"""{name}_p as (select user_id, metric, max(ds) as end_ds, min(start_ds) as start_ds, max(slope) as slope,
      max(intercept) as intercept, coalesce(max(sigma), 0) as sigma from {fit} group by all),
  {name}_w as (select user_id, metric, dow, max(weekly) as wk from {fit} group by all),
  {name}_m as (select user_id, metric, mon, max(yearly) as yr from {fit} group by all),
  {name}_e as (select user_id, metric, event, max(holiday_effect) as max_e from {fit} where event is not null group by all),
  {name}_d as (select *, cast(unnest(generate_series(end_ds + interval 1 day, end_ds + interval {periods} day, interval 1 day)) as date) as ds
    from {name}_p),
  {name}_x as (select *, date_diff('day', start_ds, ds) as t, dayofweek(ds) as dow, month(ds) as mon,
      case when date_diff('day', start_ds, ds) + 1 between 30 and 37 then 'vacation'
           when date_diff('day', start_ds, ds) + 1 between 60 and 62 then 'sick'
           when date_diff('day', start_ds, ds) + 1 = 90 then 'marathon' end as event from {name}_d),
  {name}_y as (select user_id, metric, ds, intercept + slope * t as trend, coalesce(wk, 0) as weekly, coalesce(yr, 0) as yearly,
      {effect} as holiday_effect, sigma from {name}_x left join {name}_w using (user_id, metric, dow)
      left join {name}_m using (user_id, metric, mon) left join {name}_e using (user_id, metric, event)),
  {name} as (select user_id, metric, ds, trend, weekly, yearly, holiday_effect, yhat, yhat - {z} * sigma as yhat_lower,
      yhat + {z} * sigma as yhat_upper from (
      select user_id, metric, ds, trend, weekly, yearly, holiday_effect, yhat, coalesce(sigma, 0) as sigma from {fit} union all
      select user_id, metric, ds, trend, weekly, yearly, holiday_effect, trend + weekly + yearly + holiday_effect, sigma from {name}_y))"""


def _all(n: int = 2) -> str:
    return "user_id, metric, ds, " + ", ".join(f"{sr(c, n)} as {c}" for c in COLS)


@query("i1_additive_forecast", f"""with {Q.DAILY}, {fit_sql('daily', 'fit', FC.Z95)}, {future_sql('fit', 'fc', 14, FC.Z95)}
  select {_all()} from fc""")
def i1(spark, sf):
    return rounded(FC.forecast(C.daily(spark, sf), FC.DETECTION, 14), *COLS, n=2)


@query("i1_additive_forecast_long", f"""with {Q.DAILY}, long_daily as (select * from daily where user_id = -1 union all
   select -3::bigint, l_returnflag, cast(l_shipdate as date), sum(l_quantity) from lineitem group by 2, 3),
  {fit_sql('long_daily', 'fit', FC.Z95, yearly='true')}, {future_sql('fit', 'fc', 30, FC.Z95)} select {_all()} from fc""")
def i1_long(spark, sf):
    return rounded(FC.forecast(C.long_daily(spark, sf), FC.ANALYSIS, 30), *COLS, n=2)


@query("i1_events_forecast", f"""with {Q.DAILY}, {RECENT.format(n=120)}, {fit_sql('recent', 'fit', FC.Z80, yearly='false', events=True)},
  {future_sql('fit', 'fc', 30, FC.Z80, events=True)} select {_all()} from fc""")
def i1_events(spark, sf):
    return rounded(FC.forecast(latest_rows(C.daily(spark, sf), 120), TASK_EVENTS, 30), *COLS, n=2)


def bend_sql(source: str, name: str, knots: int = TR.KNOTS) -> str:
    """Twin of the sparse trend with every product summed by itself: CTEs ending in ``name`` (span, scale, level, slope, bends)."""
    w, js = "partition by user_id, metric", range(1, knots + 1)
    at = {j: f"({TR.KNOT_RANGE} * {j} / {knots})" for j in js}
    h = {j: f"greatest(u - {at[j]}, 0)" for j in js}
    sums = [f"sum({h[j]}) as p{j}, sum({h[j]} * u) as q{j}, sum({h[j]} * v) as c{j}" for j in js]
    sums += [f"sum({h[j]} * {h[k]}) as g{j}_{k}" for j in js for k in js if j <= k]
    cell = lambda j, k: f"g{min(j, k)}_{max(j, k)} - a{j} * p{k} - b{j} * q{k}"
    moves, zeros = 2 * knots - 1, "[" + ", ".join("0.0" for _ in js) + "]::double[]"
    return f"""{name}_u as (select *, case when span > 0 then t / span else 0 end as u, y / scale as v from (select *, max(t) over ({w}) as span,
      coalesce(nullif(max(abs(y)) over ({w}), 0), 1) as scale from (select *, cast(date_diff('day', min(ds) over ({w}), ds) as double) as t from {source} where y is not null))),
  {name}_l as (select *, v - lag(v) over ({w} order by ds) as step from {name}_u),
  {name}_s as (select user_id, metric, max(span) as span, max(scale) as scale, count(*) as n, sum(u) as su, sum(u * u) as suu, sum(v) as sv, sum(u * v) as suv,
      coalesce(sum(step * step), 0) / greatest(2 * count(step), 1) as noise, {", ".join(sums)} from {name}_l group by 1, 2),
  {name}_d as (select *, case when n * suu - su * su > 1e-12 * n * suu then n * suu - su * su end as det from {name}_s),
  {name}_a as (select *, (suu * sv - su * suv) / det as ay, (n * suv - su * sv) / det as by_,
      {", ".join(f"(suu * p{j} - su * q{j}) / det as a{j}, (n * q{j} - su * p{j}) / det as b{j}" for j in js)} from {name}_d),
  {name}_g as materialized (select *, [{", ".join("[" + ", ".join(cell(j, k) for k in js) + "]" for j in js)}]::double[][] as g,
      [{", ".join(f"c{j} - a{j} * sv - b{j} * suv" for j in js)}]::double[] as c, noise / {TR.PRIOR} as lambda_ from {name}_a),
  {name}_r(user_id, metric, i, b, r) as (select user_id, metric, 0, {zeros}, c from {name}_g where det is not null union all
    select user_id, metric, i + 1, list_transform(b, lambda x, m: case when m = j then x + t when m = k then x - t else x end),
      list_transform(r, lambda x, m: x - t * (gj[m] - case when k = j then 0 else gk[m] end)) from (
      select *, case when a <= least_ then 0.0 when (grad + pen) / a < low then (grad + pen) / a when grad / a < low then low when grad / a <= high then grad / a
          when (grad - pen) / a <= high then high else (grad - pen) / a end as t from (
        select *, least(-b[j], other) as low, greatest(-b[j], other) as high from (
          select *, gj[j] - case when k = j then 0 else 2 * gj[k] - gk[k] end as a, r[j] - case when k = j then 0 else r[k] end as grad,
            case when k = j then -b[j] else b[k] end as other, case when k = j then lambda_ else 2 * lambda_ end as pen from (
            select s.user_id, s.metric, i, b, r, lambda_, {TR.NOTHING} * n as least_, case when i % {moves} < {knots} then i % {moves} + 1 else i % {moves} - {knots} + 1 end as j,
              case when i % {moves} < {knots} then i % {moves} + 1 else i % {moves} - {knots} + 2 end as k, g[j] as gj, g[k] as gk
            from {name}_r s join {name}_g x on s.user_id = x.user_id and s.metric = x.metric where i < {moves * TR.SWEEPS}))))),
  {name} as (select x.user_id, x.metric, span, scale, coalesce(b, {zeros}) as bends,
      case when det is null then sv / n else ay {"".join(f" - b[{j}] * a{j}" for j in js)} end as level,
      case when det is null then 0 else by_ {"".join(f" - b[{j}] * b{j}" for j in js)} end as slope
    from {name}_g x left join {name}_r r on x.user_id = r.user_id and x.metric = r.metric and i = {moves * TR.SWEEPS})"""


def bent_at_sql(t: str, knots: int = TR.KNOTS) -> str:
    u = f"(case when span > 0 then {t} / span else 0 end)"
    return f"scale * (level + slope * {u}" + "".join(f" + bends[{j}] * greatest({u} - {TR.KNOT_RANGE} * {j} / {knots}, 0)" for j in range(1, knots + 1)) + ")"


def bent_forecast_sql(periods: int, z: float) -> str:
    """The additive model around the sparse trend ``bt``: the straight fit of what the trend leaves, without its own line."""
    fit = fit_sql("daily", "fit", z)
    fit = fit.replace("f.*, slope, intercept, intercept + slope * t as trend,", f"f.*, b.* exclude (user_id, metric), {bent_at_sql('t')} as trend,")
    fit = fit.replace("join fit_c using (user_id, metric)", "join bt b using (user_id, metric)")
    return f"""{fit},
  ends as (select user_id, metric, max(ds) as end_ds, min(start_ds) as start_ds, coalesce(max(sigma), 0) as sigma from fit group by all),
  ahead as (select *, cast(unnest(generate_series(end_ds + interval 1 day, end_ds + interval {periods} day, interval 1 day)) as date) as ds from ends),
  wk as (select user_id, metric, dow, max(weekly) as weekly from fit group by all), mo as (select user_id, metric, mon, max(yearly) as yearly from fit group by all),
  later as (select a.user_id, a.metric, a.ds, {bent_at_sql("date_diff('day', start_ds, a.ds)")} as trend, coalesce(weekly, 0) as weekly, coalesce(yearly, 0) as yearly,
      sqrt(sigma * sigma + pow(scale * list_sum(list_transform(bends, lambda x: abs(x))) / {TR.KNOTS}, 2) * 2 * {TR.KNOTS}
        * pow(case when span > 0 then date_diff('day', end_ds, a.ds) / span else 0 end, 3) / 3) as sigma
    from ahead a join bt using (user_id, metric) left join wk on a.user_id = wk.user_id and a.metric = wk.metric and dow = dayofweek(a.ds)
    left join mo on a.user_id = mo.user_id and a.metric = mo.metric and mon = month(a.ds)),
  fc as (select *, yhat - {z} * sigma as yhat_lower, yhat + {z} * sigma as yhat_upper from (
    select user_id, metric, ds, trend, weekly, yearly, holiday_effect, yhat, coalesce(sigma, 0) as sigma from fit union all
    select user_id, metric, ds, trend, weekly, yearly, 0.0, trend + weekly + yearly, sigma from later))"""


@query("i1_bending_forecast", f"""with recursive {Q.DAILY}, {bend_sql('daily', 'bt')}, {bent_forecast_sql(14, FC.Z95)} select {_all()} from fc""")
def i1_bending(spark, sf):
    """Sparse bends, weekday and month effects, and a band that widens."""
    return rounded(FC.bending_forecast(C.daily(spark, sf), FC.DETECTION, 14), *COLS, n=2)


@query("i1_trend_bends", f"""with recursive {Q.DAILY}, {bend_sql('daily', 'bt')} select user_id, metric, {sr('scale * level', 3)} as level, {sr('scale * slope', 3)} as slope,
  {sr('scale * bends[j]', 3)} as bend, j::bigint as knot from (select *, unnest(generate_series(1, {TR.KNOTS})) as j from bt) where abs(scale * bends[j]) > 1e-4""")
def i1_bends(spark, sf):
    """The places where each series' trend bends, and by how much."""
    bends = TR.sparse_trend(C.daily(spark, sf)).select(*KEYS, "scale", "level", "slope", F.posexplode("bends").alias("j", "b"))
    bent = bends.where(F.abs(F.col("scale") * F.col("b")) > 1e-4)
    return bent.select(*KEYS, *[r(F.col("scale") * F.col(c), 3).alias(name) for c, name in (("level", "level"), ("slope", "slope"), ("b", "bend"))],
                       (F.col("j") + 1).cast("long").alias("knot"))


@query("i2_forecast_horizon", f"""with {Q.DAILY}, e as (select user_id, metric, max(ds) as end_ds from daily group by all)
  select user_id, metric, ds, false as is_future from daily union all select user_id, metric,
   cast(unnest(generate_series(end_ds + interval 1 day, end_ds + interval 7 day, interval 1 day)) as date), true from e""")
def i2(spark, sf):
    return FC.horizon(C.daily(spark, sf), 7)


@query("i3_components", f"""with {Q.DAILY}, {fit_sql('daily', 'fit', FC.Z80)} select user_id, metric, ds,
  {sr('trend', 2)} as trend, {sr('weekly', 2)} as weekly, {sr('yearly', 2)} as yearly from fit""")
def i3(spark, sf):
    parts = FC.components(C.daily(spark, sf)).select(*KEYS, "ds", "trend", "weekly", "yearly")
    return rounded(parts, "trend", "weekly", "yearly", n=2)


@query("i4_heart_rate_task", f"""with {Q.DAILY}, {RECENT.format(n=60)}, {fit_sql('recent', 'fit', FC.Z80, weekly=False, yearly='false')},
  {future_sql('fit', 'fc', 14, FC.Z80)}, s as (select user_id, metric, min(ds) + 66 as day67 from fc group by all),
  e as (select user_id, metric, case when count(*) >= 7 then avg(abs(yhat - y)) end as mae from (select *, row_number() over (
    partition by user_id, metric order by ds desc) as b from fit) where b <= 7 group by all)
  select user_id, metric, day67, {sr('max(yhat) filter (where ds = day67)', 3)} as day67_yhat, {sr('max(mae)', 3)} as mae
  from fc join s using (user_id, metric) join e using (user_id, metric) group by all""")
def i4(spark, sf):
    return rounded(FC.heart_rate_task(C.daily(spark, sf)), "day67_yhat", "mae", n=3)


@query("i5_sleep_task", f"""with {Q.DAILY}, {RECENT.format(n=90)}, {fit_sql('recent', 'fit', FC.Z80, yearly='false')},
  {future_sql('fit', 'fc', 7, FC.Z80)}, w as (select user_id, metric, dayname(ds) as weekday, round(avg(weekly), 9) as m from fc group by all),
  b as (select user_id, metric, first(weekday order by m desc, weekday) as best_day, first(weekday order by m, weekday) as worst_day
    from w group by all),
  k as (select *, row_number() over (partition by user_id, metric order by ds) as fwd,
     row_number() over (partition by user_id, metric order by ds desc) as back from fc)
  select user_id, metric, best_day, worst_day, case when count(*) < 28 then 'no clear trend (insufficient data)'
    when avg(trend) filter (where back <= 14) > avg(trend) filter (where fwd <= 14) then 'increasing' else 'decreasing' end as trend_dir
  from k join b using (user_id, metric) group by all""")
def i5(spark, sf):
    return FC.sleep_task(C.daily(spark, sf))


TASK3 = f"""{RECENT.format(n=120)}, {fit_sql('recent', 'fa', FC.Z80, yearly='false')}, {future_sql('fa', 'ca', 30, FC.Z80)},
  {fit_sql('recent', 'fb', FC.Z80, yearly='false', events=True)}, {future_sql('fb', 'cb', 30, FC.Z80, events=True)},
  cal as (select user_id, metric, event, d0 + cast(d - 1 as int) as ds from (select user_id, metric, min(ds) as d0 from recent group by all),
   (select 'vacation' as event, unnest(range(30, 38)) as d union all select 'sick', unnest([60, 61, 62]) union all select 'marathon', 90)),
  impact as (select cal.user_id, cal.metric, cal.ds, event, ca.yhat as without_holiday, cb.yhat as with_holiday,
    cb.yhat - ca.yhat as diff, abs(cb.yhat - ca.yhat) as absdiff from cal left join ca using (user_id, metric, ds)
    left join cb using (user_id, metric, ds))"""


@query("i6_steps_task", f"""with {Q.DAILY}, {TASK3} select user_id, metric, ds, event, {sr('without_holiday', 2)} as without_holiday,
  {sr('with_holiday', 2)} as with_holiday, {sr('diff', 2)} as diff, absdiff is not null and row_number() over (partition by
   user_id, metric order by round(absdiff, 9) desc nulls last, ds) = 1 as largest from impact""")
def i6(spark, sf):
    impact = FC.steps_task(C.daily(spark, sf))
    return rounded(impact.select(*KEYS, "ds", "event", "without_holiday", "with_holiday", "diff", "largest"),
                   "without_holiday", "with_holiday", "diff", n=2)


@query("d5_event_impact", f"""with {Q.DAILY}, {TASK3} select user_id, metric, ds, event, {sr('diff', 2)} as diff,
  {sr('absdiff', 2)} as absdiff from impact""")
def d5(spark, sf):
    recent = latest_rows(C.daily(spark, sf), 120)
    impact = FC.event_impact(D.holiday_calendar(recent), FC.forecast(recent, TASK_EVENTS, 30))
    return rounded(impact.select(*KEYS, "ds", "event", "diff", "absdiff"), "diff", "absdiff", n=2)


@query("e20_largest_event", f"""with {Q.DAILY}, {TASK3} select user_id, metric, event, {sr('max(absdiff)', 2)} as absdiff
  from (select *, row_number() over (partition by user_id, metric order by absdiff desc, ds) as k from impact where absdiff is not null)
  where k = 1 group by all""")
def e20(spark, sf):
    recent = latest_rows(C.daily(spark, sf), 120)
    impact = FC.event_impact(D.holiday_calendar(recent), FC.forecast(recent, TASK_EVENTS, 30))
    top = FC.largest_event(impact)
    return top.select(*KEYS, "event", r(F.abs("diff"), 2).alias("absdiff"))


@query("e18_best_worst_weekday", f"""with {Q.DAILY}, {fit_sql('daily', 'fit', FC.Z80)}, w as (select user_id, metric,
   dayname(ds) as weekday, round(avg(weekly), 9) as m from fit group by all) select user_id, metric,
   first(weekday order by m desc, weekday) as best_day, first(weekday order by m, weekday) as worst_day from w group by all""")
def e18(spark, sf):
    return FC.best_worst_weekday(FC.components(C.daily(spark, sf)))


@query("e19_mae_last_week", f"""with {Q.DAILY}, {fit_sql('daily', 'fit', FC.Z80)}, k as (select *, row_number() over (
   partition by user_id, metric order by ds desc) as b from fit) select user_id, metric,
   {sr('case when count(*) >= 7 then avg(abs(yhat - y)) end', 2)} as mae from k where b <= 7 group by all""")
def e19(spark, sf):
    d = C.daily(spark, sf)
    return rounded(FC.mae_last(d, FC.components(d)), "mae", n=2)


@query("e19_holdout_mae", f"""with {Q.DAILY}, k as (select *, row_number() over (partition by user_id, metric order by ds desc) as b
   from daily), train as (select * exclude b from k where b > 7), {fit_sql('train', 'fit', FC.Z80)},
  p as (select user_id, metric, min(start_ds) as start_ds, max(slope) as slope, max(intercept) as intercept from fit group by all),
  w as (select user_id, metric, dow, max(weekly) as wk from fit group by all),
  m as (select user_id, metric, mon, max(yearly) as yr from fit group by all),
  x as (select user_id, metric, y, intercept + slope * date_diff('day', start_ds, ds) as trend, dayofweek(ds) as dow, month(ds) as mon
    from k join p using (user_id, metric) where b <= 7)
  select user_id, metric, {sr('avg(abs(trend + coalesce(wk, 0) + coalesce(yr, 0) - y))', 2)} as holdout_mae
  from x left join w using (user_id, metric, dow) left join m using (user_id, metric, mon) group by all""")
def e19_holdout(spark, sf):
    return rounded(FC.holdout_mae(C.daily(spark, sf)), "holdout_mae", n=2)


@query("d3_forecast_inner_join", f"""with {Q.DAILY}, {RECENT.format(n=60)}, {fit_sql('recent', 'fit', FC.Z95)} select user_id, metric, ds,
  {sr('daily.y', 2)} as y, {sr('yhat', 2)} as yhat from daily join fit using (user_id, metric, ds)""")
def d3(spark, sf):
    d = C.daily(spark, sf)
    fc = FC.forecast(latest_rows(d, 60), FC.DETECTION).select(*KEYS, "ds", "yhat")
    return rounded(d.join(fc, [*KEYS, "ds"]), "y", "yhat", n=2)


@query("d4_event_days_of_forecast", f"""with {Q.DAILY}, {fit_sql('daily', 'fit', FC.Z95, events=True)} select user_id, metric, ds,
  event as holiday, {sr('yhat', 2)} as yhat from fit where event is not null""")
def d4(spark, sf):
    d = C.daily(spark, sf)
    fc = FC.forecast(d, replace(FC.DETECTION, events=True)).select(*KEYS, "ds", "yhat")
    return rounded(D.holiday_calendar(d).join(fc, [*KEYS, "ds"]), "yhat", n=2)


COMPARED = f"""{fit_sql('daily', 'fa', FC.Z95)}, {fit_sql('daily', 'fb', FC.Z95, events=True)}"""


@query("i7_compare_events", f"""with {Q.DAILY}, {COMPARED} select fa.user_id, fa.metric, fa.ds, fb.event, {sr('fa.yhat', 2)} as yhat_without,
  {sr('fb.yhat', 2)} as yhat_with, {sr('fa.lo', 2)} as lower_without, {sr('fa.hi', 2)} as upper_without,
  {sr('fb.lo', 2)} as lower_with, {sr('fb.hi', 2)} as upper_with
  from fa join fb using (user_id, metric, ds)""")
def i7(spark, sf):
    both = FC.compare_events(C.daily(spark, sf))
    numbers = [f"{c}_{k}" for c in ("yhat", "lower", "upper") for k in ("without", "with")]
    return rounded(both.select(*KEYS, "ds", "event", *numbers), *numbers, n=2)


@query("d7_flags_on_forecasts", f"""with {Q.DAILY}, {scored_sql()}, {mode_sql('bal', E.BALANCED)} select user_id, metric, ds,
  coalesce(is_anom, false) as is_anom, coalesce(explanation, '') as anom_text from daily left join bal using (user_id, metric, ds)""")
def d7(spark, sf):
    d = C.daily(spark, sf)
    return FC.compare_events(d, E.detect(d)).select(*KEYS, "ds", "is_anom", "anom_text")
