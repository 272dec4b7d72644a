"""Report tables and incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.operators import ensemble as E, report as RP, stats
from vitalgrid.plans import canonical as C, sql as Q
from vitalgrid.plans.q_detect import MOMENTS, SUMMARY, VOTED, mode_sql, scored_sql, voted
from vitalgrid.plans.q_series import _body_daily
from vitalgrid.plans.registry import plain_time, query, rounded, sr
from vitalgrid.schema import KEYS
from vitalgrid.session import scratch_path
from vitalgrid.streaming import ingest

# The tables' metrics as a body would produce them: sleep in hours, clicks scaled to step counts.
BODY = """, body as (select user_id, metric, ds, case metric when 'sleep' then y / 60 when 'steps' then y * 40 else y end as y from daily)"""
TITLE = """array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(replace(metric, '_', ' '), ' ')], ' ')"""
UNIT = """case when lower(metric) like '%heart%' then 'bpm' when lower(metric) like '%step%' then 'steps'
  when lower(metric) like '%sleep%' then 'hours' else 'units' end"""
NL = "chr(10)"


def f(x: str, d: int) -> str:
    return f"printf('%.{d}f', ({x}) + 1e-9)"


FACTS = """ranked as (select *, row_number() over (partition by user_id, metric order by ds desc) as b from body),
  facts as (select user_id, metric, count(*) as n, avg(y) as mean, quantile_cont(y, 0.5) as median,
    coalesce(stddev_samp(y), 0) as std, min(y) as min, max(y) as max, case when count(*) >= 14 then
    avg(y) filter (where b <= 7) - avg(y) filter (where b between 8 and 14) else 0.0 end as trend from ranked group by all)"""

_SCORE = f"'- Consistency Score: ' || {f('100 - std / greatest(mean, 1) * 100', 1)} || '%'"


def _either(cond: str, yes: str, no: str) -> str:
    return f"case when {cond} then '{yes}' else '{no}' end"


BLOCK = f"""blocks as (select user_id, metric, concat_ws({NL}, 'Metric: ' || {TITLE},
    '- Average: ' || {f('mean', 2)} || ' ' || {UNIT}, '- Median: ' || {f('median', 2)} || ' ' || {UNIT},
    '- Standard Deviation: ' || {f('std', 2)}, '- Range: ' || {f('min', 2)} || ' - ' || {f('max', 2)} || ' ' || {UNIT},
    '- 7-Day Trend: ' || {_either('trend > 0', 'Increasing', 'Decreasing')} || ' (' || {f('abs(trend)', 2)} || ' ' || {UNIT} || ')',
    case metric when 'heart_rate' then concat_ws({NL},
      'Health Status: ' || case when mean > 100 then 'Elevated' when mean >= 60 then 'Normal' else 'Low' end || ' at ' || {f('mean', 1)}
        || ' bpm; 60-100 bpm is normal at rest.', {_SCORE},
      '- Pattern: ' || {_either('std < mean * 0.15', 'stable', 'variable')},
      '- Recent trend: ' || {_either('trend < 0', 'beats per minute are going down', 'beats per minute are not going down')},
      case when mean > 120 or mean < 40 then '[EMERGENCY ALERT] Readings of ' || {f('min', 0)} || '-' || {f('max', 0)}
        || ' bpm need a professional''s attention.' end)
    when 'steps' then concat_ws({NL}, 'Activity Level: ' || case when mean < 5000 then 'Sedentary' when mean < 7500 then 'Low Active'
        when mean < 10000 then 'Somewhat Active' when mean < 12500 then 'Active' else 'Very Active' end || ' at ' || {f('mean', 0)}
        || ' steps per day; 10,000 are recommended.', {_SCORE},
      '- Pattern: ' || {_either('std < mean * 0.25', 'even from day to day', 'uneven from day to day')},
      '- Recent trend: ' || {_either('trend > 0', 'more steps than the week before', 'no more steps than the week before')})
    when 'sleep' then concat_ws({NL}, 'Sleep Quality: ' || case when mean < 6 then 'Poor' when mean < 7 then 'Good'
        when mean <= 9 then 'Excellent' else 'Too Much' end || ' at ' || {f('mean', 1)} || ' hours per night; 7-9 are recommended.', {_SCORE},
      '- Pattern: ' || {_either('std < mean * 0.15', 'nights of much the same length', 'nights of differing length')},
      '- Recent trend: ' || {_either('trend > 0', 'longer nights than the week before', 'nights no longer than the week before')}) end) as block from facts)"""

SECTION = f"""{MOMENTS.format(t='body')}, marked as (select *, coalesce(y < mean - 2.5 * std or y > mean + 2.5 * std, false) as hit from moments),
  listed as (select *, case when hit then row_number() over (partition by user_id, metric, hit order by ds desc) end as k from marked),
  sections as (select user_id, metric, count(*) filter (where hit) as anomalies, concat_ws({NL}, 'Metric: ' || {TITLE},
     'Anomalies Detected: ' || count(*) filter (where hit), 'Percentage of Data: ' || {f('100.0 * count(*) filter (where hit) / count(*)', 2)} || '%',
     case when count(*) filter (where hit) > 0 then 'Top Recent Anomalies:' || {NL} || string_agg(k || '. Date: ' || strftime(ds, '%Y-%m-%d')
       || ', Value: ' || {f('y', 2)} || ' ' || {UNIT} || ', Deviation: ' || {f('(y - mean) / std', 2)} || ' std_dev from mean', {NL} order by k)
       filter (where k <= 5) else 'No day stands out.' end) as section
    from listed group by user_id, metric)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query("k1_metric_analysis_block", f"with {Q.DAILY} {BODY}, {FACTS}, {BLOCK} select user_id, metric, block from blocks")
def k1(spark, sf):
    return RP.metric_block(RP.series_facts(_body_daily(spark, sf))).select(*KEYS, "block")


@query("k2_anomaly_section", f"with {Q.DAILY} {BODY}, {SECTION} select user_id, metric, anomalies, section from sections")
def k2(spark, sf):
    return RP.anomaly_section(_body_daily(spark, sf))


ADVICE_SQL = f"{_quoted(RP.RULE)}, 'Based on your metrics and anomalies:', {_quoted(RP.ADVICE)}"


@query("k3_recommendations", f"""with {Q.DAILY} {BODY}, {SECTION} select user_id, metric, concat_ws({NL}, section, {ADVICE_SQL}) as report
  from sections""")
def k3(spark, sf):
    sections = RP.anomaly_section(_body_daily(spark, sf))
    return sections.select(*KEYS, RP.with_advice(F.col("section"), "Based on your metrics and anomalies:").alias("report"))


@query("k4_user_report", f"""with {Q.DAILY} {BODY}, {FACTS}, {BLOCK}, {SECTION} select user_id, concat_ws({NL}, 'Health Report',
   {_quoted(RP.RULE)}, 'ANALYSIS OVERVIEW', string_agg(block, {NL} || {NL} order by metric), {_quoted(RP.RULE)}, 'ANOMALIES OVERVIEW',
   string_agg(section, {NL} || {NL} order by metric), {ADVICE_SQL}) as report
  from blocks join sections using (user_id, metric) group by user_id""")
def k4(spark, sf):
    return RP.user_report(_body_daily(spark, sf))


@query("k5_ensemble_report", f"""with recursive {Q.DAILY_LINES}, {VOTED}, {SUMMARY} select user_id, metric, concat_ws({NL}, '### ' || {TITLE},
  '- Total Anomalies: ' || total_anomalies, '- Avg Confidence: ' || {f('avg_confidence', 3)},
  '- Severity: HIGH=' || high || ' | MEDIUM=' || medium || ' | LOW=' || low) as report from summary""")
def k5(spark, sf):
    return RP.ensemble_report(stats.ensemble_summary(voted(spark, sf)))


_CAUSE = "case " + " ".join(f"when lower(metric) like '%{w}%' then {_quoted(c)}" for w, c in RP.CAUSES) + f" else {_quoted(RP.OTHER_CAUSE)} end"
_COUNT = "'{}' || count(*) filter (where is_anom and severity = '{}')"


@query("k6_insight_card", f"""with {Q.DAILY}, {scored_sql()}, {mode_sql('bal', E.BALANCED)},
  cards as (select user_id, metric, concat_ws({NL}, 'Flagged days: ' || count(*) filter (where is_anom),
     {_COUNT.format('- High: ', 'High')}, {_COUNT.format('- Medium: ', 'Medium')}, {_COUNT.format('- Low: ', 'Low')}, '',
     'Look first at: ' || {_CAUSE}) as head from bal group by user_id, metric),
  k as (select *, row_number() over (partition by user_id, metric order by ds desc) as back from bal),
  week as (select user_id, metric, 'Steps in the last ' || count(*) || ' days:' || {NL} || '- most on '
     || dayname(first(ds order by y desc, ds)) || ' (' || format('{{:,}}', cast(floor(max(y) + 0.5 + 1e-9) as bigint)) || ')' || {NL}
     || '- fewest on ' || dayname(first(ds order by y, ds)) || ' (' || format('{{:,}}', cast(floor(min(y) + 0.5 + 1e-9) as bigint))
     || ')' as line from k where metric = 'steps' and back <= 7 group by user_id, metric),
  wd as (select user_id, metric, dayname(ds) as wd, avg(y) as m from bal where metric = 'sleep' group by all),
  wx as (select user_id, metric, first(wd order by m desc, wd) as a, first(wd order by m, wd) as b,
     case when max(m) > 24 then max(m) / 60 else max(m) end as hi, case when max(m) > 24 then min(m) / 60 else min(m) end as lo from wd group by all),
  tr as (select user_id, metric, count(*) as n, avg(y) filter (where back <= 7) - avg(y) filter (where back between 8 and 14) as d
     from k where metric = 'sleep' group by all),
  nights as (select user_id, metric, concat_ws({NL}, 'Sleep by weekday:', case when abs(hi - lo) < 0.25
     then '- near the same on every weekday: ' || {f('(hi + lo) / 2', 1)} || ' hours'
     else '- longest on ' || a || ': ' || {f('hi', 1)} || ' hours' || {NL} || '- shortest on ' || b || ': ' || {f('lo', 1)} || ' hours' end,
     case when n >= 14 then case when abs(d) < 0.1 then 'Sleep duration is relatively stable over recent weeks.'
       when d > 0 then 'Sleep duration is increasing in the most recent week.' else 'Sleep duration is decreasing in the most recent week.' end end) as line
     from wx join tr using (user_id, metric))
  select user_id, metric, concat_ws({NL}, head, week.line, nights.line) as card from cards left join week using (user_id, metric)
   left join nights using (user_id, metric)""")
def k6(spark, sf):
    return RP.insight_card(E.detect(C.daily(spark, sf)))


@query("l1_incremental_ingest", f"""with {Q.SAMPLES}, m as (select user_id, metric, date_trunc('minute', ts) as ts,
   case when metric = 'heart_rate' then avg(value) else sum(value) end as value from samples group by user_id, metric, 3)
  select user_id, metric, ts, {sr('value')} as value from m
  where ts + interval 1 minute <= date_trunc('milliseconds', (select max(ts) from samples)) - interval 10 minute""")
def l1(spark, sf):
    events = C.table(spark, sf, "events")
    stream = (spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf))
    samples = stream.select("user_id", C.metric_of_event(F.col("event_type")).alias("metric"),
                            F.col("ts").cast("timestamp").alias("ts"), "value")
    out, state = scratch_path(spark, "minutes"), scratch_path(spark, "progress")
    ingest.append(ingest.minute_table(samples), out, state).awaitTermination()
    return plain_time(rounded(spark.read.parquet(out), "value"), "ts")
