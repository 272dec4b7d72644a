"""Sources, sinks, ingest and schema detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.operators import daily as D, timeline as TL
from vitalgrid.plans import canonical as C, sql as Q
from vitalgrid.plans.registry import plain_time, query, r, rounded, sr
from vitalgrid.schema import EVENT_IMPACT, FORECAST, HEART_RATE, KEYS, RAW_STEPS, metric_unit
from vitalgrid.session import scratch_path, stored
from vitalgrid.sources import archive, files, profile, records as REC, sniff

AS_OF = "2024-01-15"


# --- files --------------------------------------------------------------------------------------

@query("a1_csv_pruned_scan", """select cast(user_id as varchar) as user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as timestamp,
  cast(floor(value) as bigint) as steps from events""")
def a1(spark, sf):
    e = C.table(spark, sf, "events").select(
        F.col("event_id").alias("extra"), F.floor("value").alias("Steps"), F.col("props"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "user_id")
    path = scratch_path(spark, "csv")
    files.write_csv(e, path)
    return files.read_csv(spark, path, RAW_STEPS).withColumnRenamed("Steps", "steps")


@query("a2_missing_source", f"""with {Q.SAMPLES} select metric, count(*) as n from samples where metric = 'steps' group by 1""")
def a2(spark, sf):
    absent = files.read_csv(spark, scratch_path(spark, "nowhere"), RAW_STEPS)
    rows = files.clean_steps(absent).select("metric", "value")
    have = C.samples(spark, sf).where(F.col("metric") == "steps").select("metric", "value")
    return have.unionByName(rows).groupBy("metric").agg(F.count(F.lit(1)).alias("n"))


@query("a11_persist_splits", f"""with {Q.SAMPLES}, n as (select *,
   row_number() over (partition by user_id, metric order by ts, event_id) as rn,
   count(*) over (partition by user_id, metric) as c from samples)
  select metric, case when rn > c - floor(c * 0.2) then 'test' else 'train' end as split, count(*) as n,
  {sr('sum(value)', 4)} as total from n group by 1, 2""")
def a11(spark, sf):
    split = TL.chronological_split(C.samples(spark, sf), order=["ts", "event_id"])
    path = scratch_path(spark, "splits")
    files.write_splits(split, path)
    back = spark.read.parquet(path)
    return back.groupBy("metric", "split").agg(F.count(F.lit(1)).alias("n"), r(F.sum("value"), 4).alias("total"))


@query("a12_reload_splits", f"""with {Q.SAMPLES}, n as (select *,
   row_number() over (partition by user_id, metric order by ts, event_id) as rn,
   count(*) over (partition by user_id, metric) as c from samples)
  select event_id, user_id, metric, value, case when rn > c - floor(c * 0.2) then null else ts end as train_ts from n""")
def a12(spark, sf):
    split = TL.chronological_split(C.samples(spark, sf), order=["ts", "event_id"])
    path = scratch_path(spark, "splits")
    files.write_splits(split, path)
    train = spark.read.parquet(f"{path}/split=train").withColumnRenamed("ts", "train_ts")
    test = spark.read.parquet(f"{path}/split=test").drop("ts")
    both = files.union_splits(train, test)
    return plain_time(both.select("event_id", *KEYS, "value", "train_ts"), "train_ts")


_FILES = """uploads as (
  select 0 as file_ordinal, 'daily_a.csv' as file_name, * from daily where ds >= '2024-01-10'
  union all select 1, 'daily_b.csv', user_id, metric, ds, y + 1 from daily
  union all select 2, 'extra.csv', user_id, metric, ds + 3, y + 2 from daily
  union all select 6, 'late.csv', user_id, metric, ds + 90, y from daily)"""


def _uploads(spark, sf):
    """Four files with overlapping days; the last one is beyond the six-file limit."""
    d = C.daily(spark, sf)

    def upload(ordinal, name, df):
        return df.select(F.lit(ordinal).alias("file_ordinal"), F.lit(name).alias("file_name"), *KEYS, "ds", "y")

    return (upload(0, "daily_a.csv", d.where(F.col("ds") >= F.lit("2024-01-10").cast("date")))
            .unionByName(upload(1, "daily_b.csv", d.withColumn("y", F.col("y") + 1)))
            .unionByName(upload(2, "extra.csv", d.select(*KEYS, F.date_add("ds", 3).alias("ds"), (F.col("y") + 2).alias("y"))))
            .unionByName(upload(6, "late.csv", d.select(*KEYS, F.date_add("ds", 90).alias("ds"), "y"))))


@query("a13_first_file_wins", f"""with {Q.DAILY}, {_FILES} select user_id, metric, ds, {sr('y', 3)} as y from uploads
  qualify row_number() over (partition by user_id, metric, ds order by file_ordinal) = 1""")
def a13(spark, sf):
    return rounded(D.first_file_wins(_uploads(spark, sf)), "y", n=3)


@query("a14_source_lineage", f"""with {Q.DAILY}, {_FILES} select distinct metric, file_name from uploads""")
def a14(spark, sf):
    return files.sources_per_metric(_uploads(spark, sf))


@query("a15_archive_scan", f"""select metric, count(*) as n, {sr('sum(value)', 4)} as total from (
   select case event_type when 'view' then 'heart_rate' when 'click' then 'steps' else 'sleep' end as metric, value
   from events where event_type in ('view', 'click', 'purchase', 'signup')) group by 1""")
def a15_archive(spark, sf):
    """The same files as members of archives, read where they lie."""
    e = C.table(spark, sf, "events")
    path = scratch_path(spark, "archives")
    day = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    for event, name, columns in (
            ("view", "my_heartrate", [day.alias("logDate"), F.col("value")]),
            ("click", "all_steps", [F.col("value"), F.lit("w").alias("device"), day.alias("logDate")]),
            ("purchase", "sleep_log", [F.col("user_id"), F.col("value"), day.alias("timestamp")]),
            ("signup", "sleep_extra", [day.alias("timestamp"), F.col("value")]),
            ("error", "misc", [day.alias("logDate"), F.col("value")])):
        archive.write_archive(e.where(F.col("event_type") == event).select(*columns), path, name).collect()
    lines = archive.read_lines(spark, path, "*.csv")
    long = archive.read_series(lines, lambda member: sniff.metric_of_file(F.element_at(F.split(member, "/"), 1)))
    return long.groupBy("metric").agg(F.count(F.lit(1)).alias("n"), r(F.sum("value"), 4).alias("total"))


@query("a15_many_files_scan", f"""select metric, count(*) as n, {sr('sum(value)', 4)} as total from (
   select case event_type when 'view' then 'heart_rate' when 'click' then 'steps' else 'sleep' end as metric, value
   from events where event_type in ('view', 'click', 'purchase', 'signup')) group by 1""")
def a15(spark, sf):
    """Files that name and order their columns differently, in one folder."""
    e = C.table(spark, sf, "events")
    path = scratch_path(spark, "many")
    day = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    for event, name, columns in (
            ("view", "my_heartrate", [day.alias("logDate"), F.col("value")]),
            ("click", "all_steps", [F.col("value"), F.lit("w").alias("device"), day.alias("logDate")]),
            ("purchase", "sleep_log", [F.col("user_id"), F.col("value"), day.alias("timestamp")]),
            ("signup", "sleep_extra", [day.alias("timestamp"), F.col("value")]),
            ("error", "misc", [day.alias("logDate"), F.col("value")])):
        files.write_csv(e.where(F.col("event_type") == event).select(*columns), f"{path}/{name}")
    long = files.read_series(spark, path, lambda p: sniff.metric_of_file(F.element_at(F.split(p, "/"), -2)))
    return long.groupBy("metric").agg(F.count(F.lit(1)).alias("n"), r(F.sum("value"), 4).alias("total"))


@query("a16_row_cap_sample", """select event_type, event_id from events
  qualify row_number() over (partition by event_type order by md5(event_id || '-42'), event_id) <= 500""")
def a16(spark, sf):
    e = C.table(spark, sf, "events").select("event_type", "event_id")
    key = F.md5(F.concat(F.col("event_id").cast("string"), F.lit("-42")).cast("binary"))
    return files.sample_rows(e, 500, "event_type", key, "event_id")


@query("a18_null_profile", """select 'value' as "column", 'double' as dtype, count(*) - count(v) as nulls from
   (select nullif(value, 0) as v, case when event_type = 'view' then props end as p from events)
  union all select 'props', 'string', count(*) filter (where event_type <> 'view') from events
  union all select 'event_id', 'bigint', 0 from events having count(*) > 0
  union all select 'user_id', 'bigint', 0 from events having count(*) > 0
  union all select 'event_type', 'string', 0 from events having count(*) > 0
  union all select 'ts', 'timestamp_ntz', 0 from events having count(*) > 0""")
def a18(spark, sf):
    e = C.table(spark, sf, "events").withColumns({
        "value": F.nullif("value", F.lit(0.0)), "props": F.when(F.col("event_type") == "view", F.col("props"))})
    return profile.null_counts(e)


@query("a18_first_rows", "select event_id, user_id, event_type, value from events order by event_id limit 8")
def a18_head(spark, sf):
    return profile.head(C.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), ["event_id"])


@query("a20_dataset_overview", """select count(*) as total_rows, 'user_id, metric, ts, value, event_id' as columns,
  5::bigint as n_columns from events""")
def a20(spark, sf):
    return profile.overview(C.samples(spark, sf))


@query("a21_forecast_bundle", f"""with {Q.DAILY} select 'actual' as part, count(*) as n from daily
  union all select 'with_holidays', count(*) from daily where user_id <> -1
  union all select 'without_holidays', 0 union all select 'events', 0""")
def a21(spark, sf):
    d = C.daily(spark, sf)
    text_days = d.withColumn("ds", F.when(F.col("user_id") != C.ORDERS, F.col("ds").cast("string")).otherwise("bad"))
    bundle = files.forecast_bundle({
        "actual": d, "with_holidays": text_days.withColumnRenamed("y", "yhat"),
        "without_holidays": d, "events": None})
    blank = {"without_holidays": FORECAST, "events": EVENT_IMPACT}
    out = None
    for name, df in bundle.items():
        part = df if df is not None else files.empty(spark, blank[name])
        counted = part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        out = counted if out is None else out.unionByName(counted)
    return out


@query("a22_processed_table", "select event_id, ts as timestamp from events where event_type <> 'error'")
def a22(spark, sf):
    text = F.when(F.col("event_type") == "error", "broken").otherwise(F.col("ts").cast("string"))
    path = scratch_path(spark, "processed")
    C.table(spark, sf, "events").select("event_id", text.alias("timestamp")).write.parquet(path)
    return plain_time(files.read_processed(spark, path), "timestamp")


# --- nested records -----------------------------------------------------------------------------

@query("a3_payload_choice", """select event_id, case when event_type in ('error') then false else true end as nested,
  case event_type when 'view' then 'time' when 'click' then 'created_at' when 'purchase' then 'startTime'
    when 'signup' then 'ts' end as time_key from events""")
def a3(spark, sf):
    docs, load = REC.parse(C.records(spark, sf)), F.col("load")
    key = F.coalesce(*[F.when(F.nullif(REC.get(load, k, "string"), F.lit("")).isNotNull(), k) for k in REC.TIME_KEYS])
    return docs.select("event_id", (~REC.has(load, "note")).alias("nested"), key.alias("time_key"))


@query("a4_user_of_record", "select event_id, cast(user_id as varchar) as user_id from events")
def a4(spark, sf):
    return REC.parse(C.records(spark, sf)).select("event_id", REC.user_id(F.col("doc")).alias("user_id"))


@query("a5_time_of_record", """select event_id, case when event_type <> 'error' then
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') end as timestamp from events""")
def a5(spark, sf):
    return REC.parse(C.records(spark, sf)).select("event_id", REC.timestamp(F.col("load")).alias("timestamp"))


@query("a6_metric_routing", """select event_id, case event_type when 'view' then 'heart_rate' when 'click' then 'steps'
  when 'purchase' then 'sleep' when 'signup' then 'steps' end as metric from events""")
def a6(spark, sf):
    return REC.parse(C.records(spark, sf)).select("event_id", REC.metric(F.col("load")).alias("metric"))


@query("a7_value_coercion", """select event_id, case event_type when 'view' then value when 'click' then floor(value)
  when 'purchase' then value when 'signup' then 0.0 end as value from events where event_type <> 'error'""")
def a7(spark, sf):
    docs = REC.parse(C.records(spark, sf))
    routed = docs.withColumn("metric", REC.metric(F.col("load"))).where(F.col("metric").isNotNull())
    raw = routed.withColumn("raw", REC.raw_value(F.col("load"), F.col("metric")))
    return raw.select("event_id", REC.typed_value(F.col("raw"), F.col("metric")).alias("value"))


@query("a8_sleep_interval_keys", """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as start_text,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as end_text from events where event_type = 'purchase'""")
def a8(spark, sf):
    docs = REC.parse(C.records(spark, sf))
    slept = docs.where(REC.metric(F.col("load")) == "sleep")
    return slept.select("event_id", REC.first_truthy(F.col("load"), REC.START_KEYS).alias("start_text"),
                        REC.first_truthy(F.col("load"), REC.END_KEYS).alias("end_text"))


_ROUTED = """routed as (select cast(user_id as varchar) as user_id, case event_type when 'view' then 'heart_rate'
   when 'purchase' then 'sleep' else 'steps' end as metric,
   case event_type when 'purchase' then value when 'view' then value when 'click' then floor(value) else 0.0 end as value,
   case when event_type = 'view' then 'view' end as source_type from events where event_type <> 'error')"""


@query("a9_append_per_metric", f"""with {_ROUTED} select metric, source_type, 2 * count(*) as n,
  {sr('2 * sum(value)', 4)} as total from routed group by 1, 2""")
def a9(spark, sf):
    path = scratch_path(spark, "routed")
    routed = REC.route(C.records(spark, sf))
    for _ in range(2):
        files.append_by_metric(routed, path)
    return spark.read.parquet(path).groupBy("metric", "source_type").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("value"), 4).alias("total"))


@query("a10_match_counts", f"""with {_ROUTED} select metric, count(*) as n from routed group by 1
  union all select 'total', count(*) from events""")
def a10(spark, sf):
    docs = C.records(spark, sf)
    return REC.match_counts(REC.route(docs), docs)


@query("a10_observed_counts", f"""with {_ROUTED} select metric, count(*) as n from routed group by 1
  union all select 'total', count(*) from events""")
def a10_observed(spark, sf):
    """The same counts as a by-product of storing the routed records."""
    from pyspark.sql import Observation

    read, matched = Observation(), Observation()
    stored(REC.counted(REC.route(REC.counted(C.records(spark, sf), read, False)), matched, True), "routed")
    return spark.createDataFrame(sorted((read.get | matched.get).items()), "metric string, n long").where("n > 0")


@query("a19_record_keys", """select key, type, sum(n)::bigint as n from (
  select 'data' as key, 'OBJECT' as type, count(*) as n from events where event_type in ('view', 'signup')
  union all select 'payload', 'OBJECT', count(*) from events where event_type = 'click'
  union all select 'value', 'OBJECT', count(*) from events where event_type = 'purchase'
  union all select 'type', 'STRING', count(*) from events where event_type = 'view'
  union all select 'type', 'BIGINT', count(*) from events where event_type = 'purchase'
  union all select 'user_id', 'BIGINT', count(*) from events where event_type in ('view', 'error')
  union all select 'owner', 'BIGINT', count(*) from events where event_type = 'click'
  union all select 'subject', 'BIGINT', count(*) from events where event_type = 'purchase'
  union all select 'note', 'STRING', count(*) from events where event_type = 'error') group by 1, 2""")
def a19(spark, sf):
    return REC.key_types(C.records(spark, sf))


@query("a17_export_anomalies", f"""with {Q.DAILY}, m as (select *, avg(y) over w as mu, stddev_samp(y) over w as sd
   from daily window w as (partition by user_id, metric))
  select metric as data_type, ds, {sr('y', 2)} as y from m
  where abs(y - mu) > 2.5 * sd""")
def a17(spark, sf):
    from vitalgrid.operators import sigma

    found = sigma.outliers(sigma.moments(C.daily(spark, sf))).where("is_outlier").select("metric", "ds", "y")
    path = scratch_path(spark, "export")
    files.write_csv(files.with_data_type(found).select("ds", "y", "data_type"), path)
    back = spark.read.option("header", True).schema("ds date, y double, data_type string").csv(path)
    return rounded(back, "y", n=2)


@query("a17_export_daily_json", f"""with {Q.DAILY} select user_id, metric, count(*) as days, {sr('sum(y)', 2)} as total
  from daily group by all""")
def a17_json(spark, sf):
    """The daily table, one JSON document a series and day, written and read back."""
    path = scratch_path(spark, "daily-json")
    files.write_json_reports(C.daily(spark, sf), path)
    back = spark.read.schema("user_id bigint, metric string, ds date, y double").json(path)
    return back.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("days"), r(F.sum("y"), 2).alias("total"))


@query("d14_union_of_metrics", f"""with {Q.DAILY} select metric as data_type, count(*) as n from daily group by 1""")
def d14(spark, sf):
    return files.with_data_type(C.daily(spark, sf)).groupBy("data_type").agg(F.count(F.lit(1)).alias("n"))


# --- schema detection ---------------------------------------------------------------------------

@query("b1_date_column", "select l_orderkey, l_linenumber, l_shipdate as ts from lineitem")
def b1(spark, sf):
    lines = C.table(spark, sf, "lineitem")
    found = sniff.date_column(lines.columns)
    return plain_time(lines.select("l_orderkey", "l_linenumber", sniff.to_timestamp(lines, found).alias("ts")), "ts")


@query("b2_value_column", f"select event_id, ts, {sr('value')} as value from events")
def b2(spark, sf):
    e = C.table(spark, sf, "events").withColumnRenamed("ts", "startTime")
    return plain_time(rounded(sniff.extract_series(e, keep=("event_id",)), "value"), "ts")


_WEARABLE = """select user_id, ts, case event_type when 'view' then value end as "restHR",
  case event_type when 'click' then value end as step_count, case event_type when 'purchase' then value end as "minutesAsleep",
  value as threshold from events"""


@query("b3_metric_columns", f"""with w as ({_WEARABLE}) select user_id, metric, ts, {sr('value')} as value from (
  select user_id, 'heart_rate' as metric, ts, "restHR" as value from w union all
  select user_id, 'steps', ts, step_count from w union all
  select user_id, 'sleep', ts, "minutesAsleep" / 60.0 from w) where value is not null""")
def b3(spark, sf):
    wide = C.table(spark, sf, "events").select(
        "user_id", F.col("ts").alias(" activityDate "), F.col("value").alias("threshold"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("restHR"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("step_count"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("minutesAsleep"))
    return plain_time(rounded(sniff.extract_samples(wide, keep=("user_id",)), "value"), "ts")


@query("b4_metric_of_file", """select metric, count(*) as n from (select case event_type when 'view' then 'heart_rate'
  when 'click' then 'steps' when 'purchase' then 'sleep' end as metric from events) where metric is not null group by 1""")
def b4(spark, sf):
    e = C.table(spark, sf, "events")
    name = (F.when(F.col("event_type") == "view", "Daily_HR.csv").when(F.col("event_type") == "click", "stepLog.csv")
            .when(F.col("event_type") == "purchase", "SleepNights.csv").otherwise("other.csv"))
    ds_y = e.select(F.col("ts").alias("ds"), F.col("value").alias("y"), name.alias("file"))
    long = sniff.extract_samples(ds_y, keep=("file",), file_name=F.col("file"))
    return long.groupBy("metric").agg(F.count(F.lit(1)).alias("n"))


@query("b5_canonical_series", f"""with {Q.DAILY} select user_id, metric, ds as date, {sr('y', 3)} as value from daily
  where metric <> 'error'""")
def b5(spark, sf):
    d = C.daily(spark, sf)
    mixed = d.select(*KEYS, F.col("ds").cast("string").alias("ds"),
                     F.when(F.col("metric") == "error", "bad").otherwise(F.col("y").cast("string")).alias("y"))
    return rounded(D.canonical(mixed), "value", n=3)


@query("b6_raw_fallback_columns", """select cast(user_id as varchar) as user_id, ts - interval 330 minute as ts, value
  from events where value between 30 and 220""")
def b6(spark, sf):
    raw = C.table(spark, sf, "events").select(
        F.col("ts").cast("string").alias("when"), "user_id", "event_type", F.col("value").alias("reading"))
    reordered = raw.select("when", "reading", "event_type", "user_id")
    return plain_time(files.clean_heart_rate(reordered).select("user_id", "ts", "value"), "ts")


@query("b7_interval_columns", f"""with {Q.INTERVALS} select cast(user_id as varchar) as user_id,
  start_ts - interval 330 minute as start, end_ts - interval 330 minute as "end" from intervals""")
def b7(spark, sf):
    raw = C.intervals(spark, sf).select(
        "user_id", F.col("start").cast("string").alias("bedtime"), F.col("end").cast("string").alias("wake_date"))
    return plain_time(files.clean_sleep(raw), "start", "end")


@query("b8_timestamp_column", "select o_orderkey, o_orderdate as ts from orders")
def b8(spark, sf):
    orders = C.table(spark, sf, "orders")
    return orders.select("o_orderkey", F.col(sniff.timestamp_column(orders.columns)).alias("ts"))


@query("b9_strict_timestamps", "select event_id, ts from events")
def b9(spark, sf):
    text = C.table(spark, sf, "events").select("event_id", F.col("ts").cast("string").alias("ts"))
    return plain_time(sniff.strict_timestamps(text, "ts"), "ts")


@query("b9_bad_timestamp_count", "select count(*) as bad from events where event_type = 'error'")
def b9_count(spark, sf):
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("ts").cast("string"))
    return sniff.bad_timestamps(C.table(spark, sf, "events").select(text.alias("ts")), "ts")


@query("b10_metric_units", f"""with {Q.SAMPLES} select metric, case metric when 'heart_rate' then 'bpm'
  when 'steps' then 'steps' when 'sleep' then 'hours' else 'units' end as unit, count(*) as n from samples group by 1, 2""")
def b10(spark, sf):
    return (C.samples(spark, sf).groupBy("metric").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("unit", metric_unit(F.col("metric"))))


@query("b11_missing_metrics", """select unnest(['blood_pressure', 'weight']) as metric from events
  group by 1 having count(*) > 0""")
def b11(spark, sf):
    selected = spark.range(1).select(F.explode(F.array(*[
        F.lit(m) for m in (HEART_RATE, "weight", "steps", "blood_pressure")])).alias("metric"))
    return sniff.missing_metrics(selected, C.samples(spark, sf))
