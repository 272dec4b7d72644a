"""The benchmark tables as samples, daily series, intervals and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitalgrid.operators import daily as D, series as S, timeline as TL
from vitalgrid.schema import HEART_RATE, KEYS, MEAN_METRICS, SLEEP, STEPS
from vitalgrid.session import prepare

# Keys of series that belong to no single user.
ORDERS, EVERYONE, LINES = -1, -2, -3

EVENT_METRICS = {"view": HEART_RATE, "click": STEPS, "purchase": SLEEP}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def metric_of_event(event_type: Column) -> Column:
    """Three event types stand for the three device metrics, others keep their name."""
    out = event_type
    for event, metric in EVENT_METRICS.items():
        out = F.when(event_type == event, metric).otherwise(out)
    return out


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one sample."""
    return table(spark, sf_dir, "events").select(
        "user_id", metric_of_event(F.col("event_type")).alias("metric"),
        F.col("ts").cast("timestamp").alias("ts"), "value", "event_id")


def pooled_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users as one stream per metric."""
    return samples(spark, sf_dir).withColumn("user_id", F.lit(EVERYONE).cast("long"))


def order_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lit(ORDERS).cast("long").alias("user_id"), F.col("o_orderpriority").alias("metric"),
        F.col("o_orderdate").cast("timestamp").alias("ts"), F.col("o_totalprice").alias("value"))


def line_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as samples of their supplier, by return flag: series of years, so that users have windows."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("long").alias("user_id"), F.col("l_returnflag").alias("metric"),
        F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_quantity").alias("value"))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplier's line items of one time and return flag as one sample, with an id below zero."""
    return shipped(line_samples(spark, sf_dir))


def shipped(lines: DataFrame) -> DataFrame:
    number = (F.col("user_id") * 1000 + F.ascii("metric")) * 100000 + F.unix_date(F.to_date("ts"))
    return lines.groupBy(*KEYS, "ts").agg(F.sum("value").alias("value")).withColumn("event_id", -number)


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of all suppliers together."""
    return line_samples(spark, sf_dir).withColumn("user_id", F.lit(LINES).cast("long"))


def user_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.daily(samples(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series per user, of all users together, and of orders by priority.

    The series of all users are put together from per-user sums and counts, so
    events are read and shuffled once.
    """
    per_user = (samples(spark, sf_dir).where(F.col("value").isNotNull())
                .groupBy(*KEYS, F.to_date("ts").alias("ds"))
                .agg(F.sum("value").alias("s"), F.count("value").alias("c")))
    everyone = (per_user.groupBy("metric", "ds").agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
                .select(F.lit(EVERYONE).cast("long").alias("user_id"), "metric", "ds", "s", "c"))
    y = F.when(F.col("metric").isin(*MEAN_METRICS), F.col("s") / F.col("c")).otherwise(F.col("s"))
    events = per_user.unionByName(everyone).select(*KEYS, "ds", y.alias("y"))
    return events.unionByName(D.daily(order_samples(spark, sf_dir)))


def everyone_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series of all users together."""
    return D.daily(pooled_samples(spark, sf_dir))


def long_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of thousands of days: orders by priority and line items by return flag."""
    return (D.daily(order_samples(spark, sf_dir))
            .unionByName(D.daily(all_lines(spark, sf_dir))))


def window_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series with those of suppliers added: the input of window features, clusters and votes."""
    return daily(spark, sf_dir).unionByName(D.daily(line_samples(spark, sf_dir)))


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase as a sleep interval of ``value`` minutes."""
    end = F.timestamp_micros(F.unix_micros(F.col("ts")) + F.round(F.col("value") * 6e7).cast("long"))
    return (samples(spark, sf_dir).where(F.col("metric") == SLEEP)
            .select("user_id", F.col("ts").alias("start"), end.alias("end")))


def observed_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes with data of each user: means for heart rate, sums for the rest."""
    s = samples(spark, sf_dir)
    means = TL.minute_mean(s.where(F.col("metric") == HEART_RATE))
    return means.unionByName(TL.minute_sum(s.where(F.col("metric") != HEART_RATE)))


def wide_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned one-minute frame of all users together."""
    everyone = intervals(spark, sf_dir).withColumn("user_id", F.lit(EVERYONE).cast("long"))
    return aligned(pooled_samples(spark, sf_dir), everyone).drop(S.CHUNK)


def user_wide_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned one-minute frame of every user, and the day of each minute."""
    return aligned(samples(spark, sf_dir), intervals(spark, sf_dir))


def aligned(s: DataFrame, asleep: DataFrame) -> DataFrame:
    tasks = TL.day_tasks(s)
    heart = TL.interpolate(TL.dense_minutes(TL.minute_mean(s.where(F.col("metric") == HEART_RATE)), around=True, runs=True))
    steps = TL.dense_minutes(TL.minute_sum(s.where(F.col("metric") == STEPS)), fill=0.0, runs=True)
    return TL.align(heart, steps, TL.sleep_per_minute(TL.sleep_minutes(asleep, runs=True)), tasks=tasks)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the JSON documents devices send: the shape depends on the event type."""
    e = table(spark, sf_dir, "events")
    ts = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    kind, uid, value = F.col("event_type"), F.col("user_id"), F.col("value")

    def doc(*fields) -> Column:
        return F.to_json(F.struct(*fields))

    view = doc(uid.alias("user_id"), kind.alias("type"), F.struct(ts.alias("time"), value.alias("heart_rate")).alias("data"))
    click = doc(uid.alias("owner"), F.struct(ts.alias("created_at"), F.floor(value).alias("step_count")).alias("payload"))
    purchase = doc(uid.alias("subject"), F.lit(7).alias("type"), F.struct(
        ts.alias("startTime"), ts.alias("end"), value.cast("string").alias("minutesAsleep")).alias("value"))
    signup = doc(F.struct(uid.alias("userid"), F.lit("").alias("timestamp"), ts.alias("ts"),
                          F.lit("n/a").alias("total_steps")).alias("data"))
    error = doc(uid.alias("user_id"), F.col("props").alias("note"))
    return e.select("event_id", F.when(kind == "view", view).when(kind == "click", click)
                    .when(kind == "purchase", purchase).when(kind == "signup", signup).otherwise(error).alias("record"))
