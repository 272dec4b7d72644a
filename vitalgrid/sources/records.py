"""Routing of nested device records (JSON text) to heart-rate, steps and sleep rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitalgrid.schema import HEART_RATE, SLEEP, STEPS

# Key names, in the order they are tried.
PAYLOAD_KEYS = ("data", "payload", "value")
USER_KEYS = ("user_id", "id", "userid", "owner", "owner_id", "participant_id", "subject")
NESTED_USER_KEYS = ("user_id", "userid", "owner_id")
TIME_KEYS = ("timestamp", "time", "startTime", "dateTime", "created_at", "ts", "date")
HEART_RATE_KEYS = ("heart_rate", "heartrate", "hr", "bpm", "value")
STEPS_KEYS = ("steps", "step_count", "total_steps", "stepCount")
SLEEP_KEYS = ("minutesAsleep", "sleep_minutes", "minutes_asleep", "sleepMinutes", "sleep")
START_KEYS = ("startTime", "start_time", "start")
END_KEYS = ("endTime", "end_time", "end")


def get(doc: Column, key: str, kind: str = "variant") -> Column:
    return F.try_variant_get(doc, f"$.{key}", kind)


def has(doc: Column, key: str) -> Column:
    """The key is there, even if its value is null."""
    return get(doc, key).isNotNull()


def has_any(doc: Column, keys) -> Column:
    found = F.lit(False)
    for key in keys:
        found = found | has(doc, key)
    return found


def is_object(doc: Column) -> Column:
    return F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))


def payload(doc: Column) -> Column:
    """The first sub-document that holds the reading, else the record itself."""
    tries = [F.when(is_object(get(doc, k)), get(doc, k)) for k in PAYLOAD_KEYS]
    return F.coalesce(*tries, doc)


def user_id(doc: Column) -> Column:
    """First user key present at the top, else inside a ``data`` document."""
    data = F.when(is_object(get(doc, "data")), get(doc, "data"))
    top = [get(doc, k) for k in USER_KEYS]
    return F.coalesce(*top, *[get(data, k) for k in NESTED_USER_KEYS]).try_cast("string")


def timestamp(load: Column) -> Column:
    """First time key with a non-empty value, as text."""
    return F.coalesce(*[F.nullif(get(load, k, "string"), F.lit("")) for k in TIME_KEYS])


def first_of(load: Column, keys) -> Column:
    """Value of the first key present, even if it is null."""
    return F.coalesce(*[get(load, k) for k in keys])


def first_truthy(load: Column, keys) -> Column:
    return F.coalesce(*[F.nullif(get(load, k, "string"), F.lit("")) for k in keys])


def metric(load: Column) -> Column:
    """Heart rate before steps before sleep; null if nothing matches."""
    slept = has_any(load, SLEEP_KEYS) | (has(load, "startTime") & has(load, "endTime"))
    return (F.when(has_any(load, HEART_RATE_KEYS), HEART_RATE).when(has_any(load, STEPS_KEYS), STEPS)
            .when(slept, SLEEP))


def raw_value(load: Column, kind: Column) -> Column:
    """The reading under the first key of its metric, still untyped."""
    return (F.when(kind == HEART_RATE, first_of(load, HEART_RATE_KEYS)).when(kind == STEPS, first_of(load, STEPS_KEYS))
            .when(kind == SLEEP, first_of(load, SLEEP_KEYS)))


def typed_value(raw: Column, kind: Column) -> Column:
    """Number or null; steps are whole, and bad or missing steps are 0."""
    steps = F.coalesce(raw.try_cast("bigint").cast("double"), F.lit(0.0))
    return F.when(kind == STEPS, steps).otherwise(F.nanvl(raw.try_cast("double"), F.lit(None)))


def parse(records: DataFrame, text: str = "record") -> DataFrame:
    """Add ``doc`` and ``load`` (its payload); text that is no JSON object is dropped.

    The documents come out of a generator, which parses each text once: filters
    on what they hold cannot be moved below it and parse again.
    """
    docs = F.filter(F.array(F.try_parse_json(text)), is_object)
    return records.select("*", F.inline(F.transform(
        docs, lambda d: F.struct(d.alias("doc"), payload(d).alias("load")))))


def route(records: DataFrame, text: str = "record") -> DataFrame:
    """One typed row per matching record."""
    doc, load = F.col("doc"), F.col("load")
    routed = (parse(records, text).withColumn("metric", metric(load)).where(F.col("metric").isNotNull())
              .withColumn("_raw", raw_value(load, F.col("metric"))))
    source = F.when(F.schema_of_variant(get(doc, "type")) == "STRING", get(doc, "type", "string"))
    asleep = F.col("metric") == SLEEP
    return routed.select(
        user_id(doc).alias("user_id"), "metric",
        F.when(~asleep, timestamp(load)).alias("timestamp"),
        F.when(asleep, first_truthy(load, START_KEYS)).alias("startTime"),
        F.when(asleep, first_truthy(load, END_KEYS)).alias("endTime"),
        typed_value(F.col("_raw"), F.col("metric")).alias("value"), source.alias("source_type"))


def counted(records: DataFrame, name, routed: bool) -> DataFrame:
    """Counters that ride along with whatever is done with the frame: rows read, or rows matched by metric.

    ``name``: an ``Observation`` in a batch, a text in a stream, whose progress then carries the counters.
    """
    if not routed:
        return records.observe(name, F.count(F.lit(1)).alias("total"))
    return records.observe(name, *[F.count_if(F.col("metric") == m).alias(m) for m in (HEART_RATE, STEPS, SLEEP)])


def match_counts(routed: DataFrame, total: DataFrame) -> DataFrame:
    """Matches per metric, and the number of records read as ``total``."""
    return (routed.groupBy("metric").agg(F.count(F.lit(1)).alias("n"))
            .unionByName(total.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total").alias("metric"), "n")))


def key_types(records: DataFrame, text: str = "record") -> DataFrame:
    """Top-level keys of the records and how often each type occurs."""
    doc = parse(records, text).select("doc")
    pairs = doc.lateralJoin(doc.sparkSession.tvf.variant_explode(F.col("doc").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), r"^\w+", 0)
    return pairs.groupBy("key", kind.alias("type")).agg(F.count(F.lit(1)).alias("n"))
