"""Incremental ingest: device records to per-minute tables with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vitalgrid.functions.timeparse import LOCAL_ZONE, parse_to_utc
from vitalgrid.schema import MEAN_METRICS
from vitalgrid.sources import records

RECORDS = T.StructType([T.StructField("record", T.StringType())])


def read_records(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """JSON records, one per line, from new files of a directory."""
    text = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return text.withColumnRenamed("value", "record")


def samples_from_records(stream: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Route records with the same expressions the batch reader uses.

    Counters of rows read, matched by metric and dropped for want of a time ride along; see ``counters``.
    """
    routed = records.counted(records.route(records.counted(stream, "read", False)), "matched", True)
    ts = parse_to_utc(F.coalesce("timestamp", "startTime"), zone=zone)
    timed = routed.select("user_id", "metric", ts.alias("ts"), "value")
    return timed.observe("dropped", F.count_if(F.col("ts").isNull()).alias("without_time")).where(F.col("ts").isNotNull())


def counters(query) -> dict[str, int]:
    """Counts of a running or ended query so far, from its progress: no second job reads the records.

    ``late``: rows behind the watermark that a stateful operator left out.
    """
    out: dict[str, int] = {}
    for progress in query.recentProgress:
        rows = [row.asDict() for row in (progress.observedMetrics or {}).values()]
        rows.append({"late": sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)})
        for row in rows:
            for k, v in row.items():
                out[k] = out.get(k, 0) + v
    return out


def minute_table(samples: DataFrame, delay: str = "10 minutes", keys=("user_id", "metric")) -> DataFrame:
    """Per-minute mean or sum; a minute is final once the watermark has passed it."""
    minute = F.window("ts", "1 minute")
    agg = (samples.withWatermark("ts", delay).groupBy(*keys, minute)
           .agg(F.avg("value").alias("_avg"), F.sum("value").alias("_sum")))
    value = F.when(F.col("metric").isin(*MEAN_METRICS), F.col("_avg")).otherwise(F.col("_sum"))
    return agg.select(*keys, F.col("window.start").alias("ts"), value.alias("value"))


def append(minutes: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Start the append query; with ``available_now`` it ends after the data at hand."""
    writer = (minutes.writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
