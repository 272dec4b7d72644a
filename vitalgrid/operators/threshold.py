"""Rule-based detection: values outside a range for long enough."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vitalgrid.operators import series as S
from vitalgrid.operators.timeline import MINUTE_US
from vitalgrid.schema import DEFAULT_RULES, KEYS


def rules_table(spark: SparkSession, rules=DEFAULT_RULES) -> DataFrame:
    """Rules as a literal relation: its size is known, so Spark may broadcast it."""
    rows = F.array(*[F.struct(
        F.lit(r.metric).alias("metric"), F.lit(r.value_name).alias("value_name"),
        F.lit(float(r.low)).alias("low"), F.lit(float(r.high)).alias("high"),
        F.lit(r.sustained_minutes).alias("sustained_minutes"),
        F.lit(r.description).alias("description")) for r in rules])
    return spark.range(1).select(F.inline(rows))


def with_gaps(df: DataFrame, keys=KEYS, ts: str = "ts", unit: str | None = "hour") -> DataFrame:
    """Add the time chunk, the row's place in it and the gap to the row before, in microseconds; without unit a series is one chunk."""
    w = Window.partitionBy(*keys, *([S.CHUNK] if unit else [])).orderBy(ts)
    micros = F.unix_micros(F.col(ts))
    return ((S.chunked(df, ts, unit) if unit else df.dropna(subset=[*keys, ts]))
            .withColumn("_rn", F.row_number().over(w))
            .withColumn("_gap", micros - F.lag(micros).over(w)))


def _period_of(rows: DataFrame, chunks: DataFrame, keys=KEYS) -> DataFrame:
    """Most frequent gap of each series; ties go to the smallest gap."""
    inside = rows.where(F.col("_gap").isNotNull()).groupBy(*keys, "_gap").agg(F.count(F.lit(1)).alias("_c"))
    step = (F.unix_micros("_first")
            - F.unix_micros(F.lag("_last").over(Window.partitionBy(*keys).orderBy(S.CHUNK))))
    across = (chunks.select(*keys, step.alias("_gap")).where(F.col("_gap").isNotNull())
              .withColumn("_c", F.lit(1).cast("long")))
    gaps = inside.unionByName(across).groupBy(*keys, "_gap").agg(F.sum("_c").alias("_c"))
    return gaps.groupBy(*keys).agg(
        F.min_by("_gap", F.struct(-F.col("_c"), F.col("_gap"))).alias("period_us"))


def sampling_period(df: DataFrame, keys=KEYS, ts: str = "ts", unit: str = "hour") -> DataFrame:
    """Typical time between rows per series, one minute if there are fewer than two."""
    rows = with_gaps(df, keys, ts, unit)
    chunks = S.summaries(rows, {"_first": F.min(ts), "_last": F.max(ts)}, keys)
    return (df.select(*keys).distinct().join(_period_of(rows, chunks, keys), list(keys), "left")
            .withColumn("period_us", F.coalesce("period_us", F.lit(MINUTE_US))))


def rows_in(minutes, period_us):
    """Minutes as a number of rows: at least 1; the minutes themselves if the period is not positive."""
    count = F.floor(F.try_divide(minutes.cast("long") * F.lit(MINUTE_US), period_us))
    return F.when(period_us <= 0, minutes.cast("long")).otherwise(F.greatest(F.lit(1).cast("long"), count))


def detect_stored(df: DataFrame, rules: DataFrame, keys=KEYS, ts: str = "ts", value: str = "value",
                  unit: str = "hour") -> DataFrame:
    """``detect`` for a frame that is cheap to read twice: rows of metrics without a rule pass by the scans over series."""
    with_rule = rules.select("metric").distinct()
    judged = detect(df.join(with_rule, "metric", "left_semi"), rules, keys, ts, value, unit)
    free = df.join(with_rule, "metric", "left_anti").dropna(subset=[*keys, ts])
    verdict = {"threshold_anomaly": F.lit(False), "anomaly_reason": F.lit(""), "severity": F.lit("Normal")}
    return judged.unionByName(free.withColumns(verdict)).select(*df.columns, *verdict)


def detect(df: DataFrame, rules: DataFrame, keys=KEYS, ts: str = "ts", value: str = "value",
           unit: str | None = "hour") -> DataFrame:
    """Add ``threshold_anomaly, anomaly_reason, severity``.

    A rule with a sustained time flags a row once the violation has lasted for
    that many consecutive rows; low violations win over high ones. Metrics
    without a rule stay unflagged. Without ``unit`` whole series are scanned
    where they are: for rows that are dealt by ``keys`` to tasks that hold them.
    """
    parts = [*keys, *([S.CHUNK] if unit else [])]
    w = Window.partitionBy(*parts).orderBy(ts)
    rows = with_gaps(df.join(rules.drop("description"), "metric", "left"), keys, ts, unit)
    rows = (rows.withColumn("_hi", F.coalesce(F.col(value) > F.col("high"), F.lit(False)))
            .withColumn("_lo", F.coalesce(F.col(value) < F.col("low"), F.lit(False))))
    led = _carried(rows, keys, ts) if unit else _uncut(rows, keys)
    position = F.col("_rn") + F.col("_offset")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)

    def run(bad: str, carried: str):
        last_ok = F.max(F.when(~F.col(bad), position)).over(so_far)
        return position - F.coalesce(last_ok, F.col(carried), F.lit(0))

    need = rows_in(F.col("sustained_minutes"), F.col("_period"))
    flagged = (led.withColumn("_need", F.when(F.col("sustained_minutes") > 0, need).otherwise(F.lit(1)))
               .withColumn("_hi", F.col("_hi") & (run("_hi", "_hi_before") >= F.col("_need")))
               .withColumn("_lo", F.col("_lo") & (run("_lo", "_lo_before") >= F.col("_need"))))

    def reason(word: str, sign: str, limit: str):
        return F.concat(F.lit(f"{word} "), F.col("value_name"), F.lit(f" ({sign}"),
                        F.regexp_replace(F.col(limit).cast("string"), r"\.0$", ""), F.lit(")"))

    return flagged.select(
        *df.columns,
        (F.col("_hi") | F.col("_lo")).alias("threshold_anomaly"),
        F.when(F.col("_lo"), reason("Low", "<", "low")).when(F.col("_hi"), reason("High", ">", "high"))
        .otherwise("").alias("anomaly_reason"),
        F.when(F.col("_lo"), "Medium").when(F.col("_hi"), "High").otherwise("Normal").alias("severity"))


def _uncut(rows: DataFrame, keys) -> DataFrame:
    """The sampling period of each series, found in place; nothing is carried into a series that is one chunk."""
    period = F.mode("_gap", True).over(S.whole(keys))
    nothing = F.lit(None).cast("long")
    return (rows.withColumn("_period", F.coalesce(period, F.lit(MINUTE_US)))
            .withColumns({"_offset": F.lit(0).cast("long"), "_hi_before": nothing, "_lo_before": nothing}))


def _carried(rows: DataFrame, keys, ts: str) -> DataFrame:
    """What each row needs to know of the chunks before its own, and the sampling period of its series."""
    chunks = S.summaries(rows, {
        "_n": F.count(F.lit(1)), "_first": F.min(ts), "_last": F.max(ts),
        "_hi_break": F.max(F.when(~F.col("_hi"), F.col("_rn"))),
        "_lo_break": F.max(F.when(~F.col("_lo"), F.col("_rn"))),
    }, keys)
    chunks = (chunks.join(_period_of(rows, chunks, keys), list(keys), "left")
              .withColumn("_offset", F.coalesce(F.sum("_n").over(S.before(keys)), F.lit(0))))
    return S.hand_over(rows, chunks, {
        "_offset": F.col("_offset"),
        "_period": F.coalesce(F.col("period_us"), F.lit(MINUTE_US)),
        "_hi_before": F.max(F.col("_hi_break") + F.col("_offset")).over(S.before(keys)),
        "_lo_before": F.max(F.col("_lo_break") + F.col("_offset")).over(S.before(keys)),
    }, keys)
