"""Table readers and writers, row sampling, clean raw series."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.errors import AnalysisException

from vitalgrid.functions.scalars import physiological, to_number, to_number_or_zero
from vitalgrid.functions.timeparse import LOCAL_ZONE, parse_to_utc
from vitalgrid.schema import HEART_RATE, SLEEP, STEPS
from vitalgrid.sources import sniff

NO_USER = "unknown"


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, right types: what a missing source stands for."""
    return spark.createDataFrame([], schema)


def header_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The CSV files below a path, grouped by their header line; a file without a line is in no group.

    One pass over the first block of each file keeps one row a file.
    """
    lines = (spark.read.option("recursiveFileLookup", True).text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("place")).where("start = 0"))
    heads = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    found = heads.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    return [[unquote(f) for f in r["files"]] for r in found]


def csv_groups(spark: SparkSession, path: str) -> list[DataFrame]:
    """One frame for each header among the files below a path, as text, with the ``file_path`` of each row."""
    return [spark.read.option("header", True).csv(files).select("*", F.col("_metadata.file_path").alias("file_path"))
            for files in header_groups(spark, path)]


def read_csv(spark: SparkSession, path: str, schema: T.StructType, allow=None) -> DataFrame:
    """CSV with headers; only allowed columns (any case) are parsed, a missing path is an empty frame.

    Each file is read by its own header, so files may order and name their
    columns differently; a column a file lacks is null. If no column of a file
    is allowed, all of it are kept.
    """
    try:
        groups = csv_groups(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty(spark, schema)
        raise
    allowed = {a.lower() for a in (allow or [f.name for f in schema])}
    types = {f.name.lower(): f for f in schema}
    out = None
    for raw in groups:
        raw = raw.drop("file_path")
        kept = [c for c in raw.columns if c.lower() in allowed] or raw.columns
        typed = raw.select(*[F.col(f"`{c}`").try_cast(types[c.lower()].dataType if c.lower() in types else T.StringType())
                             .alias(types[c.lower()].name if c.lower() in types and len(groups) > 1 else c) for c in kept])
        out = typed if out is None else out.unionByName(typed, allowMissingColumns=True)
    return empty(spark, schema) if out is None else out


def read_many(spark: SparkSession, path: str, fmt: str = "csv", **options) -> DataFrame:
    """All files of a directory with the file each row came from; CSV files each by their own header."""
    if fmt != "csv":
        return spark.read.options(**options).format(fmt).load(path).select("*", F.col("_metadata.file_path").alias("file_path"))
    out = None
    for one in csv_groups(spark, path):
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def read_series(spark: SparkSession, path: str, metric_of) -> DataFrame | None:
    """Long series of all CSV files below a path; date and value columns are found for each header on its own.

    ``metric_of`` makes a file's metric from its path; files without a metric
    are left out. None if there are no files.
    """
    out = None
    for one in csv_groups(spark, path):
        named = one.withColumn("metric", metric_of(F.col("file_path"))).drop("file_path")
        long = sniff.extract_series(named, keep=("metric",)).where(F.col("metric").isNotNull())
        out = long if out is None else out.unionByName(long)
    return out


def read_processed(spark: SparkSession, path: str, column: str = "timestamp") -> DataFrame | None:
    """A processed table with its timestamps parsed and bad rows dropped; None if it is missing."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return drop_bad_times(df, column)


def drop_bad_times(df: DataFrame, column: str = "timestamp") -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, sniff.to_timestamp(df, column)).where(F.col(column).isNotNull())


# Columns each table of a forecast bundle must have.
BUNDLE_COLUMNS = {"actual": ("ds", "y"), "without_holidays": ("ds", "yhat"), "with_holidays": ("ds", "yhat"),
                  "events": ("ds",)}


def forecast_bundle(tables: dict[str, DataFrame | None]) -> dict[str, DataFrame | None]:
    """Keep each table that has its columns, with good days only; anything else is None."""
    out = {}
    for name, needed in BUNDLE_COLUMNS.items():
        df = tables.get(name)
        usable = df is not None and set(needed) <= set(df.columns)
        out[name] = drop_bad_times(df, "ds").withColumn("ds", F.to_date("ds")) if usable else None
    return out


def union_splits(train: DataFrame, test: DataFrame | None) -> DataFrame:
    return train if test is None else train.unionByName(test, allowMissingColumns=True)


def sources_per_metric(files: DataFrame, by=("metric",)) -> DataFrame:
    """The files each metric comes from, one row a file."""
    return files.select(*by, "file_name").distinct()


def joined_sources(sources: DataFrame, by=("metric",)) -> DataFrame:
    """The file names of ``sources_per_metric`` as one sorted text, for reports over few files."""
    return sources.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list("file_name")), ", ").alias("sources"))


def sample_rows(df: DataFrame, n: int, source: str, order_hash, tie: str, salts: int = 64) -> DataFrame:
    """At most ``n`` rows per source, picked by a hash of the row: same rows on every run.

    A large source is first thinned to ``n`` rows in each of ``salts`` parts, so
    no task ever sorts a whole source.
    """
    picked = df.withColumn("_h", order_hash).withColumn("_salt", F.pmod(F.xxhash64(tie), F.lit(salts)))
    for part in ([source, "_salt"], [source]):
        w = Window.partitionBy(*part).orderBy("_h", tie)
        picked = picked.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    return picked.drop("_h", "_r", "_salt")


def _named(user: str, df: DataFrame):
    return F.coalesce(F.col(user).cast("string"), F.lit(NO_USER)) if user in df.columns else F.lit(NO_USER)


def clean_heart_rate(raw: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Raw readings -> ``user_id, metric, ts, value`` in UTC and within physiological limits."""
    ts, value = sniff.raw_columns(raw, ("heart_rate",))
    number = to_number(F.col(value)) if value else F.lit(None).cast("double")
    rows = raw.select(_named("user_id", raw).alias("user_id"), F.lit(HEART_RATE).alias("metric"),
                      parse_to_utc(F.col(ts), zone=zone).alias("ts"), number.alias("value"))
    return physiological(rows.where(F.col("ts").isNotNull()))


def clean_steps(raw: DataFrame, zone: str = LOCAL_ZONE, drop_negative: bool = False) -> DataFrame:
    """Raw step rows in UTC; bad numbers count as 0."""
    ts, value = sniff.raw_columns(raw, ("steps",))
    number = to_number_or_zero(F.col(value)) if value else F.lit(0.0)
    rows = raw.select(_named("user_id", raw).alias("user_id"), F.lit(STEPS).alias("metric"),
                      parse_to_utc(F.col(ts), zone=zone).alias("ts"), number.alias("value"))
    rows = rows.where(F.col("ts").isNotNull())
    return rows.where(F.col("value") >= 0) if drop_negative else rows


def clean_sleep(raw: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Raw sleep rows -> intervals ``user_id, start, end`` in UTC; empty if no interval columns exist."""
    found = sniff.interval_columns(raw.columns)
    if found is None:
        schema = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("start", T.TimestampType()),
                               T.StructField("end", T.TimestampType())])
        return empty(raw.sparkSession, schema)
    start, end = (parse_to_utc(F.col(c), zone=zone) for c in found)
    return (raw.select(_named("user_id", raw).alias("user_id"), start.alias("start"), end.alias("end"))
            .where(F.col("start").isNotNull() & F.col("end").isNotNull()))


def append_by_metric(routed: DataFrame, path: str) -> None:
    """Append routed rows, one directory per metric."""
    routed.write.mode("append").partitionBy("metric").parquet(path)


def write_splits(df: DataFrame, path: str) -> None:
    """Full table once, partitioned by ``split``: train and test are its two directories."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json_reports(reports: DataFrame, path: str) -> None:
    """One JSON document a row."""
    reports.select(F.to_json(F.struct(*reports.columns)).alias("value")).write.mode("overwrite").text(path)


def with_data_type(df: DataFrame, metric: str = "metric") -> DataFrame:
    """Rows of all metrics in one table, the metric in ``data_type``."""
    return df.withColumnRenamed(metric, "data_type")
