"""Session settings the operators rely on."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUNS: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the zone: all timestamps in this library are UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, else a folder below the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def run_dir(spark: SparkSession) -> str:
    """This application's own folder in the shared one; removed when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _RUNS:
        _RUNS[app] = f"{shared_dir(spark).rstrip('/')}/vitalgrid-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove, spark, _RUNS[app])
    return _RUNS[app]


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:  # the session was stopped before
        return
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder for an intermediate table."""
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write a frame to the shared folder and read it back: computed once, no lineage, size known."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, label: str, tasks: int, keys, codec: str = "zstd") -> DataFrame:
    """``stored`` in buckets by ``keys``: windows, groups and joins on them shuffle nothing. Give it rows that are dealt so."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.bucketBy(tasks, *keys).option("path", path).option("compression", codec).saveAsTable(name)
    atexit.register(_forget, spark, name)
    return spark.table(name)


def _forget(spark: SparkSession, name: str) -> None:
    if spark.sparkContext._jsc is not None:
        spark.sql(f"drop table if exists {name}")
