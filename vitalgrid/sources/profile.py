"""Profiles of tables: nulls, types, size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def null_counts(df: DataFrame, top: int | None = None) -> DataFrame:
    """Type and number of nulls of each column, most nulls first (the first ``top``, if given); one pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                              F.col(f"`{f.name}`").alias("nulls")) for f in df.schema])
    listed = counts.select(F.inline(rows)).orderBy(F.desc("nulls"), "column")
    return listed if top is None else listed.limit(top)


def overview(df: DataFrame) -> DataFrame:
    """Number of rows and the column list as one row."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", F.lit(", ".join(df.columns)).alias("columns"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"))


def head(df: DataFrame, order, n: int = 8) -> DataFrame:
    """The first ``n`` rows in a given order."""
    return df.orderBy(*order).limit(n)
