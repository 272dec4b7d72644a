"""Ordered scans over long series that never put a whole series into one task.

A window over ``partitionBy(user_id, metric)`` sorts a complete series in one
task; a single busy device could make that a third of all rows. The helpers
here cut a series into time chunks, aggregate each chunk to one summary row,
run the window over the summaries only, and hand every chunk the state it
needs from its neighbours. Row windows inside a chunk do the rest.

Daily series are different: they hold at most one row per calendar day, so
plain windows per series are already bounded there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.schema import KEYS
from vitalgrid.session import stored

CHUNK = "_chunk"


def chunked(df: DataFrame, ts: str = "ts", unit: str = "hour") -> DataFrame:
    return df.withColumn(CHUNK, F.date_trunc(unit, F.col(ts)))


def before(keys=KEYS, chunk: str = CHUNK):
    return (Window.partitionBy(*keys).orderBy(chunk)
            .rowsBetween(Window.unboundedPreceding, -1))


def after(keys=KEYS, chunk: str = CHUNK):
    """Backwards order: a frame that runs to the end would be re-read for every row."""
    return (Window.partitionBy(*keys).orderBy(F.desc(chunk))
            .rowsBetween(Window.unboundedPreceding, -1))


def whole(keys=KEYS):
    return Window.partitionBy(*keys)


def summaries(df: DataFrame, aggs: dict[str, Column], keys=KEYS, chunk: str = CHUNK) -> DataFrame:
    """One row per chunk; partial aggregation does most of the work map-side."""
    return df.groupBy(*keys, chunk).agg(*[e.alias(n) for n, e in aggs.items()])


def hand_over(df: DataFrame, per_chunk: DataFrame, context: dict[str, Column], keys=KEYS,
              chunk: str = CHUNK) -> DataFrame:
    """Give each row of ``df`` the context computed over its series' summaries."""
    ctx = per_chunk.select(*keys, chunk, *[e.alias(n) for n, e in context.items()])
    return df.join(ctx, [*keys, chunk])


def number_rows(df: DataFrame, order, keys=KEYS, ts: str = "ts", unit: str = "hour") -> DataFrame:
    """Add ``rn`` (1-based position in the series) and ``n_rows`` (its length)."""
    local = chunked(df, ts, unit).withColumn(
        "_rn", F.row_number().over(Window.partitionBy(*keys, CHUNK).orderBy(*order)))
    counts = summaries(local, {"_n": F.count(F.lit(1))}, keys)
    numbered = hand_over(local, counts, {
        "_offset": F.coalesce(F.sum("_n").over(before(keys)), F.lit(0)),
        "n_rows": F.sum("_n").over(whole(keys)),
    }, keys)
    return (numbered.withColumn("rn", F.col("_offset") + F.col("_rn"))
            .drop("_rn", "_offset", CHUNK))


def row_blocks(df: DataFrame, halo_before: int = 0, halo_after: int = 0,
               size: int = 100_000) -> DataFrame:
    """Split numbered rows into blocks of ``size`` for fixed row frames.

    Rows near a block edge are copied into the neighbouring block with
    ``_halo`` set, so a frame of up to ``halo_before`` rows back and
    ``halo_after`` rows ahead is complete for every row that is not halo.
    """
    if max(halo_before, halo_after) > size:
        raise ValueError("the halo must fit into one block")
    block = F.floor((F.col("rn") - 1) / size).cast("long")
    inside = (F.col("rn") - 1) % size

    def copy(number: Column, is_halo: bool) -> Column:
        return F.struct(number.alias("block"), F.lit(is_halo).alias("halo"))

    copies = [copy(block, False)]
    if halo_before:
        copies.append(F.when((inside >= size - halo_before) & (F.col("rn") < F.col("n_rows")),
                             copy(block + 1, True)))
    if halo_after:
        copies.append(F.when((inside < halo_after) & (block > 0), copy(block - 1, True)))
    return (df.withColumn("_copy", F.explode(F.array_compact(F.array(*copies))))
            .select("*", F.col("_copy.block").alias("_block"), F.col("_copy.halo").alias("_halo"))
            .drop("_copy"))


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col("_halo")).drop("_halo", "_block")


#: Rows of daily series that one task sorts and scans.
TASK_ROWS = 200_000

#: Samples of a series that one task windows whole; longer series are cut into chunks.
WHOLE_ROWS = 200_000

#: Cells that series are counted in before any is counted by itself.
CELLS = 1 << 14


def long_series(df: DataFrame, keys=KEYS, rows: int = WHOLE_ROWS) -> DataFrame | None:
    """Keys of the series of more than ``rows`` rows, None if there are none.

    Only series in cells of more rows than that are counted, so that as a rule no row a series is shuffled.
    """
    celled = df.withColumn("_cell", F.pmod(F.xxhash64(*keys), F.lit(CELLS)))
    enough = F.col("_n") > rows
    full = stored(celled.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).where(enough).select("_cell"), "full-cells")
    if full.isEmpty():
        return None
    counted = celled.join(full, "_cell", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = stored(counted.where(enough).select(*keys), "long-series")
    return None if found.isEmpty() else found


def of_series(df: DataFrame, series: DataFrame, keys=KEYS, kind: str = "left_semi") -> DataFrame:
    """Rows of the given series, or with ``left_anti`` of all others; a null in a key is a value like others."""
    named = series.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(named, same, kind)


#: Ids that share a cell when repeated ones are looked for.
ID_CELL = 1 << 10


def series_with_repeated_ids(df: DataFrame, row_id: str, keys=KEYS, others: DataFrame | None = None) -> DataFrame | None:
    """Keys of the series that hold an id which comes more than once, in ``others`` too, None if there are none.

    ``df`` is dealt by ``keys``: repeats in a series are found in place. Ids of other series can only repeat in cells
    of ids that more than one series is in; only rows of such cells are shuffled.
    """
    rows = df.select(*keys, row_id)
    rows = rows if others is None else rows.unionByName(others.select(*keys, row_id))
    known = rows.where(F.col(row_id).isNotNull()).withColumns({"_cell": F.floor(F.col(row_id) / ID_CELL), "_of": F.xxhash64(*keys)})
    cells = known.groupBy("_cell").agg(F.min("_of").alias("_lo"), F.max("_of").alias("_hi")).where(F.col("_lo") != F.col("_hi"))
    ids = known.join(cells.select("_cell"), "_cell", "left_semi").groupBy(row_id).agg(F.count(F.lit(1)).alias("_n"))
    twice = stored(ids.where(F.col("_n") > 1).select(row_id), "repeated-ids")
    inside = df.where(F.col(row_id).isNotNull()).groupBy(*keys, row_id).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*keys)
    if not twice.isEmpty():
        inside = inside.unionByName(df.join(twice, row_id, "left_semi").select(*keys))
    found = stored(inside.distinct(), "repeated")
    return None if found.isEmpty() else found


def by_series(df: DataFrame, rows: int, keys=KEYS, task_rows: int = TASK_ROWS) -> DataFrame:
    """Deal whole daily series to tasks by their number of ``rows``: compressed bytes say little of what windows hold.

    Windows, groups and joins on ``keys`` that follow need no other shuffle.
    """
    return df.repartition(tasks_for(df, rows, task_rows), *keys)


def tasks_for(df: DataFrame, rows: int | None = None, task_rows: int = TASK_ROWS) -> int:
    """Tasks to deal the rows of a frame to; they are counted if their number is not given."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-(df.count() if rows is None else rows) // task_rows))


def latest_rows(df: DataFrame, n: int, ds: str = "ds", keys=KEYS) -> DataFrame:
    """The last ``n`` rows of each daily series."""
    newest_first = Window.partitionBy(*keys).orderBy(F.col(ds).desc())
    return (df.withColumn("_back", F.row_number().over(newest_first))
            .where(F.col("_back") <= n).drop("_back"))
