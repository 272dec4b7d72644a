"""Exact nearest neighbours within large groups, by a join over pivots.

Some rows of a group are its pivots; every row belongs to the cell of its nearest pivot. The distances of the rows nearest
to each pivot bound how far the k-th neighbour of any row of a cell can be, and the triangle inequality then says which
rows may be neighbours of some row of the cell: only those are sent there. Cells are compared in tiles, so no task holds
a whole cell, however many rows crowd in it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from vitalgrid.session import stored

#: Most pivots of a group, rows placed together, and rows of either side of a tile.
PIVOTS, PLACED, TILE = 256, 20_000, 2_000


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances, from differences: equal vectors are at distance zero."""
    out = np.empty((len(a), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for lo in range(0, len(a), step):
        out[lo : lo + step] = np.sqrt(((a[lo : lo + step, None, :] - b[None, :, :]) ** 2).sum(-1))
    return out


def _place(keys):
    def place(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return rows.reindex(columns=[*keys, "src", "x", "chunk", "cell", "d"])
        d = distances(np.stack(rows["x"].to_list()), np.stack(pivots["px"].to_list()))
        near = d.argmin(1)
        return rows.assign(cell=pivots["cell"].to_numpy()[near], d=d[np.arange(len(d)), near])
    return place


def _bounds(k: int):
    """For each cell, how far the k-th neighbour of one of its rows can be: through the rows nearest to all pivots."""
    def bound(pdf: pd.DataFrame) -> pd.DataFrame:
        between = distances(*[np.stack(pdf["px"].to_list())] * 2)
        first = [np.asarray(f) for f in pdf["first"]]
        far = []
        for i in range(len(pdf)):
            up = np.concatenate([pdf["radius"].iloc[i] + between[i, j] + f for j, f in enumerate(first)])
            # a row is not its own neighbour, so one more is needed
            far.append(np.partition(up, k)[k] if len(up) > k else np.inf)
        return pdf.assign(far=far).drop(columns=["first"])
    return bound


def _send(keys):
    def send(rows: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=[*keys, "dst", "y", "to"])
        d = distances(np.stack(rows["x"].to_list()), np.stack(cells["px"].to_list()))
        least = d - cells["radius"].to_numpy()  # no row of the cell is closer
        row, cell = np.nonzero(least <= cells["far"].to_numpy() * (1 + 1e-12) + 1e-12)
        out = rows[[*keys, "src", "x"]].iloc[row].rename(columns={"src": "dst", "x": "y"})
        return out.assign(to=cells["cell"].to_numpy()[cell])
    return send


def _tile(keys, k: int):
    def tile(rows: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(others):
            return pd.DataFrame(columns=[*keys, "src", "dst", "d"])
        others = others.sort_values("dst")
        ids, own = others["dst"].to_numpy(), rows["src"].to_numpy()
        d = distances(np.stack(rows["x"].to_list()), np.stack(others["y"].to_list()))
        d[own[:, None] == ids[None, :]] = np.inf
        best = np.argsort(d, axis=1, kind="stable")[:, :k]  # ties by id
        found = np.take_along_axis(d, best, 1)
        row, place = np.nonzero(np.isfinite(found))
        return pd.DataFrame({**{c: rows[c].iloc[0] for c in keys}, "src": own[row], "dst": ids[best[row, place]], "d": found[row, place]})
    return tile


def nearest(matrix: DataFrame, by, row_id: str, x: str, k: int) -> DataFrame:
    """by, src, dst, d: the k nearest other rows of each row of a group (all, if fewer), ties to the smaller id.

    Ids are whole numbers, unique in a group. Exact: what is not sent to a cell is farther from all its rows than their
    k-th neighbour.
    """
    by = list(by)
    fields = ", ".join(f"`{c}` {matrix.schema[c].dataType.simpleString()}" for c in by)
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    rows = matrix.select(*by, F.col(row_id).cast("long").alias("src"), F.col(x).cast("array<double>").alias("x"))
    rows = stored(rows.withColumn("_n", n), "knn-rows")
    order = Window.partitionBy(*by).orderBy(F.xxhash64("src"), "src")
    pivots = stored(rows.withColumn("cell", F.row_number().over(order)).where((F.col("cell") <= PIVOTS) & (F.col("cell") <= F.ceil(F.sqrt("_n"))))
                    .select(*by, "cell", F.col("x").alias("px"), F.ceil(F.col("_n") / PLACED).cast("int").alias("chunks")), "knn-pivots")
    chunk = F.pmod(F.xxhash64("src"), F.ceil(F.col("_n") / PLACED)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    placed = stored(rows.select(*by, "src", "x", chunk.alias("chunk")).groupBy(*by, "chunk")
                    .cogroup(pivots.select(*by, "cell", "px", every).groupBy(*by, "chunk"))
                    .applyInPandas(_place(by), f"{fields}, src long, x array<double>, chunk int, cell int, d double"), "knn-placed")
    in_cell = Window.partitionBy(*by, "cell").orderBy("d", "src")
    first = (placed.select(*by, "cell", "d", "src").withColumn("_r", F.row_number().over(in_cell)).where(F.col("_r") <= k + 1)
             .groupBy(*by, "cell").agg(F.collect_list("d").alias("first")))
    radius = placed.groupBy(*by, "cell").agg(F.max("d").alias("radius"), F.count(F.lit(1)).alias("rows"))
    cells = (pivots.join(first, [*by, "cell"]).join(radius, [*by, "cell"]).groupBy(*by)
             .applyInPandas(_bounds(k), f"{fields}, cell int, px array<double>, chunks int, radius double, rows long, far double"))
    cells = stored(cells, "knn-cells")
    sent = stored(placed.groupBy(*by, "chunk").cogroup(cells.select(*by, "cell", "px", "radius", "far", every).groupBy(*by, "chunk"))
                  .applyInPandas(_send(by), f"{fields}, dst long, y array<double>, to int"), "knn-sent")
    sizes = (sent.groupBy(*by, F.col("to").alias("cell")).agg(F.count(F.lit(1)).alias("others")).join(cells.select(*by, "cell", "rows"), [*by, "cell"])
             .select(*by, "cell", F.ceil(F.col("rows") / TILE).cast("int").alias("a"), F.ceil(F.col("others") / TILE).cast("int").alias("b")))
    left = (placed.join(sizes, [*by, "cell"]).select(*by, "cell", "src", "x", F.pmod(F.xxhash64("src"), "a").cast("int").alias("ta"), F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("tb")))
    right = (sent.withColumnRenamed("to", "cell").join(sizes, [*by, "cell"])
             .select(*by, "cell", "dst", "y", F.explode(F.sequence(F.lit(0), F.col("a") - 1)).alias("ta"), F.pmod(F.xxhash64("dst"), "b").cast("int").alias("tb")))
    tile = [*by, "cell", "ta", "tb"]
    found = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(_tile(by, k), f"{fields}, src long, dst long, d double")
    best = Window.partitionBy(*by, "src").orderBy("d", "dst")
    return found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).drop("_r")
