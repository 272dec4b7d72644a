"""Density clusters send a vector to few places."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import cluster as CL

RNG = np.random.default_rng(5)


def frame(spark, groups):
    rows = [(g, i, [float(v) for v in x]) for g, xs in groups.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "g long, rid long, x array<double>").repartition(3)


def blobs(n, dims=6):
    return RNG.normal(0, 3, (4, dims))[RNG.integers(0, 4, n)] + RNG.normal(0, 0.2, (n, dims))


def brute(xs, eps, least):
    close = np.sqrt(((xs[:, None] - xs[None]) ** 2).sum(-1)) <= eps
    core = close.sum(1) >= least
    label = np.where(core, np.arange(len(xs)), len(xs))
    for _ in xs:
        label = np.where(core, np.where(close & core, label, len(xs)).min(1), len(xs))
    border = np.where(close & core, label, len(xs)).min(1)
    return [int(v) if v < len(xs) else -1 for v in np.where(core, label, border)]


@pytest.mark.parametrize("one_cell", [1, 20, 1_000])
def test_labels_do_not_depend_on_the_group_size_that_needs_cells(spark, one_cell):
    groups = {1: blobs(60), 2: np.repeat(blobs(5), 3, axis=0), 3: blobs(1), 4: RNG.normal(0, 3, (30, 6))}
    labels = CL.density_labels(frame(spark, groups), ("g",), "rid", eps=0.8, min_samples=3, one_cell=one_cell)
    got = {(r.g, r.rid): r.dbscan for r in labels.collect()}
    assert got == {(g, i): v for g, xs in groups.items() for i, v in enumerate(brute(xs, 0.8, 3))}


def test_vectors_of_small_groups_are_sent_once(spark, monkeypatch):
    monkeypatch.setattr(CL, "close_candidates", lambda *a: pytest.fail("no group needs cells"))
    points = frame(spark, {1: blobs(40), 2: blobs(30)}).withColumnRenamed("rid", "pid").withColumn("w", F.lit(1))
    assert CL.near_candidates(points, ("g",), "x", 1.0).count() == 40**2 + 30**2


def test_points_are_only_sent_to_cells_that_hold_points(spark):
    rows = [(1, i, 5 * (i // 2), i % 2, 0) for i in range(40)]
    placed = spark.createDataFrame(rows, "g long, pid long, c0 long, c1 long, c2 long")
    sent = CL.occupied_neighbours(placed, ("g",), ("c0", "c1", "c2")).withColumn("_to", F.explode("_to"))
    assert sent.count() == 80  # 27 cells around each point would be 1,080
    assert sent.where(F.abs(F.col("_to.c0") - F.col("c0")) + F.abs(F.col("_to.c1") - F.col("c1")) > 1).isEmpty()
