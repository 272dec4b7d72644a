import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import axes as AX, cluster as CL, knn as K

RNG = np.random.default_rng(11)


def frame(spark, groups):
    rows = [(g, i, [float(v) for v in x]) for g, xs in groups.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "g long, rid long, x array<double>").repartition(3)


def blobs(n, dims=10, spread=0.3):
    centres = RNG.normal(0, 4, (5, dims))
    return centres[RNG.integers(0, 5, n)] + RNG.normal(0, spread, (n, dims))


def brute_nearest(xs, k):
    d = np.sqrt(((xs[:, None] - xs[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, : min(k, len(xs) - 1)]
    return {(i, int(j)) for i, js in enumerate(order) for j in js}


def test_nearest_against_all_pairs(spark, monkeypatch):
    """Crowds of equal vectors, groups of fewer rows than k, and tiles smaller than a cell."""
    for name, value in (("PLACED", 60), ("TILE", 25)):
        monkeypatch.setattr(K, name, value)
    groups = {1: blobs(250), 2: np.repeat(blobs(4), 30, axis=0), 3: blobs(5), 4: blobs(1)}
    got = K.nearest(frame(spark, groups), ("g",), "rid", "x", 7).collect()
    for g, xs in groups.items():
        assert {(r.src, r.dst) for r in got if r.g == g} == brute_nearest(xs, 7)


def test_only_near_cells_are_sent(spark, monkeypatch):
    """Far clusters are never compared: the cells see a small share of all pairs."""
    tables = {}
    monkeypatch.setattr(K, "stored", lambda df, label, f=K.stored: tables.setdefault(label, f(df, label)))
    xs = blobs(2_000, 6, 0.05)
    got = K.nearest(frame(spark, {1: xs}), ("g",), "rid", "x", 5)
    assert {(r.src, r.dst) for r in got.collect()} == brute_nearest(xs, 5)
    sent = tables["knn-sent"].groupBy(F.col("to").alias("cell")).count()
    pairs = sent.join(tables["knn-cells"], "cell").agg(F.sum(F.col("count") * F.col("rows"))).first()[0]
    assert pairs < 0.3 * 2_000**2


def test_factor_by_joins_equals_one_task(spark):
    groups = {1: blobs(120), 2: np.vstack([blobs(80), RNG.normal(0, 9, (3, 10))])}
    df = frame(spark, groups)
    near = {(r.g, r.rid): r for r in CL.local_outlier_factor(df, ("g",), "rid").collect()}
    far = {(r.g, r.rid): r for r in CL.local_outlier_factor(df, ("g",), "rid", one_task=100).collect()}
    assert set(near) == set(far) and len(near) == 203
    cut = {g: np.quantile([-r.lof for r in near.values() if r.g == g], 0.05) for g in groups}
    for key, r in near.items():
        assert far[key].lof == pytest.approx(r.lof, rel=1e-9)
        # sums in another order may part rows that tie with the cut
        assert far[key].lof_label == r.lof_label or abs(r.lof + cut[r.g]) < 1e-9
    assert sum(r.lof_label for r in near.values()) < 0


def test_axes_keep_distances(spark):
    xs = blobs(200, 9)
    found = AX.principal_axes(frame(spark, {1: xs}), "x", 9)
    assert np.allclose(found @ found.T, np.eye(9), atol=1e-9)
    spread = (xs @ found.T).var(0)
    assert (np.diff(spread) < 1e-9).all()
    got = frame(spark, {1: xs}).orderBy("rid").select(AX.along(F.col("x"), found).alias("a")).collect()
    assert np.allclose([r.a for r in got], xs @ found.T)


def brute_density(xs, eps, least):
    d = np.sqrt(((xs[:, None] - xs[None]) ** 2).sum(-1)) <= eps
    core = d.sum(1) >= least
    label = np.where(core, np.arange(len(xs)), -1)
    for _ in xs:
        label = np.array([min([label[j] for j in range(len(xs)) if d[i, j] and core[j]]) if core[i] else -1 for i in range(len(xs))])
    border = [min([label[j] for j in range(len(xs)) if d[i, j] and core[j]], default=-1) for i in range(len(xs))]
    return [int(a if c else b) for a, b, c in zip(label, border, core)]


def test_density_in_many_dimensions(spark):
    groups = {1: blobs(70, 20, 0.2), 2: np.repeat(blobs(6, 20), 3, axis=0), 3: blobs(2, 20)}
    df = frame(spark, groups)
    for eps, least in ((1.0, 2), (1.4, 4)):
        got = {(r.g, r.rid): r.dbscan for r in CL.density_labels(df, ("g",), "rid", eps=eps, min_samples=least).collect()}
        for g, xs in groups.items():
            assert [got[g, i] for i in range(len(xs))] == brute_density(xs, eps, least)


def test_candidates_are_few(spark):
    """In 26 dimensions at most five times the pairs that are really close reach the whole distance."""
    xs = np.vstack([blobs(600, 26, 0.1), RNG.normal(0, 1, (600, 26))])
    points = frame(spark, {1: xs}).withColumnRenamed("rid", "pid").withColumn("w", F.lit(1))
    pairs = CL.close_candidates(points, ("g",), "x", 1.0).select("src", "dst").collect()
    d = np.sqrt(((xs[:, None] - xs[None]) ** 2).sum(-1))
    close = {(int(i), int(j)) for i, j in zip(*np.nonzero(d <= 1.0))}
    got = {(r.src, r.dst) for r in pairs}
    assert len(got) == len(pairs) and close <= got and len(got) <= 5 * len(close)


def test_lloyd_equals_grouped_pandas(spark):
    rows = [(g, "m", i, [float(v) for v in x]) for g, n in ((1, 40), (2, 3), (3, 1)) for i, x in enumerate(blobs(n, 5))]
    df = spark.createDataFrame(rows, "user_id long, metric string, win long, x array<double>").repartition(4)
    want = {(r.user_id, r.win): r.kmeans for r in CL.kmeans_labels(df).collect()}
    centres = CL.spaced_centres(df, ("user_id",), ("metric", "win"), "x", 4)
    got, ends = CL.lloyd(df, centres, ("user_id",))
    assert {(r.user_id, r.win): r.kmeans for r in got.collect()} == want
    assert ends.where("user_id = 2").count() == 3


def test_scattered_centres_find_the_blobs(spark):
    centres = np.array([[0.0, 0], [20, 0], [0, 20], [20, 20]])
    xs = np.vstack([c + RNG.normal(0, 0.5, (60, 2)) for c in centres])
    df = frame(spark, {1: xs})
    start = CL.scattered_centres(df, ("rid",), "x", 4)
    assert start == CL.scattered_centres(df.repartition(5), ("rid",), "x", 4)
    table = spark.createDataFrame([(j, c) for j, c in enumerate(start)], "j int, c array<double>")
    got, _ = CL.lloyd(df, table, ())
    labels = pd.DataFrame([(r.rid // 60, r.kmeans) for r in got.collect()], columns=["blob", "label"])
    assert labels.groupby("blob")["label"].nunique().max() == 1 and labels["label"].nunique() == 4
    assert CL.scattered_centres(df.limit(0), ("rid",), "x", 4) == []
