import numpy as np
from pyspark.sql import functions as F

from vitalgrid.llm import neighbours as N


def brute(rows, k):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, x in ok.items():
        if q % 20 == 0:
            scores = sorted(((-float(np.cumsum(x * y)[-1]), i) for i, y in ok.items() if i != q))[:k]
            out[q] = [(i, -s) for s, i in scores]
    return out


def run(spark, rows, k=20):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("q", F.lit(1))
    out = {}
    for r in sorted(N.nearest(df.repartition(3), F.col("vec_id") % 20 == 0, k).collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_exact_with_ties_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(N, "QUERY_BLOCK", 8)
    monkeypatch.setattr(N, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(N, "STRIP", 2)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 24)).astype(np.float32)
    x[50:90] = x[20]
    x[100:110] *= 1000
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert run(spark, rows) == brute(rows, 20)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (20, [0.0, 0.0]), (40, None), (60, [1.0, None]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]),
            (1, [3.0, 4.0]), (2, [3.0, 4.0]), (2, [3.0, 4.0]), (None, [1.0, 1.0]), (120, [-1.0, 0.5])]
    assert run(spark, rows) == brute(rows, 20)
    assert run(spark, [*rows, (140, [9.0])]) == brute(rows, 20)
    assert run(spark, rows[:1]) == {}
    assert run(spark, []) == {}


def test_every_length_is_searched(spark, monkeypatch):
    monkeypatch.setattr(N, "QUERY_BLOCK", 2)
    monkeypatch.setattr(N, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(N, "STRIP", 2)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=24).astype(np.float32).tolist()) for i in range(200)]
    others = [(i, rng.normal(size=7).astype(np.float32).tolist()) for i in range(200, 250)]
    want = brute(rows, 5) | brute(others, 5)
    assert len(want) == 13 and run(spark, [*rows, *others, (999, [1.0] * 25)], 5) == want
    assert run(spark, [*rows, (1000, [1.0] * 25)], 5) == brute(rows, 5)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(50, 64)) * 10, rng.normal(size=(60, 64)) * 0.01
    (qc, qs, qn, qm), (cc, cs, cn, cm) = N.codes(x), N.codes(y)
    near = qc.astype(float) @ cc.astype(float).T * qs[:, None] * cs
    assert (abs(near - x @ y.T) <= qm[:, None] * (cn + cm) + qn[:, None] * cm + 1e-12).all()
