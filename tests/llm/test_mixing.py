import math

import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import mixing as M


def expected_targets(sizes):
    """Share by weight, cap, reshare the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(2 * sizes[s] for s in capped)
        target = {s: 2 * sizes[s] if s in capped else rest * w[s] / sum(w[x] for x in free) for s in names}
        over = {s for s in free if target[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 500, None: 70}, {"b": 3}, {"a": 0, "b": 9}, {"é": 5, "z": 5, "Z": 5}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in M.targets(df).collect()}
    want = expected_targets(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-6) for k in want)


def corpus(make):
    return make([(i, " ".join(["w"] * (i * 37 % 211)) if i % 50 else None, "en", [None, "a", "b", "hot", "hot", "hot"][i % 6])
                 for i in range(900)])


def test_taken_is_near_target_and_reruns_agree(make):
    df = corpus(make)
    out = M.taken(df).persist()
    assert out.count() == 900 and out.filter("taken > 2 * size or taken < 0 or taken is null").count() == 0
    for r in out.groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect():
        assert abs(r.t - r.target) <= max(2, r.target / 200)
    again = M.taken(df.repartition(5))
    assert out.exceptAll(again).count() == 0


def test_draws_are_disjoint_and_quotas_exact(make):
    rows, plan, draws = M.mix(corpus(make))
    assert draws.groupBy("row_id", "copy", "word_from").count().filter("count > 1").count() == 0
    assert draws.groupBy("row_id").agg(F.max("copy").alias("c")).filter("c > 1").count() == 0


def test_tree_shares_quotas_among_shards(spark):
    plan = spark.createDataFrame([(0, 700, 800), (1, 0, 5), (2, 41, 30)], "source_no int, quota long, blocks long")
    got = M.shard_ranges(plan, 7, 3).collect()
    for no, quota in ((0, 700), (1, 0), (2, 41)):
        ranges = sorted((r.lo, r.hi) for r in got if r.source_no == no)
        assert [x for lo, hi in ranges for x in range(lo, hi)] == list(range(quota))
    totals = [sum(r.hi - r.lo for r in got if r.shard == s) for s in range(7)]
    assert max(totals) - min(totals) <= 1


@pytest.mark.parametrize("n", [1, 2, 30, 1000, 4096])
def test_permutation(spark, n):
    x = spark.range(n).select(M.permuted(F.col("id"), F.lit(n), F.lit(M.multiplier(n)), F.xxhash64(F.lit(9))).alias("p"))
    assert sorted(r.p for r in x.collect()) == list(range(n))


def test_mixed_text_and_edges(odd, make):
    got = M.mixed(odd)
    assert got.columns == odd.columns
    words = sum(len(r.text.split()) for r in got.collect())
    assert words == M.taken(odd).agg(F.sum("taken")).first()[0]
    assert M.taken(make([])).count() == 0 and M.mixed(make([])).count() == 0
    assert M.taken(make([(1, None, None, None)])).collect()[0].taken == 0


def test_shards_are_written_in_shuffled_order(spark, make, tmp_path, monkeypatch):
    """Rows of the mix, each in one shard, in an order that is not that of the input and that reruns repeat."""
    monkeypatch.setattr(M, "SHARD_WORDS", 20_000)
    df = corpus(make)
    M.write_shards(df, str(tmp_path / "a"))
    M.write_shards(df.repartition(5), str(tmp_path / "b"))

    def read(name):
        rows = spark.read.parquet(f"{tmp_path}/{name}").select("number", "row.doc_id", F.size(F.split("row.text", " ")).alias("n"), F.monotonically_increasing_id().alias("at"))
        shards = {}
        for r in rows.orderBy("number", "at").collect():
            shards.setdefault(r.number, []).append((r.doc_id, r.n))
        return shards

    got = read("a")
    assert got == read("b") and len(got) > 3
    assert sorted(x[0] for rows in got.values() for x in rows) == sorted(r.doc_id for r in M.mixed(df).collect())
    sizes = [sum(x[1] for x in rows) for rows in got.values()]
    mean = sum(sizes) / len(sizes)
    assert all(abs(n - mean) < 0.25 * mean for n in sizes)  # whole documents, so not exactly alike
    for rows in got.values():
        steps = [b[0] > a[0] for a, b in zip(rows, rows[1:])]
        assert 0.35 < sum(steps) / len(steps) < 0.65
