import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import fixity as X

ROWS = "page_id long, url string, html string, hash string, shard string"


def pages(spark, n, parts=4):
    rows = [(i, f"http://h/{i}", f"<p>page {i}</p>" * (i % 5), "x", "y") for i in range(n)] + [(None, None, None, "x", "y")] * 2
    return spark.createDataFrame(rows, ROWS).repartition(parts)


def test_equal_replicas_have_equal_roots(spark):
    records = X.archive(pages(spark, 300))
    assert X.audit(records, records, X.manifest(records)).count() == 0


@pytest.mark.parametrize("n,parts", [(300, 4), (40, 20), (1, 1)])
def test_damage_is_located(spark, n, parts):
    records = X.archive(pages(spark, n, parts))
    hurt = (records.filter(~F.coalesce(F.col("page_id").isin(3, 77), F.lit(False)))
            .withColumn("record", F.when(F.col("page_id") % 50 == 0, F.concat("record", F.lit("!"))).otherwise(F.col("record"))))
    extra = records.filter("page_id = 0").withColumn("seq", F.col("seq") + 100_000).withColumn("page_id", F.lit(-1).cast("long"))
    got = X.audit(records, hurt.unionByName(extra), X.manifest(records)).collect()
    want = {(i, "missing") for i in (3, 77) if i < n} | {(i, "changed") for i in range(0, n, 50)} | {(-1, "extra")}
    assert {(r.page_id, r.status) for r in got} == want
    assert all((r.sha256_found is None) == (r.status == "missing") for r in got)


def test_order_of_records_counts(spark):
    records = X.archive(pages(spark, 20, 1))
    swapped = records.withColumn("seq", F.when(F.col("seq") == 4, 5).when(F.col("seq") == 5, 4).otherwise(F.col("seq")).cast("long"))
    got = X.audit(records, swapped, X.manifest(records)).collect()
    assert sorted(r.seq for r in got) == [4, 5]


def test_offsets_follow_lengths(spark):
    rows = sorted(X.manifest(X.archive(pages(spark, 50, 3))).collect(), key=lambda r: (r.shard, r.seq))
    for a, b in zip(rows, rows[1:]):
        assert b.lo == (a.hi if a.shard == b.shard else 0)


def test_empty(spark):
    assert X.audited(spark.createDataFrame([], ROWS)).count() == 0
