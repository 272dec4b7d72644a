"""Incremental ingest in several runs, and the entry points."""

import json

from vitalgrid.streaming import ingest


def test_ingest_picks_up_new_files(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    src.mkdir()

    def drop(name, minute, bpm):
        record = {"user_id": "u", "data": {"time": f"2021-09-24T08:{minute:02d}:10", "bpm": bpm}}
        (src / name).write_text(json.dumps(record) + "\n")

    def run():
        samples = ingest.samples_from_records(ingest.read_records(spark, str(src)))
        ingest.append(ingest.minute_table(samples), out, state).awaitTermination()
        return {(r.ts.minute, r.value) for r in spark.read.parquet(out).collect()}

    drop("a.json", 0, 60)
    drop("b.json", 0, 70)
    assert run() == set()
    drop("c.json", 30, 80)
    assert run() == {(30, 65.0)}
    drop("late.json", 0, 500)  # behind the watermark: the finished minute stays as it is
    drop("d.json", 59, 90)
    assert run() == {(30, 65.0), (0, 80.0)}


def test_registered_queries_have_keys():
    import __spark_entry__ as entry

    from vitalgrid.plans import queries as own

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 130
    assert set(own.QUERIES) <= set(queries)
    assert set(own.QUERIES) == set(own.ORACLES)
