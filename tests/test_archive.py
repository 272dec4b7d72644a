import zipfile

import pytest
from pyspark.sql import functions as F

from vitalgrid.sources import archive as A, files, sniff


@pytest.fixture
def folders(tmp_path):
    """The same files packed and unpacked, an empty member, a note, and a file that is no archive."""
    plain, packed = tmp_path / "plain", tmp_path / "packed"
    members = {
        "steps_a/one.csv": "logDate,value\n" + "".join(f"2021-09-{d:02d} 08:00:00,{d * 10}\n" for d in range(1, 20)),
        "steps_a/two.csv": "value,device,logDate\n5,w,2021-10-01 08:00:00\n7,\"w, x\",2021-10-02 08:00:00\n",
        "hr/é.csv": "logDate,value\n2021-09-01 08:00:00,61\n", "sleep/empty.csv": "", "misc/notes.csv": "logDate,value\n2021-09-01 08:00:00,1\n"}
    (packed / "deep").mkdir(parents=True)
    for name, text in members.items():
        (plain / name).parent.mkdir(parents=True, exist_ok=True)
        (plain / name).write_text(text)
    with zipfile.ZipFile(packed / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for name in list(members)[:2]:
            z.writestr(name, members[name])
    with zipfile.ZipFile(packed / "deep/b.zip", "w") as z:
        for name in list(members)[2:]:
            z.writestr(name, members[name])
        z.writestr("readme.txt", "not a table")
    (packed / "broken.zip").write_bytes(b"PK\x03\x04 not an archive")
    (packed / "other.txt").write_text("x")
    return str(plain), str(packed)


def test_members_equal_plain_files(spark, folders):
    plain, packed = folders
    metric = lambda part: sniff.metric_of_file(part)
    want = files.read_series(spark, plain, lambda p: metric(F.element_at(F.split(p, "/"), -2)))
    lines = A.read_lines(spark, packed, "*.csv")
    got = A.read_series(lines, lambda m: metric(F.element_at(F.split(m, "/"), 1)))
    cols = sorted(want.columns)
    assert got.count() == 22
    assert sorted(map(tuple, got.select(cols).collect()), key=repr) == sorted(map(tuple, want.select(cols).collect()), key=repr)
    assert lines.rdd.getNumPartitions() == 6  # five members and the broken archive
    errors = [(r.archive.rsplit("/", 1)[1], r.member) for r in lines.where("error is not null").collect()]
    assert errors == [("broken.zip", None)]
    assert A.read_lines(spark, packed).where("member = 'readme.txt'").first().line == "not a table"
    assert A.read_lines(spark, plain).count() == 0


def test_damaged_member_keeps_what_comes_before(spark, tmp_path):
    path = tmp_path / "d.zip"
    text = "logDate,value\n" + "".join(f"2021-09-01 08:00:00,{i}\n" for i in range(50_000))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("good.csv", text)
        z.writestr("steps.csv", text)
    raw = bytearray(path.read_bytes())
    raw[len(raw) - 3_000] ^= 0xFF  # inside the second member: its check sum fails at the end
    path.write_bytes(bytes(raw))
    rows = A.read_lines(spark, str(path)).groupBy("member").agg(F.count("line").alias("n"), F.max("error").alias("error")).collect()
    by = {r.member: r for r in rows}
    assert by["good.csv"].n == 50_001 and by["good.csv"].error is None
    assert 0 < by["steps.csv"].n < 50_002 and "CRC" in by["steps.csv"].error


def test_written_archives_read_back(spark, tmp_path):
    df = spark.range(0, 1_000, 1, 3).selectExpr("id", "concat('v, ', id) as name")
    out = A.write_archive(df, str(tmp_path / "z"), "part", 100).collect()
    assert sum(r.members for r in out) >= 10
    lines = A.read_lines(spark, str(tmp_path / "z"))
    rows = lines.where("line_no > 0").select(F.from_csv("line", "id long, name string").alias("r")).select("r.*")
    assert sorted(map(tuple, rows.collect())) == [(i, f"v, {i}") for i in range(1_000)]
    assert A.write_archive(df.limit(0), str(tmp_path / "none"), "part").count() == 0
