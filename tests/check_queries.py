"""Run registered queries next to their check SQL: ``python tests/check_queries.py [sf] [name-prefix ...]``."""

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return 0.0 if v == 0 and math.copysign(1, v) > 0 else float(f"{v:.10g}")
    return str(v) if not isinstance(v, (int, bool)) else v


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(norm(row[i]) for i in order) for row in data), key=repr)


def session(cpus=8):
    return (SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", "8")
            .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
            .config("spark.sql.session.timeZone", "UTC").getOrCreate())


def main(argv):
    sf = argv[0] if argv else "0.01"
    wanted = argv[1:]
    sf_dir = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name, f in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t0 = time.time()
        try:
            df = f(spark, sf_dir)
            cols, got = rows_of(df.columns, [tuple(x) for x in df.collect()])
            t1 = time.time()
            if name not in oracles:
                print(f"rows  {name:40s} {len(got):7d} rows {t1 - t0:6.2f}s")
                continue
            res = con.execute(oracles[name])
            types = {d[0]: str(d[1]) for d in res.description}
            ocols, want = rows_of([d[0] for d in res.description], res.fetchall())
            t2 = time.time()
            kinds = {c: k for c, k in types.items() if k in ("HUGEINT", "DECIMAL") or k.startswith("DECIMAL")}
            ok = cols == ocols and got == want and not kinds and len(got) > 0
            print(f"{'ok   ' if ok else 'FAIL '} {name:40s} {len(got):7d} rows {t1 - t0:6.2f}s duck {t2 - t1:6.2f}s")
            if not ok:
                bad.append(name)
                if cols != ocols:
                    print("   columns", cols, ocols)
                elif kinds:
                    print("   types", kinds)
                else:
                    s, o = set(got), set(want)
                    print("   counts", len(got), len(want), "only spark", sorted(s - o, key=repr)[:3],
                          "\n   only duck", sorted(o - s, key=repr)[:3])
        except Exception as e:
            bad.append(name)
            print(f"ERROR {name}: {str(e)[:1500]}")
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
