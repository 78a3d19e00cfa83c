"""Compares registered queries with their SQL twins: python tests/oracle.py [sf] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v + 0.0:.9g}"
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    if isinstance(v, dict):
        return str({k: norm(x) for k, x in v.items()})
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = rows_of(list(rel.columns), rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    diff = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if diff:
        return f"{len(diff)} of {len(got[1])} rows differ, e.g. {got[0]}: {diff[0]}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = sf if "/" in sf else f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(e.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        t = time.time()
        try:
            if name in e.oracle_sql():
                problem = compare(spark, con, sf_dir, e.queries()[name], e.oracle_sql()[name])
                note = "ok" if problem is None else f"FAIL {problem}"
            else:
                df = e.queries()[name](spark, sf_dir)
                note = f"rows only: {len(df.collect())}"
        except Exception as ex:  # noqa: BLE001
            note = f"ERROR {type(ex).__name__}: {str(ex)[:1500]}"
        bad += note.startswith(("FAIL", "ERROR"))
        print(f"{name:28s} {time.time() - t:6.1f}s {note}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
