"""Run registered queries against their SQL in DuckDB: python -m tests.compare [sf] [names...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("compare")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(norm(r[i]) for i in order) for r in rows])


def compare(spark, con, sf_dir, name, fn, sql):
    """Empty string when equal, else what differs."""
    df = fn(spark, sf_dir)
    got_cols, got = table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if got else "no rows"
    cur = con.execute(sql)
    want_cols, want = table([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {set(got_cols) ^ set(want_cols)}"
    if got != want:
        only_got, only_want = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        return f"rows {len(got)} vs {len(want)}; spark only {only_got}; sql only {only_want}"
    return "" if got else "EMPTY"


def main():
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, oracles = session(), connect(sf_dir), oracle_sql()
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            msg = compare(spark, con, sf_dir, name, fn, oracles.get(name))
        except Exception as e:  # noqa: BLE001
            msg = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(msg)
        print(f"{'FAIL' if msg else 'ok  '} {name} {time.time() - t:.2f}s {msg}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
