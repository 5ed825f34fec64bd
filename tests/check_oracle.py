"""Runs registered queries next to their SQL on DuckDB: ``python tests/check_oracle.py [sf] [name part ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def make_spark(partitions: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").appName("check")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", "/tmp/wattspan-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        # Value hashes tell the two zeros apart.
        return "-0.0" if v == 0 and math.copysign(1, v) < 0 else float(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, plain(x)) for k, x in v.asDict().items()))
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def family(v):
    return "null" if v is None else type(v).__name__


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns {sorted(spark_cols)} vs {sorted(duck_cols)}"
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} vs {len(duck_rows)}"
    si = [spark_cols.index(c) for c in sorted(spark_cols)]
    di = [duck_cols.index(c) for c in sorted(duck_cols)]
    key = lambda row: tuple((v is None, str(type(v)) if v is not None else "", v if v is not None else 0) for v in row)
    norm = lambda rows, idx: [tuple(plain(row[i]) for i in idx) for row in rows]
    a, b = norm(spark_rows, si), norm(duck_rows, di)
    a.sort(key=lambda x: repr(key(x))), b.sort(key=lambda x: repr(key(x)))
    bad = [(x, y) for x, y in zip(a, b) if x != y or [family(v) for v in x] != [family(v) for v in y]]
    return f"{len(bad)} rows differ, e.g. {sorted(spark_cols)}\n   spark {bad[0][0]}\n   duck  {bad[0][1]}" if bad else None


def run(spark, con, sf, name, queries, oracles):
    df = queries[name](spark, sf)
    rows = [tuple(x) for x in df.collect()]
    if name not in oracles:
        return len(rows), None
    cur = con.execute(oracles[name])
    cols = [d[0] for d in cur.description]
    return len(rows), compare(rows, df.columns, cur.fetchall(), cols)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    parts = sys.argv[2:]
    import __spark_entry__ as e

    folder = f"/root/testdata/sf{sf}"
    spark, con = make_spark(), duck(folder)
    q, o = e.queries(), e.oracle_sql()
    names = [n for n in q if not parts or any(p == n or (p.endswith("*") and n.startswith(p[:-1])) for p in parts)]
    failed = []
    for n in names:
        t0 = time.time()
        try:
            rows, diff = run(spark, con, folder, n, q, o)
        except Exception as ex:
            rows, diff = -1, "".join(traceback.format_exception_only(ex))[:900] if not os.environ.get("TRACE") else traceback.format_exc()
        mark = "FAIL" if diff else ("ok  " if n in o else "rows")
        print(f"{mark} {n} rows={rows} {time.time() - t0:.2f}s {diff or ''}", flush=True)
        if diff:
            failed.append(n)
    print(f"{len(names) - len(failed)}/{len(names)} good; failed: {failed}")


if __name__ == "__main__":
    main()
