"""Spark-vs-DuckDB comparison of registered queries (mirrors the driver's gate).

Columns are sorted by name, then row count, column names and an
order-insensitive multiset of normalised values are compared.

    python -m tests.harness [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    scols, srows = spark_rows(fn(spark, sf_dir))
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    dcols, drows = duck_rows(con, sql)
    res = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "spark_s": round(t1 - t0, 2),
           "cols_ok": scols == dcols}
    cs, cd = Counter(srows), Counter(drows)
    res["ok"] = scols == dcols and cs == cd
    if not res["ok"]:
        res["spark_cols"], res["oracle_cols"] = scols, dcols
        res["only_spark"] = list((cs - cd).elements())[:3]
        res["only_oracle"] = list((cd - cs).elements())[:3]
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from refinery.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    if os.environ.get("HARNESS_VANILLA"):  # a default session, as a caller that sets nothing would have
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    else:
        spark = build_session("local[8]", "harness", 8)
    spark.sparkContext.setLogLevel("ERROR")
    # results must not depend on the session time zone (HARNESS_TZ=America/Sao_Paulo to check)
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("HARNESS_TZ", "UTC"))
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, sf_dir, name, fn, oracle.get(name))
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r["ok"] is False
        print(r, flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
