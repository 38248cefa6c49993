"""Run every ``queries()`` entry and its ``oracle_sql()`` twin and compare them
the way the driver does: row count, column names, order-insensitive values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


# Spark type → DuckDB type name the oracle must produce
DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
              "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    o_cols = rel.columns
    o_types = {c: str(t) for c, t in zip(o_cols, rel.types)}
    o_rows = rel.fetchall()
    res["oracle_rows"] = len(o_rows)
    if sorted(s_cols) != sorted(o_cols):
        res["status"] = f"COLUMNS {sorted(s_cols)} vs {sorted(o_cols)}"
        return res
    s_types = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    if s_types != o_types:
        res["status"] = f"TYPES {sorted((k, s_types[k], o_types[k]) for k in s_types if s_types[k] != o_types[k])}"
        return res
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    o_index = {c: i for i, c in enumerate(o_cols)}
    sc = Counter(tuple(_norm(r[i]) for i in order) for r in s_rows)
    oc = Counter(tuple(_norm(r[o_index[s_cols[i]]]) for i in order) for r in o_rows)
    if sc == oc:
        res["status"] = "OK"
    else:
        only_s = list((sc - oc).elements())[:3]
        only_o = list((oc - sc).elements())[:3]
        res["status"] = "VALUES"
        res["cols"] = [s_cols[i] for i in order]
        res["only_spark"] = only_s
        res["only_oracle"] = only_o
    return res


def main(argv):
    import duckdb
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
            .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        print(r, flush=True)
    df = E.entry(spark)
    print({"entry_rows": df.count(), "entry_cols": len(df.columns)})
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
