"""Run a registered query on Spark and its oracle on DuckDB over the same
parquet tables; compare column names, types and the multiset of rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def spark_type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, T.IntegerType):
        return "INTEGER"
    if isinstance(dt, T.ShortType):
        return "SMALLINT"
    if isinstance(dt, T.DoubleType):
        return "DOUBLE"
    if isinstance(dt, T.FloatType):
        return "FLOAT"
    if isinstance(dt, T.StringType):
        return "VARCHAR"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, T.TimestampNTZType):
        return "TIMESTAMP"
    if isinstance(dt, T.TimestampType):
        return "TIMESTAMP WITH TIME ZONE"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, T.ArrayType):
        return spark_type_name(dt.elementType) + "[]"
    return dt.simpleString().upper()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, Decimal):
        return ("D", str(v))
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark, name: str, sf_dir: str, fn, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_rows = df.collect()
    t1 = time.time()
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    d_types = [str(t) for t in con.execute(f"DESCRIBE {sql}").fetchall() and
               [r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()]]
    s_cols = df.columns
    s_types = [spark_type_name(f.dataType) for f in df.schema.fields]
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2)}
    s_schema = sorted(zip(s_cols, s_types))
    d_schema = sorted(zip(d_cols, d_types))
    res["schema_ok"] = s_schema == d_schema
    if not res["schema_ok"]:
        res["schema_spark"], res["schema_oracle"] = s_schema, d_schema
    order_s = sorted(range(len(s_cols)), key=lambda k: s_cols[k])
    order_d = sorted(range(len(d_cols)), key=lambda k: d_cols[k])
    cs = Counter(tuple(_norm(r[k]) for k in order_s) for r in s_rows)
    cd = Counter(tuple(_norm(r[k]) for k in order_d) for r in d_rows)
    res["values_ok"] = cs == cd
    if not res["values_ok"]:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        res["only_spark"], res["only_oracle"] = [repr(x) for x in only_s], [repr(x) for x in only_d]
    res["ok"] = res["schema_ok"] and res["values_ok"] and len(s_rows) == len(d_rows)
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tideline.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in os_:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"{name:24s} rows-only rows={n} sec={time.time()-t0:.2f}")
            continue
        try:
            r = compare(spark, name, sf_dir, fn, os_[name], con)
        except Exception as e:  # report and go on
            bad += 1
            print(f"{name:24s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        bad += not r["ok"]
        print(f"{name:24s} {'OK ' if r['ok'] else 'BAD'} rows={r['spark_rows']}/{r['oracle_rows']} "
              f"sec={r['spark_sec']}" + ("" if r["ok"] else f" {r}"))
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
