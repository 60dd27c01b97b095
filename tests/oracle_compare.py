"""Compare a registered Spark query with its DuckDB oracle.

Columns are matched by name (sorted), rows compared as a multiset of
canonical text forms -- the same shape of check the driver makes.
Run as a script: ``python tests/oracle_compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Spark type -> the DuckDB type an oracle column must have.
SPARK2DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
              "date": "DATE"}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(float(v))
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "item"):
        return _canon(v.item())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in records), sorted(columns)


def compare(spark, sf_dir: str, name: str, con=None, queries=None, oracles=None) -> dict:
    from matchlake.plans import ORACLES, QUERIES
    queries, oracles = queries or QUERIES, oracles or ORACLES
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    s_rows, s_cols = rows_of(sdf.columns, srows)
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t_spark, 2)}
    if name not in oracles:
        out["oracle"] = None
        return out
    rel = con.sql(oracles[name])
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    stypes = {c: SPARK2DUCK.get(t, t) for c, t in sdf.dtypes}
    out["types_match"] = stypes == dtypes
    if not out["types_match"]:
        out["type_diff"] = {c: (stypes.get(c), dtypes.get(c)) for c in set(stypes) | set(dtypes)
                            if stypes.get(c) != dtypes.get(c)}
    res = con.execute(oracles[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    d_rows, d_cols = rows_of(dcols, drows)
    out.update(oracle_rows=len(drows), cols_match=s_cols == d_cols,
               values_match=s_rows == d_rows)
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    elif not out["values_match"]:
        sset, dset = set(s_rows), set(d_rows)
        out["only_spark"] = sorted(sset - dset)[:3]
        out["only_oracle"] = sorted(dset - sset)[:3]
    return out


def main(argv):
    from matchlake.session import build_session
    import __spark_entry__ as entry
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(entry.queries())
    if os.environ.get("PLAIN_SESSION"):  # a default session, as a caller might have
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session("local[8]")
    if os.environ.get("SESSION_TZ"):  # the driver's session zone may differ
        spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, con, entry.queries(), entry.oracle_sql())
        except Exception as e:  # report and continue
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("values_match") and r.get("cols_match") and r.get("types_match")
        if r.get("oracle", 1) is None:
            ok = True
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
