"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python -m tests.oracle_check /root/testdata/sf0.01 [name ...]

Rows are compared order-insensitively after normalising values (floats to
9 significant digits, dates/timestamps to text).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

EXACT = bool(os.environ.get("ORACLE_EXACT"))
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if hasattr(v, "asDict"):
        return str(v.asDict(recursive=True))
    if isinstance(v, dict):
        return str(v)
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return str(v) if not isinstance(v, str) else v


def _spark_cat(dt) -> str:
    n = dt.simpleString()
    if n in ("tinyint", "smallint", "int", "bigint"):
        return "int"
    if n in ("float", "double"):
        return "float"
    if n.startswith("decimal"):
        return "decimal"
    if n.startswith("timestamp"):
        return "timestamp"
    return {"string": "text", "boolean": "bool", "date": "date", "binary": "binary"}.get(n, "nested")


def _duck_cat(t: str) -> str:
    t = t.upper()
    if t in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT"):
        return "int"
    if t in ("FLOAT", "DOUBLE"):
        return "float"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    return {"VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date", "BLOB": "binary"}.get(t, "nested")


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(srows), "oracle": None, "sec": round(t1 - t0, 2)}
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows_raw = rel.fetchall()
    if sorted(dcols) != cols:
        return {"name": name, "ok": False, "why": f"columns spark={cols} duck={sorted(dcols)}"}
    idx = [dcols.index(c) for c in cols]
    scats = {f.name: _spark_cat(f.dataType) for f in sdf.schema.fields}
    dtypes = {d[0]: str(d[1]) for d in rel.description}
    type_diff = {c: (scats[c], _duck_cat(dtypes[c])) for c in cols if scats[c] != _duck_cat(dtypes[c])}
    drows = [tuple(_norm(r[i]) for i in idx) for r in drows_raw]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    ss, ds = sorted(srows, key=key), sorted(drows, key=key)
    ok = ss == ds
    out = {"name": name, "ok": ok, "rows": len(srows), "oracle_rows": len(drows), "sec": round(t1 - t0, 2)}
    if type_diff:
        out["type_diff"] = type_diff
    if not ok:
        sset, dset = set(ss), set(ds)
        out["only_spark"] = [dict(zip(cols, r)) for r in list(sset - dset)[:3]]
        out["only_duck"] = [dict(zip(cols, r)) for r in list(dset - sset)[:3]]
    return out


def main(argv):
    plain = "--plain" in argv
    argv = [a for a in argv if a != "--plain"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    if plain:   # a session without any of our settings, as a caller might have
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from ticklake.session import build_session
        spark = build_session()
    con = duck(sf_dir)
    qs, orc = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, con, name, qs[name], orc.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:800]}"}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
