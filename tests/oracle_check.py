"""Run ``queries()`` against ``oracle_sql()`` on DuckDB, as the driver does.

    python tests/oracle_check.py [sf_dir] [key ...]

Prints one line per key: rows (spark/oracle), column-name match, value match.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)) and not hasattr(v, "__len__"):
        return norm(v.item())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, dict):
        return tuple(sorted((str(k), norm(x)) for k, x in v.items()))
    if hasattr(v, "tolist"):
        return tuple(norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    out.sort(key=repr)
    return out


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, key, sf_dir, con=None, verbose=False):
    import __spark_entry__ as E
    q = E.queries()[key]
    sql = E.oracle_sql().get(key)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = list(sdf.columns)
    ts = time.time() - t0
    res = {"key": key, "spark_rows": len(srows), "spark_sec": round(ts, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    con = con or duck(sf_dir)
    t0 = time.time()
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    res["oracle_sec"] = round(time.time() - t0, 2)
    res["oracle_rows"] = len(orows)
    res["cols_match"] = sorted(scols) == sorted(ocols)
    a, b = rows_of(scols, srows), rows_of(ocols, orows)
    res["values_match"] = res["cols_match"] and a == b
    if verbose and not res["values_match"]:
        print("spark cols", scols, "oracle cols", ocols)
        sa, sb = set(a), set(b)
        print("only spark:", list(sa - sb)[:5])
        print("only oracle:", list(sb - sa)[:5])
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from stellate.session import get_session
    spark = get_session(master="local[8]", shuffle_partitions=8)
    import __spark_entry__ as E
    keys = argv[2:] or list(E.queries())
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = check(spark, k, sf_dir, con, verbose=True)
        except Exception as e:  # report and continue
            r = {"key": k, "error": f"{type(e).__name__}: {str(e)[:300]}"}
        ok = r.get("values_match", r.get("oracle") == "none" and "error" not in r)
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
