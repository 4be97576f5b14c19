"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]`` prints one
line per query and a JSON summary; also used by ``test_oracle.py``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: repr(t))


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, con=None):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = con or duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        rec = {"oracle": name in sqls}
        try:
            df = qs[name](spark, sf_dir)
            s_names = df.columns
            s_rows = [tuple(r) for r in df.collect()]
            rec["rows"] = len(s_rows)
            rec["spark_sec"] = round(time.time() - t0, 3)
            if name in sqls:
                cur = con.execute(sqls[name])
                d_names = [c[0] for c in cur.description]
                d_rows = cur.fetchall()
                rec["oracle_rows"] = len(d_rows)
                rec["schema_match"] = sorted(s_names) == sorted(d_names)
                rec["value_match"] = rec["schema_match"] and _rows(s_names, s_rows) == _rows(d_names, d_rows)
                if not rec["schema_match"]:
                    rec["cols"] = [sorted(s_names), sorted(d_names)]
                elif not rec["value_match"]:
                    a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
                    sa, sb = set(a), set(b)
                    rec["only_spark"] = [repr(x) for x in sorted(sa - sb, key=repr)[:3]]
                    rec["only_oracle"] = [repr(x) for x in sorted(sb - sa, key=repr)[:3]]
        except Exception as e:  # report and continue with the next query
            rec["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        results[name] = rec
    return results


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    from tidewater.session import get_session
    spark = get_session(master="local[8]", shuffle_partitions=8)
    res = compare(spark, sf_dir, names)
    bad = 0
    for k, v in res.items():
        ok = v.get("value_match", "error" not in v)
        bad += 0 if ok else 1
        print(("OK  " if ok else "FAIL"), k, json.dumps(v)[:600])
    print(json.dumps({"queries": len(res), "failed": bad}))


if __name__ == "__main__":
    main()
