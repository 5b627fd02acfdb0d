"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_harness.py [sf_dir] [key ...]

Comparison: same column names (sorted), same row count, and the same
multiset of rows after normalising values (floats rounded to 9 significant
digits, decimals to float, timestamps/dates to ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from starloom.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


_SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def type_mismatches(sdf, dcols, dtypes):
    """Columns whose Spark type does not map to the DuckDB result type."""
    out = []
    dmap = {c: str(t) for c, t in zip(dcols, dtypes)}
    for name, st in sdf.dtypes:
        dt_ = dmap.get(name)
        if dt_ is None:
            continue
        want = _SPARK_TO_DUCK.get(st)
        if st.startswith("decimal"):
            want = st.replace("decimal", "DECIMAL").replace(",", ", ")
        if want is not None and want.replace(" ", "") != dt_.replace(" ", "").upper():
            out.append((name, st, dt_))
    return out


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return {"key": key, "status": "no-oracle", "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    t2 = time.time()
    res = {"key": key, "rows": len(srows), "oracle_rows": len(drows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    dtypes = [d[1] for d in cur.description]
    res["type_mismatch"] = type_mismatches(sdf, dcols, dtypes)
    if sorted(scols) != sorted(dcols):
        res["status"] = "COLUMNS"
        res["detail"] = (sorted(set(scols) - set(dcols)), sorted(set(dcols) - set(scols)))
        return res
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    dorder = [dcols.index(scols[i]) for i in order]
    sc = Counter(tuple(norm(r[i]) for i in order) for r in srows)
    dc = Counter(tuple(norm(r[i]) for i in dorder) for r in drows)
    if sc == dc:
        res["status"] = "OK"
    else:
        res["status"] = "VALUES"
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        res["detail"] = {"cols": [scols[i] for i in order], "spark_only": only_s,
                         "oracle_only": only_d, "n_diff": sum((sc - dc).values())}
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from starloom.session import get_session
    spark = get_session("local[8]")
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in (keys or list(qs)):
        try:
            r = compare(spark, con, k, qs[k], oracle.get(k), sf_dir)
        except Exception as e:  # report and continue
            r = {"key": k, "status": "ERROR", "detail": f"{type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("OK", "no-oracle"):
            bad += 1
        if r.get("type_mismatch"):
            print("TYPES", k, r["type_mismatch"], flush=True)
        r.pop("type_mismatch", None)
        print(r, flush=True)
    print(f"== {len(keys or qs) - bad} ok / {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
