"""Side-by-side check of registered queries against their SQL twins in DuckDB.

Usage: python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

from tidemark.sources.testdata import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    import decimal

    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return ("DECIMAL", str(v))
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 5)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


# Spark type -> DuckDB type of the same values
TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_diffs(sdf, sql, con):
    sch = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    d = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    return [(c, sch.get(c), d.get(c)) for c in sorted(set(sch) | set(d)) if TYPE_MAP.get(sch.get(c), sch.get(c)) != d.get(c)]


def compare(spark, sf_dir, name, fn, sql, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    types = type_diffs(sdf, sql, con)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_n = len(s_rows) == len(d_rows)
    ok_v = ok_cols and ok_n and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    return dict(name=name, ok=ok_cols and ok_n and ok_v and not types, cols=ok_cols, rows=(len(s_rows), len(d_rows)),
                types=types,
                values=ok_v, sec=round(t1 - t0, 2), spark_cols=s_cols, sql_cols=d_cols,
                sample=(rows_of(s_cols, s_rows)[:3], rows_of(d_cols, d_rows)[:3]))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from tidemark.session import get_session

    spark = get_session("local[8]", 8)
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or qs):
        if name not in sqls:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print(f"ROWS-ONLY {name}: {n} rows {time.time() - t0:.1f}s")
            continue
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls[name], con)
        except Exception as exc:  # report and go on
            bad += 1
            print(f"ERROR {name}: {type(exc).__name__}: {str(exc)[:800]}")
            continue
        if r["ok"]:
            print(f"OK {name} rows={r['rows'][0]} {r['sec']}s")
        else:
            bad += 1
            print(f"MISMATCH {name}: cols={r['cols']} rows={r['rows']} values={r['values']} types={r['types']}\n"
                  f"  spark={r['spark_cols']}\n  sql={r['sql_cols']}\n  s={r['sample'][0]}\n  d={r['sample'][1]}")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
