"""Spark-vs-DuckDB comparison of the registered queries.

Mirrors the driver's gate: same column names, same row count, matching
types and an order-insensitive multiset of rounded values.

    python -m tests.oracle_harness [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SF_DIR = "/root/testdata/sf0.01"

SPARK_FAMILY = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "bigint",
                "double": "double", "float": "double", "string": "string", "date": "date",
                "timestamp_ntz": "timestamp", "timestamp": "timestamp", "boolean": "boolean"}
DUCK_FAMILY = {"TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "bigint",
               "DOUBLE": "double", "FLOAT": "double", "VARCHAR": "string", "DATE": "date",
               "TIMESTAMP": "timestamp", "BOOLEAN": "boolean"}


def duck(sf_dir: str = SF_DIR):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, 5)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return round(float(v), 5)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark, name: str, fn, sql: str, con, sf_dir: str = SF_DIR) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: SPARK_FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    d_types = {r[0]: DUCK_FAMILY.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = {"name": name, "spark_sec": round(t1 - t0, 2), "rows": (len(s_rows), len(d_rows))}
    if sorted(s_cols) != sorted(d_cols):
        out["error"] = f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return out
    bad_types = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if bad_types:
        out["types"] = bad_types
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sv = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    dv = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    if len(sv) != len(dv):
        out["error"] = "row count differs"
    elif sv != dv:
        diffs = [(a, b) for a, b in zip(sv, dv) if a != b][:3]
        out["error"] = f"values differ, e.g. {diffs}"
    return out


def main(names: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from horavento.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8,
                        extra={"spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    names = names or sorted(sqls)
    con = duck()
    failed = 0
    for n in names:
        if n not in sqls:
            print(f"{n}: no oracle SQL (rows-only)")
            continue
        try:
            r = compare(spark, n, qs[n], sqls[n], con)
        except Exception as e:  # report and keep going
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = "error" not in r and "types" not in r
        failed += not ok
        print(("OK   " if ok else "FAIL ") + str(r), flush=True)
    print(f"{len(names) - failed}/{len(names)} passed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
