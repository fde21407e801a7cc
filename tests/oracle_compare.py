"""Spark query vs DuckDB oracle: row count, column names and an
order-insensitive value comparison (floats at 6 decimals).

Run as a script: ``python tests/oracle_compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pyarrow as pa

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        if math.isinf(v):
            return ("inf", v > 0)
        return ("num", round(v, 6) + 0.0)
    if isinstance(v, bool):
        return ("num", float(v))
    if isinstance(v, int):
        return ("num", float(v))
    return ("str", str(v))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(sdf, rel) -> dict:
    sp = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
          for f in sdf.schema.fields}
    dk = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return {c: (sp.get(c), dk.get(c)) for c in set(sp) | set(dk) if sp.get(c) != dk.get(c)}


def rows_of(table: pa.Table) -> list[tuple]:
    """Rows with their columns by name; Arrow keeps null apart from NaN."""
    cols = sorted(table.column_names)
    return sorted((tuple(_norm(rec[c]) for c in cols) for rec in table.to_pylist()), key=repr)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    q = queries()[name]
    t0 = time.time()
    sdf = q(spark, sf_dir)
    got = sdf.toArrow()
    t_spark = time.time() - t0
    sql = oracle_sql().get(name)
    res = {"name": name, "spark_rows": got.num_rows, "spark_s": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    bad_types = type_mismatches(sdf, rel)
    want = rel.to_arrow_table()
    res["oracle_rows"] = want.num_rows
    if sorted(got.column_names) != sorted(want.column_names):
        res["status"] = f"COLUMNS {sorted(got.column_names)} vs {sorted(want.column_names)}"
        return res
    a, b = rows_of(got), rows_of(want)
    if len(a) != len(b):
        res["status"] = "ROWCOUNT"
        return res
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        res["status"] = f"VALUES {len(diff)} differ, e.g. {diff[:2]}"
    elif bad_types:
        res["status"] = f"TYPES {bad_types}"
    else:
        res["status"] = "ok"
    return res


if __name__ == "__main__":
    from partqc.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    from __spark_entry__ import queries
    con = duck(sf)
    for n in names or list(queries()):
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and go on
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        print(r, flush=True)
