"""Run registered queries next to their SQL statement in DuckDB and compare all rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def reference_connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return "null"
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{_cell(v)}" for k, v in value.items()) + "}"
    return str(value)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, con, sf, plan, sql):
    """Empty string when equal, else what differs; also rows and seconds."""
    start = time.time()
    df = plan(spark, sf)
    rows = [tuple(v.asDict() if hasattr(v, "asDict") else v for v in r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return "", len(rows), took
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want, want_names = _bag(names, cursor.fetchall())
    got, got_names = _bag(df.columns, rows)
    if want_names != got_names:
        return f"columns {got_names} instead of {want_names}", len(rows), took
    if want != got:
        extra, lacking = got - want, want - got
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; extra {list(extra)[:2]}; lacking {list(lacking)[:2]}",
            len(rows),
            took,
        )
    types = {c: t for c, t in df.dtypes}
    wants = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    odd = [f"{c} {types[c]}/{wants[c]}" for c in types if not _same_type(types[c], wants[c])]
    return ("types " + ", ".join(odd)) if odd else "", len(rows), took


def _same_type(spark_type: str, duck_type: str) -> bool:
    plain = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "smallint": "SMALLINT", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP",
    }
    return plain.get(spark_type, duck_type) == duck_type


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry_point
    from wattmill.session import build_session

    sf = sys.argv[1]
    chosen = sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = reference_connection(sf)
    plans, sqls = entry_point.queries(), entry_point.oracle_sql()
    bad = 0
    for name, plan in plans.items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        try:
            problem, rows, took = compare(spark, con, sf, plan, sqls.get(name))
        except Exception as err:  # report and go on with the next query
            problem, rows, took = f"{type(err).__name__}: {str(err)[:700]}", -1, 0.0
        bad += bool(problem)
        mark = "BAD " if problem else ("rows" if name not in sqls else "ok  ")
        print(f"{mark} {name:32s} {rows:8d} rows {took:6.2f}s  {problem}", flush=True)
    print(f"{bad} bad")
