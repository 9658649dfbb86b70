"""Run registered queries next to their SQL: ``python tests/compare.py <sf_dir> [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def difference(spark_df, con, sql: str) -> str | None:
    """None if both give the same rows under the same names, else what differs."""
    rows, names = [tuple(r) for r in spark_df.collect()], spark_df.columns
    result = con.execute(sql)
    sql_names = [d[0] for d in result.description]
    sql_types = dict(zip(sql_names, (str(d[1]) for d in result.description)))
    expected = result.fetchall()
    if sorted(names) != sorted(sql_names):
        return f"columns {names} and {sql_names}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for c, t in spark_df.dtypes:
        if kinds.get(t) != sql_types[c] and sql_types[c] not in ('"NULL"',):
            return f"type of {c}: {t} and {sql_types[c]}"
    order = sorted(range(len(names)), key=lambda i: names[i])
    sql_order = sorted(range(len(sql_names)), key=lambda i: sql_names[i])
    a = sorted(tuple(str(_plain(r[i])) for i in order) for r in rows)
    b = sorted(tuple(str(_plain(r[i])) for i in sql_order) for r in expected)
    if len(a) != len(b):
        return f"{len(a)} rows and {len(b)} rows; {list(set(a) - set(b))[:2]} {list(set(b) - set(a))[:2]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ: {bad[:2]}" if bad else None


def main(sf: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE_PARTITIONS", "8"))
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = run(spark, sf)
            problem = difference(df, con, oracles[name]) if name in oracles else (None if df.count() >= 0 else "no rows")
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.1f}s {'ok' if problem is None else problem}"
              f"{'' if name in oracles else ' (rows only)'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
