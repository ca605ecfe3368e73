"""Run queries on Spark and their SQL on DuckDB, and compare all rows."""

from __future__ import annotations

import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def compare(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when both results have the same columns, types and rows."""
    got = fn(spark, sf_dir)
    columns = sorted(got.columns)
    mine = got.select(*(f"`{c}`" for c in columns)).toArrow()
    other = con.sql(sql).to_arrow_table()
    if sorted(other.column_names) != columns:
        return f"columns {columns} vs {sorted(other.column_names)}"
    theirs = other.select(columns)
    kinds = [(c, str(mine.schema.field(c).type), str(theirs.schema.field(c).type)) for c in columns]
    odd = [k for k in kinds if k[1] != k[2]]
    a = sorted(zip(*(mine.column(c).to_pylist() for c in columns)), key=_key)
    b = sorted(zip(*(theirs.column(c).to_pylist() for c in columns)), key=_key)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}"
    if odd:
        return f"types {odd}"
    return None if a else "no rows"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf), 0
    for name, fn in contract.queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            verdict = compare(spark, con, fn, contract.oracle_sql()[name], sf)
        except Exception as exc:  # keep going: this is a report
            verdict = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += verdict is not None
        print(f"{name:34s} {time.time() - began:6.1f}s {verdict or 'ok'}", flush=True)
    print("differing:", bad)
