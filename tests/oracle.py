"""Compare registered queries with their SQL run by DuckDB on the same files.

``python tests/oracle.py [folder] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v) if not isinstance(v, (int, type(None))) or isinstance(v, bool) else v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str) -> str:
    """Empty text when both agree, else what differs."""
    df = entry.queries()[name](spark, folder)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "" if sum(mine[1].values()) else "no rows"
    cursor = con.execute(sql)
    theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if not mine[1]:
        return "no rows"
    if mine[1] != theirs[1]:
        left, right = mine[1] - theirs[1], theirs[1] - mine[1]
        return (f"{mine[0]}: rows {sum(mine[1].values())} / {sum(theirs[1].values())}; only here {sum(left.values())} "
                f"{list(left)[:2]}; only SQL {sum(right.values())} {list(right)[:2]}")
    return ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(entry.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names:
        began = time.time()
        try:
            verdict = compare(spark, con, folder, name)
        except Exception as e:  # noqa: BLE001
            verdict = f"{type(e).__name__}: {str(e)[:900]}"
        bad += bool(verdict)
        print(f"{name:28s} {time.time() - began:6.1f}s {'ok' if not verdict else 'DIFF ' + verdict}", flush=True)
    print("different:", bad)
