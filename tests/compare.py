"""Run the registered queries and their SQL on one data folder and compare the rows.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connection(folder):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql):
    """Empty when both give the same columns and rows."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    wanted = rows_of(names, expected.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    found = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if found == wanted:
        return []
    notes = [f"{len(found)} rows instead of {len(wanted)}; columns {sorted(names)}"]
    extra, missing = sorted(set(found) - set(wanted)), sorted(set(wanted) - set(found))
    return notes + [f"spark {row}" for row in extra[:3]] + [f"sql   {row}" for row in missing[:3]]


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, sql, bad = connection(folder), contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if chosen and name not in chosen:
            continue
        begun = time.time()
        try:
            df = run(spark, folder)
            if name in sql:
                notes = differences(df, con, sql[name])
            else:
                notes = [] if df.count() >= 0 else ["no rows"]
        except Exception as error:
            notes = [str(error)[:1500]]
        bad += bool(notes)
        print(f"{'ok  ' if not notes else 'DIFF'} {name} {time.time() - begun:.1f}s", *notes, sep="\n     " if notes else " ", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
