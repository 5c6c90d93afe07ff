"""Compare every query with its SQL twin: python tests/check_oracle.py [folder] [name ...]"""

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


def connect(folder):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark, con, folder, name, query, sql):
    started = time.time()
    df = query(spark, folder)
    got = rows_of(df.columns, df.collect())
    took = time.time() - started
    started = time.time()
    cursor = con.execute(sql)
    want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    return got, want, took, time.time() - started


def main():
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, bad = connect(folder), 0
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if name not in oracles or sys.argv[2:] and name not in sys.argv[2:]:
            continue
        try:
            got, want, took, other = compare(spark, con, folder, name, query, oracles[name])
        except Exception as error:
            bad += 1
            print(f"FAIL {name}: {str(error)[:600]}", flush=True)
            continue
        if got == want:
            print(f"ok   {name}: {len(got[1])} rows, {took:.1f} s, sql {other:.1f} s", flush=True)
            continue
        bad += 1
        print(f"DIFF {name}: rows {len(got[1])} / {len(want[1])}, columns {got[0]} / {want[0]}", flush=True)
        if got[0] == want[0]:
            mine, theirs = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
            print("   only spark:", str(sorted(mine)[:2])[:500], "\n   only sql:  ", str(sorted(theirs)[:2])[:500], flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
