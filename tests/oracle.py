"""Compares each query with its SQL, as sorted values. Run with names or none for all: python tests/oracle.py [NAME...]"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


def value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    return x


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted((tuple(value(r[k]) for k in order) for r in found), key=repr)


def compare(spark, name, query, sql, sf):
    import duckdb

    df = query(spark, sf)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    result = db.execute(sql)
    want = rows([c[0] for c in result.description], result.fetchall())
    assert got[0] == want[0], (name, got[0], want[0])
    assert len(got[1]) == len(want[1]), (name, len(got[1]), len(want[1]))
    odd = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    assert not odd, (name, len(odd), odd[:2])
    return len(got[1])


if __name__ == "__main__":
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in sys.argv[1:] or queries:
        t = time.time()
        try:
            n = compare(spark, name, queries[name], sql[name], "/root/testdata/sf0.01") if name in sql else queries[name](spark, "/root/testdata/sf0.01").count()
            print("ok " if name in sql else "run", name, n, round(time.time() - t, 1), flush=True)
        except Exception as e:
            print("BAD", name, str(e)[:700].replace("\n", " "), flush=True)
