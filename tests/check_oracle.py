"""Compare registered queries with their SQL: python tests/check_oracle.py [folder] [name ...]"""

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, db, folder, name, query, sql):
    df = query(spark, folder)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if sql is None:
        return len(got), None
    cur = db.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} vs {sorted(columns)}"
    want = canonical(cur.fetchall(), columns)
    if got == want:
        return len(got), None
    extra = [r for r in got if r not in set(want)][:2]
    missing = [r for r in want if r not in set(got)][:2]
    return len(got), f"rows {len(got)} vs {len(want)}; only here {extra}; only sql {missing}"


def main(argv):
    from topicloom.catalog import ORACLES, QUERIES

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            rows, problem = compare(spark, db, folder, name, QUERIES[name], ORACLES.get(name))
            state = "ROWS" if name not in ORACLES else "ok" if problem is None else "DIFF"
        except Exception as error:  # report and go on with the next query
            rows, problem, state = 0, f"{type(error).__name__}: {str(error)[:700]}", "FAIL"
        print(f"{state:5} {name:24} rows={rows} {time.time() - start:.1f}s {(problem or '')[:900]}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
