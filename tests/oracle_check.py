"""Spark results against the plain-SQL twins, value by value."""

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return repr(float(value)) if False else str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    sql_rows = rows_of(names, result.fetchall())
    if spark_rows != sql_rows:
        only_spark = [r for r in spark_rows if r not in set(sql_rows)][:2]
        only_sql = [r for r in sql_rows if r not in set(spark_rows)][:2]
        return f"{len(spark_rows)} vs {len(sql_rows)} rows\n  columns  {sorted(names)}\n  spark {only_spark}\n  sql   {only_sql}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder, wanted = sys.argv[1], sys.argv[2:]
    session = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), oracle_sql()
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            verdict = compare(session, con, name, fn, sql[name], folder) if name in sql else "no sql"
        except Exception as e:  # noqa: BLE001
            verdict = f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{name}: {'ok' if verdict is None else 'DIFF ' + verdict} ({time.time() - begin:.1f}s)", flush=True)
