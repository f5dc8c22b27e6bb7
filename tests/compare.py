"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if hasattr(value, "asDict"):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, sf, query, sql) -> tuple[int, str | None]:
    """Row count and, if they differ, what does."""
    db = connect(sf)
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    wanted = rows_of(names, result.fetchall())
    df = query(spark, sf)
    if sorted(df.columns) != sorted(names):
        return 0, f"columns {sorted(df.columns)} <> {sorted(names)}"
    got = rows_of(df.columns, df.collect())
    if got == wanted:
        return len(got), None
    only_spark = [r for r in got if r not in set(wanted)][:3]
    only_sql = [r for r in wanted if r not in set(got)][:3]
    return len(got), f"{len(got)} rows <> {len(wanted)}; only Spark {only_spark}; only SQL {only_sql}"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf = sys.argv[1]
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in oracle:
                count, problem = compare(spark, sf, run, oracle[name])
            else:
                count, problem = run(spark, sf).count(), None
        except Exception as error:
            count, problem = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        mark = "ok" if problem is None else "BAD"
        print(f"{mark:4} {name:24} {count:8} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
