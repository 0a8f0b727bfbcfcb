"""Run registered queries in Spark and their SQL in DuckDB and compare all values.

    python tests/compare.py <sf_dir> [query ...]
"""

import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return connection


def _value(x):
    return "NaN" if isinstance(x, float) and x != x else x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql):
    """None when equal, else a short description."""
    columns, mine = _rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    other_columns, other = _rows(names, result.fetchall())
    if columns != other_columns:
        return f"columns {columns} against {other_columns}"
    if mine != other:
        return (
            f"rows {sum(mine.values())} against {sum(other.values())}; only here {list((mine - other).items())[:3]}; "
            f"only there {list((other - mine).items())[:3]}"
        )
    if not mine:
        return "no rows"
    kinds = {type(v) for row in mine for v in row}
    return None if kinds <= {int, float, str, bool, type(None)} else f"types {kinds}"


def main(folder, names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as registry

    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', 8)}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    queries, oracles = registry.queries(), registry.oracle_sql()
    bad = 0
    for name in names or queries:
        started = time.time()
        try:
            if name in oracles:
                problem = difference(queries[name](spark, folder), connection, oracles[name])
            else:
                problem = None if queries[name](spark, folder).count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "exact" if name in oracles else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print("failures", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
