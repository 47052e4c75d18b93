"""Compare registered queries with their SQL, row by row without regard to order.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else (int(value) if value.is_integer() else round(value, 9))
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql):
    """Empty when both sides hold the same columns and rows."""
    columns, mine = _bag(df.columns, df.collect())
    result = connection.execute(sql)
    expected_columns, expected = _bag([c[0] for c in result.description], result.fetchall())
    if columns != expected_columns:
        return [f"columns {columns} != {expected_columns}"]
    surplus, lacking = mine - expected, expected - mine
    report = [f"surplus {str(row)[:300]}" for row in list(surplus)[:3]]
    report += [f"lacking {str(row)[:300]}" for row in list(lacking)[:3]]
    if report:
        report.insert(0, f"{sum(mine.values())} rows, {sum(expected.values())} expected")
    return report


def main(sf_dir="/root/testdata/sf0.01", *names):
    import __spark_entry__ as registry
    from broadsheet.session import build_session

    spark = build_session("oracle-compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    sqls = registry.oracle_sql()
    names = names or tuple(sqls)
    for name, query in registry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            report = differences(query(spark, sf_dir), connection, sqls[name])
        except Exception as error:  # report and go on with the next query
            report = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'ok  ' if not report else 'FAIL'} {name} {time.time() - start:.2f}s", flush=True)
        for line in report:
            print("     ", line, flush=True)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
