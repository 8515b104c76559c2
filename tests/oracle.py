"""Compare a registered query with its SQL on DuckDB: columns, row count, every value.

    python tests/oracle.py [--sf 0.01] [query ...]
"""

from __future__ import annotations

import argparse
import datetime
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    """A value as it is compared; the kind is part of it, so 1 and 1.0 and '1' differ."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("double", 0.0 if value == 0 else value)
    if isinstance(value, datetime.datetime):
        return ("timestamp", value.isoformat())
    if isinstance(value, datetime.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return (type(value).__name__, value)


#: SQL type -> Spark type; anything else (HUGEINT, DECIMAL, ...) counts as a mismatch.
_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
          "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides agree, else what differs first."""
    relation = con.sql(sql)
    expected_columns = sorted(relation.columns)
    if sorted(df.columns) != expected_columns:
        return f"columns: spark {sorted(df.columns)}, sql {expected_columns}"
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    wrong = [f"{c}: spark {kind}, sql {kinds[c]}" for c, kind in df.dtypes if _TYPES.get(kinds[c]) != kind]
    if wrong:
        return "types: " + ", ".join(wrong)
    order = [relation.columns.index(c) for c in expected_columns]
    expected = Counter(tuple(_plain(r[i]) for i in order) for r in relation.fetchall())
    rows = df.select(*[f"`{c}`" for c in expected_columns]).collect()
    actual = Counter(tuple(_plain(v) for v in r) for r in rows)
    if sum(actual.values()) != sum(expected.values()):
        return f"rows: spark {sum(actual.values())}, sql {sum(expected.values())}"
    if actual != expected:
        spark_only, sql_only = list((actual - expected).items()), list((expected - actual).items())
        return f"{len(spark_only)} rows differ on {expected_columns}: spark {spark_only[:2]}, sql {sql_only[:2]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = duck(folder), entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args.names or queries:
        began = time.time()
        try:
            df = queries[name](spark, folder)
            problem = compare(df, con, oracles[name]) if name in oracles else None
        except Exception as error:  # keep going: one broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
