"""Run queries against their SQL: ``python -m checks.compare [folder] [name ...]``."""

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES
from strata.session import scratch, start

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _sorted(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def value(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns or rows, without regard to order."""
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    expected = _sorted(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} are not {sorted(columns)}"]
    actual = _sorted(df.columns, [tuple(r) for r in df.collect()])
    found = [] if len(actual) == len(expected) else [f"{len(actual)} rows, not {len(expected)}"]
    pairs = [(a, e) for a, e in zip(actual, expected) if a != e or repr(a) != repr(e)]
    return found + [f"{len(pairs)} rows differ, {a} is not {e}" for a, e in pairs[:2]]


def main(spark: SparkSession, folder: str, names: list[str]) -> bool:
    con, good = connect(folder), True
    for name in names or QUERIES:
        began = time.time()
        try:
            with scratch():
                found = differences(QUERIES[name](spark, folder), con, ORACLES[name])
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        good &= not found
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - began:.1f}s", *found, sep="\n   ")
    return good


if __name__ == "__main__":
    session = start(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    target = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(not main(session, target, sys.argv[2:]))
