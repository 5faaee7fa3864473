"""Tables of the layers in the Spark catalog."""

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.session import PACKED

log = logging.getLogger(__name__)

# Ends the name of a table that holds the ids of another one.
INDEX = "__row_ids"


def quoted(*names: str) -> str:
    return ".".join("`" + name.replace("`", "``") + "`" for name in names)


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(quoted(database, table))


def table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(quoted(database, name))


def _previous(name: str) -> str:
    return f"{name}__previous"


def _recover(spark: SparkSession, database: str, name: str) -> None:
    """Put a table back whose replacement was cut off, or drop what a finished one left."""
    if not table_exists(spark, database, _previous(name)):
        return
    old = quoted(database, _previous(name))
    if table_exists(spark, database, name):
        spark.sql(f"DROP TABLE {old}")
    else:
        spark.sql(f"ALTER TABLE {old} RENAME TO {quoted(database, name)}")


def _create(df: DataFrame, database: str, name: str) -> int:
    """Write a new table; without rows none is left behind. The new rows are complete
    before the old ones go, and may be read from them; at every moment one of the two
    is there, if only under the name that ``_recover`` looks for."""
    spark = df.sparkSession
    temporary = f"new_{uuid.uuid4().hex}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.format("parquet").options(**PACKED).saveAsTable(quoted(database, temporary))
    rows = seen.get["rows"]
    if not rows:
        spark.sql(f"DROP TABLE {quoted(database, temporary)}")
        return rows
    target, old = quoted(database, name), quoted(database, _previous(name))
    if table_exists(spark, database, name):
        spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {quoted(database, temporary)} RENAME TO {target}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    return rows


def append_rows(df: DataFrame, database: str, name: str) -> int:
    """Append by column name; columns the rows lack become null."""
    spark = df.sparkSession
    seen = Observation()
    view = f"rows_{uuid.uuid4().hex}"
    df.observe(seen, F.count(F.lit(1)).alias("rows")).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {quoted(database, name)} BY NAME SELECT * FROM {quoted(view)}")
    finally:
        spark.catalog.dropTempView(view)
    return seen.get["rows"]


def save(df: DataFrame, database: str, name: str, if_exists: str = "append") -> int:
    """Write a table and return the row count. ``if_exists`` is ``append``,
    ``replace`` or ``fail``. Without rows nothing changes, not even by a replace."""
    if if_exists not in ("append", "replace", "fail"):
        raise ValueError(f"if_exists must be append, replace or fail, not {if_exists!r}")
    spark = df.sparkSession
    ensure_database(spark, database)
    _recover(spark, database, name)
    exists = table_exists(spark, database, name)
    if exists and if_exists == "fail":
        if df.isEmpty():
            return 0
        raise ValueError(f"table {database}.{name} exists")
    if exists and if_exists == "append":
        return append_rows(df, database, name)
    return _create(df, database, name)


def read_table(spark: SparkSession, database: str, name: str) -> DataFrame | None:
    if table_exists(spark, database, name):
        return table(spark, database, name)
    log.error("table %s.%s does not exist", database, name)
    return None


def read_first(
    spark: SparkSession,
    database: str,
    names: Sequence[str],
    keyword: str,
    skipped: Sequence[str] = (),
) -> DataFrame | None:
    """The first of the names that exists, else the first table in alphabetical
    order with the keyword in its name that is not to be skipped."""
    for name in names:
        if table_exists(spark, database, name):
            return table(spark, database, name)
    if spark.catalog.databaseExists(quoted(database)):
        found = sorted(
            t.name
            for t in spark.catalog.listTables(quoted(database))
            if not t.isTemporary
            and keyword.lower() in t.name.lower()
            and t.name not in skipped
            and not t.name.endswith((_previous(""), INDEX))
        )
        if found:
            log.info("read %s.%s for %s", database, found[0], keyword)
            return table(spark, database, found[0])
    log.error("no table for %s in %s", keyword, database)
    return None
