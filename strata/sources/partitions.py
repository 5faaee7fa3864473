"""Tables that are rewritten a partition at a time, and tables dealt into buckets."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import PACKED
from strata.sources.catalog import INDEX, ensure_database, quoted, table, table_exists


def save_partitions(df: DataFrame, database: str, name: str, by: str, dealt: bool = False) -> None:
    """Replace the partitions that the rows have; all others keep their files. The table is
    made with the first rows. Rows of one partition are written by a few tasks at most,
    as AQE deals them by size; ``dealt`` rows lie so already, as in a sort, and stay."""
    spark = df.sparkSession
    columns = [*[c for c in df.columns if c != by], by]
    rows = df.select(*[F.col(f"`{c}`") for c in columns])
    if not dealt:
        rows = rows.hint("rebalance", F.col(by))
    ensure_database(spark, database)
    if not table_exists(spark, database, name):
        # Kept with the table, so that every overwrite goes by partition.
        writer = rows.write.partitionBy(by).options(**PACKED)
        writer.option("partitionOverwriteMode", "dynamic").saveAsTable(quoted(database, name))
        return
    stored = table(spark, database, name).columns
    rows.select(*[F.col(f"`{c}`") for c in stored]).write.mode("overwrite").insertInto(
        quoted(database, name)
    )


def drop_partitions(spark: SparkSession, database: str, name: str, by: str, gone: Sequence) -> None:
    """Drop the partitions of these values, as far as they are there."""
    for value in gone:
        spark.sql(
            f"ALTER TABLE {quoted(database, name)} DROP IF EXISTS PARTITION ({quoted(by)} = {value!r})"
        )


def append_partitions(df: DataFrame, database: str, name: str, by: str) -> None:
    """Append rows as new files of their partitions."""
    spark = df.sparkSession
    if not table_exists(spark, database, name):
        save_partitions(df, database, name, by)
        return
    stored = table(spark, database, name).columns
    rows = df.select(*[F.col(f"`{c}`") for c in stored]).hint("rebalance", F.col(f"`{by}`"))
    rows.write.insertInto(quoted(database, name))


ROWS, NULLS, BUCKETS = "strata.rows", "strata.nulls", "strata.buckets"
IDS_PER_BUCKET = 2_000_000


class IdIndex:
    """The distinct ids of a table, dealt into buckets, in a table beside it.

    A join on the id reads the buckets as they lie: the stored ids are not shuffled, however
    many there are. The index knows how many rows of its table it covers, and is made anew
    if the table has another number, as after a load that was cut off.
    """

    def __init__(self, spark: SparkSession, database: str, name: str):
        self.spark, self.database, self.name = spark, database, f"{name}{INDEX}"

    def _properties(self) -> dict[str, str]:
        if not table_exists(self.spark, self.database, self.name):
            return {}
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {quoted(self.database, self.name)}").collect()
        return {r["key"]: r["value"] for r in rows}

    def _mark(self, rows: int, nulls: bool, buckets: int) -> None:
        self.spark.sql(
            f"ALTER TABLE {quoted(self.database, self.name)} SET TBLPROPERTIES "
            f"('{ROWS}'='{rows}', '{NULLS}'='{str(nulls).lower()}', '{BUCKETS}'='{buckets}')"
        )

    def _write(self, ids: DataFrame, buckets: int, mode: str) -> None:
        dealt = ids.where("_id IS NOT NULL").distinct().repartition(buckets, "_id")
        dealt.write.bucketBy(buckets, "_id").sortBy("_id").mode(mode).saveAsTable(
            quoted(self.database, self.name)
        )

    def of(self, ids: DataFrame) -> tuple[DataFrame, bool]:
        """The stored ids as ``_id``, and whether a row has none; ``ids`` has the ``_id`` of
        every row of the table."""
        rows, known = ids.count(), self._properties()
        if known.get(ROWS) != str(rows):
            least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            buckets = max(least, -(-rows // IDS_PER_BUCKET))
            self.spark.sql(f"DROP TABLE IF EXISTS {quoted(self.database, self.name)}")
            self._write(ids, buckets, "overwrite")
            nulls = not ids.where("_id IS NULL").isEmpty()
            self._mark(rows, nulls, buckets)
        else:
            nulls = known[NULLS] == "true"
        return table(self.spark, self.database, self.name), nulls

    def add(self, ids: DataFrame, rows: int) -> None:
        """Take in the ``_id`` of ``rows`` new rows, which the index did not have."""
        known = self._properties()
        if not known:
            return
        self._write(ids, int(known[BUCKETS]), "append")
        nulls = known[NULLS] == "true" or not ids.where("_id IS NULL").isEmpty()
        self._mark(int(known[ROWS]) + rows, nulls, int(known[BUCKETS]))

