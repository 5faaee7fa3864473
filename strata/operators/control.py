"""Log of loads, and which units have to be loaded."""

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.fixed_values import ALWAYS_LOADED
from strata.functions.scalars import now_utc
from strata.sources.catalog import append_rows, ensure_database, quoted

CONTROL_TABLE = "ingestion_control"
CONTROL_SCHEMA = (
    "id string, file_id string, file_name string, sheet_name string, target_table string, "
    "rows_loaded bigint, status string, error_message string, started_at timestamp, "
    "finished_at timestamp, source_modified_at timestamp, loaded_by string, env string"
)


def ensure_control_table(spark: SparkSession, database: str) -> None:
    ensure_database(spark, database)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(database, CONTROL_TABLE)} "
        f"({CONTROL_SCHEMA}) USING parquet"
    )


@dataclass
class ControlLog:
    """Log rows of a run. ``note`` takes one for a unit that is done, ``flush`` appends
    those taken in one job, ``write`` does both."""

    spark: SparkSession
    database: str
    started_at: datetime
    env: str = "dev"
    lock: Lock = field(default_factory=Lock)
    held: list[tuple] = field(default_factory=list)

    def note(
        self,
        file_name: str,
        sheet_name: str,
        target_table: str,
        status: str,
        rows_loaded: int = 0,
        error_message: str | None = None,
        file_id: str | None = None,
        source_modified_at: datetime | None = None,
    ) -> None:
        row = (
            uuid.uuid4().hex, file_id, file_name, sheet_name, target_table, rows_loaded,
            status, error_message, self.started_at, now_utc(), source_modified_at,
            None, self.env,
        )
        with self.lock:
            self.held.append(row)

    def flush(self) -> None:
        # Writers of one table take turns.
        with self.lock:
            if not self.held:
                return
            rows = self.spark.createDataFrame(self.held, CONTROL_SCHEMA).coalesce(1)
            rows = rows.withColumn("loaded_by", F.current_user())
            append_rows(rows, self.database, CONTROL_TABLE)
            self.held.clear()

    def write(self, *args, **entry) -> None:
        self.note(*args, **entry)
        self.flush()


def always_loaded(force: bool, always: Sequence[str] = ALWAYS_LOADED) -> Column:
    """Whether a unit is loaded even if it was before, by its ``table_name``."""
    kept = F.lit(force)
    for text in always:
        kept = kept | F.lower("table_name").contains(text)
    return kept


def mark_pending(
    units: DataFrame,
    control: DataFrame,
    force: bool = False,
    always: Sequence[str] = ALWAYS_LOADED,
) -> DataFrame:
    """Add ``already_loaded`` and ``pending`` to units given by ``file_name,
    sheet_name, modified_at, table_name``.

    Already loaded is a unit with a successful load of the same modified time, so
    one without such a time never is. It is still pending if its table is always
    loaded or the load is forced."""
    done = (
        control.where(F.col("status") == "SUCCESS")
        .select("file_name", "sheet_name", F.col("source_modified_at").alias("modified_at"))
        .dropna()
        .distinct()
        .withColumn("_done", F.lit(True))
    )
    return (
        units.join(done, ["file_name", "sheet_name", "modified_at"], "left")
        .withColumn("already_loaded", F.coalesce("_done", F.lit(False)))
        .withColumn("pending", always_loaded(force, always) | ~F.col("already_loaded"))
        .select(*units.columns, "already_loaded", "pending")
    )
