"""Bronze run: load what the sources have, skip what is unchanged, keep a log."""

import logging
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime
from functools import partial
from itertools import islice

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

from strata.fixed_values import ALWAYS_LOADED, LOAD_RULES
from strata.functions.names import unit_parts
from strata.functions.scalars import now_utc
from strata.operators.control import (
    CONTROL_TABLE,
    ControlLog,
    always_loaded,
    ensure_control_table,
    mark_pending,
)
from strata.operators.loads import Rule, load_rule, load_unit, reset_staging
from strata.plans.parallel import side_by_side
from strata.session import scratch, scratch_table
from strata.sources.catalog import ensure_database, table
from strata.sources.records import Source, SourceRecord

log = logging.getLogger(__name__)

UNIT_SCHEMA = "position bigint, source_name string, table_name string, modified_at timestamp"

# Units that the driver plans, holds and logs at once.
UNITS_AT_ONCE = 1000


def plan_units(
    spark: SparkSession,
    records: Sequence[SourceRecord],
    database: str,
    force: bool,
    rules: Sequence[Rule],
    always: Sequence[str],
    inventory: str,
    first: int,
) -> list[Row]:
    """File, sheet, load rule, the source that owns the table name, and whether to load, for
    a batch of units. They are added, from number ``first`` on, to the table ``inventory`` of
    a source's units; the first one of a table name owns it."""
    rows = [(first + i, r.source_name, r.table_name, r.modified_at) for i, r in enumerate(records)]
    spark.createDataFrame(rows, UNIT_SCHEMA).coalesce(1).write.mode("append").saveAsTable(inventory)
    every = spark.table(inventory)
    units = every.where(F.col("position") >= first)
    owners = every.join(units.select("table_name"), "table_name", "left_semi").groupBy("table_name")
    owners = owners.agg(F.min_by("source_name", "position").alias("owner"))
    file_name, sheet_name = unit_parts(F.col("source_name"))
    units = units.join(owners, "table_name").select(
        *units.columns,
        "owner",
        file_name.alias("file_name"),
        sheet_name.alias("sheet_name"),
        load_rule(F.col("table_name"), rules).alias("rule"),
    )
    marked = mark_pending(units, table(spark, database, CONTROL_TABLE), force, always)
    marked = marked.withColumn("forced", always_loaded(force, always))
    return marked.orderBy("position").collect()


def run_bronze(
    spark: SparkSession,
    sources: Iterable[Source],
    force: bool = False,
    database: str = "bronze",
    rules: Sequence[Rule] = LOAD_RULES,
    always: Sequence[str] = ALWAYS_LOADED,
    env: str = "dev",
    loaded_at: datetime | None = None,
    units_at_once: int = UNITS_AT_ONCE,
) -> dict[str, int]:
    """Load each unit on its own: a failing one is logged and counted.

    Of a source's units only a batch is held at a time; which units there are is a table.
    The log rows of a batch are appended together, so that what a run that is cut off has
    loaded of its last batch is loaded again by the next one. A source that fails while it
    lists a batch is an error, and none of that batch is loaded."""
    summary = {"total": 0, "success": 0, "skipped": 0, "errors": 0}
    ensure_database(spark, database)
    ensure_control_table(spark, database)
    reset_staging(spark, database, rules)
    control = ControlLog(spark, database, loaded_at or now_utc(), env)
    for source in sources:
        with scratch():
            inventory, first = scratch_table(spark, "units"), 0
            batches = _batches(source, units_at_once)
            while True:
                try:
                    records = next(batches, None)
                except Exception as error:
                    log.error("source %s failed: %s", source.source_type, error)
                    summary["errors"] += 1
                    break
                if records is None:
                    break
                summary["total"] += len(records)
                units = plan_units(spark, records, database, force, rules, always, inventory, first)
                first += len(records)
                try:
                    outcomes = _load_lanes(records, units, control, database, loaded_at)
                finally:
                    control.flush()
                for outcome in outcomes:
                    summary[outcome] += 1
            if not first:
                log.warning("source %s has no records", source.source_type)
    log.info("bronze: %s", summary)
    return summary


def _batches(source: Source, size: int) -> Iterator[list[SourceRecord]]:
    records = iter(source.extract())
    while batch := list(islice(records, size)):
        yield batch


def _load_lanes(
    records: Sequence[SourceRecord],
    units: Sequence[Row],
    control: ControlLog,
    database: str,
    loaded_at: datetime | None,
) -> list[str]:
    """Outcomes of a batch of units. Units that write to the same table, staging included, follow
    each other; others are loaded side by side."""
    lanes: dict[str, list[Row]] = {}
    for unit in units:
        lanes.setdefault(unit.rule.staging or unit.table_name, []).append(unit)
    first = units[0].position

    def load_lane(lane: list[Row]) -> list[str]:
        done: set[tuple] = set()
        return [
            _load(records[unit.position - first], unit, control, database, loaded_at, done)
            for unit in lane
        ]

    results = side_by_side({name: partial(load_lane, lane) for name, lane in lanes.items()})
    outcomes = []
    for name, result in results.items():
        if isinstance(result, Exception):
            raise result
        outcomes += result
    return outcomes


def _load(
    record: SourceRecord,
    unit: Row,
    control: ControlLog,
    database: str,
    loaded_at: datetime | None,
    done: set[tuple],
) -> str:
    """Load one unit and note it in the log. ``done`` has the units of the batch that are
    loaded."""
    entry = dict(
        file_name=unit.file_name,
        sheet_name=unit.sheet_name,
        target_table=record.table_name,
        file_id=record.source_id,
        source_modified_at=record.modified_at,
    )
    key = (unit.file_name, unit.sheet_name, record.modified_at)
    if not unit.pending or (key in done and not unit.forced):
        control.note(status="SKIPPED", **entry)
        return "skipped"
    if unit.owner != record.source_name:
        error = f"the table {unit.table_name} belongs to {unit.owner}"
        log.error("%s not loaded: %s", record.source_name, error)
        control.note(status="ERROR", error_message=error, **entry)
        return "errors"
    try:
        rows = load_unit(
            record.rows(),
            database,
            record.table_name,
            unit.file_name,
            unit.sheet_name,
            unit.rule.staging,
            unit.rule.id_column,
            loaded_at,
        )
    except Exception as error:
        log.error("%s not loaded: %s", record.source_name, error)
        control.note(status="ERROR", error_message=str(error), **entry)
        return "errors"
    control.note(status="SUCCESS", rows_loaded=rows, **entry)
    if record.modified_at is not None:
        done.add(key)
    return "success"
