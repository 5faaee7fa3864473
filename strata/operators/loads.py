"""How bronze rows get into their tables."""

import logging
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.fixed_values import (
    INGESTED_AT,
    LOAD_RULES,
    SOURCE_FILE,
    SOURCE_SHEET,
    STAGED_AT,
)
from strata.functions.scalars import canonical_key, stamp
from strata.operators.raw import normalize, stringify
from strata.session import PACKED, scratch, written
from strata.sources.catalog import (
    append_rows,
    quoted,
    save,
    table,
    table_exists,
)
from strata.sources.partitions import IdIndex

log = logging.getLogger(__name__)

Rule = tuple[str, str, str, str | None]


def load_rule(name: Column, rules: Sequence[Rule] = LOAD_RULES) -> Column:
    """Load mode, staging table and id column for a table name; the first rule
    that fits counts, a name without one is replaced and not staged."""
    lowered = F.lower(name)
    chosen = None
    for match, text, staging, id_column in rules:
        fits = lowered.contains(text) if match == "contains" else lowered == text
        fields = F.struct(
            F.lit("incremental" if id_column else "replace_with_staging").alias("load_mode"),
            F.lit(staging).cast("string").alias("staging"),
            F.lit(id_column).cast("string").alias("id_column"),
        )
        chosen = F.when(fits, fields) if chosen is None else chosen.when(fits, fields)
    otherwise = F.struct(
        F.lit("replace").alias("load_mode"),
        F.lit(None).cast("string").alias("staging"),
        F.lit(None).cast("string").alias("id_column"),
    )
    return otherwise if chosen is None else chosen.otherwise(otherwise)


def id_key(df: DataFrame, id_column: str) -> Column:
    return canonical_key(F.col(f"`{id_column}`"), df.schema[id_column].dataType)


def new_rows(incoming: DataFrame, existing: DataFrame, id_column: str) -> DataFrame:
    """Incoming rows whose id is not among the existing ones. A missing id equals
    a missing id. Copies within the incoming rows all stay."""
    ids = existing.select(id_key(existing, id_column).alias("_id"))
    return rows_without(incoming, id_column, ids, not ids.where("_id IS NULL").isEmpty())


def rows_without(incoming: DataFrame, id_column: str, ids: DataFrame, has_missing: bool) -> DataFrame:
    """Incoming rows whose id is not an ``_id`` of ``ids``; rows without an id go too if
    ``has_missing``.

    Existing ids first meet the incoming ones, so that of a large table only those go on
    which matter, and copies of an id shrink before the last join. Missing ids take no
    part in the joins, where they would share one task. If ``ids`` lie in buckets, only
    incoming ids are shuffled.
    """
    marked = incoming.select("*", id_key(incoming, id_column).alias("_id"))
    with_id = marked.where("_id IS NOT NULL")
    known = ids.join(with_id.select("_id"), "_id", "left_semi").distinct()
    new = with_id.join(known, "_id", "left_anti")
    columns = [F.col(f"`{c}`") for c in incoming.columns]
    if has_missing:
        return new.select(*columns)
    return new.select(*columns).union(marked.where("_id IS NULL").select(*columns))


def reset_staging(spark: SparkSession, database: str, rules: Sequence[Rule] = LOAD_RULES) -> None:
    """Empty each staging table, or create it with the audit columns."""
    for _, _, staging, _ in rules:
        try:
            if table_exists(spark, database, staging):
                spark.sql(f"TRUNCATE TABLE {quoted(database, staging)}")
            else:
                spark.sql(
                    f"CREATE TABLE {quoted(database, staging)} ("
                    f"{STAGED_AT} TIMESTAMP, {SOURCE_FILE} STRING, "
                    f"{SOURCE_SHEET} STRING, {INGESTED_AT} TIMESTAMP) USING parquet "
                    f"OPTIONS ({', '.join(f'{k} = {v!r}' for k, v in PACKED.items())})"
                )
        except Exception as error:
            log.warning("staging table %s not prepared: %s", staging, error)


def stage(
    df: DataFrame, database: str, staging: str, loaded_at: datetime | None = None
) -> None:
    """Append a copy of loaded rows to the staging table; columns it lacks are added
    as text. A failure is only logged, as the rows are in their table by then."""
    spark = df.sparkSession
    try:
        rows = df.drop("_stg_id").withColumn(STAGED_AT, stamp(loaded_at))
        if not table_exists(spark, database, staging):
            save(rows, database, staging)
            return
        present = {c.lower() for c in table(spark, database, staging).columns}
        added = [c for c in rows.columns if c.lower() not in present]
        if added:
            columns = ", ".join(f"{quoted(c)} STRING" for c in added)
            spark.sql(f"ALTER TABLE {quoted(database, staging)} ADD COLUMNS ({columns})")
        append_rows(rows, database, staging)
    except Exception as error:
        log.warning("staging table %s not filled: %s", staging, error)


def load_new(
    df: DataFrame,
    database: str,
    name: str,
    id_column: str,
    staging: str | None,
    loaded_at: datetime | None = None,
) -> int:
    """Append rows with new ids and stage them. A table without the id column is
    replaced. The ids of the table are kept in buckets beside it, see ``IdIndex``."""
    spark = df.sparkSession
    if not table_exists(spark, database, name):
        rows = save(df, database, name)
        if rows and staging:
            stage(table(spark, database, name), database, staging, loaded_at)
        return rows
    existing = table(spark, database, name)
    if id_column not in existing.columns:
        log.warning("table %s has no column %s and is replaced", name, id_column)
        return save(df, database, name, "replace")
    with scratch():
        incoming = written(df, "incoming")
        index = IdIndex(spark, database, name)
        ids, has_missing = index.of(existing.select(id_key(existing, id_column).alias("_id")))
        # Written before the append, after which they would be new no more.
        fresh = written(rows_without(incoming, id_column, ids, has_missing), "new_rows")
        if fresh.isEmpty():
            return 0
        rows = save(fresh, database, name)
        index.add(fresh.select(id_key(fresh, id_column).alias("_id")), rows)
        if staging:
            stage(fresh, database, staging, loaded_at)
    return rows


def load_all(
    df: DataFrame,
    database: str,
    name: str,
    staging: str | None = None,
    loaded_at: datetime | None = None,
) -> int:
    """Replace the table, and copy it to its staging table if it has one."""
    rows = save(df, database, name, "replace")
    if rows and staging:
        stage(table(df.sparkSession, database, name), database, staging, loaded_at)
    return rows


def load_unit(
    df: DataFrame,
    database: str,
    name: str,
    file: str,
    sheet: str,
    staging: str | None = None,
    id_column: str | None = None,
    loaded_at: datetime | None = None,
) -> int:
    """Normalise the rows, make them text, and load them: new ids only if there is
    an id column, else all of them."""
    rows = stringify(normalize(df, file, sheet, loaded_at))
    if not rows.columns:
        return 0
    if id_column:
        return load_new(rows, database, name, id_column, staging, loaded_at)
    return load_all(rows, database, name, staging, loaded_at)
