"""Type inference and cleaning of bronze rows."""

import functools
import logging
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.fixed_values import BRONZE_AUDIT, SILVER_AT
from strata.functions.scalars import (
    LONG_LIMIT,
    as_text,
    clean_text,
    number,
    round2,
    stamp,
    whole,
)

log = logging.getLogger(__name__)

COLUMNS_AT_ONCE = 50


def _data_fields(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name not in BRONZE_AUDIT]


def _field(f: T.StructField) -> Column:
    return F.col(f"`{f.name}`")


def _any_value(fields: list[T.StructField]) -> Column:
    return F.coalesce(*[F.when(_field(f).isNotNull(), F.lit(True)) for f in fields], F.lit(False))


def column_profiles(df: DataFrame) -> DataFrame:
    """One row per data column of a table with rows: rows of the table, rows with any
    data, values, numbers among them, and the kind. A column is numeric if at least
    half of the rows with data, missing values included, are numbers.

    One aggregation per COLUMNS_AT_ONCE columns, so that code stays within the JVM's
    limits for wide tables."""
    fields = _data_fields(df)
    blocks = [
        fields[i : i + COLUMNS_AT_ONCE] for i in range(0, len(fields), COLUMNS_AT_ONCE)
    ]
    return functools.reduce(DataFrame.union, [_profiled(df, fields, b) for b in blocks])


def _profiled(df: DataFrame, every: list[T.StructField], block: list[T.StructField]) -> DataFrame:
    rows = df.select(
        F.exists(F.array(*[_field(f).isNotNull() for f in every]), lambda v: v).alias("_any"),
        *[_field(f).cast("string").alias(f"t{i}") for i, f in enumerate(block)],
    )
    numbers = rows.select(
        "*", *[number(F.col(f"t{i}"), T.StringType()).alias(f"n{i}") for i in range(len(block))]
    )
    counts = []
    for i in range(len(block)):
        n = F.col(f"n{i}")
        counts += [
            F.count(f"t{i}").alias(f"v{i}"),
            F.count(n).alias(f"c{i}"),
            F.coalesce(F.bool_or(n % 1 != 0), F.lit(False)).alias(f"d{i}"),
            F.coalesce(F.bool_or(F.abs(n) >= LONG_LIMIT), F.lit(False)).alias(f"h{i}"),
        ]
    summed = numbers.agg(
        F.count(F.lit(1)).alias("table_rows"), F.count_if("_any").alias("row_count"), *counts
    )
    columns = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col(f"v{i}").alias("value_count"),
            F.col(f"c{i}").alias("number_count"),
            F.col(f"d{i}").alias("has_decimals"),
            F.col(f"h{i}").alias("_huge"),
        )
        for i, f in enumerate(block)
    ]
    return (
        summed.where("table_rows > 0")
        .select("table_rows", "row_count", F.explode(F.array(*columns)).alias("_c"))
        .select(
            "_c.column_name",
            "table_rows",
            "row_count",
            "_c.value_count",
            "_c.number_count",
            "_c.has_decimals",
            F.when(F.col("_c.number_count") < 0.5 * F.greatest("row_count", F.lit(1)), "text")
            # Whole numbers beyond a bigint stay doubles.
            .when(F.col("_c.has_decimals") | F.col("_c._huge"), "decimal")
            .otherwise("integer")
            .alias("kind"),
        )
    )


def _cleaned(f: T.StructField, kind: str) -> Column:
    value = _field(f)
    if kind == "decimal":
        return round2(number(value, f.dataType))
    if kind == "integer":
        return whole(value, f.dataType)
    if isinstance(f.dataType, T.BooleanType):
        return value
    return clean_text(as_text(value, f.dataType))


def clean(df: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Drop empty rows and audit columns, type each column by its content, stamp.
    A table without rows is returned as it is."""
    fields = _data_fields(df)
    if not fields:
        return df
    # One row per column.
    profiles = {p.column_name: p for p in column_profiles(df).collect()}
    if not profiles:
        return df
    for p in profiles.values():
        if p.kind != "text" and p.value_count > p.number_count:
            lost = p.value_count - p.number_count
            log.warning("%s: %d values are no numbers and become null", p.column_name, lost)
    return df.where(_any_value(fields)).select(
        *[_cleaned(f, profiles[f.name].kind).alias(f.name) for f in fields],
        stamp(loaded_at).alias(SILVER_AT),
    )
