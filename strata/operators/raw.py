"""Raw rows to bronze rows: column names, empty rows, audit columns, text."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.fixed_values import BRONZE_AUDIT, INGESTED_AT, SOURCE_FILE, SOURCE_SHEET
from strata.functions.names import column_name
from strata.functions.scalars import as_text, stamp


def normalize_columns(df: DataFrame) -> DataFrame:
    """Clean column names; of equal ones the first column stays."""
    first = {}
    for position, header in enumerate(df.columns):
        first.setdefault(column_name(header), position)
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"c{i}").alias(name) for name, i in first.items()])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def add_audit(df: DataFrame, file: str, sheet: str, loaded_at: datetime | None = None) -> DataFrame:
    return df.withColumns(
        {
            SOURCE_FILE: F.lit(file),
            SOURCE_SHEET: F.lit(sheet),
            INGESTED_AT: stamp(loaded_at),
        }
    )


def normalize(
    df: DataFrame, file: str = "", sheet: str = "", loaded_at: datetime | None = None
) -> DataFrame:
    if not df.columns:
        return df
    return add_audit(drop_empty_rows(normalize_columns(df)), file, sheet, loaded_at)


def stringify(df: DataFrame) -> DataFrame:
    """Every data column as text; audit columns keep their type."""
    return df.select(
        *[
            F.col(f"`{f.name}`")
            if f.name in BRONZE_AUDIT
            else as_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )
