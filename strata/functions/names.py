"""Column names, table names, and columns found by role."""

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.fixed_values import LONGEST_TABLE_NAME
from strata.functions.scalars import strip

UNIT_SEPARATOR = " / "


def column_name(header: object) -> str:
    """Lower-case header with every other character than a-z, 0-9 as ``_``;
    runs of ``_`` stay, outer ones go."""
    return re.sub("[^a-z0-9_]", "_", str(header).strip().lower()).strip("_")


def header_names(cells: Iterable[str | None]) -> list[str]:
    """Headers of a sheet: empty cells are numbered, repeats get a suffix."""
    taken: set[str] = set()
    names = []
    for position, cell in enumerate(cells):
        base = name = f"Unnamed: {position}" if cell is None else cell
        repeat = 0
        while name in taken:
            repeat += 1
            name = f"{base}.{repeat}"
        taken.add(name)
        names.append(name)
    return names


def _slug(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(strip(text)), "[^a-z0-9]+", "_"), F.lit("_"))


def table_name(file_name: Column, sheet_name: Column) -> Column:
    """``file__sheet`` without extension, at most 63 characters."""
    stem = F.regexp_replace(file_name, r"(?i)\.(xlsx|xls|csv)$", "")
    name = F.concat(_slug(stem), F.lit("__"), _slug(sheet_name))
    cut = F.rtrim(F.substring(name, 1, LONGEST_TABLE_NAME), F.lit("_"))
    return F.when(F.length(name) > LONGEST_TABLE_NAME, cut).otherwise(name)


def unit_parts(source_name: Column) -> tuple[Column, Column]:
    """File and sheet of a source name: the first and the last part."""
    parts = F.split(source_name, UNIT_SEPARATOR)
    return F.element_at(parts, 1), F.element_at(parts, -1)


def find_column(columns: Sequence[str], candidates: Iterable[str]) -> str | None:
    """First candidate that is a column."""
    return next((name for name in candidates if name in columns), None)


def find_column_loosely(columns: Sequence[str], candidates: Iterable[str]) -> str | None:
    """First candidate that is a column but for case, blanks and hyphens; of
    columns that then look the same the last one counts."""

    def plain(name: str) -> str:
        return re.sub("[ -]", "_", name.lower())

    by_plain_name = {plain(name): name for name in columns}
    return next(
        (by_plain_name[plain(name)] for name in candidates if plain(name) in by_plain_name), None
    )
