"""What a source hands to the bronze layer."""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime
from typing import Protocol

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class SourceRecord:
    """A unit to load: its rows, or a function that plans them when they are needed."""

    df: DataFrame | Callable[[], DataFrame]
    source_name: str
    table_name: str
    source_id: str = ""
    modified_at: datetime | None = None

    def rows(self) -> DataFrame:
        return self.df if isinstance(self.df, DataFrame) else self.df()


class Source(Protocol):
    source_type: str

    def extract(self) -> Iterator[SourceRecord]:
        """Yield units with lazy rows."""
