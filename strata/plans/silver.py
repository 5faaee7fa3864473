"""Silver run: clean the bronze tables and build the star schema."""

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.fixed_values import BRONZE_TABLES, FIRST_YEAR, LOAD_RULES
from strata.operators.clean import clean
from strata.operators.losses import lost_report, lost_sketches
from strata.operators.star import dim_clientes, dim_productos, dim_tiempo, fact_ventas
from strata.plans.parallel import side_by_side
from strata.session import scratch
from strata.sources.catalog import ensure_database, read_first, save

log = logging.getLogger(__name__)


def run_silver(
    spark: SparkSession,
    bronze: str = "bronze",
    database: str = "silver",
    names: dict[str, tuple[str, ...]] = BRONZE_TABLES,
    start_year: int = FIRST_YEAR,
    end_date: dt.date | None = None,
    loaded_at: dt.datetime | None = None,
    order_by: dict[str, Sequence[str]] | None = None,
    day_first: bool | None = False,
    lost: str | None = None,
) -> dict[str, int]:
    """Replace the four tables side by side; a failing one does not stop the others.
    ``order_by`` has the columns that keys follow, by role: clientes, productos, ventas.
    ``day_first=None`` lets the dates vote. ``lost`` names a table, besides the four, for
    the texts that became null, by role and column."""
    sorted_by = order_by or {}

    def rows(name: str) -> DataFrame:
        if isinstance(cleaned[name], Exception):
            raise cleaned[name]
        return cleaned[name]

    def built(build: Callable, name: str, **more) -> DataFrame:
        return build(rows(name), sorted_by.get(name, ()), loaded_at, **more)

    builders = {
        "dim_clientes": lambda: built(dim_clientes, "clientes"),
        "dim_productos": lambda: built(dim_productos, "productos"),
        "dim_tiempo": lambda: dim_tiempo(spark, start_year, end_date, loaded_at),
        "fact_ventas": lambda: built(fact_ventas, "ventas", day_first=day_first),
    }
    summary = {"total": len(builders), "success": 0, "errors": 0}
    ensure_database(spark, database)
    # Staging tables hold the last load only.
    staging = [rule[2] for rule in LOAD_RULES]
    raw = {k: read_first(spark, bronze, names.get(k, ()), k, staging) for k in BRONZE_TABLES}
    if any(df is None for df in raw.values()):
        summary["errors"] = summary["total"]
        return summary
    cleaned = side_by_side({k: partial(clean, df, loaded_at) for k, df in raw.items()})
    if lost:
        reports = [
            lost_report(lost_sketches(df)).select(F.lit(k).alias("role"), "*") for k, df in raw.items()
        ]
        save(reduce(DataFrame.union, reports), database, lost, "replace")
    saved = side_by_side({k: partial(_saved, b, database, k) for k, b in builders.items()})
    for name, rows in saved.items():
        if isinstance(rows, Exception):
            log.error("%s.%s not built: %s", database, name, rows)
            summary["errors"] += 1
        else:
            log.info("%s.%s: %d rows", database, name, rows)
            summary["success"] += 1
    return summary


def _saved(build: Callable[[], DataFrame], database: str, name: str) -> int:
    with scratch():
        return save(build(), database, name, "replace")
