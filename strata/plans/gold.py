"""Gold run: the three KPI tables from the star schema."""

import datetime as dt
import logging
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from strata.operators.coverage import key_coverage
from strata.operators.kpis import (
    kpi_ventas_por_cliente,
    kpi_ventas_por_periodo,
    kpi_ventas_por_producto,
    sales_cube,
)
from strata.plans.parallel import side_by_side
from strata.session import scratch, written
from strata.sources.catalog import ensure_database, read_table, save

log = logging.getLogger(__name__)

STAR = ["fact_ventas", "dim_tiempo", "dim_clientes", "dim_productos"]


def run_gold(
    spark: SparkSession,
    silver: str = "silver",
    database: str = "gold",
    loaded_at: dt.datetime | None = None,
    report_keys: bool = False,
    keep_unmatched: bool = False,
) -> dict[str, int]:
    """Replace the KPI tables side by side; a failing one does not stop the others. The
    sales are read once, for the sums of all three. ``report_keys`` also logs how many
    sales find their customer and product, ``keep_unmatched`` keeps those that do not."""
    builders = {
        "kpi_ventas_por_periodo": lambda more: kpi_ventas_por_periodo(fact, days, loaded_at, **more),
        "kpi_ventas_por_cliente": lambda more: kpi_ventas_por_cliente(
            fact, customers, days, loaded_at, **more
        ),
        "kpi_ventas_por_producto": lambda more: kpi_ventas_por_producto(
            fact, products, days, loaded_at, **more
        ),
    }
    summary = {"total": len(builders), "success": 0, "errors": 0}
    ensure_database(spark, database)
    star = [read_table(spark, silver, name) for name in STAR]
    if any(df is None for df in star):
        summary["errors"] = summary["total"]
        return summary
    fact, days, customers, products = star
    if report_keys:
        for dim, entity in ((customers, "cliente"), (products, "producto")):
            if f"nk_{entity}" in dim.columns:
                report = key_coverage(fact, f"fk_{entity}", dim, f"nk_{entity}").first()
                log.info("keys of %s: %s", entity, report.asDict())
    with scratch():
        try:
            more = (
                {"keep_unmatched": True}
                if keep_unmatched
                else {"cube": written(sales_cube(fact, days), "sales_cube")}
            )
        except Exception as error:
            log.error("the sales are not summed: %s", error)
            summary["errors"] = summary["total"]
            return summary
        saved = side_by_side(
            {k: partial(_saved, partial(b, more), database, k) for k, b in builders.items()}
        )
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
