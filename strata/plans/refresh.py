"""Gold by the month: new sales change only the months they fall in.

The sales, their sums and the KPI rows of each month lie in partitions by month. A refresh
reads the sales of the touched months only and rewrites only these partitions. What goes
over all months, the ranks of keys and the table by period, is made from the sums, which
are one row a month and key.
"""

import datetime as dt
from collections.abc import Sequence
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.fixed_values import GOLD_AT
from strata.functions.scalars import stamp
from strata.operators.kpis import (
    PERIOD,
    SALES,
    UNITS,
    entity_sales,
    key_ranks,
    kpi_ventas_por_periodo,
    month_share,
    sales_cube,
)
from strata.operators.order import sorted_ranks
from strata.plans.parallel import side_by_side
from strata.session import scratch, written
from strata.sources.catalog import quoted, save, table, table_exists
from strata.sources.partitions import append_partitions, drop_partitions, save_partitions

FACT, CUBE = "fact_ventas_mes", "ventas_sumadas"
ENTITIES = {"cliente": "cli", "producto": "prod"}


def append_sales(fact: DataFrame, database: str) -> list[int | None]:
    """Append sales of the fact's form to the fact by month, numbered after those there.
    Returns the months they fall in, None if some have no date: as many as months at most."""
    spark = fact.sparkSession
    start, exists = 0, table_exists(spark, database, FACT)
    if exists:
        start = table(spark, database, FACT).agg(F.max("sk_venta")).first()[0] or 0
    month = F.floor(F.col("fk_fecha") / 100).cast("int").alias(PERIOD)
    others = [F.col(f"`{c}`") for c in fact.columns if c not in ("sk_venta", PERIOD)]
    number = (F.col("sk_venta") + start).cast("bigint").alias("sk_venta")
    seen = Observation()
    undated = F.count_if(F.col(PERIOD).isNull()).alias("undated")
    rows = fact.select(number, *others, month).observe(seen, _found(), undated)
    append_partitions(rows, database, FACT, PERIOD)
    found = _values(seen)
    months = [None] if found.get("undated") else []
    months += sorted(found.get("months", []))
    if not (months or exists):
        spark.sql(f"DROP TABLE {quoted(database, FACT)}")
    return months


def _found() -> Column:
    """The months of rows, seen while they are written."""
    return F.collect_set(PERIOD).alias("months")


def _values(seen: Observation) -> dict:
    try:
        return seen.get
    except Py4JJavaError:
        # A plan that turns out to be empty is cut, and what observes it too.
        return {}


def _months(df: DataFrame, months: Sequence[int | None] | None) -> DataFrame:
    if months is None:
        return df
    return df.where(F.col(PERIOD).isin([m for m in months if m is not None]))


def _replace_months(
    rows: DataFrame, database: str, name: str, months: Sequence[int | None] | None, dealt: bool = False
) -> None:
    """Replace the partitions of the months, all if None, by the rows; of a month that has
    rows no more the partition goes. ``dealt`` rows lie together by month."""
    seen = Observation()
    save_partitions(rows.observe(seen, _found()), database, name, PERIOD, dealt)
    here = set(_values(seen).get("months", []))
    stored = {r[0] for r in table(rows.sparkSession, database, name).select(PERIOD).distinct().collect()}
    gone = [m for m in stored - here if m is not None and (months is None or m in months)]
    drop_partitions(rows.sparkSession, database, name, PERIOD, gone)


def _refresh_entity(
    name: str,
    fact: DataFrame,
    dim: DataFrame,
    days: DataFrame,
    cube: DataFrame,
    months: Sequence[int | None] | None,
    database: str,
    loaded_at: dt.datetime | None,
) -> None:
    spark, key, by_month = fact.sparkSession, f"fk_{name}", f"ventas_por_{name}_mes"
    with scratch():
        sales = entity_sales(fact, dim, days, name, ENTITIES[name], cube=cube)
        columns = [c for c in sales.columns if name == "producto" or c != UNITS]
        sales = written(sales.select(*columns), "month_sales")
        rows = month_share(sales, sales) if name == "producto" else sales
        rows = sorted_ranks(rows, PERIOD, SALES, "ranking_mes", key, values=sales)
        _replace_months(rows.withColumn(GOLD_AT, stamp(loaded_at)), database, by_month, months, dealt=True)
        ranks = key_ranks(table(spark, database, by_month), key)
        save(ranks, database, f"ranking_{name}", "replace")
    stored = [c for c in table(spark, database, by_month).columns if c != PERIOD]
    listed = ", ".join(f"m.{quoted(c)}" for c in [PERIOD, *stored])
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(database, f'kpi_ventas_por_{name}')} AS "
        f"SELECT {listed}, r.ranking_global FROM {quoted(database, by_month)} m "
        f"JOIN {quoted(database, f'ranking_{name}')} r ON m.{quoted(key)} = r.{quoted(key)}"
    )


def refresh_gold(
    spark: SparkSession,
    silver: str,
    database: str,
    months: Sequence[int | None] | None = None,
    loaded_at: dt.datetime | None = None,
) -> None:
    """Bring the KPIs up to the sales of ``months``, as ``append_sales`` returns them; None
    is all months, as after a change of a dimension or of the calendar.

    ``kpi_ventas_por_cliente`` and ``kpi_ventas_por_producto`` are views over their rows by
    month and the ranks of keys; ``kpi_ventas_por_periodo`` is a table. Their rows are those
    of a full run. Months without sales that count have no partition.
    """
    if months is not None and not any(m is not None for m in months):
        return
    fact = table(spark, silver, FACT)
    days = table(spark, silver, "dim_tiempo")
    with scratch():
        _replace_months(sales_cube(_months(fact, months), days), database, CUBE, months)
        cube = table(spark, database, CUBE)
        touched = _months(cube, months)
        steps = {
            name: partial(
                _refresh_entity,
                name, fact, table(spark, silver, f"dim_{name}s"), days, touched, months, database, loaded_at,
            )
            for name in ENTITIES
        }
        steps["periodo"] = lambda: save(
            kpi_ventas_por_periodo(fact, days, loaded_at, cube=cube), database, "kpi_ventas_por_periodo", "replace"
        )
        for done in side_by_side(steps).values():
            if isinstance(done, Exception):
                raise done
