"""Star schema: customers, products, calendar, sales."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.fixed_values import (
    CUSTOMER_KEYS,
    FIRST_YEAR,
    MONTHS,
    PRODUCT_KEYS,
    QUARTERS,
    SALE_CUSTOMER,
    SALE_DATE,
    SALE_PRODUCT,
    SILVER_AT,
    WEEKDAYS,
)
from strata.functions.names import find_column, find_column_loosely
from strata.functions.scalars import date_number, leading_parts, now_utc, parse_date, stamp
from strata.operators.order import add_row_number


def _dimension(
    df: DataFrame,
    entity: str,
    key_names: Sequence[str],
    order_by: Sequence[str],
    loaded_at: dt.datetime | None,
) -> DataFrame:
    key = find_column(df.columns, key_names)
    rows = add_row_number(df, f"sk_{entity}", order_by)
    if key:
        rows = rows.withColumnRenamed(key, f"nk_{entity}")
    return rows.withColumn(SILVER_AT, stamp(loaded_at))


def dim_clientes(
    df: DataFrame, order_by: Sequence[str] = (), loaded_at: dt.datetime | None = None
) -> DataFrame:
    """Customers with ``sk_cliente`` 1..n, the id column as ``nk_cliente``."""
    return _dimension(df, "cliente", CUSTOMER_KEYS, order_by, loaded_at)


def dim_productos(
    df: DataFrame, order_by: Sequence[str] = (), loaded_at: dt.datetime | None = None
) -> DataFrame:
    """Products with ``sk_producto`` 1..n, the id column as ``nk_producto``."""
    return _dimension(df, "producto", PRODUCT_KEYS, order_by, loaded_at)


def _name(words: Sequence[str], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), place)


def calendar(
    bounds: DataFrame,
    months: Sequence[str] = MONTHS,
    weekdays: Sequence[str] = WEEKDAYS,
    quarters: Sequence[str] = QUARTERS,
) -> DataFrame:
    """One row per day between the dates ``first`` and ``last`` of a one-row table."""
    day = F.col("fecha")
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("fecha"))
    year, quarter, month, weekday = F.year(day), F.quarter(day), F.month(day), F.weekday(day) + 1
    year_end = F.make_date(year, F.lit(12), F.lit(31))
    return days.select(
        date_number(day).alias("sk_tiempo"),
        day,
        year.alias("anio"),
        quarter.alias("trimestre"),
        _name(quarters, quarter).alias("trimestre_nombre"),
        month.alias("mes"),
        _name(months, month).alias("mes_nombre"),
        F.weekofyear(day).alias("semana_anio"),
        F.dayofmonth(day).alias("dia_mes"),
        weekday.alias("dia_semana"),
        _name(weekdays, weekday).alias("dia_semana_nombre"),
        (weekday >= 6).alias("es_fin_semana"),
        (F.dayofyear(year_end) == 366).alias("es_bisiesto"),
        F.dayofyear(day).alias("dia_del_anio"),
        F.when(F.dayofmonth(day) <= 15, 1).otherwise(2).alias("quincena"),
        (year * 100 + month).alias("periodo_yyyymm"),
        F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string")).alias("periodo_yyyyqq"),
    )


def dim_tiempo(
    spark: SparkSession,
    start_year: int = FIRST_YEAR,
    end_date: dt.date | None = None,
    loaded_at: dt.datetime | None = None,
) -> DataFrame:
    """Calendar from 1 January of ``start_year`` to ``end_date`` (today)."""
    bounds = spark.range(0, 1, 1, 1).select(
        F.lit(dt.date(start_year, 1, 1)).alias("first"),
        F.lit(end_date or now_utc().date()).alias("last"),
    )
    return calendar(bounds).withColumn(SILVER_AT, stamp(loaded_at))


def day_leads(df: DataFrame, names: Sequence[str]) -> dict[str, bool]:
    """For each column whether its dates with the year last have the day first: of the
    dates that leave no choice, more do than have the month first. One scan of these
    columns, and one row for the driver."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    votes = []
    for i, name in enumerate(names):
        day, month = leading_parts(F.col(f"`{name}`"), kinds[name])
        votes.append((F.count_if(day) > F.count_if(month)).alias(f"v{i}"))
    return dict(zip(names, df.agg(*votes).first())) if votes else {}


def fact_columns(df: DataFrame, day_first: bool | None = False) -> DataFrame:
    """Sales with ``fk_cliente``, ``fk_producto`` and ``fk_fecha`` in front of the
    other columns; a role without a column is null. Without a ``day_first`` (None) the
    dates of the column vote on it, see ``day_leads``."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    customer = find_column_loosely(df.columns, SALE_CUSTOMER)
    left = [c for c in df.columns if c != customer]
    product = find_column_loosely(left, SALE_PRODUCT)
    left = [c for c in left if c != product]
    date = find_column_loosely(left, SALE_DATE)
    left = [c for c in left if c != date]

    def copied(name: str | None) -> Column:
        return F.col(f"`{name}`") if name else F.lit(None).cast("string")

    if date and day_first is None:
        day_first = day_leads(df, [date])[date]
    day = parse_date(F.col(f"`{date}`"), kinds[date], bool(day_first)) if date else F.lit(None).cast("date")
    return df.select(
        copied(customer).alias("fk_cliente"),
        copied(product).alias("fk_producto"),
        date_number(day).alias("fk_fecha"),
        *[F.col(f"`{c}`") for c in left],
    )


def fact_ventas(
    df: DataFrame,
    order_by: Sequence[str] = (),
    loaded_at: dt.datetime | None = None,
    day_first: bool | None = False,
) -> DataFrame:
    """Sales fact with ``sk_venta`` 1..n."""
    rows = add_row_number(fact_columns(df, day_first), "sk_venta", order_by)
    return rows.withColumn(SILVER_AT, stamp(loaded_at))
