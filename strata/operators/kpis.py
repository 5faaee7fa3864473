"""Sales KPIs by month, customer and product."""

import logging
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.fixed_values import AMOUNT, GOLD_AT, QUANTITY, SILVER_AT
from strata.functions.names import find_column_loosely
from strata.functions.scalars import canonical_key, ratio, round2, stamp, summands, total
from strata.operators.order import add_dense_rank, sorted_ranks
from strata.session import written

log = logging.getLogger(__name__)

PERIOD = "periodo_yyyymm"
MONTH = ["anio", "mes", "mes_nombre", PERIOD]
MONTH_AND_QUARTER = ["anio", "trimestre", "trimestre_nombre", "mes", "mes_nombre", PERIOD]
SALES, COUNT, TICKET, UNITS = (
    "total_ventas",
    "cantidad_transacciones",
    "ticket_promedio",
    "cantidad_unidades",
)

# Of sales that are kept without a match.
CAUSE, UNKNOWN = "motivo", "DESCONOCIDO"

# The key of a sale as text, by which it meets its dimension.
KEY_TEXT = "_key_text"


def _column(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`")


def _parts(df: DataFrame, name: str | None, label: str) -> list[Column]:
    parts = summands(_column(df, name), df.schema[name].dataType) if name else [F.lit(0)]
    return [p.alias(f"{label}{i}") for i, p in enumerate(parts)]


def _sum_of_doubles(name: str, window: WindowSpec | None = None) -> Column:
    """Sum of a column of doubles that does not depend on the order of rows."""
    sums = [F.sum(p) for p in summands(F.col(name), T.DoubleType())]
    return total([s.over(window) for s in sums] if window else sums)


def _measures(fact: DataFrame, keys: Sequence[str], units: bool) -> tuple[DataFrame, list[Column]]:
    """The columns of the sales that KPIs need, and what sums them."""
    amount = find_column_loosely(fact.columns, AMOUNT)
    quantity = find_column_loosely(fact.columns, QUANTITY) if units else None
    if amount is None:
        log.warning("the sales have no amount column; totals are 0")
    sales = fact.select(
        "fk_fecha",
        "sk_venta",
        *keys,
        *_parts(fact, amount, "_amount"),
        *(_parts(fact, quantity, "_units") if quantity else []),
    )
    parts = [c for c in sales.columns if c.startswith(("_amount", "_units"))]
    return sales, [*[F.sum(c).alias(c) for c in parts], F.count("sk_venta").alias(COUNT)]


def _numbered(days: DataFrame, **numbers: Sequence[str]) -> DataFrame:
    """Days of the calendar with a number for each group of columns, by its name. It stands
    for the columns while sums are dealt, and is the same in each reading."""
    places = {n: F.rank().over(Window.orderBy(*columns)) for n, columns in numbers.items()}
    # One row per day of the calendar.
    return days.withColumns(places)


def dated_sales(
    fact: DataFrame,
    dim_tiempo: DataFrame,
    period: Sequence[str],
    key: str | None = None,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Counts, and sums in parts for ``summed``, per period and key. Sales without a calendar
    day or without a key belong to no group and are left out, unless ``keep_unmatched`` gives
    them groups of nulls."""
    keys = [key] if key else []
    sales, sums = _measures(fact, keys, bool(key))
    months = _numbered(dim_tiempo.select("sk_tiempo", *period).dropna(), _month=period)
    days = months.select("sk_tiempo", "_month")
    if key and not keep_unmatched:
        sales = sales.where(F.col(key).isNotNull())
    how = "left" if keep_unmatched else "inner"
    groups = sales.join(days, sales.fk_fecha == days.sk_tiempo, how).groupBy("_month", *keys).agg(*sums)
    labels = F.broadcast(months.select("_month", *period).distinct())
    return groups.join(labels, "_month", how).select(*period, *groups.columns[1:])


# The sets of a cube: what its rows are grouped by beside the period.
CUBE_SET = "conjunto"
CUBE_KEYS = {"periodo": [], "cliente": ["fk_cliente"], "producto": ["fk_producto"]}


def sales_cube(fact: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    """The sums of ``dated_sales`` for all three KPIs, from one scan of the sales and one
    join with the calendar: by period, by period and customer, by period and product. The
    set a row belongs to is in CUBE_SET; columns that a set does not group by are null."""
    keys = [k for own in CUBE_KEYS.values() for k in own]
    sales, sums = _measures(fact, keys, True)
    calendar = dim_tiempo.select("sk_tiempo", *MONTH_AND_QUARTER).dropna(subset=MONTH)
    months = _numbered(calendar, _month=MONTH, _full=[*MONTH, *MONTH_AND_QUARTER])
    days = months.select("sk_tiempo", "_month", "_full")
    grouped = {name: ["_month" if own else "_full", *own] for name, own in CUBE_KEYS.items()}
    columns = ["_month", "_full", *keys]
    cube = (
        sales.join(days, sales.fk_fecha == days.sk_tiempo)
        .groupingSets([[F.col(c) for c in own] for own in grouped.values()], *[F.col(c) for c in columns])
        .agg(*sums, F.grouping_id().alias("_set"))
    )
    # A bit for each column that a set lacks, the first column highest.
    number = {
        name: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in own)
        for name, own in grouped.items()
    }
    whole, which = F.lit(False), None
    for name, own in grouped.items():
        here = F.col("_set") == number[name]
        which = F.when(here, name) if which is None else which.when(here, name)
        full = here
        for c in own:
            full = full & F.col(c).isNotNull()
        whole = whole | full
    # Quarters count for the set of periods alone, so they may be missing elsewhere.
    named = [
        F.col(c) if c in MONTH else F.lit(None).cast(months.schema[c].dataType).alias(c)
        for c in MONTH_AND_QUARTER
    ]
    labels = months.dropna().select(F.col("_full").alias("_place"), *MONTH_AND_QUARTER).union(
        months.select((-F.col("_month")).alias("_place"), *named)
    )
    placed = cube.where(whole).withColumn("_place", F.coalesce("_full", -F.col("_month")))
    totals = [c for c in cube.columns if c not in (*columns, "_set")]
    return placed.join(F.broadcast(labels.distinct()), "_place").select(
        which.alias(CUBE_SET), *MONTH_AND_QUARTER, *keys, *totals
    )


def _grouped_sales(
    fact: DataFrame,
    dim_tiempo: DataFrame,
    period: Sequence[str],
    name: str,
    keep_unmatched: bool,
    cube: DataFrame | None,
) -> DataFrame:
    """``dated_sales``, from the cube if there is one."""
    keys = CUBE_KEYS[name]
    if cube is None:
        return dated_sales(fact, dim_tiempo, period, keys[0] if keys else None, keep_unmatched)
    if keep_unmatched:
        raise ValueError("a cube has no unmatched sales")
    sums = [c for c in cube.columns if c.startswith(("_amount", "_units")) or c == COUNT]
    return cube.where(F.col(CUBE_SET) == name).select(*period, *keys, *sums)


def _multiplied(part: Column, kind: T.DataType, times: Column | None) -> Column:
    """A summed part, as often as ``times``, as a double. Below 1e10 all 18 places count;
    beyond, the six that a product of decimals leaves are more than a double has."""
    if times is None or not isinstance(kind, T.DecimalType):
        return part.cast("double") if times is None else part.cast("double") * times
    near = (F.abs(part) < 10**10) & (times < 10**9)
    exact = part.try_cast("decimal(28,18)") * times.try_cast("decimal(9,0)")
    return F.when(near, exact.cast("double")).otherwise((part * times).cast("double"))


def summed(df: DataFrame, label: str, times: Column | None = None) -> Column:
    """The double that the summed parts of a column make, as often as ``times``."""
    return total(
        [
            _multiplied(F.col(c), df.schema[c].dataType, times)
            for c in df.columns
            if c.startswith(label)
        ]
    )


def _totals(df: DataFrame, times: Column | None) -> list[Column]:
    """Average ticket from the unrounded sum, then the rounded sum."""
    amount = summed(df, "_amount", times)
    count = F.col(COUNT) if times is None else F.col(COUNT) * times
    return [
        round2(amount).alias(SALES),
        count.alias(COUNT),
        round2(ratio(amount, count.cast("double"))).alias(TICKET),
    ]


def growth(df: DataFrame, value: str, name: str) -> DataFrame:
    """Change in % against the month before in the table, which has one row a month."""
    previous = F.lag(value).over(Window.orderBy(F.col(PERIOD).asc_nulls_last()))
    change = round2((ratio(F.col(value), previous) - 1) * 100)
    return df.withColumn(name, F.when(F.col(PERIOD).isNotNull(), change))


def year_to_date(df: DataFrame, value: str, name: str) -> DataFrame:
    """Running total within the year, of one row a month."""
    so_far = (
        Window.partitionBy("anio").orderBy(PERIOD).rowsBetween(Window.unboundedPreceding, 0)
    )
    return df.withColumn(name, round2(_sum_of_doubles(value, so_far)))


def kpi_ventas_por_periodo(
    fact: DataFrame,
    dim_tiempo: DataFrame,
    loaded_at: datetime | None = None,
    keep_unmatched: bool = False,
    cube: DataFrame | None = None,
) -> DataFrame:
    """Sales by month. ``keep_unmatched`` adds a row without a month for sales that have
    none. The sums may come from a ``cube`` of the same sales."""
    sums = _grouped_sales(fact, dim_tiempo, MONTH_AND_QUARTER, "periodo", keep_unmatched, cube)
    months = sums.select(*MONTH_AND_QUARTER, *_totals(sums, None))
    grown = growth(months, SALES, "variacion_mes_anterior_pct")
    return (
        year_to_date(grown, SALES, "acumulado_anual")
        .withColumn(GOLD_AT, stamp(loaded_at))
        .orderBy(PERIOD)
    )


def month_rank(df: DataFrame) -> DataFrame:
    """Dense rank of the total within the month, largest first."""
    return add_dense_rank(df, [PERIOD], SALES, "ranking_mes")


def global_rank(df: DataFrame, key: str) -> DataFrame:
    """Dense rank of each key's total over all months, put on each of its rows."""
    return df.join(key_ranks(df, key), key, "left")


def key_ranks(df: DataFrame, key: str, *more: str) -> DataFrame:
    """Each key and the dense rank of its total over all months. No key has no rank.
    ``more`` are columns that the key determines."""
    totals = df.where(F.col(key).isNotNull()).groupBy(*more, key)
    totals = written(totals.agg(round2(_sum_of_doubles(SALES)).alias("_total")), "key_totals")
    return add_dense_rank(totals, [], "_total", "ranking_global").drop("_total")


def month_share(df: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """Share of the month's total in %. ``sales`` may give the totals of the rows, where
    reading these costs less."""
    months = (df if sales is None else sales).groupBy(PERIOD).agg(_sum_of_doubles(SALES).alias("_month_total"))
    share = round2(ratio(F.col(SALES), F.col("_month_total")) * 100)
    # One row per month of the calendar.
    return (
        df.join(F.broadcast(months), PERIOD, "left")
        .withColumn("participacion_mes_pct", share)
        .drop("_month_total")
    )


def dimension_attributes(
    dim: DataFrame, entity: str, prefix: str, taken: Sequence[str], keep_nulls: bool = False
) -> tuple[DataFrame | None, list[str]]:
    """The dimension's key as text, its attributes, and how often each such row
    occurs; attributes whose name is taken get a prefix. Rows with a null belong to
    no group, unless ``keep_nulls`` keeps those that have a key."""
    key = f"nk_{entity}"
    if key not in dim.columns:
        log.warning("the dimension has no column %s; attributes are left out", key)
        return None, []
    names = {
        c: f"{prefix}_{c}" if c in taken else c
        for c in dim.columns
        if c not in (f"sk_{entity}", key, SILVER_AT)
    }
    rows = dim.select(
        canonical_key(_column(dim, key), dim.schema[key].dataType).alias("_key"),
        *[_column(dim, c).alias(name) for c, name in names.items()],
    )
    attributes = list(names.values())
    rows = rows.dropna(subset=["_key"]) if keep_nulls else rows.dropna()
    counted = rows.groupBy("_key", *attributes).agg(F.count(F.lit(1)).alias("_times"))
    return counted, attributes


def _cause(key: str, attributes: Sequence[str], known: Column) -> Column:
    """Why a group of sales is none of a month, member and attributes; null if it is one."""
    cause = F.when(F.col(PERIOD).isNull(), "sin_fecha").when(F.col(key).isNull(), "sin_clave")
    cause = cause.when(~known, "sin_miembro")
    for name in attributes:
        cause = cause.when(F.col(f"`{name}`").isNull(), "atributo_nulo")
    return cause


def entity_sales(
    fact: DataFrame,
    dim: DataFrame,
    dim_tiempo: DataFrame,
    entity: str,
    prefix: str,
    keep_unmatched: bool = False,
    cube: DataFrame | None = None,
    key_text: bool = False,
) -> DataFrame:
    """Totals per month, key and attributes of the dimension.

    Sales are summed per month and key before they meet the dimension, so a key
    with many sales is one row a month in that join. A dimension row that occurs
    n times counts its sales n times. Groups with a null attribute are left out.

    With ``keep_unmatched`` all sales stay, and CAUSE tells why a group is incomplete:
    without a date, without a key, of a key that the dimension lacks, or of a member with
    a null attribute. Text attributes of an unknown member are UNKNOWN.

    ``key_text`` adds KEY_TEXT, the key as the dimension has it, and leaves the rows dealt by
    it.
    """
    key = f"fk_{entity}"
    sums = _grouped_sales(fact, dim_tiempo, MONTH, entity, keep_unmatched, cube)
    taken = {*fact.columns, *MONTH, SALES, COUNT, TICKET, UNITS, *([CAUSE] if keep_unmatched else [])}
    rows, attributes = dimension_attributes(dim, entity, prefix, taken, keep_unmatched)
    times = None
    known = F.lit(True)
    sums = sums.withColumn(KEY_TEXT, canonical_key(F.col(key), fact.schema[key].dataType))
    if rows is not None:
        # An unmatched sale lacks the attributes, if there are any.
        how = "left" if keep_unmatched or not attributes else "inner"
        if key_text:
            rows = rows.hint("merge")
        # A number stands for the columns of the month while the sums are dealt by key.
        months = F.broadcast(_numbered(dim_tiempo.select(*MONTH).dropna().distinct(), _month=MONTH))
        a, b = sums.alias("a"), months.alias("b")
        same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in MONTH]
        sums = a.join(b, same, "left").select(
            "b._month", *[F.col(f"a.`{c}`") for c in sums.columns if c not in MONTH]
        )
        sums = sums.join(rows, F.col(KEY_TEXT) == F.col("_key"), how).join(months, "_month", "left")
        times = F.coalesce("_times", F.lit(1))
        known = F.col("_key").isNotNull()
    elif key_text:
        sums = sums.repartition(KEY_TEXT)
    units = []
    if any(c.startswith("_units") for c in sums.columns):
        units.append(summed(sums, "_units", times).alias(UNITS))
    described = [F.col(f"`{name}`") for name in attributes]
    cause = []
    if keep_unmatched:
        described = [
            F.when(known, F.col(f"`{f.name}`")).otherwise(UNKNOWN).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in (sums.schema[name] for name in attributes)
        ]
        cause = [_cause(key, attributes, known).alias(CAUSE)]
    text = [KEY_TEXT] if key_text else []
    return sums.select(*MONTH, key, *described, *cause, *_totals(sums, times), *units, *text)


def _ranked(sales: DataFrame, key: str, share: bool = False) -> DataFrame:
    """Written sales with both ranks and the ``share`` of the month, sorted by month, rank and key. Their rows are moved
    once, to be sorted: they lie in buckets by the key, where the ranks of keys come to them."""
    s, r = sales.alias("s"), key_ranks(sales, key, KEY_TEXT).hint("merge").alias("r")
    # Several keys may have one text; as an equality this would be one more column to deal by.
    own = F.col(f"s.{key}").between(F.col(f"r.{key}"), F.col(f"r.{key}"))
    ranked = s.join(r, (F.col(f"s.{KEY_TEXT}") == F.col(f"r.{KEY_TEXT}")) & own, "left")
    columns = [F.col(f"s.`{c}`") for c in sales.columns if c != KEY_TEXT]
    ranked = ranked.select(*columns, "r.ranking_global")
    if share:
        # Before the sort: the optimizer drops a sort that a join follows.
        ranked = month_share(ranked, sales)
    return sorted_ranks(ranked, PERIOD, SALES, "ranking_mes", key, values=sales)


def _finished(df: DataFrame, columns: Sequence[str], loaded_at: datetime | None):
    """The columns of ``_ranked`` rows, in whose order they stay."""
    return df.select(*columns).withColumn(GOLD_AT, stamp(loaded_at))


def kpi_ventas_por_cliente(
    fact: DataFrame,
    dim_clientes: DataFrame,
    dim_tiempo: DataFrame,
    loaded_at: datetime | None = None,
    keep_unmatched: bool = False,
    cube: DataFrame | None = None,
) -> DataFrame:
    """Sales by month and customer, see ``entity_sales``. What has no month or key has no
    rank there."""
    sales = entity_sales(fact, dim_clientes, dim_tiempo, "cliente", "cli", keep_unmatched, cube, True)
    # The totals feed several groupings; written, the fact is read once.
    sales = written(sales.drop(UNITS), "customer_sales", by=KEY_TEXT)
    ranked = _ranked(sales, "fk_cliente")
    own = [c for c in sales.columns if c != KEY_TEXT]
    return _finished(ranked, [*own, "ranking_mes", "ranking_global"], loaded_at)


def kpi_ventas_por_producto(
    fact: DataFrame,
    dim_productos: DataFrame,
    dim_tiempo: DataFrame,
    loaded_at: datetime | None = None,
    keep_unmatched: bool = False,
    cube: DataFrame | None = None,
) -> DataFrame:
    """Sales by month and product, see ``entity_sales``. What has no month or key has no
    rank or share there."""
    sales = entity_sales(fact, dim_productos, dim_tiempo, "producto", "prod", keep_unmatched, cube, True)
    sales = written(sales, "product_sales", by=KEY_TEXT)
    ranked = _ranked(sales, "fk_producto", share=True)
    own = [c for c in sales.columns if c != KEY_TEXT]
    columns = [*own, "ranking_mes", "ranking_global", "participacion_mes_pct"]
    return _finished(ranked, columns, loaded_at)
