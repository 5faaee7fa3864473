import datetime as dt
import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import kpis, order
from strata.operators.coverage import key_coverage, key_sample
from strata.operators.star import dim_tiempo

AT = dt.datetime(2024, 5, 1, tzinfo=dt.UTC)
FACT = "sk_venta int, fk_cliente int, fk_producto int, fk_fecha int, total double, cantidad int"


@pytest.fixture(scope="module")
def days(spark):
    return dim_tiempo(spark, 2024, dt.date(2025, 12, 31))


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame(
        [
            (1, 10, 200, 20240103, 12.5, 5), (2, 30, 100, 20240119, 40.0, 2),
            (3, 20, 100, 20240207, 7.25, 1), (4, 30, 200, 20240528, 100.0, 4),
            (5, 20, 200, 20240528, 60.5, 2), (6, 10, 100, 20240531, 60.5, 3),
            (7, 10, 100, 20240209, 20.75, 1),
        ],
        FACT,
    )


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [(1, 10, "LUNA", "SALTA"), (2, 20, "RIO", "CUSCO"), (3, 30, "SOL", "QUITO")],
        "sk_cliente int, nk_cliente int, nombre string, ciudad string",
    )


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [(1, 100, "MESA", "HOGAR"), (2, 200, "LAMPARA", "LUZ")],
        "sk_producto int, nk_producto int, nombre string, categoria string",
    )


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# By period.


def test_periods(fact, days):
    kpi = kpis.kpi_ventas_por_periodo(fact, days, AT)
    assert kpi.columns == [
        "anio", "trimestre", "trimestre_nombre", "mes", "mes_nombre", "periodo_yyyymm", "total_ventas",
        "cantidad_transacciones", "ticket_promedio", "variacion_mes_anterior_pct", "acumulado_anual",
        "_gold_loaded_at",
    ]
    assert rows(kpi, *kpi.columns[5:11]) == [
        (202401, 52.5, 2, 26.25, None, 52.5),
        (202402, 28.0, 2, 14.0, -46.67, 80.5),
        (202405, 221.0, 3, 73.67, 689.29, 301.5),
    ]
    assert rows(kpi, "mes_nombre", "trimestre_nombre")[2] == ("MAYO", "SEGUNDO TRIMESTRE")


def sales(spark, data, schema=FACT):
    return spark.createDataFrame(data, schema)


def test_growth_follows_rows_and_years_start_anew(spark, days):
    kpi = kpis.kpi_ventas_por_periodo(
        sales(
            spark,
            [
                (1, 1, 1, 20241105, 0.0, 1), (2, 1, 1, 20241205, 10.0, 1), (3, 1, 1, 20250301, -5.0, 1),
                (4, 1, 1, 20250401, 0.0, 1), (5, 1, 1, 20250501, 0.0, 1), (6, 1, 1, 20250601, -3.0, 1),
            ],
        ),
        days,
    )
    assert rows(kpi, "periodo_yyyymm", "variacion_mes_anterior_pct", "acumulado_anual") == [
        (202411, None, 0.0), (202412, math.inf, 10.0), (202503, -150.0, -5.0), (202504, -100.0, -5.0),
        (202505, None, -5.0), (202506, -math.inf, -8.0),
    ]


def test_sales_without_a_day_are_left_out(spark, days):
    data = [(1, 1, 1, 20240115, 5.0, 1), (2, 1, 1, None, 7.0, 1), (3, 1, 1, 19990101, 9.0, 1)]
    assert rows(kpis.kpi_ventas_por_periodo(sales(spark, data), days), "total_ventas") == [(5.0,)]


def test_amounts(spark, days):
    """No number counts as 0, a missing sale key is not counted, sums are exact."""
    schema = "sk_venta int, fk_fecha int, Monto string"
    data = [(1, 20240115, "0.1"), (None, 20240115, "0.2"), (3, 20240116, "x"), (4, 20240117, None)]
    kpi = kpis.kpi_ventas_por_periodo(sales(spark, data, schema), days)
    assert rows(kpi, "total_ventas", "cantidad_transacciones", "ticket_promedio") == [(0.3, 3, 0.1)]
    uncounted = kpis.kpi_ventas_por_periodo(sales(spark, data[1:2], schema), days)
    assert rows(uncounted, "cantidad_transacciones", "ticket_promedio") == [(0, math.inf)]
    no_amount = kpis.kpi_ventas_por_periodo(sales(spark, data, schema).drop("Monto"), days)
    assert rows(no_amount, "total_ventas", "ticket_promedio") == [(0.0, 0.0)]


def test_ticket_comes_from_the_unrounded_sum(spark, days):
    data = [(1, 20240115, 0.004), (2, 20240115, 0.008)]
    kpi = kpis.kpi_ventas_por_periodo(sales(spark, data, "sk_venta int, fk_fecha int, total double"), days)
    assert rows(kpi, "total_ventas", "ticket_promedio") == [(0.01, 0.01)]


def test_sums_do_not_depend_on_order(spark, days):
    data = [(i, 1, 1, 20240101 + i % 28, (i * 37 % 10007) / 100 + 1e9, 1) for i in range(3000)]
    found = {
        rows(
            kpis.kpi_ventas_por_periodo(sales(spark, data[::step]).repartition(n), days), "total_ventas"
        )[0]
        for step, n in ((1, 3), (-1, 7))
    }
    assert len(found) == 1


# By customer.


def test_customers(fact, customers, days):
    kpi = kpis.kpi_ventas_por_cliente(fact, customers, days, AT)
    assert kpi.columns == [
        "anio", "mes", "mes_nombre", "periodo_yyyymm", "fk_cliente", "nombre", "ciudad", "total_ventas",
        "cantidad_transacciones", "ticket_promedio", "ranking_mes", "ranking_global", "_gold_loaded_at",
    ]
    assert rows(kpi, *kpi.columns[3:12]) == [
        (202401, 30, "SOL", "QUITO", 40.0, 1, 40.0, 1, 1),
        (202401, 10, "LUNA", "SALTA", 12.5, 1, 12.5, 2, 2),
        (202402, 10, "LUNA", "SALTA", 20.75, 1, 20.75, 1, 2),
        (202402, 20, "RIO", "CUSCO", 7.25, 1, 7.25, 2, 3),
        (202405, 30, "SOL", "QUITO", 100.0, 1, 100.0, 1, 1),
        (202405, 10, "LUNA", "SALTA", 60.5, 1, 60.5, 2, 2),
        (202405, 20, "RIO", "CUSCO", 60.5, 1, 60.5, 2, 3),
    ]


def test_amounts_of_any_size(spark, customers, days):
    """Small amounts add up, large and infinite ones neither fail nor vanish."""
    data = [(n, 10, 1, 20240101, 4e-7, 1) for n in range(100_000)]
    data += [(1, 20, 1, 20240101, 1e23, 1), (2, 20, 1, 20240101, 1e18, 1), (3, 30, 1, 20240101, float("inf"), 1)]
    kpi = kpis.kpi_ventas_por_cliente(sales(spark, data).repartition(7), customers, days)
    assert rows(kpi, "fk_cliente", "total_ventas", "ranking_mes", "ranking_global") == [
        (30, float("inf"), 1, 1), (20, 1e23 + 1e18, 2, 2), (10, 0.04, 3, 3),
    ]


def test_equal_totals_share_a_rank(spark, customers, days):
    data = [(1, 10, 1, 20240101, 5.0, 1), (2, 20, 1, 20240102, 5.0, 1), (3, 30, 1, 20240103, 1.0, 1)]
    kpi = kpis.kpi_ventas_por_cliente(sales(spark, data), customers, days)
    assert rows(kpi, "fk_cliente", "ranking_mes", "ranking_global") == [(10, 1, 1), (20, 1, 1), (30, 2, 2)]


def test_missing_and_repeated_customers(spark, days):
    """Without a match or with a null attribute sales vanish; a repeated customer
    counts its sales again."""
    data = [(i, k, 1, 20240101, 10.0, 1) for i, k in enumerate([1, 2, 3, 4, None, 3])]
    dim = spark.createDataFrame(
        [(1.0, "A", "x"), (2.0, "B", None), (3.0, "C", "x"), (3.0, "C", "x"), (3.0, "D", "x")],
        "nk_cliente double, nombre string, zona string",
    )
    kpi = kpis.kpi_ventas_por_cliente(sales(spark, data), dim, days)
    found = rows(kpi, "fk_cliente", "nombre", "total_ventas", "cantidad_transacciones", "ranking_global")
    assert sorted(found) == [(1, "A", 10.0, 1, 2), (3, "C", 40.0, 4, 1), (3, "D", 20.0, 2, 1)]


def test_dimension_without_attributes_or_key(spark, fact, customers, days):
    keys = customers.select("nk_cliente").where("nk_cliente < 30")
    found = rows(kpis.kpi_ventas_por_cliente(fact, keys, days), "fk_cliente", "total_ventas")
    assert (30, 40.0) in found and len(found) == 7
    no_key = kpis.kpi_ventas_por_cliente(fact, customers.drop("nk_cliente"), days)
    assert no_key.columns[4:6] == ["fk_cliente", "total_ventas"] and no_key.count() == 7


def test_attribute_names_that_are_taken(fact, customers, days):
    dim = customers.withColumnsRenamed({"nombre": "total", "ciudad": "mes"})
    kpi = kpis.kpi_ventas_por_cliente(fact, dim, days)
    assert kpi.columns[5:7] == ["cli_total", "cli_mes"]


def test_text_keys(spark, fact, customers, days):
    padded = customers.withColumn("nk_cliente", F.concat(F.lit(" "), "nk_cliente", F.lit(" ")))
    assert kpis.kpi_ventas_por_cliente(fact, padded, days).count() == 7
    as_double = fact.withColumn("fk_cliente", F.col("fk_cliente").cast("double"))
    assert kpis.kpi_ventas_por_cliente(as_double, padded, days).count() == 7


def brute_force(sales, dim, days):
    """Join row by row, then group, rank and share as the definitions say."""
    groups = {}
    for sale in sales:
        month = days.get(sale["fk_fecha"])
        for row in dim:
            group = (month, sale["fk_producto"], row["nombre"], row["zona"])
            if row["nk_producto"] is None or str(row["nk_producto"]) != str(sale["fk_producto"]):
                continue
            if None not in group:
                groups.setdefault(group, []).append((sale["total"] or Decimal(0), sale["cantidad"] or 0))
    kpi = {g: float(sum(t for t, _ in rows)) for g, rows in groups.items()}
    months, keys = {}, {}
    for (month, key, *_), total in kpi.items():
        months.setdefault(month, []).append(total)
        keys[key] = keys.get(key, Decimal(0)) + Decimal(str(total))
    places = sorted(set(keys.values()), reverse=True)
    found = []
    for (month, key, *names), total in kpi.items():
        rows = groups[month, key, *names]
        found.append(
            (
                month, key, *names, total, len(rows), float(np.round(total / len(rows), 2)), sum(u for _, u in rows),
                sorted(set(months[month]), reverse=True).index(total) + 1, places.index(keys[key]) + 1,
            )
        )
    return sorted(found)


def test_random_sales_against_brute_force(spark, days):
    rng = random.Random(11)
    data = []
    for n in range(400):
        key = 1 if rng.random() < 0.4 else rng.choice([2, 3, 4, 5, 6, None])
        day = rng.choice([20240110, 20240111, 20240205, 20250301, 19990101, None])
        total = rng.choice([None, Decimal(rng.randrange(-500, 5000)) / 4])
        data.append((n, 1, key, day, total, rng.choice([None, 1, 2])))
    schema = FACT.replace("total double", "total decimal(12,2)")
    dim = [
        (key, name, zone)
        for key in (1, 2, 3, 4, 5, None)
        for name in rng.sample(["A", "B", "B", None], 2)
        for zone in (["N", "N"] if key == 3 else ["S"])
    ]
    products = spark.createDataFrame(dim, "nk_producto int, nombre string, zona string")
    kpi = kpis.kpi_ventas_por_producto(sales(spark, data, schema), products, days)
    found = rows(
        kpi, "periodo_yyyymm", "fk_producto", "nombre", "zona", "total_ventas", "cantidad_transacciones",
        "ticket_promedio", "cantidad_unidades", "ranking_mes", "ranking_global",
    )
    names = ["sk_venta", "fk_cliente", "fk_producto", "fk_fecha", "total", "cantidad"]
    expected = brute_force(
        [dict(zip(names, row, strict=True)) for row in data],
        [dict(zip(["nk_producto", "nombre", "zona"], row, strict=True)) for row in dim],
        {20240110: 202401, 20240111: 202401, 20240205: 202402, 20250301: 202503},
    )
    assert sorted(found) == expected


# By product.


def test_products(fact, products, days):
    kpi = kpis.kpi_ventas_por_producto(fact, products, days, AT)
    assert kpi.columns == [
        "anio", "mes", "mes_nombre", "periodo_yyyymm", "fk_producto", "nombre", "categoria",
        "total_ventas", "cantidad_transacciones", "ticket_promedio", "cantidad_unidades", "ranking_mes",
        "ranking_global", "participacion_mes_pct", "_gold_loaded_at",
    ]
    assert rows(kpi, *kpi.columns[3:5], *kpi.columns[7:14]) == [
        (202401, 100, 40.0, 1, 40.0, 2.0, 1, 2, 76.19),
        (202401, 200, 12.5, 1, 12.5, 5.0, 2, 1, 23.81),
        (202402, 100, 28.0, 2, 14.0, 2.0, 1, 2, 100.0),
        (202405, 200, 160.5, 2, 80.25, 6.0, 1, 1, 72.62),
        (202405, 100, 60.5, 1, 60.5, 3.0, 2, 2, 27.38),
    ]


def test_products_without_quantity(fact, products, days):
    kpi = kpis.kpi_ventas_por_producto(fact.drop("cantidad"), products, days)
    assert "cantidad_unidades" not in kpi.columns


def test_share_of_an_empty_month(spark, products, days):
    data = [(1, 1, 100, 20240101, 0.0, 1), (2, 1, 200, 20240201, 5.0, 1), (3, 1, 100, 20240202, -5.0, 1)]
    kpi = kpis.kpi_ventas_por_producto(sales(spark, data), products, days)
    assert rows(kpi, "total_ventas", "participacion_mes_pct") == [
        (0.0, None), (5.0, math.inf), (-5.0, -math.inf),
    ]


def test_shares_add_up(spark, days):
    data = [(i, 1, i % 9, 20240101 + i % 28, float(i), 1) for i in range(500)]
    dim = spark.createDataFrame([(i, f"P{i}") for i in range(9)], "nk_producto int, nombre string")
    kpi = kpis.kpi_ventas_por_producto(sales(spark, data), dim, days)
    total = kpi.agg(F.sum("participacion_mes_pct")).first()[0]
    assert abs(total - 100) < 0.1


# Keys.


def test_key_coverage(spark, fact, customers):
    more = fact.unionByName(fact.limit(2).withColumn("fk_cliente", F.lit(99))).unionByName(
        fact.limit(1).withColumn("fk_cliente", F.lit(None).cast("int"))
    )
    report = key_coverage(more, "fk_cliente", customers, "nk_cliente").first().asDict()
    assert report == {
        "rows": 10, "rows_without_key": 1, "unmatched_rows": 3, "distinct_keys": 4, "unmatched_keys": 1,
    }
    assert rows(key_sample(more, "fk_cliente", 2), "key") == [(10,), (20,)]


# Ranks of rows that are moved once.


def test_sorted_ranks_equal_dense_ranks(spark):
    random.seed(5)
    values = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1.5]
    data = [
        (random.choice([None, 202401, 202402]), random.choice([*values, float(random.randrange(900))]), i)
        for i in range(1500)
    ]
    # A value that many rows share, and a month of one value.
    data += [(202401, 7.0, 2000 + i) for i in range(800)] + [(202403, 1.0, 9000 + i) for i in range(50)]
    df = spark.createDataFrame(data, "m int, v double, k int").repartition(7)
    found = [tuple(r) for r in order.sorted_ranks(df, "m", "v", "r", "k").collect()]
    expected = {r.k: r.r for r in order.add_dense_rank(df, ["m"], "v", "r").collect()}
    assert {r[2]: r[3] for r in found} == expected and len(found) == len(data)
    places = [(m or 0, r or 0, k) for m, _, k, r in found]
    assert places == sorted(places)


def test_sales_with_attributes_move_once(spark, fact, products, days):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kpi = kpis.kpi_ventas_por_producto(fact, products, days, AT)
        plan = kpi._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # To be sorted. The ranks of the keys come to the buckets; months are summed.
    assert plan.count("Exchange rangepartitioning") == 1, plan
    dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert dealt and not any("nombre" in line or "total_ventas" in line for line in dealt), plan


def test_keys_of_one_text_keep_their_ranks(spark, days):
    data = [(1, "10", 20240101, 5.0), (2, " 10", 20240101, 9.0), (3, "10", 20240201, 8.0), (4, "2", 20240101, 9.0)]
    fact = spark.createDataFrame(data, "sk_venta int, fk_cliente string, fk_fecha int, total double")
    dim = spark.createDataFrame([("10", "A"), ("2", "B")], "nk_cliente string, nombre string")
    kpi = kpis.kpi_ventas_por_cliente(fact, dim, days)
    assert rows(kpi, "periodo_yyyymm", "fk_cliente", "ranking_mes", "ranking_global") == [
        (202401, " 10", 1, 2), (202401, "2", 1, 2), (202401, "10", 2, 1), (202402, "10", 1, 1),
    ]
