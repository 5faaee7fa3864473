import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import order
from strata.operators.clean import clean, column_profiles
from strata.operators.losses import lost_report, lost_sketches
from strata.operators.star import (
    calendar,
    day_leads,
    dim_clientes,
    dim_productos,
    dim_tiempo,
    fact_ventas,
)

AT = dt.datetime(2024, 5, 1, tzinfo=dt.UTC)


def one_column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def column(df, name="c"):
    return sorted((r[name] for r in df.collect()), key=repr)


# Cleaning.


def test_text_is_upper_and_stripped(spark):
    df = clean(one_column(spark, ["inés", "  Tomás  ", " none ", "", "Nat"], "string"))
    assert column(df) == ["INÉS", "NAT", "TOMÁS", None, None]


def test_two_decimals(spark):
    assert column(clean(one_column(spark, [2.7182, 8.999], "double"))) == [2.72, 9.0]


def test_integers_stay(spark):
    df = clean(one_column(spark, [1, 2, 3], "int"))
    assert df.dtypes[0] == ("c", "bigint") and column(df) == [1, 2, 3]
    assert column(clean(one_column(spark, ["1", "2.0", "9007199254740993"], "string"))) == [
        1, 2, 9007199254740993,
    ]


def test_huge_whole_numbers_stay_doubles(spark):
    assert column(clean(one_column(spark, ["1e30", "5"], "string"))) == [1e30, 5.0]


def test_empty_rows_and_audit_columns_go(spark):
    df = spark.createDataFrame(
        [("ANA", 25, "f"), (None, None, "f"), ("LUIS", 30, "f"), ("NONE", None, "f")],
        "nombre string, edad int, _source_file string",
    )
    found = clean(df, AT)
    assert found.columns == ["nombre", "edad", "_silver_loaded_at"]
    assert found.count() == 3


def test_table_without_rows_is_unchanged(spark):
    df = spark.createDataFrame([], "a string, _source_file string")
    assert clean(df).columns == ["a", "_source_file"]


def test_only_empty_rows(spark):
    df = spark.createDataFrame([(None, "f")], "a string, _source_file string")
    assert clean(df).count() == 0


def test_half_of_all_rows_makes_a_number(spark):
    half = one_column(spark, ["1", "2", "x", "y"], "string")
    assert column(clean(half)) == [1, 2, None, None]
    less = spark.createDataFrame(
        [("1", "a"), ("2", "a"), ("x", "a"), (None, "a"), (None, "a")], "c string, d string"
    )
    assert column(clean(less)) == ["1", "2", "X", None, None]


def test_profiles(spark, caplog):
    df = spark.createDataFrame(
        [("1.5", "a", None), ("2", "b", None), ("x", None, None), (None, None, None)],
        "n string, t string, z string",
    )
    found = {r.column_name: r[1:] for r in column_profiles(df).collect()}
    assert found == {
        "n": (4, 3, 3, 2, True, "decimal"),
        "t": (4, 3, 2, 0, False, "text"),
        "z": (4, 3, 0, 0, False, "text"),
    }
    clean(df)
    assert "n: 1 values" in caplog.text


def test_only_audit_columns(spark):
    df = spark.createDataFrame([("f",)], "_source_file string")
    assert clean(df).columns == ["_source_file"]


def test_other_types(spark):
    df = spark.sql("SELECT true b, DATE'2024-01-02' d, CAST(1.005 AS decimal(10,3)) x")
    assert clean(df).drop("_silver_loaded_at").first()[:] == (True, "2024-01-02", 1.0)


# Calendar.


@pytest.fixture(scope="module")
def days(spark):
    return dim_tiempo(spark, 2024, dt.date(2025, 3, 10), AT)


def day(days, text):
    return days.where(F.col("fecha") == text).first()


def test_calendar_columns_and_rows(days):
    assert days.columns == [
        "sk_tiempo", "fecha", "anio", "trimestre", "trimestre_nombre", "mes", "mes_nombre",
        "semana_anio", "dia_mes", "dia_semana", "dia_semana_nombre", "es_fin_semana", "es_bisiesto",
        "dia_del_anio", "quincena", "periodo_yyyymm", "periodo_yyyyqq", "_silver_loaded_at",
    ]
    assert days.count() == 366 + 31 + 28 + 10
    assert days.select("sk_tiempo").distinct().count() == days.count()
    assert days.agg(F.min("anio")).first()[0] == 2024


def test_calendar_days(days):
    assert tuple(day(days, "2024-01-01"))[:-1] == (
        20240101, dt.date(2024, 1, 1), 2024, 1, "PRIMER TRIMESTRE", 1, "ENERO", 1, 1, 1, "LUNES",
        False, True, 1, 1, 202401, "2024Q1",
    )
    assert tuple(day(days, "2024-12-31"))[:-1] == (
        20241231, dt.date(2024, 12, 31), 2024, 4, "CUARTO TRIMESTRE", 12, "DICIEMBRE", 1, 31, 2,
        "MARTES", False, True, 366, 2, 202412, "2024Q4",
    )
    assert day(days, "2024-01-06").es_fin_semana and day(days, "2024-01-07").es_fin_semana
    assert day(days, "2024-01-07").dia_semana_nombre == "DOMINGO"
    assert day(days, "2024-12-01").mes_nombre == "DICIEMBRE"
    assert (day(days, "2024-01-10").quincena, day(days, "2024-01-20").quincena) == (1, 2)
    assert not day(days, "2025-01-01").es_bisiesto


def test_calendar_runs_to_today_and_in_other_languages(spark):
    last = dim_tiempo(spark).agg(F.max("fecha")).first()[0]
    assert abs((last - dt.datetime.now(dt.UTC).date()).days) <= 1
    bounds = spark.sql("SELECT DATE'2024-02-01' first, DATE'2024-02-01' last")
    english = calendar(bounds, [f"M{i}" for i in range(1, 13)]).first()
    assert english.mes_nombre == "M2"


# Dimensions and fact.


def test_customers(spark):
    df = spark.createDataFrame([(10, "ANA"), (20, "LUIS")], "id_cliente int, nombre string").coalesce(1)
    found = dim_clientes(df, loaded_at=AT)
    assert found.columns == ["sk_cliente", "nk_cliente", "nombre", "_silver_loaded_at"]
    assert sorted(r[:3] for r in found.collect()) == [(1, 10, "ANA"), (2, 20, "LUIS")]


def test_products(spark):
    df = spark.createDataFrame([("X", 200), ("Y", 100)], "nombre string, id_producto int")
    found = dim_productos(df, ["id_producto"])
    assert sorted(r[:3] for r in found.collect()) == [(1, "Y", 100), (2, "X", 200)]
    assert "nk_producto" in found.columns


def test_dimension_without_id(spark):
    found = dim_clientes(spark.createDataFrame([("ANA",)], "nombre string"))
    assert found.columns == ["sk_cliente", "nombre", "_silver_loaded_at"]


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [(1, "2023-11-02", 41, 700, 12.75), (2, "2025-02-28", 42, 800, 99.0), (3, "?", 30, 300, 1.0)],
        "id_venta int, Fecha string, id_cliente int, `ID-Producto` int, total double",
    ).coalesce(1)


def test_fact(sales):
    found = fact_ventas(sales, ["id_venta"], AT)
    assert found.columns == [
        "sk_venta", "fk_cliente", "fk_producto", "fk_fecha", "id_venta", "total", "_silver_loaded_at",
    ]
    assert sorted(tuple(r)[:5] for r in found.collect()) == [
        (1, 41, 700, 20231102, 1), (2, 42, 800, 20250228, 2), (3, 30, 300, None, 3),
    ]


def test_fact_without_roles(spark):
    row = fact_ventas(spark.createDataFrame([(1,)], "x int")).first()
    assert (row.sk_venta, row.fk_cliente, row.fk_producto, row.fk_fecha, row.x) == (1, None, None, None, 1)


# Row numbers and ranks.


def test_row_numbers_in_arrival_order(spark):
    df = spark.range(0, 1000, 1, 7)
    found = sorted(tuple(r) for r in order.add_row_number(df, "n").collect())
    assert found == [(i + 1, i) for i in range(1000)]


def test_row_numbers_sorted(spark):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).alias("k"), "id")
    found = sorted(tuple(r)[:2] for r in order.add_row_number(df, "n", ["k"]).collect())
    assert found == [(i + 1, i) for i in range(5000)]


def test_row_numbers_spread_copies_of_a_key(spark):
    """A key that holds most rows is numbered by several tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(0, 40_000, 1, 4).select(F.when(F.col("id") < 1000, F.col("id")).otherwise(5000).alias("k"))
    numbered = order.add_row_number(df, "n", ["k"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert numbered.select(F.count_distinct("n"), F.min("n"), F.max("n")).first()[:] == (40_000, 1, 40_000)
    sizes = [
        r["count"]
        for r in spark.read.parquet(*numbered.inputFiles())  # the written rows
        .where("k = 5000")
        .groupBy(F.shiftrightunsigned("_slot", 33))
        .count()
        .collect()
    ]
    assert len(sizes) > 1 and max(sizes) < 20_000


def test_row_numbers_of_nothing(spark):
    assert order.add_row_number(spark.range(0), "n").count() == 0


def test_large_ranks_equal_windows(spark):
    df = spark.createDataFrame(
        [
            ("a", v)
            for v in [0, 1, -1, 5, 5, 5, 2**21, 2**21 - 1, 2**42, 2**42 + 7, -(2**50), 2**62, -(2**62)]
        ]
        + [("b", 7), ("b", 7), ("b", -9)],
        "g string, v bigint",
    )
    window = Window.partitionBy("g").orderBy(F.desc("v"))
    plain = df.withColumn("r", F.dense_rank().over(window))
    rows = lambda d: sorted(tuple(r) for r in d.select("g", "v", "r").collect())
    assert rows(order.add_dense_rank(df, ["g"], "v", "r")) == rows(plain)
    ungrouped = order.add_dense_rank(df.drop("g"), [], "v", "r")
    assert sorted(tuple(r) for r in ungrouped.select("v", "r").collect())[-1] == (2**62, 1)


def test_ranks_keep_rows_without_group_or_value(spark):
    df = spark.createDataFrame([("a", 1.5), ("a", None), (None, 2.0), (None, None)], "g string, v double")
    found = order.add_dense_rank(df, ["g"], "v", "r").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [("a", 1.5, 1), ("a", None, None), (None, 2.0, None), (None, None, None)], key=repr
    )


# Lost values.


def report(sketches, top=10):
    return {
        r["column_name"]: (r["lost_rows"], [(t["text"], t["rows"]) for t in r["texts"]])
        for r in lost_report(sketches, top).collect()
    }


def test_lost_texts_are_counted_by_column(spark):
    rows = [("1", "x", "n/a"), ("2", "x", "3"), (" n/a ", "1", "4"), ("n/a", None, "5"), ("?", "y", "6")]
    rows += [(str(i), "x", str(i)) for i in range(9)]
    df = spark.createDataFrame([(*r, "a.xlsx") for r in rows], "a string, b string, `c.d` string, _source_file string")
    assert report(lost_sketches(df)) == {"a": (3, [("n/a", 2), ("?", 1)]), "c.d": (1, [("n/a", 1)])}
    assert report(lost_sketches(df), 1)["a"] == (3, [("n/a", 2)])


def test_lost_texts_of_loads_are_merged(spark):
    def load(*texts):
        return lost_sketches(one_column(spark, [*texts, *map(str, range(9))], "string"))

    empty = lost_sketches(one_column(spark, [], "string"))
    none = lost_sketches(one_column(spark, ["1", None], "string"))
    assert report(load("x", "y").union(load("y", "z")).union(none).union(empty)) == {
        "c": (4, [("y", 2), ("x", 1), ("z", 1)])
    }
    assert report(none) == report(empty) == {}


# Dates whose shape the column tells.


def test_dates_vote_for_the_day_or_the_month_first(spark):
    rows = [
        ("13/02/2024", "02/13/2024", "01/02/2024", None, 20240102),
        ("01/02/2024", "02/01/2024", "3 May 2024", "x", 20240103),
        ("02-25-2024", "25.02.2024", "", "", None),
        ("14/03/2024", "03/14/2024", None, "32/32/2024", 5),
    ]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e bigint")
    assert day_leads(df, df.columns) == {"a": True, "b": False, "c": False, "d": False, "e": False}
    assert day_leads(df.where("1 = 0"), ["a"]) == {"a": False}
    assert day_leads(df, []) == {}
    sales = df.select(F.col("a").alias("fecha"))
    assert column(fact_ventas(sales, day_first=None), "fk_fecha") == [
        20240201, 20240213, 20240225, 20240314,
    ]
    assert column(fact_ventas(sales), "fk_fecha")[0] == 20240102
    assert column(fact_ventas(df.select("b"), day_first=None), "fk_fecha") == [None] * 4
