import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import scalars as s
from strata.functions.names import (
    column_name,
    find_column,
    find_column_loosely,
    header_names,
    table_name,
    unit_parts,
)


def results(spark, values, kind, rule):
    """Rule applied to each value, in the order given."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind.simpleString()}")
    return [r[0] for r in rows.orderBy("i").select(rule(F.col("v")).alias("r")).collect()]


def test_number_grammar(spark):
    cases = {
        "12": 12.0, " 12 ": 12.0, "+5": 5.0, "-5": -5.0, ".5": 0.5, "5.": 5.0, "1e3": 1000.0,
        "1E-2": 0.01, "\t7\n": 7.0, "7\xa0": None, "0012": 12.0, "1d": None, "1f": None, "1_000": None, "1,000": None,
        "0x10": None, "1e400": None, "inf": None, "nan": None, "": None, "1 2": None, "--1": None,
        None: None,
    }
    found = results(spark, list(cases), T.StringType(), lambda c: s.number(c, T.StringType()))
    assert found == list(cases.values())


def test_numbers_as_pandas_reads_them(spark):
    rng = random.Random(5)
    texts = sorted(
        {"".join(rng.choice("0123456789+-.e _,dfx\t\xa0") for _ in range(rng.randint(1, 5))) for _ in range(4000)}
    )
    found = results(spark, texts, T.StringType(), lambda c: s.number(c, T.StringType()))
    for text, number in zip(texts, found, strict=True):
        expected = pd.to_numeric(pd.Series([text], dtype=object), errors="coerce").iloc[0]
        if number is None:
            assert math.isnan(expected), text
        else:
            assert math.isclose(number, expected, rel_tol=1e-15), text


def test_rounding_and_text_of_doubles(spark):
    rng = np.random.default_rng(5)
    doubles = [*rng.uniform(-1e6, 1e6, 2000), *(np.arange(-400, 400) / 8), *(np.arange(0, 2, 0.005))]
    doubles = [float(d) for d in doubles]
    assert results(spark, doubles, T.DoubleType(), s.round2) == list(np.round(doubles, 2))
    texts = results(spark, doubles, T.DoubleType(), lambda c: s.as_text(c, T.DoubleType()))
    assert texts == [repr(d) for d in doubles]


def test_number_of_nan_is_null(spark):
    values = [1.5, float("nan"), None]
    found = results(spark, values, T.DoubleType(), lambda c: s.number(c, T.DoubleType()))
    assert found == [1.5, None, None]


def test_whole_keeps_all_digits(spark):
    values = ["9007199254740993", "5.0", "1e3", "x", None, " 7 "]
    found = results(spark, values, T.StringType(), lambda c: s.whole(c, T.StringType()))
    assert found == [9007199254740993, 5, 1000, None, None, 7]


def test_round2_takes_halves_to_even(spark):
    cases = {
        0.125: 0.12, 0.375: 0.38, 1.005: 1.0, 1.255: 1.25, 2.675: 2.68, -0.125: -0.12,
        10.5678: 10.57, 3.14159: 3.14, 1e300: 1e300,
    }
    assert results(spark, list(cases), T.DoubleType(), s.round2) == list(cases.values())


def test_ratio_of_zero(spark):
    rows = spark.createDataFrame(
        [(0, 4.0, 2.0), (1, 3.0, 0.0), (2, -3.0, 0.0), (3, 0.0, 0.0), (4, 1.0, None)],
        "i int, a double, b double",
    )
    found = [r.r for r in rows.select("i", s.ratio(F.col("a"), F.col("b")).alias("r")).orderBy("i").collect()]
    assert found == [2.0, math.inf, -math.inf, None, None]


def test_strip_removes_blanks_of_all_scripts(spark):
    values = ["  bogota  ", "\xa0x\u3000", "\x1fa b\u2003", "\u200b"]
    found = results(spark, values, T.StringType(), s.strip)
    assert found == [v.strip() for v in values]


def test_clean_text(spark):
    cases = {
        "juan": "JUAN", " nan ": None, "None": None, "  ": None, "nat": "NAT", "nanna": "NANNA",
        "niño": "NIÑO", None: None,
    }
    assert results(spark, list(cases), T.StringType(), s.clean_text) == list(cases.values())


def test_double_as_text(spark):
    cases = {
        1.0: "1.0", 0.1: "0.1", 12345678.5: "12345678.5", 1e7: "10000000.0", -2.5: "-2.5",
        123456789012.25: "123456789012.25", 0.0001: "0.0001", 100.0: "100.0", 0.0: "0.0",
        float("nan"): None,
    }
    found = results(spark, list(cases), T.DoubleType(), lambda c: s.as_text(c, T.DoubleType()))
    assert found == list(cases.values())


def test_other_types_as_text(spark):
    df = spark.sql(
        "SELECT true b, 5L i, 'nan' t, DATE'2024-03-15' d, named_struct('k', 1) n, array(1, 2) a, "
        "CAST(NULL AS string) z"
    )
    row = df.select(*[s.as_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]).first()
    assert list(row) == ["True", "5", None, "2024-03-15", '{"k":1}', "[1,2]", None]


@pytest.mark.parametrize(
    "kind, values, expected",
    [
        (T.StringType(), ["10", " 10 ", "A1", None], ["10", "10", "A1", None]),
        (T.DoubleType(), [10.0, 10.5, None], ["10", "10.5", None]),
        (T.LongType(), [10, None], ["10", None]),
        (T.DecimalType(10, 2), ["10.00", "10.50"], ["10", "10.50"]),
    ],
)
def test_canonical_key(spark, kind, values, expected):
    df = spark.createDataFrame([(i, None if v is None else str(v)) for i, v in enumerate(values)], "i int, v string")
    typed = df.withColumn("v", F.col("v").cast(kind)).orderBy("i")
    found = [r[0] for r in typed.select(s.canonical_key(F.col("v"), kind)).collect()]
    assert found == expected


def test_dates(spark):
    march = dt.date(2024, 3, 15)
    cases = {
        "2024-03-15": march, "2024-03-15 10:11:12": march, "2024-03-15T10:11:12": march,
        "2024-03-15T23:30:00-05:00": march, "2024/3/15": march, " 20240315 ": march,
        "20240315 10:00": march, "05/03/2024": dt.date(2024, 5, 3), "15/03/2024": march,
        "3/15/2024 00:00": march, "15.03.2024": march, "3-15-24": march,
        "3/15/99": dt.date(1999, 3, 15), "3/15/2024 10:00 PM": march, "2024-02-30": None,
        "20241315": None, "2024-03-15 x": None, "32/13/2024": None, "ayer": None, "": None,
        None: None,
    }
    found = results(spark, list(cases), T.StringType(), lambda c: s.parse_date(c, T.StringType()))
    assert found == list(cases.values())


def test_dates_with_names_and_without_days(spark):
    may, march = dt.date(2024, 5, 12), dt.date(2024, 3, 1)
    cases = {
        "12 May 2024": may, "12-MAY-2024": may, "12th may, 2024": may, "May 12, 2024": may,
        "MAY 12 2024 10:00": may, "12-May-24": may, "1 Mar. 2024": march, "March 2024": march,
        "2024-03": march, "2024/3": march, "2024": dt.date(2024, 1, 1), "Sept 3, 2024": dt.date(2024, 9, 3),
        "31 June 2024": None, "12 Mayo 2024": None, "12 Mar": None, "2024-13": None, "May": None,
        "Marchy 1, 2024": None, "204": None,
    }
    found = results(spark, list(cases), T.StringType(), lambda c: s.parse_date(c, T.StringType()))
    assert found == list(cases.values())
    assert results(spark, [2024], T.LongType(), lambda c: s.parse_date(c, T.LongType())) == [None]


def test_dates_of_other_types(spark):
    day_first = results(
        spark, ["05/03/2024"], T.StringType(), lambda c: s.parse_date(c, T.StringType(), True)
    )
    assert day_first == [dt.date(2024, 3, 5)]
    numbers = results(spark, [20240315, 5], T.LongType(), lambda c: s.parse_date(c, T.LongType()))
    assert numbers == [dt.date(2024, 3, 15), None]
    whole = results(
        spark, [20240315.0], T.DoubleType(), lambda c: s.parse_date(c, T.DoubleType())
    )
    assert whole == [dt.date(2024, 3, 15)]


def test_column_names():
    assert column_name("Nombre Completo") == "nombre_completo"
    assert column_name("Fecha Nac.") == "fecha_nac"
    assert column_name(" a - b ") == "a___b"
    assert column_name("año") == "a_o"
    assert column_name("_id_") == "id"
    assert column_name(2024) == "2024"


def test_header_names():
    assert header_names(["a", None, "a", "a"]) == ["a", "Unnamed: 1", "a.1", "a.2"]


def test_table_names(spark):
    cases = {
        ("Ventas 2024.xlsx", "Enero"): "ventas_2024__enero",
        ("Mi Reporte (Q1).xlsx", "Hoja 1"): "mi_reporte_q1__hoja_1",
        ("a" * 50, "b" * 50): "a" * 50 + "__" + "b" * 11,
        ("a" * 62 + ".XLS", "b"): "a" * 62,
        ("datos.csv", "hoja"): "datos__hoja",
        ("Ejercicio Sesion #7 - Clientes.xlsx", "Sheet1"): "ejercicio_sesion_7_clientes__sheet1",
    }
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(cases)], "i int, f string, s string")
    found = [r[0] for r in df.orderBy("i").select(table_name(F.col("f"), F.col("s"))).collect()]
    assert found == list(cases.values())


def test_unit_parts(spark):
    df = spark.createDataFrame([("a.xlsx / x / Hoja",), ("only",)], "s string")
    found = {tuple(r) for r in df.select(*unit_parts(F.col("s"))).collect()}
    assert found == {("a.xlsx", "Hoja"), ("only", "only")}


def test_columns_by_role():
    assert find_column(["x", "id", "id_cliente"], ["id_cliente", "id"]) == "id_cliente"
    assert find_column(["ID"], ["id"]) is None
    assert find_column_loosely(["Id Cliente"], ["id_cliente"]) == "Id Cliente"
    assert find_column_loosely(["ID-CLIENTE", "id_cliente"], ["id_cliente"]) == "id_cliente"
    assert find_column_loosely(["idcliente"], ["id_cliente"]) is None
    assert find_column_loosely(["valor", "monto"], ["total", "monto", "valor"]) == "monto"
