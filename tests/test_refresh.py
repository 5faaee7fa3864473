import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.fixed_values import GOLD_AT
from strata.operators import kpis
from strata.operators.loads import load_unit, rows_without
from strata.operators.star import dim_tiempo
from strata.plans import refresh
from strata.plans.refresh import append_sales, refresh_gold
from strata.session import scratch, written
from strata.sources.catalog import quoted, save, table, table_exists
from strata.sources.partitions import IdIndex, save_partitions

FACT = "sk_venta int, fk_cliente int, fk_producto int, fk_fecha int, total double, cantidad int"


def sales(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows, 1)], FACT)


@pytest.fixture
def star(spark, database):
    """Names of two databases; the first has the dimensions."""
    silver, gold = f"{database}_s", f"{database}_g"
    save(spark.createDataFrame([(1, 10, "SOL"), (2, 20, "RIO")], "sk_cliente int, nk_cliente int, nombre string"), silver, "dim_clientes")
    save(spark.createDataFrame([(1, 7, "MESA"), (2, 8, "SILLA")], "sk_producto int, nk_producto int, nombre string"), silver, "dim_productos")
    save(dim_tiempo(spark, 2024, dt.date(2024, 12, 31)), silver, "dim_tiempo")
    spark.sql(f"CREATE DATABASE {quoted(gold)}")
    yield silver, gold
    for name in (silver, gold):
        spark.sql(f"DROP DATABASE IF EXISTS {quoted(name)} CASCADE")


def files(spark, database, name):
    rows = table(spark, database, name).select(kpis.PERIOD, F.col("_metadata.file_path")).distinct().collect()
    out = {}
    for month, path in rows:
        out.setdefault(month, set()).add(path)
    return out


FIRST = [(10, 7, 20240105, 5.5, 1), (20, 7, 20240110, 3.0, 2), (10, 8, 20240301, 9.0, 1), (None, 8, 20240302, 1.0, 1)]
SECOND = [(20, 8, 20240320, 30.0, 2), (10, 7, 20240411, 2.5, 4), (30, 7, 20240412, 8.0, 1), (10, 7, None, 4.0, 1)]


def test_refresh_rewrites_only_the_touched_months(spark, star):
    silver, gold = star
    months = append_sales(sales(spark, FIRST), silver)
    assert months == [202401, 202403]
    refresh_gold(spark, silver, gold, months)
    stored = ("ventas_sumadas", "ventas_por_cliente_mes", "ventas_por_producto_mes")
    before = {name: files(spark, gold, name) for name in stored}
    months = append_sales(sales(spark, SECOND), silver)
    assert months == [None, 202403, 202404]
    refresh_gold(spark, silver, gold, months)
    for name in stored:
        after = files(spark, gold, name)
        assert after[202401] == before[name][202401] and set(after) == {202401, 202403, 202404}
        assert not after[202403] & before[name][202403]
    numbers = [r[0] for r in table(spark, silver, "fact_ventas_mes").select("sk_venta").collect()]
    assert sorted(numbers) == list(range(1, 9))

    fact, days = sales(spark, FIRST + SECOND), table(spark, silver, "dim_tiempo")
    whole = {
        "cliente": kpis.kpi_ventas_por_cliente(fact, table(spark, silver, "dim_clientes"), days),
        "producto": kpis.kpi_ventas_por_producto(fact, table(spark, silver, "dim_productos"), days),
        "periodo": kpis.kpi_ventas_por_periodo(fact, days),
    }
    for name, kpi in whole.items():
        columns = [c for c in kpi.columns if c != GOLD_AT]
        got = table(spark, gold, f"kpi_ventas_por_{name}")
        assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, kpi.select(columns).collect()))


def test_refresh_reads_the_touched_months_only(spark, star):
    silver, _ = star
    append_sales(sales(spark, FIRST), silver)
    fact = table(spark, silver, "fact_ventas_mes").where(F.col(kpis.PERIOD).isin([202401]))
    plan = kpis.sales_cube(fact, table(spark, silver, "dim_tiempo"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(periodo_yyyymm" in plan or "periodo_yyyymm#" in plan.split("PartitionFilters: [")[1][:60]


def test_nothing_new_changes_nothing(spark, star):
    silver, gold = star
    assert append_sales(sales(spark, []), silver) == []
    refresh_gold(spark, silver, gold, [])
    refresh_gold(spark, silver, gold, [None])
    assert spark.catalog.listTables(gold) == []


def test_all_months_follow_a_changed_dimension(spark, star):
    silver, gold = star
    rows = [*FIRST, (20, 7, 20240601, 2.0, 1)]
    refresh_gold(spark, silver, gold, append_sales(sales(spark, rows), silver))
    assert set(files(spark, gold, "ventas_por_cliente_mes")) == {202401, 202403, 202406}
    save(spark.createDataFrame([(1, 10, "LUNA")], "sk_cliente int, nk_cliente int, nombre string"), silver, "dim_clientes", "replace")
    refresh_gold(spark, silver, gold)
    names = {r["nombre"] for r in table(spark, gold, "kpi_ventas_por_cliente").collect()}
    # A partition without rows keeps none of the old ones.
    assert names == {"LUNA"}
    assert set(files(spark, gold, "ventas_por_cliente_mes")) == {202401, 202403}


def test_partitions_keep_columns_in_any_order(spark, database):
    save_partitions(spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "p int, t string, n int"), database, "x", "p")
    save_partitions(spark.createDataFrame([(9, "c", 2), (8, None, 3)], "n int, t string, p int"), database, "x", "p")
    assert sorted(map(tuple, table(spark, database, "x").select("p", "t", "n").collect()), key=str) == [
        (1, "a", 5), (2, "c", 9), (3, None, 8),
    ]


def test_cube_reads_the_sales_once(spark, database):
    fact = sales(spark, FIRST + SECOND)
    save(fact, database, "fact")
    days = dim_tiempo(spark, 2024, dt.date(2024, 12, 31))
    cube = kpis.sales_cube(table(spark, database, "fact"), days)
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan
    for name, own in kpis.CUBE_KEYS.items():
        period = kpis.MONTH if own else kpis.MONTH_AND_QUARTER
        whole = kpis.dated_sales(fact, days, period, *own)
        columns = [c for c in whole.columns]
        got = cube.where(F.col(kpis.CUBE_SET) == name).select(columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


def test_unmatched_sales_make_up_the_rest(spark):
    fact, days = sales(spark, FIRST + SECOND), dim_tiempo(spark, 2024, dt.date(2024, 12, 31))
    dim = spark.createDataFrame([(10, None, 3), (20, "RIO", None)], "nk_cliente int, nombre string, nivel int")
    kept = kpis.entity_sales(fact, dim, days, "cliente", "cli", keep_unmatched=True)
    found = {(r[kpis.PERIOD], r["fk_cliente"]): (r["nombre"], r["nivel"], r[kpis.CAUSE], r[kpis.SALES]) for r in kept.collect()}
    assert found == {
        (202401, 10): (None, 3, "atributo_nulo", 5.5),
        (202401, 20): ("RIO", None, "atributo_nulo", 3.0),
        (202403, 10): (None, 3, "atributo_nulo", 9.0),
        (202403, None): ("DESCONOCIDO", None, "sin_clave", 1.0),
        (202403, 20): ("RIO", None, "atributo_nulo", 30.0),
        (202404, 10): (None, 3, "atributo_nulo", 2.5),
        (202404, 30): ("DESCONOCIDO", None, "sin_miembro", 8.0),
        (None, 10): (None, 3, "sin_fecha", 4.0),
    }
    assert sum(x[3] for x in found.values()) == sum(r[3] for r in FIRST + SECOND)
    assert kpis.entity_sales(fact, dim, days, "cliente", "cli").count() == 0


def test_tiny_quantities_of_repeated_members_stay(spark):
    fact = spark.createDataFrame([(i, 10, 7, 20240105, 1.0, 1e-7) for i in range(3)], FACT.replace("cantidad int", "cantidad double"))
    days = dim_tiempo(spark, 2024, dt.date(2024, 1, 31))
    dim = spark.createDataFrame([(7, "MESA")] * 2, "nk_producto int, nombre string")
    (row,) = kpis.entity_sales(fact, dim, days, "producto", "prod").collect()
    assert row[kpis.UNITS] == pytest.approx(6e-7, rel=1e-12) and row[kpis.COUNT] == 6


# The index of ids.


def load(spark, database, ids):
    rows = spark.createDataFrame([(i, "x") for i in ids], "idventa string, t string")
    return load_unit(rows, database, "ventas__a", "a.xlsx", "a", None, "idventa")


def test_stored_ids_are_not_shuffled(spark, database):
    load(spark, database, map(str, range(500)))
    assert load(spark, database, ["3", "3.0", "700", " 4 "]) == 2
    ids, missing = IdIndex(spark, database, "ventas__a").of(table(spark, database, "ventas__a").selectExpr("idventa AS _id"))
    assert not missing
    incoming = spark.range(10**6).selectExpr("CAST(id AS string) AS idventa")
    with scratch():
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = rows_without(incoming, "idventa", ids, missing)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("\n")
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    above = [line for line in lines[:scan] if "Exchange" in line and line.index("Exchange") < lines[scan].index("FileScan")]
    # Of the three sides only those of the incoming rows are dealt anew.
    assert plan.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in lines[scan], plan
    assert not any("_id" in line and scan - i < 4 for i, line in enumerate(above)), plan


def test_index_follows_its_table(spark, database):
    assert load(spark, database, ["1", None]) == 2
    assert load(spark, database, ["1", None, "2"]) == 1
    assert load(spark, database, ["2", None]) == 0
    # A load that was cut off before the index knew of it.
    spark.sql(f"INSERT INTO {quoted(database, 'ventas__a')} BY NAME SELECT '9' AS idventa")
    assert load(spark, database, ["9", "8"]) == 1
    assert load(spark, database, ["8", "9", "10"]) == 1
    assert table(spark, database, "ventas__a").count() == 6


# What is written once.


def test_a_refresh_writes_sales_and_sums_once(spark, database, monkeypatch):
    labels = []

    def noted(df, label, *more, **named):
        labels.append(label)
        return written(df, label, *more, **named)

    monkeypatch.setattr(refresh, "written", noted)
    days = dim_tiempo(spark, 2024, dt.date(2024, 12, 31))
    save(days, database, "dim_tiempo")
    save(spark.createDataFrame([(1, "A")], "nk_cliente int, nombre string"), database, "dim_clientes")
    save(spark.createDataFrame([(5, "X")], "nk_producto int, nombre string"), database, "dim_productos")
    schema = "sk_venta int, fk_cliente int, fk_producto int, fk_fecha int, total double, cantidad int"
    none = spark.createDataFrame([], schema)
    assert refresh.append_sales(none, database) == []
    assert not table_exists(spark, database, refresh.FACT)
    sales = spark.createDataFrame([(1, 1, 5, 20240105, 2.0, 1), (2, 1, 5, None, 2.0, 1), (3, 1, 5, 20240301, 3.0, 1)], schema)
    months = refresh.append_sales(sales, database)
    assert months == [None, 202401, 202403]
    refresh.refresh_gold(spark, database, database, months)
    found = table(spark, database, "kpi_ventas_por_producto").orderBy("periodo_yyyymm").collect()
    assert [(r.periodo_yyyymm, r.total_ventas, r.ranking_mes) for r in found] == [(202401, 2.0, 1), (202403, 3.0, 1)]
    assert sorted(labels) == ["month_sales", "month_sales"]
