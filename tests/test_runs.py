import datetime as dt
import logging

import pytest
from pyspark.sql import functions as F

from strata.plans import gold, silver
from strata.plans.run import failed, run
from strata.session import scratch_database
from strata.sources.catalog import ensure_database, save, table
from strata.sources.records import SourceRecord


@pytest.fixture
def names(spark, database):
    layers = {layer: f"{database}_{layer}" for layer in ("bronze", "silver", "gold")}
    yield layers
    for name in layers.values():
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


class Sales:
    source_type = "sales"

    def __init__(self, spark):
        self.frames = {
            "clientes": spark.createDataFrame(
                [(10, " ana "), (20, "luis"), (None, None)], "`Id Cliente` int, Nombre string"
            ),
            "productos": spark.createDataFrame([(100, "x"), (200, "y")], "id_producto int, nombre string"),
            "ventas": spark.createDataFrame(
                [
                    (1, "2024-01-15", 10, 100, 10.126, 2), (2, "2024-02-20", 20, 200, 30.0, 1),
                    (3, "2024-02-21", 10, 100, 5.5, 3), (4, "nunca", 10, 100, 7.0, 3),
                ],
                "IdVenta int, Fecha string, IdCliente int, IdProducto int, Total double, Cantidad int",
            ),
        }

    def extract(self):
        for name, df in self.frames.items():
            yield SourceRecord(df, f"{name}.xlsx / Hoja", f"{name}__hoja")


def scratch_tables(spark):
    return {t.name for t in spark.catalog.listTables(scratch_database(spark))}


def options(names):
    return {
        "bronze": {"database": names["bronze"]},
        "silver": {
            "bronze": names["bronze"],
            "database": names["silver"],
            "end_date": dt.date(2024, 12, 31),
        },
        "gold": {"silver": names["silver"], "database": names["gold"], "report_keys": True},
    }


def test_all_layers(spark, names, caplog):
    caplog.set_level(logging.INFO)
    before = scratch_tables(spark)
    summary = run(spark, "all", [Sales(spark)], options=options(names))
    assert scratch_tables(spark) == before
    assert summary == {
        "bronze": {"total": 3, "success": 3, "skipped": 0, "errors": 0},
        "silver": {"total": 4, "success": 4, "errors": 0},
        "gold": {"total": 3, "success": 3, "errors": 0},
    }
    assert not failed(summary)
    assert "unmatched_rows" in caplog.text

    customers = table(spark, names["silver"], "dim_clientes")
    assert sorted(tuple(r)[:3] for r in customers.collect()) == [(1, 10, "ANA"), (2, 20, "LUIS")]
    fact = table(spark, names["silver"], "fact_ventas")
    assert fact.columns == [
        "sk_venta", "fk_cliente", "fk_producto", "fk_fecha", "idventa", "total", "cantidad",
        "_silver_loaded_at",
    ]
    assert sorted(r.sk_venta for r in fact.collect()) == [1, 2, 3, 4]
    kpi = table(spark, names["gold"], "kpi_ventas_por_cliente")
    assert sorted(
        (r.periodo_yyyymm, r.fk_cliente, r.nombre, r.total_ventas, r.ranking_mes, r.ranking_global)
        for r in kpi.collect()
    ) == [
        (202401, 10, "ANA", 10.13, 1, 2), (202402, 10, "ANA", 5.5, 2, 2), (202402, 20, "LUIS", 30.0, 1, 1),
    ]

    again = run(spark, "all", [Sales(spark)], options=options(names))
    assert again == summary
    assert table(spark, names["bronze"], "ventas__hoja").count() == 4
    assert table(spark, names["bronze"], "stg_ventas_nuevos").count() == 0
    assert table(spark, names["bronze"], "stg_clientes_nuevos").count() == 2


def test_one_layer(spark, names):
    assert list(run(spark, "bronze", [], options=options(names))) == ["bronze"]
    with pytest.raises(ValueError):
        run(spark, "copper")


def test_silver_needs_all_tables(spark, names):
    ensure_database(spark, names["bronze"])
    save(spark.range(1), names["bronze"], "clientes")
    summary = run(spark, "silver", options=options(names))
    assert summary == {"silver": {"total": 4, "success": 0, "errors": 4}} and failed(summary)


def test_gold_needs_all_tables(spark, names):
    assert run(spark, "gold", options=options(names)) == {"gold": {"total": 3, "success": 0, "errors": 3}}


def test_failing_tables_do_not_stop_the_others(spark, names, monkeypatch):
    def broken(*args, **kwargs):
        raise RuntimeError("broken")

    run(spark, "bronze", [Sales(spark)], options=options(names))
    with monkeypatch.context() as patch:
        patch.setattr(silver, "dim_productos", broken)
        summary = run(spark, "silver", options=options(names))
        assert summary["silver"] == {"total": 4, "success": 3, "errors": 1}
    run(spark, "silver", options=options(names))
    monkeypatch.setattr(gold, "kpi_ventas_por_cliente", broken)
    summary = run(spark, "gold", options=options(names))
    assert summary["gold"] == {"total": 3, "success": 2, "errors": 1}


def test_errors_in_one_layer_do_not_stop_the_next(spark, names):
    summary = run(spark, "all", [], options=options(names))
    assert [summary[layer]["errors"] for layer in ("bronze", "silver", "gold")] == [0, 4, 3]


def test_an_interrupted_replace_is_put_back(spark, database):
    from strata.sources.catalog import save, table

    save(spark.range(3), database, "t")
    spark.sql(f"ALTER TABLE {database}.t RENAME TO {database}.t__previous")
    assert save(spark.range(5).toDF("id"), database, "t") == 5
    assert table(spark, database, "t").count() == 8
    spark.sql(f"CREATE TABLE {database}.t__previous USING parquet AS SELECT 1 AS id")
    assert save(spark.range(2), database, "t", "replace") == 2
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]


def test_lost_texts_are_saved(spark, names):
    class Gaps(Sales):
        def __init__(self, spark):
            super().__init__(spark)
            totals = F.when(F.col("IdVenta") == 3, "s/n").otherwise(F.col("Total").cast("string"))
            self.frames["ventas"] = self.frames["ventas"].withColumn("Total", totals)

    given = options(names)
    given["silver"] |= {"lost": "lost_values", "day_first": None}
    summary = run(spark, "all", [Gaps(spark)], options=given)
    assert not failed(summary)
    rows = table(spark, names["silver"], "lost_values").collect()
    found = [(r["role"], r["column_name"], r["lost_rows"], [tuple(t) for t in r["texts"]]) for r in rows]
    assert found == [("ventas", "total", 1, [("s/n", 1)])]
