import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.fixed_values import INGESTED_AT, STAGED_AT
from strata.operators import control
from strata.operators.control import ControlLog, ensure_control_table, mark_pending
from strata.operators.loads import (
    load_rule,
    load_unit,
    new_rows,
    reset_staging,
    stage,
)
from strata.operators.raw import normalize, normalize_columns, stringify
from strata.plans.bronze import run_bronze
from strata.sources.catalog import ensure_database, read_first, read_table, save, table
from strata.session import scratch_database
from strata.sources.records import SourceRecord

AT = dt.datetime(2024, 5, 1, tzinfo=dt.UTC)


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# Rows.


def test_clean_column_names(spark):
    df = spark.createDataFrame([("Ana", "2000-01-01")], ["Nombre Completo", "Fecha Nac."])
    assert normalize_columns(df).columns == ["nombre_completo", "fecha_nac"]


def test_first_of_equal_names_stays(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["x", "y", "z"]).toDF("A b", "a-b", "c")
    assert [tuple(r) for r in normalize_columns(df).collect()] == [(1, 3)]
    same = spark.createDataFrame([(1, 2)], ["x", "y"]).toDF("a", "a")
    assert [tuple(r) for r in normalize_columns(same).collect()] == [(1,)]


def test_empty_rows_go(spark):
    df = spark.createDataFrame([(1.0, 4.0), (None, None), (3.0, None)], "a double, b double")
    assert normalize(df).count() == 2


def test_audit_columns(spark):
    df = normalize(spark.createDataFrame([(1,)], ["x"]), "test.xlsx", "Hoja1", AT)
    assert df.columns == ["x", "_source_file", "_source_sheet", "_ingested_at"]
    assert df.first()[1:3] == ("test.xlsx", "Hoja1")


def test_frame_without_columns(spark):
    df = spark.range(3).select()
    assert normalize(df).columns == []


def test_stringify(spark):
    df = spark.sql("SELECT 1 a, 2.5D b, 'nan' c, true d, 'x' _source_file")
    found = stringify(df)
    assert [f.dataType.simpleString() for f in found.schema] == ["string"] * 5
    assert tuple(found.first()) == ("1", "2.5", None, "True", "x")


# Load rules.


@pytest.mark.parametrize(
    "name, expected",
    [
        ("Mis_Clientes__a", ("replace_with_staging", "stg_clientes_nuevos", None)),
        ("productos_y_ventas", ("replace_with_staging", "stg_productos_nuevos", None)),
        ("ventas__enero", ("incremental", "stg_ventas_nuevos", "idventa")),
        ("api_posts", ("replace_with_staging", "stg_api_posts", None)),
        ("api_posts_2", ("replace", None, None)),
        ("api_clientes_ext", ("replace_with_staging", "stg_clientes_nuevos", None)),
        ("otros", ("replace", None, None)),
    ],
)
def test_load_rule(spark, name, expected):
    df = spark.createDataFrame([(name,)], ["n"]).select(load_rule(F.col("n")).alias("r"))
    assert tuple(df.first().r) == expected


# Incremental.


def test_new_rows(spark):
    incoming = spark.createDataFrame(
        [(" 1 ", "a"), ("2", "b"), ("3", "c"), ("3", "d"), (None, "e"), ("", "f")], "id string, v string"
    )
    existing = spark.createDataFrame([(1,), (1,), (9,)], "id int")
    assert values(new_rows(incoming, existing, "id"), "v") == [("b",), ("c",), ("d",), ("e",), ("f",)]


def test_missing_ids_are_equal(spark):
    incoming = spark.createDataFrame([(None, "a"), ("2", "b"), ("", "c")], "id string, v string")
    existing = spark.createDataFrame([(None,), (None,), ("7",)], "id string")
    assert values(new_rows(incoming, existing, "id"), "v") == [("b",), ("c",)]


def test_new_rows_against_brute_force(spark):
    ids = [None if i % 11 == 0 else str(i % 700) for i in range(3000)]
    incoming = spark.createDataFrame([(v, i) for i, v in enumerate(ids)], "id string, n int")
    known = [str(i) for i in range(0, 900, 3)]
    existing = spark.createDataFrame([(v,) for v in known * 2], "id string")
    expected = sorted(i for i, v in enumerate(ids) if v not in set(known))
    assert sorted(r.n for r in new_rows(incoming, existing, "id").collect()) == expected
    # A missing id among many is found once, and takes its like along.
    more = existing.union(spark.createDataFrame([(None,)] * 50, "id string"))
    named = sorted(i for i in expected if ids[i] is not None)
    assert sorted(r.n for r in new_rows(incoming, more, "id").collect()) == named


def test_incremental_load(spark, database):
    ensure_database(spark, database)
    reset_staging(spark, database)
    name, staging = "ventas__a", "stg_ventas_nuevos"

    def load(rows):
        df = spark.createDataFrame(rows, "idventa string, total string")
        return load_unit(df, database, name, "ventas.xlsx", "a", staging, "idventa", AT)

    assert load([("1", "10"), ("2", "20"), ("2", "20")]) == 3
    assert load([("1", "11"), (" 2", "21")]) == 0
    assert table(spark, database, staging).count() == 3
    assert load([("2", "22"), ("3", "30"), ("3", "31"), (None, "40")]) == 3
    assert load([(None, "41")]) == 0
    assert values(table(spark, database, name), "total") == [
        ("10",), ("20",), ("20",), ("30",), ("31",), ("40",),
    ]
    staged = table(spark, database, staging)
    assert staged.count() == 6
    assert staged.where(F.col(STAGED_AT).isNull()).count() == 0
    assert staged.select("_source_file").distinct().first()[0] == "ventas.xlsx"


def test_scratch_tables_are_dropped(spark, database):
    rows = spark.createDataFrame([("1",), ("2",)], "idventa string")
    load_unit(rows.where("idventa = 1"), database, "ventas__a", "f", "s", None, "idventa")

    def scratch_tables():
        return {t.name for t in spark.catalog.listTables(scratch_database(spark))}

    before = scratch_tables()
    assert load_unit(rows, database, "ventas__a", "f", "s", None, "idventa") == 1
    assert scratch_tables() == before


def test_incremental_load_fills_missing_columns_and_refuses_new_ones(spark, database):
    def load(df):
        return load_unit(df, database, "ventas__a", "f", "s", None, "idventa")

    load(spark.createDataFrame([("1", "a", "b")], "idventa string, x string, y string"))
    assert load(spark.createDataFrame([("2", "c")], "idventa string, x string")) == 1
    assert values(table(spark, database, "ventas__a"), "idventa", "y") == [("1", "b"), ("2", None)]
    with pytest.raises(Exception, match="(?i)column"):
        load(spark.createDataFrame([("3", "c")], "idventa string, z string"))


def test_table_without_the_id_is_replaced(spark, database):
    save(spark.createDataFrame([("x",)], "other string"), database, "ventas__a")
    rows = spark.createDataFrame([("1",), ("2",)], "idventa string")
    assert load_unit(rows, database, "ventas__a", "f", "s", "stg_ventas_nuevos", "idventa") == 2
    assert "idventa" in table(spark, database, "ventas__a").columns
    assert read_table(spark, database, "stg_ventas_nuevos") is None


def test_incoming_rows_without_the_id_fail(spark, database):
    load_unit(
        spark.createDataFrame([("1",)], "idventa string"), database, "ventas__a", "f", "s", None, "idventa"
    )
    with pytest.raises(KeyError):
        load_unit(
            spark.createDataFrame([("1",)], "otra string"), database, "ventas__a", "f", "s", None, "idventa"
        )


# Replace and staging.


def test_replace(spark, database):
    first = spark.createDataFrame([("1", "a")], "id string, v string")
    assert load_unit(first, database, "otros", "f", "s") == 1
    assert load_unit(first.drop("v").union(first.select("v")), database, "otros", "f", "s") == 2
    assert values(table(spark, database, "otros"), "id") == [("1",), ("a",)]
    assert "v" not in table(spark, database, "otros").columns


def test_replace_by_nothing_changes_nothing(spark, database):
    rows = spark.createDataFrame([("1",)], "id string")
    load_unit(rows, database, "otros", "f", "s")
    assert load_unit(rows.where("false"), database, "otros", "f", "s") == 0
    assert table(spark, database, "otros").count() == 1
    assert load_unit(rows.where("false"), database, "nuevos", "f", "s") == 0
    assert read_table(spark, database, "nuevos") is None
    left = [t.name for t in spark.catalog.listTables(database)]
    assert left == ["otros"]


def test_replace_from_the_table_itself(spark, database):
    save(spark.range(5).toDF("n"), database, "t")
    assert save(table(spark, database, "t").where("n > 2"), database, "t", "replace") == 2
    assert table(spark, database, "t").count() == 2


def test_save_modes(spark, database):
    rows = spark.range(2).toDF("n")
    assert save(rows, database, "t", "fail") == 2
    with pytest.raises(ValueError):
        save(rows, database, "t", "fail")
    assert save(rows.where("false"), database, "t", "fail") == 0
    with pytest.raises(ValueError):
        save(rows, database, "t", "upsert")
    assert save(rows, database, "t") == 2
    assert save(rows.where("false"), database, "t") == 0
    assert table(spark, database, "t").count() == 4


def test_staging_gets_new_columns(spark, database):
    ensure_database(spark, database)
    reset_staging(spark, database)
    staging = "stg_productos_nuevos"
    load_unit(spark.createDataFrame([("1",)], "id string"), database, "productos__a", "a", "s", staging)
    more = spark.createDataFrame([("2", "rojo")], "id string, color string")
    load_unit(more, database, "productos__b", "b", "s", staging)
    staged = table(spark, database, staging)
    assert values(staged, "id", "color") == [("1", None), ("2", "rojo")]
    assert staged.columns[:4] == [STAGED_AT, "_source_file", "_source_sheet", INGESTED_AT]
    reset_staging(spark, database)
    assert table(spark, database, staging).count() == 0
    assert "color" in table(spark, database, staging).columns


def test_failure_to_stage_is_only_logged(spark, database, caplog):
    ensure_database(spark, database)
    spark.sql(f"CREATE TABLE {database}.stg (id INT, {STAGED_AT} STRING) USING parquet")
    stage(spark.createDataFrame([("no number",)], "id string"), database, "stg")
    assert "stg" in caplog.text


def test_read_first(spark, database):
    save(spark.createDataFrame([("b",)], "v string"), database, "b_clientes")
    save(spark.createDataFrame([("a",)], "v string"), database, "a_clientes")
    assert read_first(spark, database, ["x", "b_clientes"], "clientes").first().v == "b"
    assert read_first(spark, database, ["x"], "CLIENTES").first().v == "a"
    assert read_first(spark, database, ["x"], "clientes", ["a_clientes"]).first().v == "b"
    assert read_first(spark, database, ["x"], "ventas") is None
    assert read_first(spark, "no_such_database", ["x"], "ventas") is None


# Control.


def test_pending_units(spark):
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    schema = "file_name string, sheet_name string, modified_at timestamp, table_name string"
    units = spark.createDataFrame(
        [
            ("a", "s", early, "t"), ("b", "s", late, "t"), ("c", "s", early, "t"),
            ("d", "s", None, "t"), ("e", "s", early, "mis_Ventas"),
        ],
        schema,
    )
    control = spark.createDataFrame(
        [
            ("a", "s", early, "SUCCESS"), ("a", "s", early, "SUCCESS"), ("b", "s", early, "SUCCESS"),
            ("c", "s", early, "ERROR"), ("d", "s", None, "SUCCESS"), ("e", "s", early, "SUCCESS"),
        ],
        "file_name string, sheet_name string, source_modified_at timestamp, status string",
    )
    found = values(mark_pending(units, control), "file_name", "already_loaded", "pending")
    assert found == [
        ("a", True, False), ("b", False, True), ("c", False, True), ("d", False, True), ("e", True, True),
    ]
    assert mark_pending(units, control, force=True).where("NOT pending").count() == 0


def test_control_log(spark, database):
    ensure_control_table(spark, database)
    ensure_control_table(spark, database)
    writer = ControlLog(spark, database, AT)
    writer.write("f", "s", "t", "SUCCESS", rows_loaded=3)
    writer.write("g", "s", "t", "ERROR", error_message="broken")
    log = table(spark, database, "ingestion_control")
    assert values(log, "file_name", "status", "rows_loaded", "error_message") == [
        ("f", "SUCCESS", 3, None), ("g", "ERROR", 0, "broken"),
    ]
    assert log.where("id IS NULL OR loaded_by IS NULL OR finished_at IS NULL").count() == 0


# Runs.


class Units:
    source_type = "units"

    def __init__(self, *records):
        self.records = records

    def extract(self):
        yield from self.records


class Broken:
    source_type = "broken"

    def extract(self):
        raise OSError("unreachable")
        yield


def test_run(spark, database):
    fine = spark.createDataFrame([(1, "a")], "Id Uno int, b string".replace("Id Uno", "`Id Uno`"))
    failing = fine.withColumn("b", F.raise_error(F.lit("bad row")))
    sources = [
        Units(
            SourceRecord(fine, "x.xlsx / Hoja", "x__hoja", "file-1", AT),
            SourceRecord(failing, "y.xlsx / Hoja", "y__hoja", "file-2", AT),
            SourceRecord(fine.where("false"), "z.xlsx / Hoja", "z__hoja", "file-3", AT),
            SourceRecord(fine, "c.xlsx / Hoja", "clientes__hoja", "file-4", AT),
        ),
        Broken(),
        Units(),
    ]
    first = run_bronze(spark, sources, database=database)
    assert first == {"total": 4, "success": 3, "skipped": 0, "errors": 2}
    assert table(spark, database, "x__hoja").columns[0] == "id_uno"
    log = table(spark, database, "ingestion_control")
    assert values(log, "file_name", "sheet_name", "status", "rows_loaded", "file_id") == [
        ("c.xlsx", "Hoja", "SUCCESS", 1, "file-4"), ("x.xlsx", "Hoja", "SUCCESS", 1, "file-1"),
        ("y.xlsx", "Hoja", "ERROR", 0, "file-2"), ("z.xlsx", "Hoja", "SUCCESS", 0, "file-3"),
    ]
    assert "bad row" in log.where("status = 'ERROR'").first().error_message
    assert table(spark, database, "stg_clientes_nuevos").count() == 1

    second = run_bronze(spark, sources, database=database)
    assert second == {"total": 4, "success": 1, "skipped": 2, "errors": 2}
    assert table(spark, database, "stg_clientes_nuevos").count() == 1
    forced = run_bronze(spark, sources, force=True, database=database)
    assert forced == {"total": 4, "success": 3, "skipped": 0, "errors": 2}


class Counted(SourceRecord):
    """Counts how many units are held."""

    held = most = 0

    def __post_init__(self):
        Counted.held += 1
        Counted.most = max(Counted.most, Counted.held)

    def __del__(self):
        Counted.held -= 1


class Listing:
    source_type = "listing"

    def __init__(self, units, df):
        self.units, self.df = units, df

    def extract(self):
        for i in range(self.units):
            yield Counted(self.df, f"f{i}.xlsx / Hoja", f"t{i}", str(i), AT)


def test_many_units_are_never_held_at_once(spark, database, monkeypatch):
    """100,000 units, all but two loaded before, in batches that append the log once each."""
    many, size = 100_000, 20_000
    ensure_control_table(spark, database)
    before = spark.range(many).where(f"id NOT IN (3, {many - 1})").select(
        F.concat(F.lit("f"), "id", F.lit(".xlsx")).alias("file_name"),
        F.lit("Hoja").alias("sheet_name"),
        F.lit("SUCCESS").alias("status"),
        F.lit(AT).alias("source_modified_at"),
    )
    save(before, database, "ingestion_control")
    appends = []
    plain = control.append_rows
    monkeypatch.setattr(control, "append_rows", lambda *a: appends.append(plain(*a)))
    fine = spark.createDataFrame([(1, "a")], "a int, b string")
    found = run_bronze(spark, [Listing(many, fine)], database=database, units_at_once=size)
    assert found == {"total": many, "success": 2, "skipped": many - 2, "errors": 0}
    assert appends == [size] * 5
    assert Counted.most <= size + 1
    assert table(spark, database, "t3").count() == table(spark, database, f"t{many - 1}").count() == 1


def test_table_names_have_one_owner_over_batches(spark, database):
    fine = spark.createDataFrame([(1, "a")], "a int, b string")
    names = [("x.xlsx", "t"), ("y.xlsx", "u"), ("z.xlsx", "t"), ("x.xlsx", "t")]
    units = Units(*[SourceRecord(fine, f"{f} / Hoja", t, f, AT) for f, t in names])
    found = run_bronze(spark, [units], database=database, units_at_once=2)
    assert found == {"total": 4, "success": 2, "skipped": 1, "errors": 1}
    log = table(spark, database, "ingestion_control").where("status = 'ERROR'")
    assert log.first().error_message == "the table t belongs to x.xlsx / Hoja"
