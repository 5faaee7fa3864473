import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from checks.workbooks import packed, workbook
from strata.operators.raw import normalize
from strata.plans.bronze import run_bronze
from strata.sources.catalog import table
from strata.sources.documents import JsonDocuments, read_documents, records
from strata.sources.workbook import (
    WorkbookFolder,
    filter_units,
    list_workbooks,
    name_tables,
    read_workbook,
    sheet_cells,
    with_columns,
)


@pytest.fixture
def folder(tmp_path):
    def put(name, sheets, modified=None):
        path = tmp_path / name
        path.write_bytes(workbook(sheets) if isinstance(sheets, dict) else sheets)
        if modified:
            os.utime(path, (modified, modified))
        return str(path)

    put.path = str(tmp_path)
    return put


def test_one_sheet(spark, folder):
    path = folder("a.xlsx", {"Datos": [["col_a", "col_b"], [1, "x"], [2, "y"]]})
    sheets = read_workbook(spark, path)
    assert list(sheets) == ["Sheet1"]
    assert [tuple(r) for r in sheets["Sheet1"].collect()] == [("1", "x"), ("2", "y")]


def test_all_and_named_sheets(spark, folder):
    path = folder("a [1].xlsx", {"Enero": [["v"], [1], [2]], "Febrero": [["v"], [3], [4], [5]]})
    sheets = read_workbook(spark, path, None)
    assert {k: df.count() for k, df in sheets.items()} == {"Enero": 2, "Febrero": 3}
    assert list(read_workbook(spark, path, "Febrero")) == ["Febrero"]
    assert read_workbook(spark, path, 1)["Sheet1"].count() == 3
    with pytest.raises(ValueError, match="Marzo"):
        read_workbook(spark, path, "Marzo")


def test_cell_values(spark, folder):
    row = [
        True, 1.0, 2.5, -3, dt.datetime(2024, 3, 15), dt.datetime(2024, 3, 15, 10, 30), "N/A", None,
        "<b> & ñ", 1e20,
    ]
    path = folder("a.xlsx", {"s": [list("abcdefghij"), row]})
    found = tuple(read_workbook(spark, path)["Sheet1"].first())
    assert found == (
        "True", "1", "2.5", "-3", "2024-03-15", "2024-03-15 10:30:00", None, None, "<b> & ñ",
        "100000000000000000000",
    )


def test_headers(spark, folder):
    rows = [["note"], ["a", None, "a", "NA"], [1, 2, 3, 4, 5], [6]]
    path = folder("a.xlsx", {"s": rows})
    df = read_workbook(spark, path, header_row=1)["Sheet1"]
    assert df.columns == ["a", "Unnamed: 1", "a.1", "NA", "Unnamed: 4"]
    assert sorted(map(tuple, df.collect()))[1] == ("6", None, None, None, None)
    assert normalize(df).columns[:5] == ["a", "unnamed__1", "a_1", "na", "unnamed__4"]


def test_types_asked_for(spark, folder):
    path = folder("a.xlsx", {"s": [["a", "b"], [1, 2]]})
    df = read_workbook(spark, path, dtype={"a": "int"})["Sheet1"]
    assert df.dtypes == [("a", "int"), ("b", "string")]


def test_broken_workbook(spark, folder):
    path = folder("a.xlsx", b"no zip")
    with pytest.raises(ValueError, match="BadZipFile"):
        read_workbook(spark, path)


def test_long_sheet_keeps_all_rows(spark):
    rows = spark.range(25_000).select("id", F.concat(F.lit("t"), "id").alias("t"))
    found = with_columns(sheet_cells(packed(rows, "S"), "S"), rows.columns)
    assert found.count() == 25_000
    assert found.selectExpr("sum(cast(id as bigint))", "count(distinct t)").first()[:] == (
        25_000 * 24_999 // 2,
        25_000,
    )


def test_list_workbooks(spark, folder):
    folder("old.xlsx", {"s": [["a"]]}, 1_000_000)
    folder("new.XLSX", {"s": [["a"]]}, 2_000_000)
    folder("legacy.xls", b"x", 1_500_000)
    folder("notes.txt", b"x")
    found = list_workbooks(spark, folder.path).collect()
    assert [r.name for r in found] == ["new.XLSX", "legacy.xls", "old.xlsx"]
    assert found[0].mime_type.endswith("sheet") and found[1].size == 1


def test_unit_filters(spark):
    units = spark.createDataFrame(
        [("Ventas 1.xlsx", "Hoja Uno"), ("ventas 2.xlsx", "hoja.uno"), ("Ventas 3.xlsx", None)],
        "file_name string, sheet_name string",
    )
    names = lambda df: sorted(r.file_name for r in df.collect())
    assert names(filter_units(units, "Ventas")) == ["Ventas 1.xlsx", "Ventas 3.xlsx"]
    assert names(filter_units(units, None, ["HOJA_uno"])) == ["Ventas 1.xlsx", "Ventas 3.xlsx"]
    assert names(filter_units(units, None, ["a.u"])) == ["Ventas 3.xlsx", "ventas 2.xlsx"]
    assert names(filter_units(units)) == ["Ventas 1.xlsx", "Ventas 3.xlsx", "ventas 2.xlsx"]


def test_folder_of_workbooks(spark, folder, database):
    folder(
        "Ejercicio Ventas.xlsx",
        {"Ventas 2024": [["IdVenta", "Total"], [1, 10.5], [2, 20]], "Notas": [["x"], [1]]},
        1_000_000,
    )
    folder("Ejercicio roto.xlsx", b"broken", 3_000_000)
    folder("Ejercicio Otros.xlsx", {"ventas": [["Color"], ["rojo"], [None], ["azul"]]}, 2_000_000)
    folder("Aparte.xlsx", {"ventas": [["z"], [1]]})
    source = WorkbookFolder(spark, folder.path, "Ejercicio", ["VENTAS"])
    units = list(source.extract())
    assert [u.source_name for u in units] == [
        "Ejercicio Otros.xlsx / ventas",
        "Ejercicio Ventas.xlsx / Ventas 2024",
    ]
    assert units[1].rows().columns == ["IdVenta", "Total"]
    assert units[1].table_name == "ejercicio_ventas__ventas_2024"
    assert units[1].modified_at == dt.datetime.fromtimestamp(1_000_000)
    summary = run_bronze(spark, [source], database=database)
    assert summary == {"total": 2, "success": 2, "skipped": 0, "errors": 0}
    loaded = table(spark, database, "ejercicio_ventas__ventas_2024")
    assert sorted((r.idventa, r.total) for r in loaded.collect()) == [("1", "10.5"), ("2", "20")]
    assert table(spark, database, "ejercicio_otros__ventas").count() == 2
    assert list(WorkbookFolder(spark, folder.path, "nothing").extract()) == []


# JSON.


@pytest.fixture
def document(tmp_path):
    def put(name, text):
        path = tmp_path / name
        path.write_text(text, encoding="utf8")
        return str(path)

    return put


def test_json_list_and_object(spark, document):
    path = document("list.json", '[\n{"name": "A", "iso2": "a"},\n {"name": "B"}]')
    df = records(read_documents(spark, path))
    assert sorted((r.name, r.iso2) for r in df.collect()) == [("A", "a"), ("B", None)]
    single = records(read_documents(spark, document("one.json", '{"a": {"b": 1}, "c": 2}')))
    assert single.count() == 1 and sorted(single.columns) == ["a", "c"]


def test_json_data_key(spark, document):
    path = document("posts.json", '{"posts": [{"id": 1, "tags": ["x"]}, {"id": 2}], "total": 2}')
    df = records(read_documents(spark, path), "posts")
    assert sorted(r.id for r in df.collect()) == [1, 2]
    with pytest.raises(ValueError, match=r"'data'.*posts.*total"):
        records(read_documents(spark, path), "data")
    with pytest.raises(ValueError, match="no list"):
        records(read_documents(spark, path), "total")


def test_json_list_of_values(spark, document):
    path = document("values.json", '{"ids": [3, 4]}')
    df = records(read_documents(spark, path), "ids")
    assert df.columns == ["0"] and sorted(r[0] for r in df.collect()) == [3, 4]


def test_json_errors(spark, document, tmp_path):
    with pytest.raises(ValueError):
        records(read_documents(spark, document("scalar.json", "17")))
    with pytest.raises(Exception, match="(?i)invalid JSON|corrupt"):
        records(read_documents(spark, document("bad.json", '{"a": 1'), "a int")).collect()
    (tmp_path / "pages").mkdir()
    document("pages/1.json", '{"data": [{"id": 1}]}')
    document("pages/2.json", '{"error": "no more"}')
    with pytest.raises(Exception, match="data_key"):
        records(read_documents(spark, str(tmp_path / "pages")), "data").collect()


def test_json_source(spark, document, database):
    good = document("good.json", '{"data": [{"id": 1, "user": {"n": "x"}}, {"id": 2}]}')
    source = JsonDocuments(
        spark,
        [
            {"path": good, "table_name": "api_x", "data_key": "data"},
            {"path": good},
            {"table_name": "t"},
            {"path": good, "table_name": "t", "data_key": "nothing"},
            {"path": document("empty.json", "[]"), "table_name": "t"},
            {"path": "/no/such/file.json", "table_name": "t"},
        ],
    )
    units = list(source.extract())
    assert [(u.source_name, u.table_name, u.modified_at) for u in units] == [(good, "api_x", None)]
    run_bronze(spark, [source], database=database)
    loaded = table(spark, database, "api_x")
    assert sorted((r.id, r.user) for r in loaded.collect()) == [("1", '{"n":"x"}'), ("2", None)]
    assert loaded.first()["_source_file"] == good


def test_units_of_one_table_name_keep_their_own(spark):
    long = "a" * 70
    rows = [(f"{long}1.xlsx", "x"), (f"{long}2.xlsx", "x"), ("b.xlsx", "x"), ("b.xls", "x"), ("c.xlsx", None)]
    named = name_tables(spark.createDataFrame(rows, "file_name string, sheet_name string")).collect()
    names = [r["table_name"] for r in named if r["sheet_name"]]
    assert len(set(names)) == len(names) == 4
    assert all(len(n) <= 63 for n in names)
    assert {"a" * 63, "b__x"} <= set(names)


def mixed(spark, texts, key=None):
    from strata.sources.mixed import mixed_records

    df = spark.createDataFrame(list(enumerate(texts)), "position_in_file int, document string")
    rows = mixed_records(df, key).orderBy("position_in_file", "position").collect()
    return [(r["position_in_file"], r["position"], r["record"], r["error"]) for r in rows]


def test_documents_of_any_form(spark):
    texts = ['{"a": 1, "b": {"c": [2]}}', '[{"a": "x"}, 5, null, [1]]', "[]", "7", "null", "{x", "", None]
    other = "neither an object nor a list"
    assert mixed(spark, texts) == [
        (0, 0, {"a": "1", "b": '{"c":[2]}'}, None),
        (1, 0, {"a": "x"}, None),
        (1, 1, {"0": "5"}, None),
        (1, 2, {"0": None}, None),
        (1, 3, {"0": "[1]"}, None),
        (3, None, None, other),
        (4, None, None, other),
        (5, None, None, "invalid JSON: {x"),
        (6, None, None, "empty document"),
        (7, None, None, "empty document"),
    ]


def test_documents_with_a_key(spark):
    texts = ['{"my key": [{"a": 1}, {"b": 2}]}', '{"z": 1, "a": 2}', '{"my key": 5}', '{"my key": null}', "[1]", "{}"]
    assert mixed(spark, texts, "my key") == [
        (0, 0, {"a": "1"}, None),
        (0, 1, {"b": "2"}, None),
        (1, None, None, "data_key 'my key' not found; the keys are a, z"),
        (2, None, None, "'my key' holds no list"),
        (3, None, None, "data_key 'my key' not found; the keys are my key"),
        (4, None, None, "no object with data_key 'my key'"),
        (5, None, None, "data_key 'my key' not found; the keys are "),
    ]
    assert mixed(spark, [], "my key") == []


def test_a_broken_document_does_not_stop_a_mixed_endpoint(spark, tmp_path):
    for i, text in enumerate(['[{"a": 1}, {"b c": "x"}]', "{no", '{"a": 2}']):
        (tmp_path / f"{i}.json").write_text(text)
    endpoints = [
        {"path": str(tmp_path), "table_name": "plain", "data_key": "a"},
        {"path": str(tmp_path), "table_name": "any", "mixed": True},
        {"path": str(tmp_path), "table_name": "none", "mixed": True, "data_key": "z"},
    ]
    found = {r.table_name: r.rows() for r in JsonDocuments(spark, endpoints).extract()}
    assert found.keys() == {"any"}
    assert found["any"].columns == ["a", "b c"]
    rows = sorted((tuple(r) for r in found["any"].collect()), key=repr)
    assert rows == [("1", None), ("2", None), (None, "x")]
