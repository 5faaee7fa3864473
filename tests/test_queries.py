import datetime as dt
import os

import pytest
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as contract
from checks.compare import connect, differences
from checks.queries import QUERIES
from strata.session import scratch, scratch_database

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = connect(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert QUERIES.keys() <= contract.queries().keys()
    assert QUERIES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    with scratch():
        df = contract.queries()[name](spark, FOLDER)
        assert differences(df, con, contract.oracle_sql()[name]) == []
    assert spark.catalog.listTables(scratch_database(spark)) == []
    assert {d.name for d in spark.catalog.listDatabases()} <= {"default", scratch_database(spark)}


def test_entry(spark):
    with scratch():
        assert contract.entry(spark).count() > 0


def test_landed_files_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    statuses = ["F", "O", "P", None]
    rows = [(i, i, statuses[i % 4], i * 1.5, dt.date(1995, 1, 1)) for i in range(400)]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "orders.parquet"))
    most, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before, csv = spark.conf.get(most), DataFrameWriter.csv
    monkeypatch.setattr(
        DataFrameWriter, "csv", lambda self, path: (seen.append(int(spark.conf.get(most))), csv(self, path))
    )
    files = QUERIES["landed_files"](spark, str(tmp_path)).collect()
    assert len(files) == 4 and {f.extension for f in files} == {"xls"}
    assert len(seen) == 2 and min(seen) > 0 and spark.conf.get(most) == before
