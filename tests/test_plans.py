"""What the plans of the main steps look like."""

import contextlib
import io
import os
import re

import pytest

from checks import queries as q
from strata.operators import kpis, order
from strata.operators.clean import column_profiles
from strata.operators.loads import new_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

WITH_PYTHON = {"workbook_rows"}


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def read_columns(text):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*)>", text)]


@pytest.mark.parametrize("name", sorted(q.QUERIES.keys() - WITH_PYTHON - {"medallion_run"}))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(q.QUERIES[name](spark, FOLDER))
    for unwanted in ("Python", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"):
        assert unwanted not in text


def test_sales_are_read_once_and_only_the_needed_columns(spark):
    dim = q.products(spark, FOLDER).withColumnRenamed("id_producto", "nk_producto")
    sales = kpis.entity_sales(q.line_fact(spark, FOLDER), dim, q.days(spark), "producto", "prod")
    scans = read_columns(plan(sales))
    assert scans == [
        {"l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"},
        {"p_partkey", "p_name", "p_brand", "p_type"},
    ]


def test_sales_are_summed_before_they_meet_the_dimension(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dim = q.gap_customers(spark, FOLDER)
        sales = kpis.entity_sales(q.order_fact(spark, FOLDER), dim, q.days(spark), "cliente", "cli")
        tree = plan(sales).split("\n\n")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = next(line for line in tree.splitlines() if "SortMergeJoin Inner" in line)
    below = tree[tree.index(join) :]
    assert below.index("HashAggregate") < below.index("Scan parquet")


def test_keys_that_are_missing_are_filtered_in_the_scan(spark):
    lines = q.line_fact(spark, FOLDER)
    text = plan(kpis.dated_sales(lines, q.days(spark), kpis.MONTH, "fk_producto"))
    assert "PushedFilters: [IsNotNull(l_partkey)" in text


def test_period_window_comes_after_the_aggregate(spark):
    tree = plan(q.kpi_by_period(spark, FOLDER)).split("\n\n")[0]
    assert tree.index("Window") < tree.index("HashAggregate")


def test_a_column_profile_is_one_pass(spark):
    text = plan(column_profiles(q.messy_customers(spark, FOLDER)))
    assert text.count("Scan parquet") == 2  # in the tree and in the details


def test_missing_ids_meet_in_no_join_of_two_tables(spark):
    incoming = q.orders(spark, FOLDER)
    loaded = q.read(spark, FOLDER, "lineitem").selectExpr("l_orderkey AS idventa")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(new_rows(incoming, loaded, "idventa"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin LeftSemi" in text and "SortMergeJoin LeftAnti" in text
    assert text.count("PushedFilters: [IsNotNull") == 2


def test_large_ranks_have_no_window_over_a_whole_group(spark):
    ranks = order.dense_ranks(q.order_totals(spark, FOLDER), [kpis.PERIOD], kpis.SALES, "r")
    tree = plan(ranks)
    assert "dense_rank" not in tree
    kpi = plan(q.kpi_by_customer(spark, FOLDER))
    assert "dense_rank" not in kpi
    # Windows without keys are over a row per task.
    assert kpi.count("rowsBetween") == 0 and kpi.count("_task#") > 0
