"""One query per operator, each over whole tables."""

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.workbooks import packed
from strata.fixed_values import GOLD_AT, INGESTED_AT, LOAD_RULES, SILVER_AT, STAGED_AT
from strata.functions.scalars import date_number
from strata.operators import kpis
from strata.operators.clean import clean, column_profiles
from strata.operators.control import mark_pending
from strata.operators.coverage import key_coverage, key_sample
from strata.operators.loads import load_rule, load_unit, new_rows, reset_staging
from strata.operators.losses import lost_report, lost_sketches
from strata.operators.order import add_row_number, dense_ranks
from strata.operators.raw import normalize, normalize_columns, stringify
from strata.operators.star import (
    calendar,
    dim_clientes,
    dim_productos,
    dim_tiempo,
    fact_columns,
    fact_ventas,
)
from strata.plans.gold import run_gold
from strata.plans.refresh import append_sales, refresh_gold
from strata.plans.run import failed, run
from strata.session import fresh_path, new_database, shared_folder, written
from strata.sources.catalog import read_first, save, table
from strata.sources.documents import JsonDocuments, read_documents, records
from strata.sources.mixed import mixed_records
from strata.sources.records import SourceRecord
from strata.sources.workbook import filter_units, list_workbooks, name_tables, sheet_cells, with_columns

FIRST_YEAR, LAST_DAY = 1995, dt.date(2001, 12, 31)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The tables in the roles of customers, products and sales.


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").select(
        F.col("c_custkey").alias("id_cliente"),
        F.col("c_name").alias("nombre"),
        F.col("c_mktsegment").alias("segmento"),
        F.col("c_acctbal").alias("saldo"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").select(
        F.col("p_partkey").alias("id_producto"),
        F.col("p_name").alias("nombre"),
        F.col("p_brand").alias("marca"),
        F.col("p_type").alias("categoria"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("idventa"),
        F.col("o_custkey").alias("id_cliente"),
        F.col("o_orderdate").alias("fecha"),
        F.col("o_orderstatus").alias("estado"),
        F.col("o_totalprice").alias("total"),
    )


def order_fact(spark: SparkSession, folder: str) -> DataFrame:
    return fact_columns(orders(spark, folder)).withColumnRenamed("idventa", "sk_venta")


def line_fact(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("sk_venta"),
        F.col("l_partkey").alias("id_producto"),
        F.col("l_shipdate").alias("fecha"),
        F.col("l_extendedprice").alias("importe"),
        F.col("l_quantity").alias("cantidad"),
    )
    return fact_columns(lines)


def days(spark: SparkSession) -> DataFrame:
    return dim_tiempo(spark, FIRST_YEAR, LAST_DAY)


# Bronze.


def bronze_normalize_columns(spark, folder):
    part = read(spark, folder, "part")
    return normalize_columns(
        part.toDF(" P.Part-Key ", "Name (full)", "BRAND", "brand", "_Size.", "Año Retail Price")
    )


def bronze_drop_empty_rows(spark, folder):
    sales = read(spark, folder, "orders")
    blanked = sales.select(
        *[F.when(F.col("o_orderstatus") != "P", F.col(c)).alias(c) for c in sales.columns]
    )
    return normalize(blanked, "orders.xlsx", "Hoja 1").drop(INGESTED_AT, "o_orderdate")


def bronze_stringify(spark, folder):
    return stringify(
        read(spark, folder, "orders").withColumns(
            {
                "is_open": F.col("o_orderstatus") == "O",
                "o_orderpriority": F.when(
                    F.col("o_orderpriority") == "5-LOW", "nan"
                ).otherwise(F.col("o_orderpriority")),
                "in_tens_of_millions": F.col("o_totalprice") * 1024,
            }
        )
    )


def unit_inventory(spark, folder):
    names = F.create_map(
        *[
            F.lit(text)
            for pair in (("en", "Clientes "), ("es", "Ventas "), ("fr", "Productos "), ("de", "api"))
            for text in pair
        ]
    )
    units = (
        read(spark, folder, "documents")
        .groupBy("source", "lang")
        .agg(F.max("doc_id").alias("last_doc"))
        .select(
            F.concat(
                F.coalesce(names[F.col("lang")], F.lit("")),
                F.when(F.length("source") > 4, F.repeat(F.col("source"), F.lit(20))).otherwise(
                    F.col("source")
                ),
                F.lit(" (Q1).XLSX"),
            ).alias("file_name"),
            F.concat(F.lit(" Hoja "), F.col("lang"), F.lit("-"), F.col("last_doc")).alias(
                "sheet_name"
            ),
        )
    )
    kept = filter_units(units, "src", ["hoja_es", "hoja_EN", "hoja_de"])
    return name_tables(kept).withColumn("rule", load_rule(F.col("table_name"))).select(
        "file_name", "sheet_name", "table_name", "rule.load_mode", "rule.staging", "rule.id_column"
    )


def bronze_incremental_new(spark, folder):
    incoming = orders(spark, folder).withColumn(
        "idventa", F.when(F.col("estado") != "P", F.concat(F.lit(" "), F.col("idventa")))
    )
    loaded = read(spark, folder, "lineitem").select(F.col("l_orderkey").alias("idventa"))
    return new_rows(incoming, loaded, "idventa").drop("fecha")


def bronze_replace_staging(spark, folder):
    database = new_database(spark, "replace")
    reset_staging(spark, database)
    staging = LOAD_RULES[0][2]
    rows = customers(spark, folder)
    load_unit(rows.withColumn("viejo", F.lit(1)), database, "clientes__a", "a.xlsx", "a")
    load_unit(rows, database, "clientes__a", "a.xlsx", "a", staging)
    columns = [*rows.columns, "_source_file", "_source_sheet"]
    target, staged = table(spark, database, "clientes__a"), table(spark, database, staging)
    return target.select(F.lit("target").alias("place"), *columns).union(
        staged.select(F.lit("staging").alias("place"), *columns)
    )


def bronze_staging_evolve(spark, folder):
    database = new_database(spark, "evolve")
    reset_staging(spark, database)
    staging = LOAD_RULES[1][2]
    rows = products(spark, folder)
    load_unit(rows.drop("marca"), database, "productos__a", "a.xlsx", "a", staging)
    load_unit(rows, database, "productos__b", "b.xlsx", "b", staging)
    return table(spark, database, staging).drop(STAGED_AT, INGESTED_AT)


def control_pending_units(spark, folder):
    units = (
        read(spark, folder, "documents")
        .groupBy(F.col("source").alias("file_name"), F.col("lang").alias("sheet_name"))
        .agg(F.max("doc_id").alias("last_doc"))
        .select(
            "file_name",
            "sheet_name",
            F.timestamp_seconds("last_doc").alias("modified_at"),
            F.when(F.col("sheet_name") == "es", "ventas_x").otherwise("x").alias("table_name"),
        )
    )
    control = units.select(
        "file_name",
        "sheet_name",
        F.when(F.col("sheet_name") == "fr", "ERROR").otherwise("SUCCESS").alias("status"),
        F.when(F.col("sheet_name") == "de", F.col("modified_at") + F.expr("INTERVAL 1 DAY"))
        .otherwise(F.col("modified_at"))
        .alias("source_modified_at"),
    )
    return mark_pending(units, control).drop("modified_at")


def json_records(spark, folder):
    record = F.struct("event_id", "event_type", F.from_json("props", "k bigint").alias("props"))
    documents = read(spark, folder, "events").select(
        F.to_json(F.struct(F.array(record).alias("posts"), F.lit(1).alias("total")))
    )
    landed = landing(spark, documents)
    return stringify(records(read_documents(spark, landed, multi_line=False), "posts")).select(
        "event_id", "event_type", "props"
    )


def landed_files(spark, folder):
    """Workbook files of a landed folder, one for each status of the orders, among others."""
    landed = fresh_path(spark, "landed")
    sales = orders(spark, folder).repartition("estado")
    # A task has its files open side by side, as sorting its rows by status takes memory for
    # all of them.
    most = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(most)
    spark.conf.set(most, "64")
    try:
        for name, kind in (("old", "xls"), ("other", "csv")):
            sales.write.partitionBy("estado").option("extension", kind).csv(f"{landed}/kind={name}")
    finally:
        spark.conf.set(most, before)
    files = list_workbooks(spark, landed)
    times = Window.orderBy(F.monotonically_increasing_id())
    files = files.withColumn("_before", F.lag("modified_at").over(times))
    return files.select(
        F.regexp_extract("id", "estado=([^/]*)", 1).alias("estado"),
        F.regexp_extract("name", r"\.(\w+)$", 1).alias("extension"),
        "mime_type",
        (F.col("size") > 0).alias("has_content"),
        F.col("modified_at").isNotNull().alias("has_time"),
        F.coalesce(F.col("_before") >= F.col("modified_at"), F.lit(True)).alias("newest_first"),
    )


def landing(spark, documents):
    """A folder with the documents, one a line."""
    text = written(documents.toDF("value"), "documents", "text")
    return f"{shared_folder(spark)}/{'/'.join(text.inputFiles()[0].split('/')[-3:-1])}"


def json_list(spark, folder):
    """Documents that are a list of records, some of which lack a field."""
    record = F.struct(
        "event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("event_type")
    )
    documents = read(spark, folder, "events").select(F.to_json(F.array(record)))
    landed = landing(spark, documents)
    return stringify(records(read_documents(spark, landed, multi_line=False))).select(
        "event_id", "event_type"
    )


def catalog_named_read(spark, folder):
    """The second of the names looked for, though a keyword would fit another table."""
    database = new_database(spark, "named")
    save(customers(spark, folder), database, "clientes__sheet1")
    save(products(spark, folder), database, "a_clientes_viejos")
    return read_first(spark, database, ["clientes__hoja", "clientes__sheet1"], "clientes")


def staging_truncated(spark, folder):
    """A staging table that a new run empties before it is filled again."""
    database = new_database(spark, "truncate")
    reset_staging(spark, database)
    staging = LOAD_RULES[1][2]
    rows = products(spark, folder)
    load_unit(rows, database, "productos__a", "a.xlsx", "a", staging)
    reset_staging(spark, database)
    load_unit(rows.where("id_producto % 2 = 0"), database, "productos__a", "a.xlsx", "a", staging)
    return table(spark, database, staging).drop(STAGED_AT, INGESTED_AT)


def bronze_incremental_load(spark, folder):
    """A load of new ids, of which many are missing, into a table that has some."""
    database = new_database(spark, "incremental")
    reset_staging(spark, database)
    staging, key = LOAD_RULES[2][2], "idventa"
    text = orders(spark, folder).withColumn(
        key, F.when(F.col("estado") != "P", F.col(key).cast("string"))
    )
    old = text.where("total < 100000")
    load_unit(old, database, "ventas__a", "a.xlsx", "a", staging, key)
    load_unit(text, database, "ventas__a", "b.xlsx", "b", staging, key)
    columns = ["idventa", "id_cliente", "estado", "total", "_source_file"]
    target, staged = table(spark, database, "ventas__a"), table(spark, database, staging)
    return target.select(F.lit("target").alias("place"), *columns).union(
        staged.select(F.lit("staging").alias("place"), *columns)
    )


def dates_mixed(spark, folder):
    """Dates in other shapes than year, month, day with hyphens."""
    day = F.col("o_orderdate")
    shape = F.col("o_orderkey") % 4
    text = (
        F.when(shape == 0, F.date_format(day, "yyyyMMdd"))
        .when(shape == 1, F.date_format(day, "d/M/yyyy"))
        .when(shape == 2, F.date_format(day, "yyyy/MM/dd HH:mm"))
        .otherwise(F.lit("mañana"))
    )
    sales = read(spark, folder, "orders").select("o_orderkey", text.alias("fecha"))
    return fact_columns(sales, day_first=True).select("o_orderkey", "fk_fecha")


def dates_voted(spark, folder):
    """Columns of dates that have the day or the month first, some with names of months;
    which is first is left to the dates."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    parts = []
    for shape, text in (("day", "dd/MM/yyyy"), ("month", "MM/dd/yyyy"), ("short", "d-M-yy")):
        date = (
            F.when(key % 5 == 0, F.date_format(day, "d MMMM yyyy"))
            .when(key % 5 == 1, F.date_format(day, "MMM dd, yyyy"))
            .when(key % 5 == 2, F.date_format(day, "dd-MMM-yy"))
            .otherwise(F.date_format(day, text))
        )
        sales = read(spark, folder, "orders").select("o_orderkey", date.alias("fecha"))
        found = fact_columns(sales, day_first=None)
        parts.append(found.select(F.lit(shape).alias("shape"), "o_orderkey", "fk_fecha"))
    return reduce(DataFrame.union, parts)


def lost_values(spark, folder):
    """Texts that are no numbers, in columns that are mostly numbers, of two loads."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    sales = read(spark, folder, "orders").select(
        F.when(key % 9 == 0, F.concat(F.lit(" ref "), F.col("o_orderpriority")))
        .otherwise(key.cast("string"))
        .alias("idventa"),
        F.when(status == "P", F.lit("n/a"))
        .when(key % 7 == 0, F.lit("pendiente"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("total"),
        F.col("o_orderpriority").alias("prioridad"),
        F.col("o_custkey").cast("string").alias("id_cliente"),
    )
    loads = [sales.where("id_cliente % 3 = 0"), sales.where("id_cliente % 3 > 0")]
    report = lost_report(lost_sketches(loads[0]).union(lost_sketches(loads[1])))
    return report.select("column_name", "lost_rows", F.explode("texts").alias("_t")).select(
        "column_name", "lost_rows", "_t.text", "_t.rows"
    )


def stamped(spark, folder):
    """Rows per layer and load time, where the time is given."""
    at = dt.datetime(2024, 5, 6, 7, 8, 9)
    sales, calendar_days = order_fact(spark, folder), days(spark)
    parts = {
        SILVER_AT: clean(customers(spark, folder), at),
        GOLD_AT: kpis.kpi_ventas_por_periodo(sales, calendar_days, at),
    }
    counted = [
        df.groupBy(F.lit(name).alias("layer"), F.col(name).cast("string").alias("at")).count()
        for name, df in parts.items()
    ]
    return counted[0].union(counted[1]).withColumnRenamed("count", "n")


def kpi_order(spark, folder):
    """The rows of a KPI table with their place, as they are returned in order."""
    kpi = kpis.kpi_ventas_por_cliente(
        order_fact(spark, folder), gap_customers(spark, folder), days(spark)
    )
    rows = add_row_number(kpi.select(kpis.PERIOD, "ranking_mes", "fk_cliente"), "place")
    return rows


def workbook_rows(spark, folder):
    sales = orders(spark, folder)
    files = packed(sales.repartition(spark.sparkContext.defaultParallelism), "Ventas")
    return with_columns(sheet_cells(files, "Ventas"), sales.columns)


def catalog_fallback_read(spark, folder):
    database = new_database(spark, "fallback")
    save(products(spark, folder), database, "b_clientes_viejos")
    save(customers(spark, folder), database, "a_clientes_2024")
    return read_first(spark, database, ["clientes__hoja", "clientes__sheet1"], "CLIENTES")


# Silver.


def messy_customers(spark, folder):
    """Customers as text, with blanks, odd numbers and texts for missing."""
    text = stringify(customers(spark, folder))
    segment, balance = F.col("segmento"), F.col("saldo")
    return text.select(
        "id_cliente",
        F.concat(F.lit(" \t"), F.lower("nombre"), F.lit("  ")).alias("nombre"),
        F.when(segment == "BUILDING", " nan ")
        .when(segment == "MACHINERY", "None")
        .when(segment == "FURNITURE", "  ")
        .otherwise(F.lower(segment))
        .alias("segmento"),
        F.when(segment == "BUILDING", F.concat(F.lit(" +"), balance, F.lit("5 ")))
        .when(segment == "MACHINERY", "n/a")
        .otherwise(balance)
        .alias("saldo"),
        F.when(segment == "BUILDING", "1_000")
        .when(segment == "MACHINERY", "1d")
        .when(segment == "FURNITURE", "0x10")
        .otherwise("7.")
        .alias("raros"),
        F.when(segment != "BUILDING", "1e3").alias("miles"),
        F.lit("origen.xlsx").alias("_source_file"),
    )


def silver_infer_types(spark, folder):
    return column_profiles(messy_customers(spark, folder))


def silver_clean_customer(spark, folder):
    return clean(messy_customers(spark, folder)).drop(SILVER_AT)


def dim_customer(spark, folder):
    return dim_clientes(customers(spark, folder), ["id_cliente"]).drop(SILVER_AT)


def dim_product(spark, folder):
    return dim_productos(products(spark, folder), ["categoria", "id_producto"]).drop(SILVER_AT)


def dim_time(spark, folder):
    bounds = read(spark, folder, "orders").agg(
        F.trunc(F.min("o_orderdate"), "year").alias("first"),
        F.to_date(F.max("o_orderdate")).alias("last"),
    )
    return calendar(bounds)


def fact_sales(spark, folder):
    return fact_ventas(stringify(orders(spark, folder)), ["total", "idventa"]).drop(SILVER_AT)


# Gold.


def kpi_by_period(spark, folder):
    return kpis.kpi_ventas_por_periodo(order_fact(spark, folder), days(spark)).drop(GOLD_AT)


def gap_customers(spark, folder):
    """Customers whose segment is missing below a zero balance, as text keys."""
    return customers(spark, folder).select(
        F.concat(F.lit(" "), F.col("id_cliente")).alias("nk_cliente"),
        "nombre",
        F.when(F.col("saldo") >= 0, F.col("segmento")).alias("segmento"),
    )


def kpi_by_customer(spark, folder):
    return kpis.kpi_ventas_por_cliente(
        order_fact(spark, folder), gap_customers(spark, folder), days(spark)
    ).drop(GOLD_AT)


def kpi_repeated_keys(spark, folder):
    """A dimension in which a key has many rows and few different attributes."""
    dim = read(spark, folder, "customer").select(
        F.col("c_nationkey").cast("double").alias("nk_cliente"), F.col("c_mktsegment").alias("segmento")
    )
    lines = read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("sk_venta"),
        F.col("l_linenumber").alias("id_cliente"),
        F.col("l_shipdate").alias("fecha"),
        F.col("l_extendedprice").alias("total"),
    )
    return kpis.kpi_ventas_por_cliente(fact_columns(lines), dim, days(spark)).drop(GOLD_AT)


def kpi_by_product(spark, folder):
    dim = products(spark, folder).withColumnRenamed("id_producto", "nk_producto")
    return kpis.kpi_ventas_por_producto(line_fact(spark, folder), dim, days(spark)).drop(GOLD_AT)


def _months(spark, folder):
    sums = kpis.dated_sales(order_fact(spark, folder), days(spark), kpis.MONTH)
    return sums.select(
        "anio", kpis.PERIOD, kpis.round2(kpis.summed(sums, "_amount")).alias(kpis.SALES)
    )


def period_growth(spark, folder):
    return kpis.growth(_months(spark, folder), kpis.SALES, "variacion_mes_anterior_pct")


def period_ytd(spark, folder):
    return kpis.year_to_date(_months(spark, folder), kpis.SALES, "acumulado_anual")


def order_totals(spark, folder):
    return read(spark, folder, "orders").select(
        "o_orderkey",
        (date_number(F.to_date("o_orderdate")) / 100).cast("int").alias(kpis.PERIOD),
        F.col("o_totalprice").alias(kpis.SALES),
    )


def rank_month(spark, folder):
    """Orders ranked within their month."""
    return kpis.month_rank(order_totals(spark, folder))


def rank_missing(spark, folder):
    """Totals ranked within their month, some without a total or a month."""
    totals = order_totals(spark, folder).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 5 != 0, F.col(kpis.PERIOD)).alias(kpis.PERIOD),
        F.when(F.col("o_orderkey") % 7 != 0, F.col(kpis.SALES)).alias(kpis.SALES),
    )
    return kpis.month_rank(totals)


def kpi_small_and_large(spark, folder):
    """Sales of amounts with many decimals, and of large ones."""
    lines = read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("sk_venta"),
        F.col("l_shipdate").alias("fecha"),
        (
            F.col("l_extendedprice")
            * F.when(F.col("l_linenumber") % 2 == 0, F.lit(1e-7)).otherwise(F.lit(1e5))
        ).alias("total"),
    )
    by_size = fact_columns(lines).withColumn("fk_cliente", (F.col("total") > 1).cast("string"))
    names = by_size.select(F.col("fk_cliente").alias("nk_cliente")).distinct()
    return kpis.kpi_ventas_por_cliente(by_size, names, days(spark)).drop(GOLD_AT)


def kpi_fractions(spark, folder):
    """Products of which tiny parts are sold, some of them twice in the dimension."""
    lines = read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("sk_venta"),
        F.col("l_partkey").alias("id_producto"),
        F.col("l_shipdate").alias("fecha"),
        F.col("l_extendedprice").alias("importe"),
        (F.col("l_quantity") * 1e-9).alias("cantidad"),
    )
    dim = products(spark, folder).select(F.col("id_producto").alias("nk_producto"), "marca")
    again = dim.where("nk_producto % 3 = 0")
    sales = kpis.entity_sales(fact_columns(lines), dim.union(again), days(spark), "producto", "prod")
    # As whole billionths, which do not depend on how a sum of doubles is rounded.
    return sales.select(
        kpis.PERIOD, "fk_producto", F.rint(F.col(kpis.UNITS) * 1e9).cast("bigint").alias("partes")
    )


def lines_with_customers(spark, folder):
    """Order lines as sales with customer and product."""
    return fact_columns(sale_lines(spark, folder).dropna(how="all")).withColumnRenamed("idventa", "sk_venta")


def sales_cube(spark, folder):
    """Sums by month, by month and customer, by month and product, of one scan."""
    cube = kpis.sales_cube(lines_with_customers(spark, folder), days(spark))
    return cube.select(
        kpis.CUBE_SET,
        "trimestre",
        kpis.PERIOD,
        "fk_cliente",
        "fk_producto",
        kpis.round2(kpis.summed(cube, "_amount")).alias(kpis.SALES),
        kpis.COUNT,
        kpis.summed(cube, "_units").alias(kpis.UNITS),
    )


def gap_sales(spark, folder):
    """Sales of which some lack the date, some the customer, and some customers are unknown."""
    sales = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("sk_venta"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("id_cliente"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("fecha"),
        F.col("o_totalprice").alias("total"),
    )
    return fact_columns(sales), gap_customers(spark, folder).where("nk_cliente % 7 != 0")


def kpi_unmatched(spark, folder):
    """All sales by customer, those without date, customer or attributes by cause."""
    fact, known = gap_sales(spark, folder)
    return kpis.kpi_ventas_por_cliente(fact, known, days(spark), keep_unmatched=True).drop(GOLD_AT)


def kpi_unmatched_periods(spark, folder):
    """All sales by month, those without a date in a row of their own."""
    fact, _ = gap_sales(spark, folder)
    return kpis.kpi_ventas_por_periodo(fact, days(spark), keep_unmatched=True).select(
        kpis.PERIOD, kpis.SALES, kpis.COUNT, "variacion_mes_anterior_pct", "acumulado_anual"
    )


def rank_global(spark, folder):
    """Customers ranked by their orders' total."""
    totals = read(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("fk_cliente"), F.col("o_totalprice").alias(kpis.SALES)
    )
    return kpis.global_rank(totals, "fk_cliente")


def rank_lines(spark, folder):
    """Distinct line prices ranked within return flag."""
    lines = read(spark, folder, "lineitem").select(
        "l_returnflag", F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("cents")
    )
    return dense_ranks(lines, ["l_returnflag"], "cents", "place")


def month_share(spark, folder):
    return kpis.month_share(order_totals(spark, folder))


def key_coverage_report(spark, folder):
    documents, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    sales, lines = read(spark, folder, "orders"), read(spark, folder, "lineitem")
    return key_coverage(documents, "doc_id", labels, "doc_id").select(
        F.lit("labels").alias("dimension"), "*"
    ).union(
        key_coverage(sales, "o_orderkey", lines, "l_orderkey").select(F.lit("lineitem"), "*")
    )


def key_samples(spark, folder):
    return key_sample(read(spark, folder, "orders"), "o_custkey")


@dataclass
class Tables:
    """The given tables as a source of units."""

    tables: dict[str, DataFrame]
    source_type: str = "tables"

    def extract(self):
        for name, df in self.tables.items():
            yield SourceRecord(df, f"{name}.xlsx / Hoja", f"{name}__hoja")


def medallion_run(spark, folder):
    """Customers, products and sales through all layers; the customer KPI."""
    bronze, silver, gold = (new_database(spark, layer) for layer in ("bronze", "silver", "gold"))
    source = Tables(
        {
            "clientes": customers(spark, folder).drop("saldo"),
            "productos": products(spark, folder),
            "ventas": orders(spark, folder),
        }
    )
    run(
        spark,
        "all",
        [source],
        options={
            "bronze": {"database": bronze},
            "silver": {
                "bronze": bronze,
                "database": silver,
                "start_year": FIRST_YEAR,
                "end_date": LAST_DAY,
            },
            "gold": {"silver": silver, "database": gold},
        },
    )
    return table(spark, gold, "kpi_ventas_por_cliente").drop(GOLD_AT)


def sale_lines(spark, folder):
    """Sales with products and quantities, among them empty rows."""
    sales = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = read(spark, folder, "lineitem").join(sales, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("idventa"),
        F.col("o_custkey").alias("id_cliente"),
        F.col("l_partkey").alias("id_producto"),
        F.col("o_orderdate").alias("fecha"),
        F.col("l_extendedprice").alias("total"),
        F.col("l_quantity").alias("cantidad"),
    )
    empty = read(spark, folder, "nation").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    )
    return rows.union(empty)


def medallion_kpis(spark, folder):
    """Sale lines through all layers; the rows of all three KPI tables."""
    bronze, silver, gold = (new_database(spark, layer) for layer in ("bronze", "silver", "gold"))
    source = Tables(
        {
            "clientes": customers(spark, folder),
            "productos": products(spark, folder),
            "ventas": sale_lines(spark, folder),
        }
    )
    period = {"start_year": FIRST_YEAR, "end_date": LAST_DAY}
    options = {
        "bronze": {"database": bronze},
        "silver": {"bronze": bronze, "database": silver, **period},
        "gold": {"silver": silver, "database": gold},
    }
    summary = run(spark, "all", [source], options=options)
    assert not failed(summary) and summary["gold"]["success"] == 3, summary
    columns = {
        "clave": "bigint",
        "ranking_mes": "int",
        "ranking_global": "int",
        "participacion_mes_pct": "double",
        "acumulado_anual": "double",
        "cantidad_unidades": "double",
    }
    parts = []
    for name, key in (("periodo", None), ("cliente", "fk_cliente"), ("producto", "fk_producto")):
        kpi = table(spark, gold, f"kpi_ventas_por_{name}")
        kpi = kpi.withColumnRenamed(key, "clave") if key else kpi
        more = [
            (F.col(c) if c in kpi.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in columns.items()
        ]
        parts.append(
            kpi.select(
                F.lit(name).alias("kpi"),
                kpis.PERIOD,
                kpis.SALES,
                kpis.COUNT,
                kpis.TICKET,
                *more,
            )
        )
    return parts[0].union(parts[1]).union(parts[2])


def kpi_refresh(spark, folder):
    """Sales that come in two loads, the second of late months; the rows of two KPIs."""
    silver, gold = new_database(spark, "silver"), new_database(spark, "gold")
    save(customers(spark, folder).withColumnRenamed("id_cliente", "nk_cliente"), silver, "dim_clientes")
    save(products(spark, folder).withColumnRenamed("id_producto", "nk_producto"), silver, "dim_productos")
    save(days(spark), silver, "dim_tiempo")
    sales = written(lines_with_customers(spark, folder), "sales")
    for load in (sales.where("fk_fecha < 19980401"), sales.where("fk_fecha >= 19980401")):
        refresh_gold(spark, silver, gold, append_sales(load, silver))
    parts = []
    for name, more in (("cliente", F.lit(None).cast("double")), ("producto", F.col("participacion_mes_pct"))):
        parts.append(
            table(spark, gold, f"kpi_ventas_por_{name}").select(
                F.lit(name).alias("kpi"),
                kpis.PERIOD,
                F.col(f"fk_{name}").alias("clave"),
                "nombre",
                kpis.SALES,
                kpis.COUNT,
                "ranking_mes",
                "ranking_global",
                more.alias("participacion_mes_pct"),
            )
        )
    return parts[0].union(parts[1])


def silver_empty_rows(spark, folder):
    """Text rows of which some are null in all data columns, cleaned."""
    rows = read(spark, folder, "orders").select(
        *[
            F.when(F.col("o_orderstatus") != "P", F.col(c).cast("string")).alias(name)
            for c, name in (("o_orderkey", "idventa"), ("o_orderpriority", "prioridad"), ("o_totalprice", "total"))
        ],
        F.lit("v.xlsx").alias("_source_file"),
    )
    return clean(rows).drop(SILVER_AT)


def gold_without_table(spark, folder):
    """Gold runs over star schemas that each lack one table: errors only."""
    fact = order_fact(spark, folder)
    star = {
        "fact_ventas": fact,
        "dim_tiempo": days(spark),
        "dim_clientes": customers(spark, folder),
        "dim_productos": products(spark, folder),
    }
    parts = []
    for missing in star:
        silver, gold = new_database(spark, "silver"), new_database(spark, "gold")
        for name, df in star.items():
            if name != missing:
                save(df, silver, name)
        summary = run_gold(spark, silver, gold)
        stored = read(spark, folder, "customer").agg(F.count("*").alias("stored"))
        assert not spark.catalog.listTables(gold)
        columns = [F.lit(summary[c]).alias(c) for c in ("total", "success", "errors")]
        parts.append(stored.select(F.lit(missing).alias("missing"), *columns, "stored"))
    return reduce(DataFrame.union, parts)


def json_mixed(spark, folder):
    """Documents of all forms, with and without a key that the records lie under."""
    kind, at = F.col("event_type"), F.col("event_id")
    record = F.struct(at, kind, F.struct(F.lit(1).alias("x")).alias("more"))
    one, bare = F.to_json(record), F.to_json(F.struct(at))
    forms = [
        one,
        F.concat(F.lit("["), one, F.lit(", "), bare, F.lit("]")),
        at.cast("string"),
        F.concat(F.lit("{broken "), kind),
        F.concat(F.lit('["'), kind, F.lit('", 5]')),
        F.concat(F.lit('{"posts": ['), one, F.lit("]}")),
        F.concat(F.lit('{"posts": '), at, F.lit("}")),
        F.lit(" "),
    ]
    form = F.lit(None)
    for i, text in enumerate(forms):
        form = F.when(at % len(forms) == i, text).otherwise(form)
    documents = read(spark, folder, "events").select(at.alias("source"), form.alias("document"))
    parts = []
    for key in (None, "posts"):
        found = mixed_records(documents, key)
        fields = [F.try_element_at("record", F.lit(n)) for n in ("event_id", "event_type", "more", "0")]
        names = ["found_id", "found_type", "more", "scalar"]
        parts.append(
            found.select(
                F.lit(key or "").alias("data_key"),
                "source",
                "position",
                *[f.alias(n) for f, n in zip(fields, names)],
                "error",
            )
        )
    return parts[0].union(parts[1])


def json_endpoints(spark, folder):
    """Landed documents of several endpoints, of which some are incomplete, missing, broken
    or without the key; the records of the good ones."""
    base = fresh_path(spark, "landed")
    rows = read(spark, folder, "events").select("event_id", "event_type")
    rows.write.json(f"{base}/lines")
    # Lists of one task's records, a document each.
    lists = rows.groupBy((F.col("event_id") % 64).alias("part")).agg(
        F.collect_list(F.struct("event_id", "event_type")).alias("eventos")
    )
    lists.select("eventos").write.json(f"{base}/lists")
    lists.select(F.lit("{no").alias("value")).write.text(f"{base}/broken")
    endpoints = [
        {"path": f"{base}/lines", "table_name": "api_eventos", "multi_line": False},
        {"path": f"{base}/lists", "table_name": "api_listas", "data_key": "eventos", "multi_line": False},
        {"path": f"{base}/lists", "table_name": "api_otra", "data_key": "otra", "multi_line": False},
        {"path": f"{base}/broken", "table_name": "api_rota", "multi_line": False},
        {"path": f"{base}/none", "table_name": "api_sin_datos"},
        {"path": f"{base}/lines"},
        {"table_name": "api_sin_ruta"},
    ]
    found = [
        r.df.groupBy(F.lit(r.table_name).alias("table_name"), F.col("event_type").alias("kind")).agg(
            F.count("*").alias("n")
        )
        for r in JsonDocuments(spark, endpoints).extract()
    ]
    return reduce(DataFrame.union, found)


@dataclass
class Landed:
    """Units of one run: given tables, one of them twice, one that breaks, and one whose
    table name is taken."""

    tables: dict[str, DataFrame]
    source_type: str = "landed"

    def extract(self):
        def broken():
            raise ValueError("no sheet")

        at = dt.datetime(2024, 5, 6, tzinfo=dt.timezone.utc)
        for name, df in self.tables.items():
            yield SourceRecord(df, f"{name}.xlsx / Hoja", f"{name}__hoja", "1", at)
        first = next(iter(self.tables))
        yield SourceRecord(self.tables[first], f"{first}.xlsx / Hoja", f"{first}__hoja", "1", at)
        yield SourceRecord(self.tables[first], f"{first}-b.xlsx / Hoja", f"{first}__hoja", "2", at)
        yield SourceRecord(broken, "roto.xlsx / Hoja", "roto__hoja", "3", at)


def bronze_log(spark, folder):
    """The log of two runs over the same units, of which some fail; the second one plans two
    units at a time."""
    database = new_database(spark, "log")
    source = Landed(
        {
            "regiones": read(spark, folder, "region"),
            "paises": read(spark, folder, "nation"),
            "clientes": customers(spark, folder),
        }
    )
    summaries = [
        run(spark, "bronze", [source], options={"bronze": {"database": database, "units_at_once": size}})
        for size in (1000, 2)
    ]
    assert [s["bronze"]["errors"] for s in summaries] == [2, 2], summaries
    return table(spark, database, "ingestion_control").select(
        "file_id", "file_name", "sheet_name", "target_table", "rows_loaded", "status", "env"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_normalize_columns": bronze_normalize_columns,
    "bronze_drop_empty_rows": bronze_drop_empty_rows,
    "bronze_stringify": bronze_stringify,
    "unit_inventory": unit_inventory,
    "bronze_incremental_new": bronze_incremental_new,
    "bronze_replace_staging": bronze_replace_staging,
    "bronze_staging_evolve": bronze_staging_evolve,
    "control_pending_units": control_pending_units,
    "json_records": json_records,
    "workbook_rows": workbook_rows,
    "catalog_fallback_read": catalog_fallback_read,
    "silver_infer_types": silver_infer_types,
    "silver_clean_customer": silver_clean_customer,
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_time": dim_time,
    "fact_sales": fact_sales,
    "kpi_by_period": kpi_by_period,
    "kpi_by_customer": kpi_by_customer,
    "kpi_repeated_keys": kpi_repeated_keys,
    "kpi_by_product": kpi_by_product,
    "period_growth": period_growth,
    "period_ytd": period_ytd,
    "rank_month": rank_month,
    "json_list": json_list,
    "catalog_named_read": catalog_named_read,
    "staging_truncated": staging_truncated,
    "bronze_incremental_load": bronze_incremental_load,
    "dates_mixed": dates_mixed,
    "stamped": stamped,
    "kpi_order": kpi_order,
    "rank_missing": rank_missing,
    "kpi_small_and_large": kpi_small_and_large,
    "kpi_fractions": kpi_fractions,
    "sales_cube": sales_cube,
    "kpi_unmatched": kpi_unmatched,
    "kpi_unmatched_periods": kpi_unmatched_periods,
    "kpi_refresh": kpi_refresh,
    "silver_empty_rows": silver_empty_rows,
    "gold_without_table": gold_without_table,
    "json_endpoints": json_endpoints,
    "landed_files": landed_files,
    "json_mixed": json_mixed,
    "dates_voted": dates_voted,
    "lost_values": lost_values,
    "rank_global": rank_global,
    "rank_lines": rank_lines,
    "month_share": month_share,
    "key_coverage": key_coverage_report,
    "key_sample": key_samples,
    "medallion_run": medallion_run,
    "medallion_kpis": medallion_kpis,
    "bronze_log": bronze_log,
}
