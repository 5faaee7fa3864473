"""The SQL each query is compared with, for DuckDB."""

from strata.fixed_values import (
    BLANKS,
    GOLD_AT,
    LOAD_RULES,
    MONTHS,
    QUARTERS,
    SILVER_AT,
    WEEKDAYS,
)

NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
STRIP = "'" + BLANKS + "'"


def words(names: list[str]) -> str:
    return "[" + ", ".join(f"'{name}'" for name in names) + "]"


def plain(number: str) -> str:
    """A number as a workbook cell shows it: whole ones without decimals."""
    return (
        f"CASE WHEN {number} = floor({number}) THEN CAST(CAST({number} AS BIGINT) AS VARCHAR) "
        f"ELSE CAST({number} AS VARCHAR) END"
    )


def two(number: str) -> str:
    return f"round_even(({number}) * 100, 0) / 100"


def rule(place: int) -> str:
    """Value of a load rule for a table name; 0 is the mode."""
    cases = ""
    for match, text, staging, id_column in LOAD_RULES:
        test = f"contains(table_name, '{text}')" if match == "contains" else f"table_name = '{text}'"
        mode = "incremental" if id_column else "replace_with_staging"
        value = (mode, staging, id_column)[place]
        cases += f" WHEN {test} THEN " + (f"'{value}'" if value else "CAST(NULL AS VARCHAR)")
    return f"CASE{cases} ELSE {'NULL' if place else repr('replace')} END"


CUSTOMERS = """
    SELECT c_custkey AS id_cliente, c_name AS nombre, c_mktsegment AS segmento,
           c_acctbal AS saldo
    FROM customer"""

PRODUCTS = """
    SELECT p_partkey AS id_producto, p_name AS nombre, p_brand AS marca,
           p_type AS categoria
    FROM part"""

MESSY = f"""
    SELECT CAST(id_cliente AS VARCHAR) AS id_cliente,
           ' ' || chr(9) || lower(nombre) || '  ' AS nombre,
           CASE segmento WHEN 'BUILDING' THEN ' nan ' WHEN 'MACHINERY' THEN 'None'
                WHEN 'FURNITURE' THEN '  ' ELSE lower(segmento) END AS segmento,
           CASE segmento WHEN 'BUILDING' THEN ' +' || CAST(saldo AS VARCHAR) || '5 '
                WHEN 'MACHINERY' THEN 'n/a' ELSE CAST(saldo AS VARCHAR) END AS saldo,
           CASE segmento WHEN 'BUILDING' THEN '1_000' WHEN 'MACHINERY' THEN '1d'
                WHEN 'FURNITURE' THEN '0x10' ELSE '7.' END AS raros,
           CASE WHEN segmento <> 'BUILDING' THEN '1e3' END AS miles
    FROM ({CUSTOMERS})"""


def parsed(column: str) -> str:
    text = f"trim({column}, {STRIP})"
    return f"CASE WHEN regexp_matches({text}, '{NUMBER}') THEN TRY_CAST({text} AS DOUBLE) END"


def profile(column: str) -> str:
    return f"""
    SELECT '{column}' AS column_name, count(*) AS table_rows, count(*) AS row_count,
           count({column}) AS value_count, count(n) AS number_count,
           coalesce(bool_or(n % 1 <> 0), false) AS has_decimals,
           CASE WHEN count(n) < 0.5 * count(*) THEN 'text'
                WHEN coalesce(bool_or(n % 1 <> 0), false) THEN 'decimal'
                ELSE 'integer' END AS kind
    FROM (SELECT {column}, {parsed(column)} AS n FROM messy)"""


def upper_text(column: str) -> str:
    text = f"upper(trim({column}, {STRIP}))"
    return f"CASE WHEN {text} NOT IN ('NAN', 'NONE', '') THEN {text} END"


DAY = f"""
    CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS sk_tiempo,
    CAST(d AS DATE) AS fecha,
    CAST(year(d) AS INTEGER) AS anio,
    CAST(quarter(d) AS INTEGER) AS trimestre,
    {words(QUARTERS)}[quarter(d)] AS trimestre_nombre,
    CAST(month(d) AS INTEGER) AS mes,
    {words(MONTHS)}[month(d)] AS mes_nombre,
    CAST(weekofyear(d) AS INTEGER) AS semana_anio,
    CAST(day(d) AS INTEGER) AS dia_mes,
    CAST(isodow(d) AS INTEGER) AS dia_semana,
    {words(WEEKDAYS)}[isodow(d)] AS dia_semana_nombre,
    isodow(d) IN (6, 7) AS es_fin_semana,
    (year(d) % 4 = 0 AND (year(d) % 100 <> 0 OR year(d) % 400 = 0)) AS es_bisiesto,
    CAST(dayofyear(d) AS INTEGER) AS dia_del_anio,
    CAST(CASE WHEN day(d) <= 15 THEN 1 ELSE 2 END AS INTEGER) AS quincena,
    CAST(year(d) * 100 + month(d) AS INTEGER) AS periodo_yyyymm,
    year(d) || 'Q' || quarter(d) AS periodo_yyyyqq"""


def month_of(date: str) -> str:
    return f"CAST(year({date}) * 100 + month({date}) AS INTEGER)"


def month_keys(date: str) -> str:
    return f"""CAST(year({date}) AS INTEGER) AS anio, CAST(month({date}) AS INTEGER) AS mes,
           {words(MONTHS)}[month({date})] AS mes_nombre, {month_of(date)} AS periodo_yyyymm"""


MONTHLY = f"""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS anio,
           {month_of("o_orderdate")} AS periodo_yyyymm,
           {two("CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE)")} AS total_ventas
    FROM orders GROUP BY ALL"""

GROWTH = two("(total_ventas / lag(total_ventas) OVER (ORDER BY periodo_yyyymm) - 1) * 100")
YEAR_TO_DATE = (
    "CAST(sum(CAST(total_ventas AS DECIMAL(18, 2))) OVER "
    "(PARTITION BY anio ORDER BY periodo_yyyymm) AS DOUBLE)"
)
SUMS = f"""
           {two("CAST(sum(amount) AS DOUBLE)")} AS total_ventas,
           count(*) AS cantidad_transacciones,
           {two("CAST(sum(amount) AS DOUBLE) / count(*)")} AS ticket_promedio"""


def ranked(key: str, more: str = "") -> str:
    return f"""
    , totals AS (
        SELECT {key}, dense_rank() OVER (ORDER BY total DESC) AS ranking_global
        FROM (SELECT {key}, sum(CAST(total_ventas AS DECIMAL(18, 2))) AS total
              FROM sales GROUP BY {key}))
    SELECT sales.*,
           CAST(dense_rank() OVER (PARTITION BY periodo_yyyymm ORDER BY total_ventas DESC)
                AS INTEGER) AS ranking_mes,
           CAST(ranking_global AS INTEGER) AS ranking_global{more}
    FROM sales JOIN totals USING ({key})"""


SHARE = two(
    "total_ventas / CAST(sum(CAST(total_ventas AS DECIMAL(18, 2))) "
    "OVER (PARTITION BY periodo_yyyymm) AS DOUBLE) * 100"
)

CUSTOMER_KPI = """
    WITH sales AS (
        SELECT {keys}, {fk} AS fk_cliente, {attributes}, {sums}
        FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18, 2)) AS amount FROM orders)
        JOIN customer ON c_custkey = o_custkey
        {where}
        GROUP BY ALL)
    {ranked}"""

SALE_LINES = f"""
    SELECT {month_keys("o_orderdate")}, CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
           o_custkey AS fk_cliente, l_partkey AS fk_producto, l_quantity,
           CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

GAP_SALES = """
    SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS d,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS k,
           CAST(o_totalprice AS DECIMAL(18, 2)) AS amount
    FROM orders"""

UNITS = """
    SELECT source AS file_name, lang AS sheet_name, max(doc_id) AS last_doc
    FROM documents GROUP BY ALL"""

ORACLES: dict[str, str] = {
    "bronze_normalize_columns": """
        SELECT p_partkey AS p_part_key, p_name AS name__full, p_brand AS brand,
               p_size AS size, p_retailprice AS a_o_retail_price
        FROM part""",
    "bronze_drop_empty_rows": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
               'orders.xlsx' AS _source_file, 'Hoja 1' AS _source_sheet
        FROM orders WHERE o_orderstatus <> 'P'""",
    "bronze_stringify": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
               CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
               CAST(o_totalprice AS VARCHAR) AS o_totalprice,
               CAST(o_orderdate AS VARCHAR) AS o_orderdate,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority,
               CASE WHEN o_orderstatus = 'O' THEN 'True' ELSE 'False' END AS is_open,
               CAST(o_totalprice * 1024 AS VARCHAR) AS in_tens_of_millions
        FROM orders""",
    "unit_inventory": f"""
        WITH units AS (
            SELECT CASE lang WHEN 'en' THEN 'Clientes ' WHEN 'es' THEN 'Ventas '
                        WHEN 'fr' THEN 'Productos ' WHEN 'de' THEN 'api' ELSE '' END
                   || CASE WHEN length(source) > 4 THEN repeat(source, 20) ELSE source END
                   || ' (Q1).XLSX' AS file_name,
                   ' Hoja ' || lang || '-' || max(doc_id) AS sheet_name
            FROM documents GROUP BY source, lang),
        kept AS (
            SELECT *,
                   trim(regexp_replace(lower(regexp_replace(file_name, '(?i)\\.(xlsx|xls|csv)$', '')),
                                       '[^a-z0-9]+', '_', 'g'), '_')
                   || '__'
                   || trim(regexp_replace(lower(sheet_name), '[^a-z0-9]+', '_', 'g'), '_') AS full_name
            FROM units
            WHERE contains(file_name, 'src')
              AND regexp_matches(lower(replace(sheet_name, ' ', '_')), 'hoja_es|hoja_en|hoja_de')),
        named AS (
            SELECT file_name, sheet_name,
                   CASE WHEN length(full_name) > 63 THEN rtrim(full_name[1:63], '_')
                        ELSE full_name END AS table_name
            FROM kept)
        SELECT *, {rule(0)} AS load_mode, {rule(1)} AS staging, {rule(2)} AS id_column
        FROM named""",
    "bronze_incremental_new": """
        SELECT i.* FROM (
            SELECT CASE WHEN o_orderstatus <> 'P' THEN ' ' || o_orderkey END AS idventa,
                   o_custkey AS id_cliente, o_orderstatus AS estado, o_totalprice AS total
            FROM orders) i
        WHERE NOT EXISTS (
            SELECT 1 FROM lineitem
            WHERE CAST(l_orderkey AS VARCHAR) IS NOT DISTINCT FROM trim(i.idventa))""",
    "bronze_replace_staging": f"""
        SELECT place, CAST(id_cliente AS VARCHAR) AS id_cliente, nombre, segmento,
               CAST(saldo AS VARCHAR) AS saldo, 'a.xlsx' AS _source_file, 'a' AS _source_sheet
        FROM ({CUSTOMERS}), (SELECT unnest(['target', 'staging']) AS place)""",
    "bronze_staging_evolve": f"""
        SELECT CAST(id_producto AS VARCHAR) AS id_producto, nombre,
               CASE WHEN unit = 'b' THEN marca END AS marca, categoria,
               unit || '.xlsx' AS _source_file, unit AS _source_sheet
        FROM ({PRODUCTS}), (SELECT unnest(['a', 'b']) AS unit)""",
    "control_pending_units": f"""
        SELECT file_name, sheet_name,
               CASE WHEN sheet_name = 'es' THEN 'ventas_x' ELSE 'x' END AS table_name,
               sheet_name NOT IN ('fr', 'de') AS already_loaded,
               sheet_name IN ('fr', 'de', 'es') AS pending
        FROM ({UNITS})""",
    "json_records": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
               CASE WHEN props IS NOT NULL
                    THEN '{"k":' || json_extract_string(props, '$.k') || '}' END AS props
        FROM events""",
    "workbook_rows": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS idventa, CAST(o_custkey AS VARCHAR) AS id_cliente,
               strftime(o_orderdate, '%Y-%m-%d') AS fecha, o_orderstatus AS estado,
               {plain("o_totalprice")} AS total
        FROM orders""",
    "catalog_fallback_read": CUSTOMERS,
    "silver_infer_types": f"WITH messy AS ({MESSY})"
    + " UNION ALL ".join(
        profile(c) for c in ["id_cliente", "nombre", "segmento", "saldo", "raros", "miles"]
    ),
    "silver_clean_customer": f"""
        SELECT CAST({parsed("id_cliente")} AS BIGINT) AS id_cliente,
               {upper_text("nombre")} AS nombre, {upper_text("segmento")} AS segmento,
               {two(parsed("saldo"))} AS saldo,
               {upper_text("raros")} AS raros,
               CAST({parsed("miles")} AS BIGINT) AS miles
        FROM ({MESSY})""",
    "dim_customer": f"""
        SELECT row_number() OVER (ORDER BY id_cliente) AS sk_cliente,
               id_cliente AS nk_cliente, nombre, segmento, saldo
        FROM ({CUSTOMERS})""",
    "dim_product": f"""
        SELECT row_number() OVER (ORDER BY categoria, id_producto) AS sk_producto,
               id_producto AS nk_producto, nombre, marca, categoria
        FROM ({PRODUCTS})""",
    "dim_time": f"""
        SELECT {DAY}
        FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)),
                                            max(o_orderdate), INTERVAL 1 DAY)) AS d
              FROM orders)""",
    "fact_sales": f"""
        SELECT row_number() OVER (ORDER BY CAST(o_totalprice AS VARCHAR) COLLATE "C",
                                           CAST(o_orderkey AS VARCHAR) COLLATE "C") AS sk_venta,
               CAST(o_custkey AS VARCHAR) AS fk_cliente, CAST(NULL AS VARCHAR) AS fk_producto,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS fk_fecha,
               CAST(o_orderkey AS VARCHAR) AS idventa, o_orderstatus AS estado,
               CAST(o_totalprice AS VARCHAR) AS total
        FROM orders""",
    "kpi_by_period": f"""
        WITH sales AS (
            SELECT CAST(year(o_orderdate) AS INTEGER) AS anio,
                   CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
                   {words(QUARTERS)}[quarter(o_orderdate)] AS trimestre_nombre,
                   CAST(month(o_orderdate) AS INTEGER) AS mes,
                   {words(MONTHS)}[month(o_orderdate)] AS mes_nombre,
                   {month_of("o_orderdate")} AS periodo_yyyymm, {SUMS}
            FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18, 2)) AS amount FROM orders)
            GROUP BY ALL)
        SELECT *, {GROWTH} AS variacion_mes_anterior_pct, {YEAR_TO_DATE} AS acumulado_anual
        FROM sales""",
    "kpi_by_customer": CUSTOMER_KPI.format(
        keys=month_keys("o_orderdate"),
        fk="o_custkey",
        attributes="c_name AS nombre, c_mktsegment AS segmento",
        where="WHERE c_acctbal >= 0",
        sums=SUMS,
        ranked=ranked("fk_cliente"),
    ),
    "kpi_repeated_keys": f"""
        WITH sales AS (
            SELECT {month_keys("l_shipdate")}, l_linenumber AS fk_cliente,
                   c_mktsegment AS segmento, {SUMS}
            FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount FROM lineitem)
            JOIN customer ON c_nationkey = l_linenumber
            GROUP BY ALL)
        {ranked("fk_cliente")}""",
    "kpi_by_product": f"""
        WITH sales AS (
            SELECT {month_keys("l_shipdate")}, l_partkey AS fk_producto, p_name AS nombre,
                   p_brand AS marca, p_type AS categoria, {SUMS},
                   CAST(sum(l_quantity) AS DOUBLE) AS cantidad_unidades
            FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount FROM lineitem)
            JOIN part ON p_partkey = l_partkey
            GROUP BY ALL)
        {ranked("fk_producto", f", {SHARE} AS participacion_mes_pct")}""",
    "period_growth": f"SELECT *, {GROWTH} AS variacion_mes_anterior_pct FROM ({MONTHLY})",
    "period_ytd": f"SELECT *, {YEAR_TO_DATE} AS acumulado_anual FROM ({MONTHLY})",
    "rank_month": f"""
        SELECT o_orderkey, {month_of("o_orderdate")} AS periodo_yyyymm,
               o_totalprice AS total_ventas,
               CAST(dense_rank() OVER (PARTITION BY {month_of("o_orderdate")}
                                       ORDER BY o_totalprice DESC) AS INTEGER) AS ranking_mes
        FROM orders""",
    "json_list": """
        SELECT CAST(event_id AS VARCHAR) AS event_id,
               CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type
        FROM events""",
    "catalog_named_read": CUSTOMERS,
    "staging_truncated": f"""
        SELECT CAST(id_producto AS VARCHAR) AS id_producto, nombre, marca, categoria,
               'a.xlsx' AS _source_file, 'a' AS _source_sheet
        FROM ({PRODUCTS}) WHERE id_producto % 2 = 0""",
    "bronze_incremental_load": f"""
        SELECT place, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) END AS idventa,
               CAST(o_custkey AS VARCHAR) AS id_cliente, o_orderstatus AS estado,
               CAST(o_totalprice AS VARCHAR) AS total,
               CASE WHEN o_totalprice < 100000 THEN 'a.xlsx' ELSE 'b.xlsx' END AS _source_file
        FROM orders, (SELECT unnest(['target', 'staging']) AS place)
        WHERE o_totalprice < 100000 OR o_orderstatus <> 'P'""",
    "dates_mixed": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3
               THEN CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) END AS fk_fecha
        FROM orders""",
    "stamped": f"""
        SELECT '{SILVER_AT}' AS layer, '2024-05-06 07:08:09' AS at, count(*) AS n FROM customer
        UNION ALL
        SELECT '{GOLD_AT}', '2024-05-06 07:08:09', count(DISTINCT {month_of("o_orderdate")})
        FROM orders""",
    "kpi_order": "SELECT row_number() OVER (ORDER BY periodo_yyyymm, ranking_mes, fk_cliente)"
    " AS place, periodo_yyyymm, ranking_mes, fk_cliente FROM ("
    + CUSTOMER_KPI.format(
        keys=month_keys("o_orderdate"),
        fk="o_custkey",
        attributes="c_name AS nombre, c_mktsegment AS segmento",
        where="WHERE c_acctbal >= 0",
        sums=SUMS,
        ranked=ranked("fk_cliente"),
    )
    + ")",
    "rank_missing": f"""
        SELECT *, CASE WHEN periodo_yyyymm IS NOT NULL AND total_ventas IS NOT NULL
                  THEN CAST(dense_rank() OVER (PARTITION BY periodo_yyyymm
                                               ORDER BY total_ventas DESC NULLS LAST) AS INTEGER)
                  END AS ranking_mes
        FROM (SELECT o_orderkey,
                     CASE WHEN o_orderkey % 5 <> 0 THEN {month_of("o_orderdate")} END AS periodo_yyyymm,
                     CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS total_ventas
              FROM orders)""",
    "kpi_small_and_large": f"""
        WITH sales AS (
            SELECT {month_keys("l_shipdate")}, CAST(amount > 1 AS VARCHAR) AS fk_cliente,
                   {two("fsum(amount)")} AS total_ventas, count(*) AS cantidad_transacciones,
                   {two("fsum(amount) / count(*)")} AS ticket_promedio
            FROM (SELECT *, l_extendedprice * CASE WHEN l_linenumber % 2 = 0 THEN CAST(1e-7 AS DOUBLE)
                                              ELSE CAST(1e5 AS DOUBLE) END AS amount FROM lineitem)
            GROUP BY ALL)
        {ranked("fk_cliente")}""",
    "rank_global": """
        SELECT o_orderkey, o_custkey AS fk_cliente, o_totalprice AS total_ventas,
               CAST(dense_rank() OVER (ORDER BY total DESC) AS INTEGER) AS ranking_global
        FROM (SELECT *, sum(CAST(o_totalprice AS DECIMAL(18, 2)))
                        OVER (PARTITION BY o_custkey) AS total
              FROM orders)""",
    "rank_lines": """
        SELECT l_returnflag, cents,
               CAST(dense_rank() OVER (PARTITION BY l_returnflag ORDER BY cents DESC)
                    AS INTEGER) AS place
        FROM (SELECT DISTINCT l_returnflag,
                     CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) AS cents
              FROM lineitem)""",
    "month_share": f"""
        SELECT o_orderkey, periodo_yyyymm, total_ventas, {SHARE} AS participacion_mes_pct
        FROM (SELECT o_orderkey, {month_of("o_orderdate")} AS periodo_yyyymm,
                     o_totalprice AS total_ventas
              FROM orders)""",
    "key_coverage": """
        SELECT 'labels' AS dimension, count(*) AS rows,
               CAST(0 AS BIGINT) AS rows_without_key,
               count_if(NOT known) AS unmatched_rows, count(DISTINCT k) AS distinct_keys,
               count(DISTINCT k) FILTER (NOT known) AS unmatched_keys
        FROM (SELECT doc_id AS k, doc_id IN (SELECT doc_id FROM labels) AS known FROM documents)
        UNION ALL
        SELECT 'lineitem', count(*), CAST(0 AS BIGINT), count_if(NOT known), count(DISTINCT k),
               count(DISTINCT k) FILTER (NOT known)
        FROM (SELECT o_orderkey AS k,
                     o_orderkey IN (SELECT l_orderkey FROM lineitem) AS known FROM orders)""",
    "key_sample": "SELECT DISTINCT o_custkey AS key FROM orders ORDER BY key LIMIT 5",
    "kpi_fractions": f"""
        SELECT periodo_yyyymm, fk_producto, n * CASE WHEN fk_producto % 3 = 0 THEN 2 ELSE 1 END AS partes
        FROM (SELECT {month_of("l_shipdate")} AS periodo_yyyymm, l_partkey AS fk_producto,
                     CAST(sum(l_quantity) AS BIGINT) AS n
              FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)""",
    "sales_cube": f"""
        SELECT CASE WHEN grouping(fk_cliente) = 0 THEN 'cliente' WHEN grouping(fk_producto) = 0
                    THEN 'producto' ELSE 'periodo' END AS conjunto,
               trimestre, periodo_yyyymm, fk_cliente, fk_producto,
               {two("CAST(sum(amount) AS DOUBLE)")} AS total_ventas,
               count(*) AS cantidad_transacciones, CAST(sum(l_quantity) AS DOUBLE) AS cantidad_unidades
        FROM ({SALE_LINES})
        GROUP BY GROUPING SETS ((trimestre, periodo_yyyymm), (periodo_yyyymm, fk_cliente),
                                (periodo_yyyymm, fk_producto))""",
    "kpi_unmatched": f"""
        WITH known AS (
            SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment
            FROM customer WHERE c_custkey % 7 <> 0),
        sales AS (
            SELECT {month_keys("d")}, k AS fk_cliente,
                   CASE WHEN c_custkey IS NULL THEN 'DESCONOCIDO' ELSE c_name END AS nombre,
                   CASE WHEN c_custkey IS NULL THEN 'DESCONOCIDO' ELSE segment END AS segmento,
                   CASE WHEN d IS NULL THEN 'sin_fecha' WHEN k IS NULL THEN 'sin_clave'
                        WHEN c_custkey IS NULL THEN 'sin_miembro'
                        WHEN segment IS NULL THEN 'atributo_nulo' END AS motivo, {SUMS}
            FROM ({GAP_SALES}) LEFT JOIN known ON c_custkey = k GROUP BY ALL),
        totals AS (
            SELECT fk_cliente, dense_rank() OVER (ORDER BY total DESC) AS place
            FROM (SELECT fk_cliente, sum(CAST(total_ventas AS DECIMAL(18, 2))) AS total
                  FROM sales WHERE fk_cliente IS NOT NULL GROUP BY fk_cliente))
        SELECT sales.*, CASE WHEN periodo_yyyymm IS NOT NULL THEN CAST(dense_rank() OVER (
                   PARTITION BY periodo_yyyymm ORDER BY total_ventas DESC) AS INTEGER) END AS ranking_mes,
               CAST(place AS INTEGER) AS ranking_global
        FROM sales LEFT JOIN totals ON totals.fk_cliente = sales.fk_cliente""",
    "kpi_unmatched_periods": f"""
        WITH sales AS (
            SELECT CAST(year(d) AS INTEGER) AS anio, {month_of("d")} AS periodo_yyyymm, {SUMS}
            FROM ({GAP_SALES}) GROUP BY ALL)
        SELECT periodo_yyyymm, total_ventas, cantidad_transacciones,
               CASE WHEN periodo_yyyymm IS NOT NULL THEN {two(
                   "(total_ventas / lag(total_ventas) OVER (ORDER BY periodo_yyyymm NULLS LAST) - 1) * 100"
               )} END AS variacion_mes_anterior_pct,
               {YEAR_TO_DATE} AS acumulado_anual
        FROM sales""",
    "kpi_refresh": f"""
        WITH parts AS (
            SELECT 'cliente' AS kpi, periodo_yyyymm, fk_cliente AS clave, c_name AS nombre, {SUMS}
            FROM ({SALE_LINES}) JOIN customer ON c_custkey = fk_cliente GROUP BY ALL
            UNION ALL
            SELECT 'producto', periodo_yyyymm, fk_producto, p_name, {SUMS}
            FROM ({SALE_LINES}) JOIN part ON p_partkey = fk_producto GROUP BY ALL),
        keyed AS (
            SELECT *, sum(CAST(total_ventas AS DECIMAL(18, 2))) OVER (PARTITION BY kpi, clave) AS whole
            FROM parts)
        SELECT kpi, periodo_yyyymm, clave, nombre, total_ventas, cantidad_transacciones,
               CAST(dense_rank() OVER (PARTITION BY kpi, periodo_yyyymm ORDER BY total_ventas DESC)
                    AS INTEGER) AS ranking_mes,
               CAST(dense_rank() OVER (PARTITION BY kpi ORDER BY whole DESC) AS INTEGER) AS ranking_global,
               CASE WHEN kpi = 'producto' THEN {two("total_ventas / CAST(sum(CAST(total_ventas AS DECIMAL(18, 2))) "
                   "OVER (PARTITION BY kpi, periodo_yyyymm) AS DOUBLE) * 100")} END AS participacion_mes_pct
        FROM keyed""",
    "silver_empty_rows": """
        SELECT o_orderkey AS idventa, upper(o_orderpriority) AS prioridad, round_even(o_totalprice * 100, 0) / 100 AS total
        FROM orders WHERE o_orderstatus <> 'P'""",
    "gold_without_table": """
        SELECT missing, 3 AS total, 0 AS success, 3 AS errors, (SELECT count(*) FROM customer) AS stored
        FROM (SELECT unnest(['fact_ventas', 'dim_tiempo', 'dim_clientes', 'dim_productos']) AS missing)""",
    "json_endpoints": """
        SELECT 'api_eventos' AS table_name, event_type AS kind, count(*) AS n FROM events GROUP BY ALL
        UNION ALL SELECT 'api_listas', event_type, count(*) FROM events GROUP BY ALL""",
    "landed_files": """
        SELECT DISTINCT o_orderstatus AS estado, 'xls' AS extension,
               'application/vnd.ms-excel' AS mime_type, true AS has_content, true AS has_time,
               true AS newest_first
        FROM orders""",
    "json_mixed": """
        WITH e AS (SELECT event_id, event_type, event_id % 8 AS form,
                          CAST(event_id AS VARCHAR) AS id FROM events)
        SELECT '' AS data_key, event_id AS source, p AS position,
               CASE WHEN form IN (0, 1) THEN id END AS found_id,
               CASE WHEN form IN (0, 1) AND p = 0 THEN event_type END AS found_type,
               CASE WHEN form IN (0, 1) AND p = 0 THEN '{"x":1}' END AS more,
               CASE WHEN form = 4 THEN CASE p WHEN 0 THEN event_type ELSE '5' END END AS scalar,
               CASE form WHEN 2 THEN 'neither an object nor a list'
                         WHEN 3 THEN 'invalid JSON: {broken ' || event_type
                         WHEN 7 THEN 'empty document' END AS error
        FROM (SELECT *, unnest(CASE WHEN form IN (1, 4) THEN [0, 1] WHEN form IN (2, 3, 7) THEN [NULL]
                               ELSE [0] END) AS p FROM e)
        UNION ALL
        SELECT 'posts', event_id, CASE WHEN form = 5 THEN 0 END, CASE WHEN form = 5 THEN id END,
               CASE WHEN form = 5 THEN event_type END, CASE WHEN form = 5 THEN '{"x":1}' END, NULL,
               CASE WHEN form = 0
                    THEN $$data_key 'posts' not found; the keys are event_id, event_type, more$$
                    WHEN form IN (1, 2, 4) THEN $$no object with data_key 'posts'$$
                    WHEN form = 3 THEN 'invalid JSON: {broken ' || event_type
                    WHEN form = 6 THEN $$'posts' holds no list$$
                    WHEN form = 7 THEN 'empty document' END
        FROM e""",
    "dates_voted": """
        SELECT shape, o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS fk_fecha
        FROM orders, (SELECT unnest(['day', 'month', 'short']) AS shape)""",
    "lost_values": """
        WITH cells AS (
            SELECT 'idventa' AS column_name, 'ref ' || o_orderpriority AS text
            FROM orders WHERE o_orderkey % 9 = 0
            UNION ALL
            SELECT 'total', CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE 'pendiente' END
            FROM orders WHERE o_orderstatus = 'P' OR o_orderkey % 7 = 0)
        SELECT column_name, CAST(sum(count(*)) OVER (PARTITION BY column_name) AS BIGINT) AS lost_rows,
               text, count(*) AS rows
        FROM cells GROUP BY column_name, text""",
    "medallion_run": CUSTOMER_KPI.format(
        keys=month_keys("o_orderdate"),
        fk="o_custkey",
        attributes="upper(c_name) AS nombre, upper(c_mktsegment) AS segmento",
        where="",
        sums=SUMS,
        ranked=ranked("fk_cliente"),
    ),
    "medallion_kpis": f"""
        WITH lines AS (
            SELECT {month_keys("o_orderdate")}, o_custkey, l_partkey, l_quantity,
                   CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON c_custkey = o_custkey),
        parts AS (
            SELECT 'periodo' AS kpi, anio, periodo_yyyymm, CAST(NULL AS BIGINT) AS clave, {SUMS},
                   NULL AS units FROM lines GROUP BY ALL
            UNION ALL
            SELECT 'cliente', anio, periodo_yyyymm, o_custkey, {SUMS}, NULL FROM lines GROUP BY ALL
            UNION ALL
            SELECT 'producto', anio, periodo_yyyymm, l_partkey, {SUMS}, sum(l_quantity)
            FROM lines JOIN part ON p_partkey = l_partkey GROUP BY ALL),
        keyed AS (
            SELECT *, sum(CAST(total_ventas AS DECIMAL(18, 2))) OVER (PARTITION BY kpi, clave) AS whole
            FROM parts)
        SELECT kpi, periodo_yyyymm, total_ventas, cantidad_transacciones, ticket_promedio, clave,
               CASE WHEN kpi <> 'periodo' THEN CAST(dense_rank() OVER (
                   PARTITION BY kpi, periodo_yyyymm ORDER BY total_ventas DESC) AS INTEGER) END AS ranking_mes,
               CASE WHEN kpi <> 'periodo' THEN CAST(dense_rank() OVER (
                   PARTITION BY kpi ORDER BY whole DESC) AS INTEGER) END AS ranking_global,
               CASE WHEN kpi = 'producto' THEN {two("total_ventas / CAST(sum(CAST(total_ventas AS DECIMAL(18, 2))) "
                   "OVER (PARTITION BY kpi, periodo_yyyymm) AS DOUBLE) * 100")} END AS participacion_mes_pct,
               CASE WHEN kpi = 'periodo' THEN CAST(sum(CAST(total_ventas AS DECIMAL(18, 2))) OVER (
                   PARTITION BY kpi, anio, clave IS NULL ORDER BY periodo_yyyymm
                   ROWS UNBOUNDED PRECEDING) AS DOUBLE) END AS acumulado_anual,
               CAST(units AS DOUBLE) AS cantidad_unidades
        FROM keyed""",
    "bronze_log": """
        WITH runs AS (SELECT unnest([1, 2]) AS run),
        sizes AS (SELECT 'regiones' AS name, count(*) AS n FROM region
                  UNION ALL SELECT 'paises', count(*) FROM nation
                  UNION ALL SELECT 'clientes', count(*) FROM customer)
        SELECT '1' AS file_id, name || '.xlsx' AS file_name, 'Hoja' AS sheet_name,
               name || '__hoja' AS target_table,
               CASE WHEN run = 1 OR name = 'clientes' THEN n ELSE 0 END AS rows_loaded,
               CASE WHEN run = 1 OR name = 'clientes' THEN 'SUCCESS' ELSE 'SKIPPED' END AS status,
               'dev' AS env
        FROM sizes, runs
        UNION ALL SELECT '1', 'regiones.xlsx', 'Hoja', 'regiones__hoja', 0, 'SKIPPED', 'dev' FROM runs
        UNION ALL SELECT '2', 'regiones-b.xlsx', 'Hoja', 'regiones__hoja', 0, 'ERROR', 'dev' FROM runs
        UNION ALL SELECT '3', 'roto.xlsx', 'Hoja', 'roto__hoja', 0, 'ERROR', 'dev' FROM runs""",
}
