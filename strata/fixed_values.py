"""Values that results depend on and that must not change."""

# Calendar names.
MONTHS = [
    "ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO",
    "JULIO", "AGOSTO", "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE",
]
ENGLISH_MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
WEEKDAYS = [
    "LUNES", "MARTES", "MIÉRCOLES", "JUEVES", "VIERNES", "SÁBADO", "DOMINGO",
]
QUARTERS = [
    "PRIMER TRIMESTRE", "SEGUNDO TRIMESTRE", "TERCER TRIMESTRE", "CUARTO TRIMESTRE",
]
FIRST_YEAR = 2024

# Audit columns.
SOURCE_FILE = "_source_file"
SOURCE_SHEET = "_source_sheet"
INGESTED_AT = "_ingested_at"
BRONZE_AUDIT = [SOURCE_FILE, SOURCE_SHEET, INGESTED_AT]
STAGED_AT = "_stg_loaded_at"
SILVER_AT = "_silver_loaded_at"
GOLD_AT = "_gold_loaded_at"

# Texts read as missing.
NULL_TEXTS = ["NAN", "NONE", ""]
NULL_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Blanks that stripping removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Column names by role, first match wins.
CUSTOMER_KEYS = ["id_cliente", "cliente_id", "id", "codigo_cliente", "idcliente"]
PRODUCT_KEYS = ["id_producto", "producto_id", "id", "codigo_producto", "idproducto"]
SALE_CUSTOMER = ["id_cliente", "idcliente", "cliente_id", "id_cli"]
SALE_PRODUCT = ["id_producto", "idproducto", "producto_id", "id_prod"]
SALE_DATE = ["fecha", "fecha_venta", "date", "fecha_factura"]
AMOUNT = ["total", "monto", "valor", "venta", "importe", "precio_total"]
QUANTITY = ["cantidad", "units", "qty", "cantidad_vendida"]

# Load rules, in order: kind of match, text, staging table, id column.
LOAD_RULES = [
    ("contains", "clientes", "stg_clientes_nuevos", None),
    ("contains", "productos", "stg_productos_nuevos", None),
    ("contains", "ventas", "stg_ventas_nuevos", "idventa"),
    ("equals", "api_paises", "stg_api_paises", None),
    ("equals", "api_posts", "stg_api_posts", None),
]
ALWAYS_LOADED = ["clientes", "productos", "ventas"]
LONGEST_TABLE_NAME = 63

# Bronze tables read by silver: name, other name, search word.
BRONZE_TABLES = {
    "clientes": (
        "ejercicio_sesion_7_clientes__ejercicio_sesion_7_clientes",
        "ejercicio_sesion_7_clientes__sheet1",
    ),
    "productos": (
        "ejercicio_sesion_7_productos__ejercicio_sesion_7_productos",
        "ejercicio_sesion_7_productos__sheet1",
    ),
    "ventas": (
        "ejercicio_sesion_7_ventas__ejercicio_sesion_7_ventas",
        "ejercicio_sesion_7_ventas__sheet1",
    ),
}

# Workbook file types.
WORKBOOK_TYPES = {
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xls": "application/vnd.ms-excel",
}
