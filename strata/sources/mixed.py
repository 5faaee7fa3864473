"""JSON documents of any form as records, parsed once and without a common schema."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_texts(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``source`` and ``document``: each file, or with ``multi_line=False`` each line that
    is not blank."""
    rows = spark.read.text(path, wholetext=multi_line)
    rows = rows.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("document"))
    return rows if multi_line else rows.where(F.trim("document") != "")


def _member(value: Column) -> Column:
    """An element of a list: the fields of an object, else the value under the name 0."""
    single = F.create_map(F.lit("0"), value.try_cast("string"))
    return F.coalesce(value.try_cast("map<string,string>"), single)


def mixed_records(documents: DataFrame, data_key: str | None = None, document: str = "document") -> DataFrame:
    """The other columns of ``documents``, and for each record ``position`` (from 0) and
    ``record``, its fields as text, or for a document that holds none ``error``.

    A list has a record per element, an object is one record, or with ``data_key`` has the
    elements of the list under that key. Errors are texts that are no JSON, null and empty
    documents, scalars, and with ``data_key`` whatever is no object with a list under it.
    An empty list has no row. Texts are parsed once, as variants, whatever their forms."""
    others = [F.col(f"`{c}`") for c in documents.columns if c != document]
    text = F.col(f"`{document}`")
    parsed = documents.select(*others, text.alias("_text"), F.try_parse_json(text).alias("_value"))
    fields = F.col("_value").try_cast("map<string,variant>")
    if data_key is None:
        one = F.when(fields.isNotNull(), F.array("_value"))
        members = F.coalesce(F.col("_value").try_cast("array<variant>"), one)
        other = F.lit("neither an object nor a list")
    else:
        under = F.try_element_at(fields, F.lit(data_key))
        members = under.try_cast("array<variant>")
        keys = F.array_join(F.array_sort(F.map_keys(fields)), ", ")
        missing = F.concat(F.lit(f"data_key '{data_key}' not found; the keys are "), keys)
        other = (
            F.when(fields.isNull(), f"no object with data_key '{data_key}'")
            .when(under.isNull() | F.is_variant_null(under), missing)
            .otherwise(f"'{data_key}' holds no list")
        )
    blank = F.col("_text").isNull() | (F.trim("_text") == "")
    broken = F.concat(F.lit("invalid JSON: "), F.substring("_text", 1, 80))
    error = F.when(blank, "empty document").when(F.col("_value").isNull(), broken).otherwise(other)
    listed = parsed.select(*others, members.alias("_members"), error.alias("_error"))
    failed = F.col("_members").isNull()
    # One element that is null stands for a document that failed.
    either = F.when(failed, F.array(F.lit(None).cast("variant"))).otherwise(F.col("_members"))
    return listed.select(
        *others, F.posexplode(either).alias("_at", "_member"), failed.alias("_failed"), "_error"
    ).select(
        *others,
        F.when(~F.col("_failed"), F.col("_at")).alias("position"),
        F.when(~F.col("_failed"), _member(F.col("_member"))).alias("record"),
        F.when(F.col("_failed"), F.col("_error")).alias("error"),
    )


def field_names(records: DataFrame) -> list[str]:
    """Names of the fields of all records, sorted; as many as the table has columns."""
    names = records.select(F.explode(F.map_keys("record")).alias("name")).distinct()
    return sorted(r["name"] for r in names.collect())


def as_table(records: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The records as text columns, one per field; documents that failed are left out."""
    names = field_names(records) if names is None else names
    rows = records.where("error IS NULL")
    return rows.select(*[F.try_element_at("record", F.lit(n)).alias(n) for n in names])
