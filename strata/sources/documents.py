"""JSON documents of a landed path as records."""

import logging
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.mixed import as_table, mixed_records, read_texts
from strata.sources.records import SourceRecord

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = True
) -> DataFrame:
    """Parsed documents: an object is a row, a list is a row per object. One file is
    one document, or with ``multi_line=False`` each line is one. A schema saves the
    pass that infers it."""
    reader = spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if schema:
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        reader = reader.schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())]))
    return reader.json(path)


def _checked_list(key: str) -> Column:
    """The list under the key; a document without one fails the job."""
    missing = F.raise_error(F.lit(f"data_key '{key}' not found in a document"))
    value = F.col(f"`{key}`")
    return F.when(value.isNotNull(), value).otherwise(missing)


def records(documents: DataFrame, data_key: str | None = None) -> DataFrame:
    """The records of parsed documents: the rows themselves, or the list under
    ``data_key`` of each."""
    keys = [c for c in documents.columns if c != CORRUPT]
    if CORRUPT in documents.columns:
        if not keys:
            raise ValueError("the documents are neither objects nor lists of objects")
        broken = F.col(CORRUPT).isNotNull()
        error = F.raise_error(F.concat(F.lit("invalid JSON: "), F.substring(CORRUPT, 1, 80)))
        first = F.when(broken, error).otherwise(F.col(f"`{keys[0]}`"))
        documents = documents.withColumn(keys[0], first).drop(CORRUPT)
    if not data_key:
        return documents
    if data_key not in keys:
        raise ValueError(f"data_key '{data_key}' not found; the keys are {keys}")
    kind = documents.schema[data_key].dataType
    if not isinstance(kind, T.ArrayType):
        raise ValueError(f"'{data_key}' holds no list of records but {kind.simpleString()}")
    if isinstance(kind.elementType, T.StructType):
        return documents.select(F.inline(_checked_list(data_key)))
    return documents.select(F.explode(_checked_list(data_key)).alias("0"))


@dataclass(frozen=True)
class JsonDocuments:
    """Endpoints given as ``path``, ``table_name`` and, where the list of records
    lies under a key, ``data_key``; also ``schema`` and ``multi_line``. With ``mixed`` the
    documents may have any form: those without records are counted in the log, and the
    fields of the others are text."""

    spark: SparkSession
    endpoints: Sequence[dict]
    source_type: str = "json_documents"

    def extract(self) -> Iterator[SourceRecord]:
        for endpoint in self.endpoints:
            path, table_name = endpoint.get("path"), endpoint.get("table_name")
            if not path or not table_name:
                log.warning("endpoint without path or table_name left out: %s", endpoint)
                continue
            try:
                df = self._records(endpoint)
                empty = not df.columns or df.isEmpty()
            except Exception as error:
                log.error("%s skipped: %s", path, error)
                continue
            if empty:
                log.warning("%s holds no records", path)
                continue
            yield SourceRecord(
                df=df, source_name=path, table_name=table_name, source_id=path
            )

    def _records(self, endpoint: dict) -> DataFrame:
        path, key, multi_line = endpoint["path"], endpoint.get("data_key"), endpoint.get("multi_line", True)
        if not endpoint.get("mixed"):
            return records(read_documents(self.spark, path, endpoint.get("schema"), multi_line), key)
        found = mixed_records(read_texts(self.spark, path, multi_line), key)
        failed = found.where("error IS NOT NULL").count()
        if failed:
            log.warning("%s: %d documents without records left out", path, failed)
        return as_table(found)
