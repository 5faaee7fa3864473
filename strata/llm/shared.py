"""Steps that several operators need: written results, checked broadcasts, row keys."""

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strata
from strata.session import fresh_path

# The code of the workers travels with the job.
cloudpickle.register_pickle_by_value(strata)

# Rows of the largest side that is broadcast, of a few words each (some 50 MB).
BROADCAST_ROWS = 400_000

# The same for rows of one number each.
NUMBERS = 1_000_000

# Rows that cross to Python at once. Texts have no bound, so few of them.
BATCH_ROWS = 500


def session(df: DataFrame) -> SparkSession:
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def kept_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write rows once to the shared folder and read them from there, so that neither
    later steps nor retries run the plan before them again. Also where they are."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def kept(df: DataFrame, label: str) -> DataFrame:
    return kept_at(df, label)[0]


def remove(spark: SparkSession, *paths: str) -> None:
    """Drop written rows that nothing reads any more: later steps are written too."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Ask for a broadcast only of a counted side; a larger one is shuffled."""
    return F.broadcast(df) if rows <= limit else df.hint("merge")


def row_key(doc_id: str, text: str) -> list[Column]:
    """Names a document row by id and text, so that a repeated or missing id does not
    mix up texts. Rows equal in both have equal results."""
    texts = F.col(f"`{text}`")
    return [F.col(f"`{doc_id}`").alias("_id"), F.xxhash64(texts, F.length(texts)).alias("_hash")]


def parts(rows: int, per_part: int, least: int = 1, most: int = 100_000) -> int:
    return max(least, min(most, math.ceil(rows / per_part)))


def grouped(
    batches: Iterator[pa.RecordBatch], keys: list[str], limit: int = 1 << 40
) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted batches, each as one table."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns))
        begin = 0
        for i, row in enumerate(rows):
            if row != last:
                if i > begin:
                    held.append(batch.slice(begin, i - begin))
                if held:
                    yield pa.Table.from_batches(held)
                held, begin, last = [], i, row
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


