"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the docs of the next. All but the last return the columns of
the documents, whatever these are; ``doc_id`` and ``text`` are needed.

Nulls and empty texts pass through: they are scored like an empty text, link with
nothing, repeat nothing, hold no benchmark item, and have null or no ids. Empty tables
give empty results. Of repeated rows one stays, in the second stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.decontaminate import decontaminate
from strata.llm.pieces import encode
from strata.llm.quality import fit_quality, keep_good
from strata.llm.shared import broadcast_if_small, kept, row_key
from strata.llm.shingle_join import shingle_join
from strata.llm.substring_dedup import remove_passages
from strata.session import fresh_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from two folds of three."""
    learn = F.crc32(F.col("_id").cast("string")) % 3 != 1
    return keep_good(docs, fit_quality(docs, _table(spark, sf_dir, "labels"), learn))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id."""
    marks = (
        shingle_join(docs)
        .groupBy("_id", "_hash")
        .agg(F.max("kept").alias("_stays"), (F.count("*") > 1).alias("_again"))
        .where("NOT _stays OR _again")
    )
    marks = kept(marks, "copies")
    gone = marks.where("NOT _stays").select("_id", "_hash")
    again = marks.where("_stays").select("_id", "_hash")
    rows = docs.select(F.struct("*").alias("_row"), *row_key("doc_id", "text"))
    once = rows
    for left in (gone, again):
        once = _matching(once, left, "left_anti")
    more = _matching(rows, again, "left_semi")
    first = more.groupBy("_id", "_hash").agg(F.any_value("_row").alias("_row"))
    return once.select("_row.*").union(first.select("_row.*"))


def _matching(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    a, b = rows.alias("a"), broadcast_if_small(keys, keys.count()).alias("b")
    same = F.col("a._id").eqNullSafe(F.col("b._id")) & F.col("a._hash").eqNullSafe(F.col("b._hash"))
    return a.join(b, same, how)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that repeat those of earlier ones."""
    rest = remove_passages(docs).drop("_spans", "_removed")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rest = rest.withColumn("n_chars", F.length("text").cast(kind))
    return rest


def drop_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    hits = decontaminate(docs, _table(spark, sf_dir, "benchmark")).where("n_hit > 0")
    hits = kept(hits.select("_id", "_text").distinct(), "contaminated")
    a = docs.alias("a")
    b = broadcast_if_small(hits, hits.count()).alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b._id")) & (F.md5("a.text") == F.col("b._text"))
    return a.join(b, same, "left_anti")


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    return encode(docs.select("doc_id", "text"), verify=True).select(
        "doc_id",
        F.col("_ids").alias("ids"),
        F.size("_ids").cast("bigint").alias("n_tokens"),
        F.col("_exact").alias("round_trip"),
    )


STAGES = [
    ("quality", keep_quality),
    ("near_copies", keep_distinct),
    ("passages", drop_passages),
    ("benchmarks", drop_benchmarks),
    ("token_ids", to_ids),
]

# A fitted model and signatures are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
