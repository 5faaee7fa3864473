"""Texts that typing turns into nulls: how many, and which most often."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalars import number, strip
from strata.operators.clean import column_profiles

# Distinct texts per column and task up to which the counts are exact.
TRACKED = 10_000
MOST = 10


def lost_sketches(df: DataFrame) -> DataFrame:
    """``column_name``, ``lost_rows`` and ``sketch`` of the lost texts, of each column that
    is typed as a number though some of its texts are none. Sketches of several loads can
    be kept and merged by ``lost_report``.

    All such columns are unpivoted in one scan, and each task sends one row per column.
    A table without rows or losses has no row."""
    spark = df.sparkSession
    # One row per column.
    numeric = [
        p.column_name
        for p in column_profiles(df).collect()
        if p.kind != "text" and p.value_count > p.number_count
    ]
    if numeric:
        texts = [
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("text"))
            for c in numeric
        ]
        cells = df.select(F.explode(F.array(*texts)).alias("cell")).select("cell.*")
    else:
        cells = spark.createDataFrame([], "column_name string, text string")
    lost = cells.where(F.col("text").isNotNull() & number(F.col("text"), T.StringType()).isNull())
    return lost.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("lost_rows"),
        F.call_function("approx_top_k_accumulate", strip(F.col("text")), F.lit(TRACKED)).alias("sketch"),
    )


def lost_report(sketches: DataFrame, top: int = MOST) -> DataFrame:
    """``column_name``, ``lost_rows`` and ``texts``, the ``top`` most frequent lost texts
    with their rows, from the sketches of one or more loads. ``lost_rows`` is exact; the
    rows of texts are, while a column has less than some 7,500 distinct ones. Of texts
    that are equally frequent at the end of the list any may be left out."""
    merged = sketches.groupBy("column_name").agg(
        F.sum("lost_rows").alias("lost_rows"),
        F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(TRACKED)).alias("sketch"),
    )
    found = F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(top))
    ordered = F.array_sort(
        F.transform(found, lambda x: F.struct((-x["count"]).alias("less"), x["item"].alias("text")))
    )
    texts = F.transform(
        ordered, lambda x: F.struct(x["text"].alias("text"), (-x["less"]).cast("bigint").alias("rows"))
    )
    return merged.select("column_name", "lost_rows", texts.alias("texts"))
