"""How well the keys of the sales match a dimension."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import canonical_key


def _keys(df: DataFrame, name: str) -> DataFrame:
    key = canonical_key(F.col(f"`{name}`"), df.schema[name].dataType)
    return df.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))


def key_coverage(fact: DataFrame, fk: str, dim: DataFrame, nk: str) -> DataFrame:
    """One row: rows and distinct keys of the fact, and how many find no partner.
    Both sides are counted per key before they are joined."""
    known = _keys(dim, nk).where(F.col("_key").isNotNull()).select("_key", F.lit(True).alias("_known"))
    met = _keys(fact, fk).join(known, "_key", "left").withColumn(
        "_lost", F.col("_known").isNull()
    )
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("_rows"))), F.lit(0))
    return met.agg(
        total(F.lit(True)).alias("rows"),
        total(F.col("_key").isNull()).alias("rows_without_key"),
        total(F.col("_lost")).alias("unmatched_rows"),
        F.count("_key").alias("distinct_keys"),
        F.count_if(F.col("_lost") & F.col("_key").isNotNull()).alias("unmatched_keys"),
    )


def key_sample(df: DataFrame, name: str, size: int = 5) -> DataFrame:
    """The first few distinct keys, to look at."""
    key = F.col(f"`{name}`")
    return df.where(key.isNotNull()).select(key.alias("key")).distinct().orderBy("key").limit(size)
