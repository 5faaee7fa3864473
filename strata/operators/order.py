"""Row numbers and dense ranks that no single task has to hold."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import written

# A task numbers its rows in the low 33 bits of the id, its own number is above.
TASK_SHIFT = 33
ROW_MASK = (1 << TASK_SHIFT) - 1



def _positions(rows: DataFrame, slot: str, name: str) -> DataFrame:
    """Written rows with their place 1..n from ``slot``, the number each task gave."""
    task = F.shiftrightunsigned(slot, TASK_SHIFT)
    counts = rows.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per task of the written step.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    position = F.col("_start") + F.col(slot).bitwiseAND(F.lit(ROW_MASK)) + 1
    columns = [F.col(f"`{c}`") for c in rows.columns if c != slot]
    return rows.join(F.broadcast(starts), task == F.col("_task")).select(
        position.alias(name), F.col(slot), *columns
    )


def add_row_number(df: DataFrame, name: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Put 1..n in front: in arrival order, or sorted with ties in arrival order.

    Each task numbers its own rows and the result is written once, so a retry cannot
    renumber. One count per task then gives each task its start. A sort moves only its
    keys and the arrival numbers, which spread copies of a key over tasks; the numbers
    then join the written rows.
    """
    number = F.monotonically_increasing_id()
    rows = written(df.withColumn("_slot", number), "numbered")
    columns = [F.col(f"`{c}`") for c in df.columns]
    if not order_by:
        return _positions(rows, "_slot", name).select(name, *columns)
    keys = rows.select("_slot", *order_by).orderBy(*order_by, "_slot").select("_slot")
    places = written(keys.withColumn("_place", number), "sorted")
    places = _positions(places, "_place", name).select("_slot", name)
    return rows.join(places, "_slot").select(name, *columns)


def dense_ranks(df: DataFrame, groups: Sequence[str], value: str, name: str) -> DataFrame:
    """One row per group and distinct value, ranked from the largest.

    The distinct values are sorted by group and value, which deals a large group out
    over tasks, and numbered; a rank is the distance from the group's first number. Rows
    without a group or value have no rank.
    """
    distinct = df.select(*groups, value).dropna().distinct()
    rows = distinct.orderBy(*groups, F.desc(value))
    rows = written(rows.withColumn("_slot", F.monotonically_increasing_id()), "ranked")
    numbered = _positions(rows, "_slot", "_number").drop("_slot")
    if not groups:
        return numbered.select(value, F.col("_number").cast("int").alias(name))
    first = numbered.groupBy(*groups).agg(F.min("_number").alias("_first"))
    rank = (F.col("_number") - F.col("_first") + 1).cast("int")
    return numbered.join(first, list(groups)).select(*groups, value, rank.alias(name))


def add_dense_rank(df: DataFrame, groups: Sequence[str], value: str, name: str) -> DataFrame:
    """Rank each row's value within its group, largest first. All rows stay; those without
    a group or value have no rank."""
    ranks = dense_ranks(df, groups, value, name)
    return df.join(ranks, [*groups, value], "left").select(*df.columns, name)


# Ranges of values that the rows of a group are cut into at most.
SLICES = 64


def sorted_ranks(
    df: DataFrame, group: str, value: str, name: str, ties: str, values: DataFrame | None = None
) -> DataFrame:
    """Rank each row's number within its group as ``add_dense_rank`` does; the rows come
    sorted by group, rank and ``ties``, and are moved once. Of groups there are a few, as
    months.

    Quantiles cut a group into slices of values, and a value that many rows share is a slice
    of its own. The distinct values of a slice are counted without the other columns. The
    rows are then dealt by slice in order, and ranked within it, on from those before. Rows
    of a slice with one value, or without a value, need no others, so ``ties`` spreads them.
    ``values`` may give the groups and values of the rows, where reading these costs less.
    """
    values = (df if values is None else values).select(group, value).dropna()
    cuts = values.groupBy(group)
    shares = [i / SLICES for i in range(1, SLICES)]
    cuts = cuts.agg(F.array_distinct(F.percentile_approx(value, shares, 1000)).alias("_cuts"))
    cuts = written(cuts, "cuts")
    v = F.col(value)
    above = F.size(F.filter("_cuts", lambda cut: cut > v))
    # Even between the cuts, odd on one.
    place = F.when(~F.isnan(v.cast("double")), above * 2 + F.array_contains("_cuts", v).cast("int"))

    def sliced(rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(cuts), group, "left").withColumn("_slice", place).drop("_cuts")

    counts = sliced(values.distinct()).groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_values"))
    before = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # At most twice SLICES rows per group.
    counts = written(
        counts.withColumn("_before", F.coalesce(F.sum("_values").over(before), F.lit(0))), "slices"
    )
    alone = F.coalesce(F.col("_values") == 1, F.lit(True))
    rows = sliced(df).join(F.broadcast(counts), [group, "_slice"], "left")
    rows = rows.withColumn("_alone", F.when(alone, F.col(ties)))
    slices = [group, "_slice", "_alone"]
    rows = rows.repartitionByRange(*slices).sortWithinPartitions(*slices, F.desc(value), ties)
    down = Window.partitionBy(*slices).orderBy(F.desc(value))
    rows = rows.withColumn("_new", (~F.lag(value).over(down).eqNullSafe(v)).cast("int"))
    rank = F.sum("_new").over(down.rowsBetween(Window.unboundedPreceding, 0))
    known = F.col("_values").isNotNull()
    rows = rows.withColumn(name, F.when(known, (F.col("_before") + rank).cast("int")))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], name)
