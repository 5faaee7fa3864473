"""Whitening of vectors: principal components of the distinct ones, by distributed blocks.

Vectors become whole numbers, are centred and dealt as numbered rows into a BlockMatrix.
Its transpose times itself is the scatter, a few numbers that the driver takes apart; the
rows times the whitening matrix are the projections.
"""

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import kept
from strata.operators.order import add_row_number

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 1024  # at least
BLOCKS = 50_000  # at most, as the driver deals them by their numbers
BLOCK_COLUMNS = 1024
TOGETHER = 8  # row blocks whose products one task sums


def whole_numbers(vector: str) -> Column:
    """Each entry c as floor(256 c). Null if the vector is null, holds a null or non-finite
    entry, or one whose number would not be a bigint."""
    entries = F.col(f"`{vector}`").cast("array<double>")
    most = 2.0**63 / SCALE

    def bad(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) >= most)

    numbers = F.transform(entries, lambda c: F.floor(c * SCALE).cast("bigint"))
    return F.when(~F.exists(entries, bad), numbers)


@dataclass(frozen=True)
class Whitening:
    """What whitens: the number of distinct vectors, their sums, the components as rows, by
    falling eigenvalue, these, and the trace of the covariance. Eigenvalues that rounding
    alone may make are 0."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def matrix(self) -> np.ndarray:
        """Whitens centred rows; a component without variance gives zeros."""
        scale = [1 / math.sqrt(e) if e > 0 else 0.0 for e in self.values.tolist()]
        return self.components.T * np.array(scale)


def _blocks(rows: DataFrame, n: int, sums: list[int], last: int) -> BlockMatrix:
    """``_row``, up to ``last``, and ``_x`` as blocks of centred rows."""
    centre = F.array(*[F.lit(s / n) for s in sums])
    centred = F.zip_with("_x", centre, lambda x, mean: x.cast("double") - mean)
    indexed = rows.select((F.col("_row") - 1).alias("index"), array_to_vector(centred).alias("vector"))
    indexed = MLUtils.convertVectorColumnsFromML(indexed, "vector")
    matrix = IndexedRowMatrix(indexed, last, len(sums))
    return matrix.toBlockMatrix(max(BLOCK_ROWS, -(-last // BLOCKS)), BLOCK_COLUMNS)


def _product(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """a b. Blocks along their common side are dealt over ``splits`` tasks for each block
    of the result, and summed after that, so that no task gets all of them."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def _scatter(blocks: BlockMatrix) -> np.ndarray:
    many = -(-blocks.numRows() // blocks.rowsPerBlock)
    return _product(blocks.transpose(), blocks, -(-many // TOGETHER)).toLocalMatrix().toArray()


def _projected(rows: DataFrame, blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """``_row`` and ``_w``, each row times ``matrix``."""
    d, k = matrix.shape
    parts = []
    for i, low in enumerate(range(0, d, BLOCK_COLUMNS)):
        part = matrix[low : low + BLOCK_COLUMNS]
        parts.append(((i, 0), DenseMatrix(len(part), k, part.ravel(order="F"))))
    side = BlockMatrix(rows.sparkSession.sparkContext.parallelize(parts, 1), BLOCK_COLUMNS, k, d, k)
    done = _product(blocks, side).toIndexedRowMatrix()
    indexed = callMLlibFunc("getIndexedRows", done._java_matrix_wrapper._java_model)
    return indexed.select((F.col("index") + 1).alias("_row"), vector_to_array("vector").alias("_w"))


def _components(scatter: np.ndarray, n: int, sums: list[int], most: int) -> Whitening:
    covariance = (scatter + scatter.T) / 2 / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:most]
    noise = len(values) * np.finfo(float).eps * max(values.max(initial=0), 0)
    found = np.where(values[order] > noise, values[order], 0.0)
    return Whitening(n, sums, vectors[:, order].T, found, float(np.trace(covariance)))


def _deviation(n: int, sums: list[int]) -> Column:
    """Sum over dimensions of (n x - S)^2, exact; null if it is no bigint."""
    whole = F.array(*[F.lit(str(s)).cast("decimal(38,0)") for s in sums])
    many = F.lit(str(n)).cast("decimal(19,0)")
    apart = F.zip_with(
        "_x", whole, lambda x, s: (x.cast("decimal(19,0)") * many - s).try_cast("bigint")
    )
    return F.aggregate(
        apart, F.lit(0).cast("bigint"), lambda total, a: F.try_add(total, F.try_multiply(a, a))
    )


def whiten(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """``_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and
    ``identity_error`` of every usable row and each of the first components.

    Entries c count as x = floor(256 c). The components are unit eigenvectors of the
    covariance of the ``n`` distinct vectors, so copies weigh nothing. ``whitened`` is the
    centred row's part along a component over the root of its eigenvalue, ``explained`` the
    eigenvalue's share of the variance, ``deviation`` the squared distance of n x from the
    sums, null if it passes 64 bits. ``identity_error`` is the largest entry of the
    covariance of what is whitened less the identity, over components with variance.

    Rows whose vector is null or holds a null or non-finite entry, or one of 2^55 or more,
    are left out, and so are vectors whose length is not the most frequent one (of equally
    frequent ones the longest). A component without variance whitens to 0 and explains 0.
    There are as many components as dimensions, if these are fewer. Without usable rows or
    dimensions the result is empty. Repeated and missing ids keep their rows; other columns
    are not read.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").alias("_id"), whole_numbers(vector).alias("_x"))
    rows = add_row_number(rows.where("_x IS NOT NULL"), "_row")
    sizes = rows.groupBy(F.size("_x").alias("d")).agg(F.count("*").alias("rows"), F.max("_row").alias("last"))
    common = sizes.orderBy(F.desc("rows"), F.desc("d")).first()
    kind = rows.schema["_id"].dataType.simpleString()
    if common is None or not common["d"]:
        empty = (
            f"_id {kind}, component int, n bigint, deviation bigint, whitened double, "
            "explained double, identity_error double"
        )
        return vectors.sparkSession.createDataFrame([], empty)
    d, last = common["d"], common["last"]
    rows = rows.where(F.size("_x") == d)
    # One row of each vector; copies meet in partial aggregates first.
    once = kept(rows.groupBy("_x").agg(F.min("_row").alias("_row")), "distinct")
    sums = once.select(F.posexplode("_x").alias("place", "x")).groupBy("place")
    sums = sums.agg(F.sum(F.col("x").cast("decimal(19,0)")).alias("s"), F.count("*").alias("n")).collect()
    n = sums[0]["n"]
    sums = [int(r["s"]) for r in sorted(sums, key=lambda r: r["place"])]
    model = _components(_scatter(_blocks(once, n, sums, last)), n, sums, min(components, d))
    projected = kept(_projected(rows, _blocks(rows, n, sums, last), model.matrix()), "whitened")
    found = _result(rows.join(projected, "_row"), model)
    return found.withColumn("identity_error", F.lit(_identity_error(projected, once, model)))


def _identity_error(projected: DataFrame, once: DataFrame, model: Whitening) -> float:
    some = [i for i, e in enumerate(model.values.tolist()) if e > 0]
    pairs = [(i, j) for i in some for j in some if i <= j]
    if not pairs:
        return 0.0
    fit = projected.join(once.select("_row"), "_row", "left_semi")
    found = fit.agg(*[F.covar_pop(F.col("_w")[i], F.col("_w")[j]) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def _result(rows: DataFrame, model: Whitening) -> DataFrame:
    shares = [e / model.trace if model.trace > 0 else 0.0 for e in model.values.tolist()]
    each = [
        F.struct(F.lit(i + 1).alias("component"), F.col("_w")[i].alias("whitened"), F.lit(e).alias("explained"))
        for i, e in enumerate(shares)
    ]
    rows = rows.withColumn("deviation", _deviation(model.n, model.sums))
    return rows.select("_id", "deviation", F.explode(F.array(*each)).alias("c")).select(
        "_id", "c.component", F.lit(model.n).cast("bigint").alias("n"), "deviation", "c.whitened", "c.explained"
    )
