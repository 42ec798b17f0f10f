"""Whitening of vectors by distributed block matrices: scatter of centred rows, local eigenvectors, projected rows."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.llm.tables import stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
# Numbers in a block: 2 MB. Blocks that meet in one task of a multiplication.
BLOCK, TOGETHER = 1 << 18, 16
# Components of less than this part of all variance are noise of the arithmetic and left out.
_LEAST = 1e-12


def integer_vectors(
    df: DataFrame, scale: int = SCALE, shift: int = SHIFT, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """`id, x` of the rows whose vector is neither null nor empty and has only finite entries c: x = floor(scale * c) + shift,
    whole numbers. Entries whose x is beyond 2^61 count as not finite."""
    v = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.transform(v, lambda c: F.floor(c * F.lit(float(scale)))).alias("x"), v.alias("v"))
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0**61 / scale))
    return rows.filter(sound & (F.size("v") > 0)).select("id", F.transform("x", lambda c: c + F.lit(shift).cast("bigint")).alias("x"))


def _numbers(values: list[int]) -> Column:
    """A literal array of whole numbers, one small expression however many they are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _indexed(rows: DataFrame, width: int) -> DataFrame:
    """Adds `block` (numbered from 0 without gaps) and `at`, the row's place in it, by where rows stand in the table's parts."""
    tall = max(1, BLOCK // width)
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "rows")
    chunk = F.call_function("div", place, F.lit(tall))
    placed = placed.select(*rows.columns, part.alias("_part"), chunk.alias("_chunk"), (place % tall).cast("int").alias("at"))
    # a row for each part of the table
    blocks = placed.groupBy("_part").agg((F.max("_chunk") + 1).alias("_blocks"))
    before = F.sum("_blocks").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    joined = placed.join(starts, "_part")
    return stored(joined.select(*rows.columns, (F.col("_start") + F.col("_chunk")).cast("int").alias("block"), "at"), "indexed")


def _row_blocks(rows: DataFrame, column: str) -> DataFrame:
    """`block, numbers`: the rows of each block one after the other. A block has at most BLOCK numbers."""
    ordered = F.array_sort(F.collect_list(F.struct("at", F.col(column).alias("v"))))
    return rows.groupBy("block").agg(F.flatten(F.transform(ordered, lambda r: r["v"])).alias("numbers"))


def _block(width: int, across: int, row) -> tuple[tuple[int, int], DenseMatrix]:
    """A block at its place: row `block // across`, column `block % across` of the grid."""
    numbers = np.array(row["numbers"])
    return (row["block"] // across, row["block"] % across), DenseMatrix(len(numbers) // width, width, numbers, isTransposed=True)


def _matrix(rows: DataFrame, column: str, width: int, blocks: int, across: int) -> BlockMatrix:
    tall = max(1, BLOCK // width)
    made = _row_blocks(rows, column).rdd.map(partial(_block, width, across))
    return BlockMatrix(made, tall, width, -(-blocks // across) * tall, across * width)


def _multiplied(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """a x b, the inner dimension dealt to `splits` tasks (a choice that only the JVM's method offers)."""
    product = a._java_matrix_wrapper._java_model.multiply(b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def scatter(rows: DataFrame, column: str, width: int, blocks: int) -> np.ndarray:
    """Sum of the outer products of the rows (`block, at, <column>`): the transposed matrix times itself.

    The rows are one column of blocks; the products of TOGETHER blocks are added up in a task, and these by key.
    """
    tall = _matrix(rows, column, width, blocks, 1)
    return _multiplied(tall.transpose(), tall, -(-blocks // TOGETHER)).toLocalMatrix().toArray()


def _unfolded(across: int, width: int, item) -> Iterator[tuple[int, int, list[float]]]:
    (i, j), matrix = item
    for at, v in enumerate(matrix.toArray().reshape(-1, width).tolist()):
        yield i * across + j, at, v


def projected(rows: DataFrame, column: str, width: int, blocks: int, onto: np.ndarray) -> DataFrame:
    """`block, at, z`: the rows times the matrix `onto`.

    The blocks are laid out as a square grid, and `onto` stands on the diagonal of the other factor, so that every
    block meets it once and tasks get few blocks each, whatever the number of rows.
    """
    across = max(1, math.isqrt(blocks - 1) + 1)
    grid = _matrix(rows, column, width, blocks, across)
    few = onto.shape[1]
    # Of the grid's column blocks, by number the root of all blocks, each takes the same small factor.
    spark = rows.sparkSession
    diagonal = spark.sparkContext.parallelize(range(across)).map(lambda k: ((k, k), DenseMatrix(width, few, onto.ravel("F"))))
    factor = BlockMatrix(diagonal, width, few, across * width, across * few)
    made = _multiplied(grid, factor, 1).blocks.flatMap(partial(_unfolded, across, few))
    return spark.createDataFrame(made, "block int, at int, z array<double>")


def whitened_rows(
    vectors: DataFrame, components: int = COMPONENTS
) -> DataFrame:
    """`id, component, n, deviation, whitened, explained, identity_error` of `id, x` rows, x whole numbers.

    Rows are centred at the mean of all n rows and projected on the unit eigenvectors of their covariance (divisor n),
    by falling eigenvalue, over its root; `component` counts from 1 up to `components`. `explained` is the eigenvalue's
    share of the trace, `deviation` the sum over dimensions of (n * x - sum)^2, a decimal, exact (null beyond 38
    digits). `identity_error` is the largest entry by which the covariance of all `whitened` rows, computed from them,
    is off the identity. Sums are exact, of integers.

    Components without variance are left out: fewer dimensions, rows or different rows give fewer of them, and equal
    rows none. Rows of another length than most (the longest of equally frequent ones) are left out. Repeated rows and
    ids, and null ids, count and come out each. No rows: none.
    """
    spark = vectors.sparkSession
    schema = "id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    found = vectors.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if found is None:
        return spark.createDataFrame([], schema)
    width, n = found["width"], found["n"]
    rows = _indexed(vectors.filter(F.size("x") == width), width)
    blocks = rows.agg(F.max("block")).first()[0] + 1
    sums = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s"))
    total = [int(r["s"]) for r in sums.orderBy("i").collect()]  # a number for each dimension
    whole, rest = _numbers([s // n for s in total]), _numbers([s % n for s in total])
    # n * x - s = n * (x - whole) - rest, whose first part is exact in a long
    differ = F.zip_with("x", whole, lambda x, w: x - w)
    centred = F.zip_with(differ, rest, lambda u, r: u.cast("double") - r / F.lit(float(n)))
    number = "decimal(38,0)"
    exact = F.zip_with(differ, rest, lambda u, r: F.try_subtract(F.try_multiply(F.lit(n).cast("decimal(19,0)"), u.cast("decimal(19,0)")).cast(number), r.cast(number)))
    squares = F.transform(exact, lambda e: F.try_multiply(e, e).cast(number))
    deviation = F.aggregate(squares, F.lit(0).cast(number), lambda s, e: F.try_add(s, e).cast(number))
    rows = rows.select("id", "block", "at", centred.alias("centred"), deviation.alias("deviation"))

    covariance = scatter(rows, "centred", width, blocks) / n
    values, vectors_ = np.linalg.eigh((covariance + covariance.T) / 2)
    trace = float(np.trace(covariance))
    order = [k for k in np.argsort(-values, kind="stable")[:components] if values[k] > _LEAST * trace]
    if not order:
        return spark.createDataFrame([], schema)
    values, onto = values[order], vectors_[:, order] / np.sqrt(values[order])
    white = stored(projected(rows, "centred", width, blocks, onto), "white")
    off = scatter(white, "z", len(order), blocks) / n - np.eye(len(order))
    explained = F.element_at(F.array(*[F.lit(float(e / trace)) for e in values]), F.col("component"))
    joined = rows.select("id", "block", "at", "deviation").join(white, ["block", "at"])
    each = joined.select("id", "deviation", F.posexplode("z").alias("_k", "whitened")).withColumn("component", (F.col("_k") + 1).cast("int"))
    return each.select(
        "id", "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", explained.alias("explained"),
        F.lit(float(np.abs(off).max())).alias("identity_error"),
    )
