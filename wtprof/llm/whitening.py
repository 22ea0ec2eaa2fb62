"""Whitening of integer-coded embeddings with Spark MLlib's BlockMatrix.

A component c of a vector becomes the integer x = floor(64 c) + 1 000 000. The
fit list is each distinct x vector once. Its rows are centred (the mean is
taken off as an exact integer and a fraction below one, so the large offset
costs no digits), indexed and cut into a distributed ``BlockMatrix`` A; the
scatter is A' A, the one d x d matrix that comes to the driver, where ``eigh``
gives components and the whitening matrix W. The centred rows of the whole
table are a second BlockMatrix, and its product with W is the result.

Sums, counts and deviations are exact. A carries a column of ones beside the
dimensions, so A' A also holds what rounding left of the column means, which
is taken off every covariance.

``BlockMatrix.multiply`` sends all blocks that meet in one block of the
product to one task. For A' A this is every row, so the product is split along
the rows (the argument ``numMidDimSplits``) and the parts are summed.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wtprof.llm.common import numbered, shuffle_width, written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 4096       # rows of a block: 2 MB at 64 dimensions
BLOCK_COLUMNS = 1024
NO_VARIANCE = 1e-12     # an eigenvalue below this share of the largest is zero to double precision
EXACT = float(1 << 53)  # integers below are exact as doubles


def usable(v: Column) -> Column:
    """Has the vector (array<double>) finite, non-null entries only, whose
    integer codes a double holds exactly?"""
    return v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= EXACT / SCALE / 2))


def codes(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of the rows whose vectors take part; x is array<long>."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    x = F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(OFFSET).cast("long"))
    return rows.where(usable(F.col("v"))).select("id", x.alias("x"))


def _centred(n: int, sums: list[int]) -> tuple[Column, Column]:
    """(x - S/n, n x - S): doubles, and exact longs (null where they don't fit)."""
    whole, rest = [s // n for s in sums], [s % n for s in sums]
    off = F.zip_with("x", F.lit(np.array(whole, np.int64)), lambda x, q: x - q)
    double = F.zip_with(off, F.lit(np.array([r / n for r in rest])), lambda d, r: d.cast("double") - r)
    exact = F.zip_with(off, F.lit(np.array(rest, np.int64)),
                       lambda d, r: F.try_subtract(F.try_multiply(d, F.lit(n).cast("long")), r))
    return double, exact


def _block_matrix(df: DataFrame, rows: int, columns: int) -> BlockMatrix:
    """Distributed blocks of the rows (idx, a) of ``df``."""
    vectors = df.select(F.col("idx").cast("long").alias("index"), array_to_vector("a").alias("vector"))
    return (IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), rows, columns)
            .toBlockMatrix(BLOCK_ROWS, BLOCK_COLUMNS))


def _scatter(a: BlockMatrix, splits: int) -> np.ndarray:
    """A' A as a local matrix; ``splits`` tasks share the rows."""
    product = a.transpose()._java_matrix_wrapper.call("multiply", a._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, BLOCK_COLUMNS, BLOCK_COLUMNS).toLocalMatrix().toArray()


def _local_blocks(a: BlockMatrix, m: np.ndarray) -> BlockMatrix:
    """The small matrix ``m`` as a BlockMatrix that ``a`` can be multiplied by."""
    sc = a.blocks.context
    parts = [((i // BLOCK_COLUMNS, j // BLOCK_COLUMNS), m[i:i + BLOCK_COLUMNS, j:j + BLOCK_COLUMNS])
             for i in range(0, m.shape[0], BLOCK_COLUMNS) for j in range(0, m.shape[1], BLOCK_COLUMNS)]
    blocks = [(k, DenseMatrix(b.shape[0], b.shape[1], np.asfortranarray(b).ravel(order="F"))) for k, b in parts]
    return BlockMatrix(sc.parallelize(blocks, 1), BLOCK_COLUMNS, BLOCK_COLUMNS, m.shape[0], m.shape[1])


def _rows_of(m: BlockMatrix) -> DataFrame:
    """(index, vector) rows of a BlockMatrix, kept in the JVM."""
    rows = callMLlibFunc("getIndexedRows", m.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return MLUtils.convertVectorColumnsToML(rows, "vector")


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whiten the integer codes of all vectors.

    Returns one row for each remaining row of ``df`` and component (1 up to
    ``components``, by falling eigenvalue): id_col, component int, n long (size
    of the fit list), deviation long (sum over dimensions of (n x - S)^2),
    whitened double, explained double (share of the trace), identity_error
    double (the same in every row).

    Rows are dropped whose vector is null or holds null or non-finite entries,
    or entries from 2^46 on, whose codes a double does not hold exactly. A
    deviation that exceeds a long is null. Components without variance (an
    eigenvalue of zero to double precision) can't be whitened and are left
    out: equal vectors only, a single row or empty vectors give no rows. Ties
    between eigenvalues leave the order of their components to ``eigh``, alike
    for all rows. Vectors of another length are fitted on their own. Repeated
    rows and null ids give rows of their own. An empty table gives an empty
    result; other columns are ignored.
    """
    spark = df.sparkSession
    rows = written(codes(df, id_col, vector_col), "codes")
    out = None
    for width, in sorted(rows.select(F.size("x")).distinct().collect()):  # few widths
        part = _whiten_width(rows.where(F.size("x") == width), width, components) if width else None
        if part is not None:
            out = part if out is None else out.union(part)
    if out is None:
        id_type = rows.schema["id"].dataType.simpleString()
        out = spark.createDataFrame([], f"id {id_type}, component int, n long, deviation long, whitened double, "
                                        "explained double, identity_error double")
    return out.withColumnRenamed("id", id_col)


def _whiten_width(rows: DataFrame, width: int, components: int) -> DataFrame | None:
    spark = rows.sparkSession
    fit = numbered(rows.select("x").distinct(), "fit")
    n = fit.count()
    entry = fit.select(F.posexplode("x").alias("d", "x")).groupBy("d").agg(F.sum(F.col("x").cast("decimal(19,0)")).alias("s"))
    sums = [int(s) for _, s in sorted(entry.collect())]  # one row a dimension
    double, exact = _centred(n, sums)
    splits = max(1, min(-(-n // BLOCK_ROWS), shuffle_width(spark)))

    # the last column is one for every row of the fit list
    a = _block_matrix(fit.select("idx", F.concat(double, F.array(F.lit(1.0))).alias("a")), n, width + 1)
    both = _scatter(a, splits)
    left = both[:width, width] / n
    cov = both[:width, :width] / n - np.outer(left, left)
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = int(np.count_nonzero(values[:components] > NO_VARIANCE * max(values[0], 0.0)))
    if not keep or values[0] <= 0:
        return None
    w = vectors[:, :keep] / np.sqrt(values[:keep])

    z = a.multiply(_local_blocks(a, np.vstack([w, -left @ w])))  # the mean's rest off: centred before multiplying
    error = float(np.abs(_scatter(z, splits) / n - np.eye(keep)).max())

    every = numbered(rows, "rows")
    r = _block_matrix(every.select("idx", double.alias("a")), every.count(), width)
    projected = _rows_of(r.multiply(_local_blocks(r, w))).select(F.col("index").alias("idx"), vector_to_array("vector").alias("z"))
    square = F.aggregate(exact, F.lit(0).cast("long"), lambda s, e: F.try_add(s, F.try_multiply(e, e)))
    shares = F.lit(values[:keep] / values.sum())
    return (every.select("id", "idx", square.alias("deviation")).join(projected, "idx")
            .select("id", "deviation", F.posexplode("z").alias("k", "whitened"))
            .select("id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", F.get(shares, F.col("k")).alias("explained"), F.lit(error).alias("identity_error")))
