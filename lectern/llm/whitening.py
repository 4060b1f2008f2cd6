"""Whitening of embeddings by block Lanczos: the covariance is never formed, only applied to blocks of vectors.

Entries are held as whole numbers (``floor(64 c) + 1000000``), so sums, means and deviations are exact. The covariance is
that of the fit list, each different vector once. A pass over the fit list multiplies it with a block of vectors: every task
adds up ``x (x . v)`` over its centred rows, the sums of all tasks meet by dimension. What the driver holds is the basis: as many
columns as ``BASIS`` allows, of one entry for each dimension; it doesn't grow with the rows.

The basis is orthogonalised in full, twice, at each step. Directions in which a block brings nothing new (breakdown) restart
from random ones. When the basis is full it is cut down to its best Ritz vectors, and goes on from the same residual block.
It ends when the residuals of all wanted pairs are at rounding level and a pass over random directions finds no others, or the
basis spans the whole space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import bound_batches, read_table, tidy, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Columns of the basis at most; passes at most; largest residual, as a share of the largest eigenvalue.
BASIS, PASSES, RESIDUAL = 512, 400, 2e-14
#: Beyond this, an entry can't be held as a whole number exactly.
LARGEST = float(1 << 52)
#: Eigenvalues below this share of the largest one are rounding, not variance.
NO_VARIANCE = 1e-11


def fixed_point(df: DataFrame, vector: str) -> DataFrame:
    """The rows with ``x``, the vector as whole numbers.

    Rows whose vector is null, empty or of another length than most (ties: the shorter), or holds null or non-finite entries
    or such that 64 times them passes 2^52, are left out.
    """
    c = F.col(vector)
    bad = F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) * SCALE >= LARGEST))
    sound = df.where(c.isNotNull() & (F.size(c) > 0) & ~F.coalesce(bad, F.lit(False)))
    lengths = sound.groupBy(F.size(c).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dims = lengths[0].d if lengths else 0
    return sound.where(F.size(c) == dims).withColumn("x", F.transform(c, lambda e: F.floor(e.cast("double") * SCALE) + F.lit(SHIFT).cast("long")))


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _summed(fit: DataFrame, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum of a matrix over all batches of the fit list: each task sends one row of sums for each row of the matrix."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if len(batch):
                total += of(_matrix(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array(range(shape[0]), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "sums"])

    parts = fit.select("x").mapInArrow(run, "i int, sums array<double>")
    each = parts.select("i", F.posexplode("sums").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros(shape)
    for r in each.collect():  # rows and columns of the matrix, however many rows the table has
        out[r.i, r.j] = r.v
    return out


class Centre:
    """Exact mean of whole-number vectors: the quotient and remainder of each dimension's sum by n."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.quotient = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n; the whole part is taken off before anything is rounded."""
        return (x - self.quotient).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum of (n x - S)^2 over the dimensions of each row, exact."""
        off = x - self.quotient
        largest = (int(np.abs(off).max(initial=0)) + 1) * self.n
        kind = np.int64 if largest * largest * max(1, x.shape[1]) < 1 << 63 else object
        whole = off.astype(kind) * self.n - self.rest.astype(kind)
        return (whole * whole).sum(axis=1).tolist()


def _orthonormal(block: np.ndarray, basis: np.ndarray, least: float, rng: np.random.Generator, width: int) -> np.ndarray:
    """``width`` orthonormal columns orthogonal to the basis: those of the block that are longer than ``least``, and random ones where it breaks down."""
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    kept = u[:, s > least][:, :width]
    while kept.shape[1] < width:
        fresh = rng.standard_normal((block.shape[0], width - kept.shape[1]))
        kept = np.hstack([kept, fresh])
        for _ in range(2):
            kept -= basis @ (basis.T @ kept)
            kept, _ = np.linalg.qr(kept)
    for _ in range(2):
        kept -= basis @ (basis.T @ kept)
        kept, _ = np.linalg.qr(kept)
    return kept


def block_lanczos(apply: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, block: int | None = None, basis_limit: int = BASIS, passes: int = PASSES, seed: int = 1) -> tuple[np.ndarray, np.ndarray, dict]:
    """The largest eigenpairs of a symmetric operator that is only applied: values, vectors (columns), and what it took.

    Raises ArithmeticError if residuals haven't settled after ``passes`` applications.
    """
    wanted = min(wanted, dims)
    block = min(block or max(wanted, 1), dims)
    basis_limit = min(dims, max(basis_limit, wanted + 2 * block))
    rng = np.random.default_rng(seed)
    basis, images = np.zeros((dims, 0)), np.zeros((dims, 0))
    new, found = _orthonormal(rng.standard_normal((dims, block)), basis, 0.0, rng, block), None
    for taken in range(1, passes + 1):
        image = apply(new)
        basis, images = np.hstack([basis, new]), np.hstack([images, image])
        inner = basis.T @ images
        values, inside = np.linalg.eigh((inner + inner.T) / 2)
        values, inside = values[::-1], inside[:, ::-1]
        ritz, moved = basis @ inside[:, :wanted], images @ inside[:, :wanted]
        residual = float(np.linalg.norm(moved - ritz * values[:wanted], axis=0).max(initial=0.0))
        top = max(float(values[0]), 0.0)
        settled = basis.shape[1] >= wanted and residual <= RESIDUAL * top
        # Equal eigenvalues may hide from a block: what has settled must stand a pass over random directions.
        stands = settled and found is not None and np.abs(values[:wanted] - found).max() <= 1e-10 * top
        if basis.shape[1] == dims or stands:
            return values[:wanted], ritz, {"passes": taken, "residual": residual / top if top else 0.0, "basis": basis.shape[1]}
        left = np.zeros_like(image) if settled else image - basis @ (basis.T @ image)
        found = values[:wanted] if settled else None
        if basis.shape[1] + block > basis_limit and basis.shape[1] < dims and basis_limit < dims:
            keep = wanted + block
            basis, images = basis @ inside[:, :keep], images @ inside[:, :keep]
        new = _orthonormal(left, basis, 1e-13 * top, rng, min(block, dims - basis.shape[1]))
    raise ArithmeticError(f"residuals are {residual / top:.3g} of the largest eigenvalue after {passes} passes")


def whitened(df: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Each sound row on each component: ``key``, component, n, deviation (decimal), whitened, explained, identity_error, eigenvalue.

    See ``fixed_point`` for the rows that take no part. Repeated rows and keys (also null) are returned as often as they come,
    and count once in the fit. Components without variance are left out: a table of one different vector, or none, gives no rows.
    Columns of the input besides these two aren't returned.
    """
    spark = df.sparkSession
    bound_batches(spark)
    rows = fixed_point(df.select(F.col(key).alias("key"), F.col(vector).alias("vector")), "vector").select("key", "x")
    fit = written(rows.groupBy("x").count().select("x"), "fit")
    totals = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).orderBy("i").collect()
    schema = "key long, component int, deviation decimal(38,0), whitened double, explained double, eigenvalue double"
    if not totals:
        return _named(spark.createDataFrame([], schema), key, df, 0, 0.0)
    n, dims = totals[0].n, len(totals)
    centre = Centre(n, [int(r.s) for r in totals])

    def apply(block: np.ndarray) -> np.ndarray:
        def product(x: np.ndarray) -> np.ndarray:
            off = centre.centred(x)
            return off.T @ (off @ block)

        return _summed(fit, product, block.shape) / n

    values, vectors, _ = block_lanczos(apply, dims, components)
    alive = values > NO_VARIANCE * max(float(values[0]), 0.0)
    values, vectors = values[alive], vectors[:, alive]
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    scaled = vectors / np.sqrt(values)

    @tidy
    def deviation_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([sum(sum(centre.deviations(_matrix(b.column(0)))) for b in batches if len(b))], pa.decimal128(38, 0))], ["deviation"])

    # The trace of the covariance is the sum of all deviations by n^3.
    spread = int(fit.select("x").mapInArrow(deviation_rows, "deviation decimal(38,0)").agg(F.sum("deviation")).first()[0] or 0)
    k = len(values)
    if not k or not spread:
        return _named(spark.createDataFrame([], schema), key, df, n, 0.0)

    def inner(x: np.ndarray) -> np.ndarray:
        w = centre.centred(x) @ scaled
        return w.T @ w

    error = float(np.abs(_summed(fit, inner, (k, k)) / n - np.eye(k)).max())
    explained = values * (float(n) * float(n) * float(n)) / float(spread)

    @tidy
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, m = _matrix(batch.column("x")), len(batch)
            taken = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(taken), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(centre.deviations(x), pa.decimal128(38, 0)).take(taken),
                    pa.array((centre.centred(x) @ scaled).ravel()), pa.array(np.tile(explained, m)), pa.array(np.tile(values, m)),
                ],
                ["key", "component", "deviation", "whitened", "explained", "eigenvalue"],
            )

    typed = f"key {df.schema[key].dataType.simpleString()},{schema.split(',', 1)[1]}"
    return _named(rows.mapInArrow(project, typed), key, df, n, error)


def _named(rows: DataFrame, key: str, df: DataFrame, n: int, error: float) -> DataFrame:
    return rows.select(F.col("key").cast(df.schema[key].dataType).alias(key), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"), "eigenvalue")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator's rows with deviations as long, as the contract has it; beyond 64 bits that is null, and ``deviation_wide`` holds it."""
    rows = whitened(read_table(spark, sf_dir, "embeddings"))
    return rows.withColumnRenamed("deviation", "deviation_wide").select("vec_id", "component", "n", F.expr("try_cast(deviation_wide AS bigint)").alias("deviation"), "whitened", "explained", "identity_error", "eigenvalue", "deviation_wide")
