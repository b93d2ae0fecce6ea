"""Operator 13: whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers x = floor(scale * c) + shift; A holds the rows x - S/n, divided by sqrt(n). Each step
takes a direction v, forms Av on the rows and A'(Av) from it in one pass over the blocks of rows, and
makes both sides orthogonal to all directions before them, twice. A left direction is never stored: it
is A p for some short vector p, and its product with another A q is (A'Ap)'q, where A'Ap came from p's own
pass. What the driver keeps is so many vectors as there are steps, each as long as a row is
wide; nothing there grows with the number of rows. The small bidiagonal matrix's SVD gives
components and deviations. Rows up to ``WIDE`` entries get a step for each dimension, which leaves nothing to
converge (and finds equal eigenvalues, as a run that has ended starts anew across); wider ones stop when the
residual of each wanted component is gone.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped; of several lengths
the most common one (the smaller, if equal) is fitted and the other rows are dropped, as they lack
entries; rows with a null id and repeated rows are rows like others; components of no variance are left out,
so equal rows give no row; whole numbers beyond 2^62 are held there; a deviation that a long can't hold
is null; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from smogline.session import pin_table

from . import common

#: Bytes of a block of rows, and the row width up to which every dimension gets a step.
BLOCK_BYTES, WIDE = 2 << 20, 128
#: What counts as gone, against the largest of its kind.
TINY = 1e-14
SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whole(vectors: DataFrame, id_col: str, vec_col: str, scale: int, shift: int) -> DataFrame:
    """(vec_id long, x array<long>): the rows that take part, of any length."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    far = F.lit(2.0**62)

    def entry(c):
        return F.floor(F.greatest(F.least(F.lit(float(scale)) * c, far), -far)).cast("long") + F.lit(shift)
    return (vectors.filter(F.col(vec_col).isNotNull() & fine)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, entry).alias("x")))


def packed(rows: DataFrame, dim: int) -> DataFrame:
    """(ids array<long>, body binary): blocks of rows of length ``dim``, written to the shared folder."""
    each = max(1, BLOCK_BYTES // (8 * dim))

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, each):
                part = batch.slice(at, each)
                body = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([body.tobytes()])],
                    names=["ids", "body"])

    return pin_table(rows.filter(F.size("x") == dim).mapInArrow(pack, "ids array<long>, body binary"), "blocks")


def in_tasks(blocks: DataFrame, fn: Callable[[np.ndarray], np.ndarray], dim: int, size: int, kind: type) -> DataFrame:
    """(y array): ``fn`` of each block (an array of ``size`` numbers), added up within each task."""
    name = "double" if kind is np.float64 else "long"

    def run(batches):
        total = np.zeros(size, kind)
        for batch in batches:
            for body in batch.column(0):
                total = total + fn(np.frombuffer(body.as_buffer(), np.int64).reshape(-1, dim))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.from_numpy_dtype(kind)))], names=["y"])

    return blocks.select("body").mapInArrow(run, f"y array<{name}>")


def summed(blocks: DataFrame, fn: Callable[[np.ndarray], np.ndarray], dim: int, size: int) -> np.ndarray:
    """``fn`` of each block, added up over all blocks: in each task, then by one vector aggregate."""
    parts = in_tasks(blocks, fn, dim, size, np.float64)
    got = parts.select(Summarizer.sum(array_to_vector("y")).alias("s")).first()
    return got.s.toArray()


def exact_sums(blocks: DataFrame, fn: Callable[[np.ndarray], np.ndarray], dim: int, size: int) -> list[int]:
    """The same for whole numbers, exactly."""
    parts = in_tasks(blocks, fn, dim, size, np.int64).select(F.posexplode("y"))
    got = parts.groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()
    return [int(r.s) for r in sorted(got)]


class Rows:
    """The centred rows: n, exact sums, and how a block is centred."""

    def __init__(self, blocks: DataFrame, dim: int):
        self.blocks, self.dim = blocks, dim

        def sums(x):  # halves, as a sum of whole numbers may pass a long
            return np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
        got = exact_sums(blocks, sums, dim, 1 + 2 * dim)
        self.n = got[0]
        self.sums = [(h << 32) + low for h, low in zip(got[1:1 + dim], got[1 + dim:])]
        top = blocks.select("body").mapInArrow(_largest, "m long").agg(F.max("m")).first()[0] or 0
        #: whether n * x - S fits a long
        self.small = max(top, 1) * max(self.n, 1) < 2**61

    def tools(self):
        """(scaled, centred): n * x - S, as long where that fits and as Python's numbers elsewhere, and x - S/n."""
        n, small = self.n, self.small
        sums = np.array(self.sums, np.int64 if small else object)

        def scaled(x):
            return x * n - sums if small else x.astype(object) * n - sums

        def centred(x):
            return (scaled(x) / n).astype(np.float64)
        return scaled, centred

    def gram(self, q: np.ndarray) -> np.ndarray:
        """A'(Aq), and at the end the square of Aq's length: one pass."""
        _, centred = self.tools()
        root = float(np.sqrt(self.n))

        def product(x):
            a = centred(x) / root
            left = a @ q
            return np.append(left @ a, left @ left)
        return summed(self.blocks, product, self.dim, self.dim + 1)

    def trace(self) -> float:
        _, centred = self.tools()
        return summed(self.blocks, lambda x: np.array([np.square(centred(x)).sum()]), self.dim, 1)[0] / self.n


def _largest(batches):
    most = 0
    for batch in batches:
        for body in batch.column(0):
            most = max(most, int(np.abs(np.frombuffer(body.as_buffer(), np.int64)).max(initial=0)))
    yield pa.RecordBatch.from_arrays([pa.array([most], pa.int64())], names=["m"])


def across(x: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``x`` without its parts along an orthonormal basis; twice, so rounding leaves nothing."""
    if basis:
        m = np.array(basis)
        for _ in range(2):
            x = x - m.T @ (m @ x)
    return x


def bidiagonal(rows: Rows, trace: float, k: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; components as columns): the first ``k`` of A'A, those of no variance left out."""
    dim, rng = rows.dim, np.random.default_rng(seed)
    gone = TINY * np.sqrt(trace)
    right: list[np.ndarray] = []
    short: list[np.ndarray] = []   # p of each left direction A p
    back: list[np.ndarray] = []    # A'A p
    diagonal, above = [], []

    def fresh():
        for _ in range(20):
            x = across(rng.standard_normal(dim), right)
            if np.linalg.norm(x) > 1e-8:
                return across(x / np.linalg.norm(x), right)
        return None

    v = fresh()
    while v is not None and len(right) < dim:
        right.append(v / np.linalg.norm(v))
        q = right[-1]
        for _ in range(2 if short else 0):  # Av without its parts along the left directions
            q = q - np.array(short).T @ (np.array(back) @ q)
        y = rows.gram(q)
        alpha = float(np.sqrt(max(y[-1], 0)))
        if alpha > gone:
            short.append(q / alpha)
            back.append(y[:-1] / alpha)
            rest = across(back[-1], right)
        else:
            alpha = 0.0
            short.append(np.zeros(dim))
            back.append(np.zeros(dim))
            rest = np.zeros(dim)
        beta = float(np.linalg.norm(rest))
        beta = beta if beta > gone else 0.0
        diagonal.append(alpha)
        above.append(beta)
        if dim > WIDE and len(right) >= k and beta:
            left, values, _ = np.linalg.svd(np.diag(diagonal) + np.diag(above[:-1], 1))
            if (beta * np.abs(left[-1, :k]) <= TINY * values[0]).all():
                break
        v = rest / beta if beta else fresh()
    _, values, turned = np.linalg.svd(np.diag(diagonal) + np.diag(above[:-1], 1))
    kept = [i for i in range(min(k, len(values))) if values[i]**2 > 1e-12 * max(trace, 0)]
    components = (np.array(right).T @ turned.T)[:, kept]
    return np.square(values[kept]), components


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8, scale: int = 1024,
           shift: int = 100_000) -> DataFrame:
    """A row of SCHEMA for each row of ``vectors`` that takes part and each component up to ``k``."""
    spark = vectors.sparkSession
    rows = whole(vectors, id_col, vec_col, scale, shift)
    size = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if size is None or size.d == 0:
        return spark.createDataFrame([], SCHEMA)
    dim = size.d
    table = Rows(packed(rows, dim), dim)
    trace = table.trace()
    if trace <= 0:
        return spark.createDataFrame([], SCHEMA)
    values, components = bidiagonal(table, trace, k)
    k, n = len(values), table.n
    scaled, centred = table.tools()
    stretch = components / np.sqrt(values)

    def moments(x):
        w = centred(x) @ stretch
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    got = summed(table.blocks, moments, dim, k * k + k)
    mean = got[k * k:] / n
    error = float(np.abs(got[:k * k].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max(initial=0))
    explained = values / trace

    def rows_of(batches):
        for batch in batches:
            for ids, body in zip(batch.column(0), batch.column(1)):
                x = np.frombuffer(body.as_buffer(), np.int64).reshape(-1, dim)
                w, far = centred(x) @ stretch, scaled(x)
                if far.dtype != object and float(np.square(far.astype(np.float64)).sum(axis=1).max(initial=0)) < 2.0**62:
                    deviation = np.square(far).sum(axis=1)
                else:
                    exact = np.square(far.astype(object)).sum(axis=1)
                    deviation = [d if d < 2**63 else None for d in exact]
                m = len(x)
                deviation = pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n)), deviation, pa.array(w.ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * k, error))], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return table.blocks.select("ids", "body").mapInArrow(rows_of, SCHEMA)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings`` on their first eight components."""
    return whiten(common.table(spark, sf_dir, "embeddings"))
