"""Whitening of embeddings by the leading eigenvectors of their covariance.

The covariance is never formed.  A product with it is one Spark job: every task centres its vectors, multiplies them
by a block of columns and back, and sums what it has; the sums of the tasks, a matrix of dimensions x columns, are
added up by cell.  ``jacobi_davidson`` needs such products only: it expands a search space by corrections of the
leading Ritz vectors, which are solved inexactly by MINRES in the space orthogonal to them (all corrections together,
one product a step), and takes Ritz pairs in the space by Rayleigh-Ritz.  Converged pairs are locked: they stay in the
space and get no more corrections.  It ends when the residuals of all wanted pairs are at rounding level.

Vectors are whole numbers (``quantised``), so sums by dimension and deviations are exact.

Defined results: null vectors, vectors with null, NaN or infinite entries, empty vectors and vectors whose length is
not the most frequent one (of equally frequent ones the longest) are dropped.  Repeated rows count each.  Components
of no variance are left out: one row, or equal rows, give no result, as does an empty table.  A deviation that does
not fit a long is null.  Ids may be null or repeated and of any type; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

#: Ritz pairs beyond the wanted ones that are improved with them.
GUARD = 4
#: MINRES steps for one expansion of the search space, and the part of a residual at which they end.
INNER_STEPS, INNER_TOLERANCE = 5, 0.05
#: Columns of the search space, as a multiple of the block, at which it is cut back to its leading Ritz vectors.
LARGEST = 6


def quantised(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(id, x) of the usable vectors of one length, x = floor(1024 c) + 100000 for every entry c as a double."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(F.col(f"`{key}`").alias("id"), v.alias("v")).filter(F.col("v").isNotNull() & (F.size("v") > 0))
    rows = rows.filter(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    x = F.transform("v", lambda c: F.floor(F.lit(1024.0) * c) + F.lit(100000).cast("long"))
    return rows.select("id", x.alias("x"))


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions of symmetric systems, one a column of ``rhs``, by MINRES on all columns at once."""
    tiny = np.finfo(float).tiny ** 0.5
    x = w = w_before = np.zeros_like(rhs)
    r_before = r = y = rhs
    beta = first = np.linalg.norm(rhs, axis=0)
    beta_before = delta_bar = epsilon = sine = np.zeros_like(beta)
    left, cosine = first, -np.ones_like(beta)
    for turn in range(steps):
        live = (beta > 1e-15 * first) & (left > tolerance * first)
        if not live.any():
            break
        v = np.where(live, y / np.maximum(beta, tiny), 0.0)
        y = apply(v)
        if turn:
            y = y - beta / np.maximum(beta_before, tiny) * r_before
        alpha = (v * y).sum(0)
        y = y - alpha / np.maximum(beta, tiny) * r
        r_before, r = r, y
        beta_before, beta = beta, np.linalg.norm(y, axis=0)
        # the rotation of this step, on a tridiagonal matrix that grows by one row
        epsilon_before, delta = epsilon, cosine * delta_bar + sine * alpha
        gamma_bar = sine * delta_bar - cosine * alpha
        epsilon, delta_bar = sine * beta, -cosine * beta
        gamma = np.maximum(np.hypot(gamma_bar, beta), tiny)
        cosine, sine = gamma_bar / gamma, beta / gamma
        step, left = cosine * left, np.where(live, sine * left, left)
        w, w_before = (v - epsilon_before * w_before - delta * w) / gamma, w
        x = np.where(live, x + step * w, x)
    return x


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Columns that span ``block`` outside of ``against``; what is left of them as rounding is dropped."""
    block = block / np.maximum(np.linalg.norm(block, axis=0), 1e-300)
    for _ in range(2):
        block = block - against @ (against.T @ block)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-10]
    return block


@dataclass(frozen=True)
class Pairs:
    values: np.ndarray              # falling
    vectors: np.ndarray             # dimensions x pairs
    residuals: np.ndarray           # lengths, relative to the largest value
    products: int


def jacobi_davidson(apply: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, rounds: int = 200) -> Pairs:
    """The ``wanted`` largest eigenpairs of a positive semidefinite matrix that is given by its products alone.

    Raises if the residuals do not come down to rounding level in that many rounds.
    """
    wanted = min(wanted, size)
    block = min(size, wanted + GUARD)
    tolerance = 8 * size ** 0.5 * np.finfo(float).eps
    products = 0

    def product(columns: np.ndarray) -> np.ndarray:
        nonlocal products
        products += 1
        return apply(columns)

    space = np.linalg.qr(np.random.default_rng(12).standard_normal((size, block)))[0]
    image = product(space)
    for _ in range(rounds):
        small = space.T @ image
        value, turn = np.linalg.eigh((small + small.T) / 2)
        value, turn = value[::-1], turn[:, ::-1]
        ritz, ritz_image = space @ turn, image @ turn
        residual = ritz_image[:, :block] - ritz[:, :block] * value[:block]
        length = np.linalg.norm(residual, axis=0) / max(value[0], np.finfo(float).tiny)
        if (length[:wanted] <= tolerance).all() or value[0] <= 0:
            return Pairs(value[:wanted], ritz[:, :wanted], length[:wanted], products)
        if space.shape[1] + block > LARGEST * block and size > LARGEST * block:
            space, image = ritz[:, :2 * block], ritz_image[:, :2 * block]
        held, open_ = ritz[:, :block], np.flatnonzero(length > tolerance)

        def outside(columns: np.ndarray, held: np.ndarray = held) -> np.ndarray:
            return columns - held @ (held.T @ columns)

        shift = value[open_]
        new = minres(lambda v, shift=shift, outside=outside: outside(product(outside(v)) - shift * outside(v)),
                     -outside(residual[:, open_]), INNER_STEPS, INNER_TOLERANCE)
        new = _orthonormal(new, space)[:, :size - space.shape[1]]
        if not new.shape[1]:                    # corrections are inside the space: go on with any new directions
            new = _orthonormal(np.random.default_rng(products).standard_normal((size, block)), space)
            new = new[:, :size - space.shape[1]]
        if not new.shape[1]:                    # the space is whole, and its pairs are as good as rounding lets them
            image = product(space)
            continue
        space, image = np.hstack([space, new]), np.hstack([image, product(new)])
    raise ArithmeticError(f"residuals of {length[:wanted].max():.1e} after {rounds} rounds")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.names.index("x"))
    return column.flatten().to_numpy().reshape(len(column), -1)


def _parts(batch: pa.RecordBatch, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    residuals: np.ndarray
    products: int

    def transform(self, rows: DataFrame) -> DataFrame:
        """(id, component, deviation, whitened) of every row and component."""
        n, base, rest = self.n, *_split(self.n, self.sums)
        maps, k = self.vectors / np.sqrt(self.values), len(self.values)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in _parts(whole):
                    a = _matrix(b) - base
                    white = (a - rest / n) @ maps
                    reach = n * (int(np.abs(a).max(initial=0)) + 1)
                    own = a * n - rest if reach * reach * a.shape[1] < 1 << 63 else a.astype(object) * n - rest.astype(object)
                    far = [None if s >= 1 << 63 else int(s) for s in (own * own).sum(1)]
                    at = np.repeat(np.arange(len(a)), k)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(a))),
                         pa.array(far, pa.int64()).take(pa.array(at)), pa.array(white.ravel())],
                        names=["id", "component", "deviation", "whitened"])

        kind = rows.schema["id"].dataType.simpleString()
        return rows.select("id", "x").mapInArrow(
            run, f"id {kind}, component int, deviation long, whitened double")


def _split(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Whole part of the mean of each dimension, and what its n-fold lacks to the sum: x - mean is (x - whole) - rest / n,
    with a first difference that is exact."""
    whole = [s // n for s in sums]
    return np.array(whole, np.int64), np.array([s - n * w for s, w in zip(sums, whole, strict=True)], np.int64)


def fit(rows: DataFrame, components: int = 8) -> Whitening | None:
    """Fit on all ``rows`` (id, x): None if they have no variance.

    ``rows`` is read once for the sums and once for each product, so it should be a written table.
    """

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, 0
        for whole in batches:
            for b in _parts(whole):
                x = _matrix(b)
                n += len(x)             # in two halves, as sums of a batch need not fit 64 bits
                sums = sums + (((x >> 32).sum(0).astype(object)) * (1 << 32) + (x & 0xFFFFFFFF).sum(0).astype(object))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums), pa.int64()),
                 pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0))], names=["dim", "n", "total"])

    by_dim = (rows.select("x").mapInArrow(totals, "dim int, n long, total decimal(38,0)").groupBy("dim")
              .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dim").collect())
    if not by_dim:
        return None
    n, sums = by_dim[0]["n"], tuple(int(r["total"]) for r in by_dim)
    size, (base, rest) = len(sums), _split(n, sums)

    def summed(task: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
        """Sum over all rows of ``task(centred rows)``, a small matrix."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for whole in batches:
                for b in _parts(whole):
                    total += task((_matrix(b) - base) - rest / n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())],
                                             names=["cell", "part"])

        cells = rows.select("x").mapInArrow(run, "cell int, part double").groupBy("cell").agg(F.sum("part")).collect()
        out = np.zeros(total := shape[0] * shape[1])
        assert len(cells) == total
        for cell, part in cells:
            out[cell] = part
        return out.reshape(shape)

    def product(columns: np.ndarray) -> np.ndarray:
        return summed(lambda a: a.T @ (a @ columns), columns.shape) / n

    trace = float(summed(lambda a: (a * a).sum(0)[None], (1, size)).sum() / n)
    if trace == 0:
        return None
    pairs = jacobi_davidson(product, size, components)
    some = pairs.values > size * np.finfo(float).eps * pairs.values[0]
    values, vectors = pairs.values[some], pairs.vectors[:, some]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    white = vectors / np.sqrt(values)
    error = float(np.abs(white.T @ product(white) - np.eye(len(values))).max())
    return Whitening(n, sums, values, vectors, trace, error, pairs.residuals[some], pairs.products)


def whiten(df: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = 8) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    rows = quantised(df, vector, key)
    kind = rows.schema["id"].dataType.simpleString()
    rows = cut_lineage(rows, "vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    model = None
    if lengths:
        rows = rows.filter(F.size("x") == lengths[0]["d"])
        model = fit(rows, components)
    if model is None:
        return df.sparkSession.createDataFrame(
            [], f"id {kind}, component int, n long, deviation long, whitened double, explained double, "
                "identity_error double")
    share = F.element_at(F.array(*[F.lit(float(v / model.trace)) for v in model.values]), F.col("component"))
    return model.transform(rows).select("id", "component", F.lit(model.n).cast("long").alias("n"), "deviation",
                                        "whitened", share.alias("explained"),
                                        F.lit(model.identity_error).alias("identity_error"))
