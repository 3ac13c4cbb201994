"""Exact quantiles (linear interpolation, as pandas/DuckDB) without one-task collects.

``F.median`` / ``percentile`` merge a value -> count map for the whole column
in one final task, which is unbounded for continuous data at scale.  Here
doubles become whole numbers in the same order, and every needed order
statistic is bracketed by a range of these numbers.  One pass a round counts
the values of every bracket in ``PARTS`` equal parts of its range; the part
that holds the wanted rank is the next bracket.  A bracket with few values is
counted by value, which ends it.

A round leaves a range ``PARTS`` times narrower, so there are seven rounds at
most, whatever the values and ties, and two or three for usual columns.  The
driver receives counts of non-empty parts; no value list reaches it, and all
order statistics of all columns share the pass of a round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import q as Q
from ..session import cut_lineage

#: Parts of a bracket that a round counts, and the number of values that are counted by value.
PARTS, FEW = 1024, 64
_TOP = 1 << 63


def matrix(batch: pa.RecordBatch, first: int = 0) -> np.ndarray:
    """The columns of a batch from ``first`` on as rows x columns of doubles; null is NaN."""
    columns = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns[first:]]
    return np.column_stack(columns) if columns else np.empty((batch.num_rows, 0))


def doubles(df: DataFrame, cols: Sequence[str], others: Sequence[str] = ()) -> DataFrame:
    """``others`` and ``cols`` as doubles (booleans and numbers alike)."""
    return df.selectExpr(*[Q(c) for c in others], *[f"CAST({Q(c)} AS DOUBLE) AS c{i}" for i, c in enumerate(cols)])


def _ordered(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the order of the doubles (without NaN)."""
    bits = (values + 0.0).view(np.int64)            # the two zeros are one value
    return (bits ^ ((bits >> 63) & np.int64(_TOP - 1))).view(np.uint64) ^ np.uint64(_TOP)


def _double(key: int) -> float:
    bits = np.array([key], np.uint64) ^ np.uint64(_TOP)
    bits = bits.view(np.int64)
    return float((bits ^ ((bits >> 63) & np.int64(_TOP - 1))).view(np.float64)[0])


def exact_quantiles(df: DataFrame, targets: Sequence[tuple[str, float]], accuracy: int = PARTS
                    ) -> dict[tuple[str, float], float | None]:
    """The value of each (column, quantile); None for a column without values.  NaN counts as missing, as in pandas.

    ``accuracy`` is the number of parts that a round counts; the values do not depend on it.
    """
    targets = list(dict.fromkeys(targets))
    if not targets:
        return {}
    cols = list(dict.fromkeys(c for c, _ in targets))
    # only the needed columns, kept for the rounds (spills to disk if large)
    rows = doubles(df, cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = _counted(rows, [(c, 0, 63, 1 << 64) for c in range(len(cols))])
        n = [sum(parts.values()) for parts in counts]
        at = {(c, q): (n[cols.index(c)] - 1) * q for c, q in targets if n[cols.index(c)]}
        ranks = sorted({(cols.index(c), r) for (c, _), x in at.items() for r in (math.floor(x), math.ceil(x))})
        value = _order_statistics(rows, ranks, n, max(2, accuracy))
    finally:
        rows.unpersist()
    out: dict[tuple[str, float], float | None] = dict.fromkeys(targets)
    for (c, q), x in at.items():
        a, b = value[cols.index(c), math.floor(x)], value[cols.index(c), math.ceil(x)]
        out[c, q] = a if a == b else a + (b - a) * (x - math.floor(x))
    return out


def _counted(rows: DataFrame, brackets: Sequence[tuple[int, int, int, int]]) -> list[dict[int, int]]:
    """For each bracket (column, first number, bits of a part, numbers), how many values each part has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[dict[int, int]] = [{} for _ in brackets]
        for b in batches:
            held: dict[int, np.ndarray] = {}
            for i, (c, low, shift, size) in enumerate(brackets):
                if c not in held:
                    x = b.column(c).to_numpy(zero_copy_only=False)
                    held[c] = _ordered(x[~np.isnan(x)])
                keys = held[c]
                inside = keys[(keys >= low) & (keys - np.uint64(low) <= np.uint64(size - 1))] - np.uint64(low)
                inside >>= np.uint64(shift)
                if (size - 1) >> shift < 4 * PARTS:         # few parts: counted without sorting the values
                    counts = np.bincount(inside.astype(np.int64))
                    part = np.flatnonzero(counts)
                    count = counts[part]
                else:
                    part, count = np.unique(inside, return_counts=True)
                for p, k in zip(part.tolist(), count.tolist(), strict=True):
                    total[i][p] = total[i].get(p, 0) + k
        cells = [(i, p - _TOP, k) for i, parts in enumerate(total) for p, k in parts.items()]
        cols = list(zip(*cells, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(x, pa.int64()) for x in cols[1:])],
                                         names=["bracket", "part", "n"])

    out: list[dict[int, int]] = [{} for _ in brackets]
    for r in rows.mapInArrow(run, "bracket int, part long, n long").groupBy("bracket", "part").agg(
            F.sum("n").alias("n")).collect():
        out[r["bracket"]][r["part"] + _TOP] = r["n"]
    return out


def _order_statistics(rows: DataFrame, ranks: Sequence[tuple[int, int]], n: Sequence[int], parts: int
                      ) -> dict[tuple[int, int], float]:
    """The value of each (column number, zero-based rank among the column's values)."""
    found: dict[tuple[int, int], float] = {}
    # first number, numbers, values below, values inside
    pending = {t: (0, 1 << 64, 0, n[t[0]]) for t in ranks}
    while pending:
        brackets = {}
        for (c, _), (low, size, _, inside) in pending.items():
            shift = 0 if inside <= FEW else max(0, (size - 1).bit_length() - (parts - 1).bit_length())
            brackets[c, low, shift, size] = None
        brackets = dict(zip(brackets, _counted(rows, list(brackets)), strict=True))
        after = {}
        for t, (low, size, below, inside) in pending.items():
            key = next(k for k in brackets if k[0] == t[0] and k[1] == low and k[3] == size)
            for part, count in sorted(brackets[key].items()):
                if t[1] < below + count:
                    break
                below += count
            first = low + (part << key[2])
            if key[2] == 0:
                found[t] = _double(first)
            else:
                after[t] = (first, min(1 << key[2], low + size - first), below, count)
        pending = after
    return found


def exact_quantile(df: DataFrame, col: str, q: float = 0.5, **kw) -> float | None:
    return exact_quantiles(df, [(col, q)], **kw)[(col, q)]


def column_moments(df: DataFrame, cols: Sequence[str], absolute: bool = True) -> tuple[list[int], list[float], list[float]]:
    """Of every column the number of values, their mean (``absolute``: of their sizes) and their population standard
    deviation; null and NaN are no values.

    One pass over the rows: every task adds up values and squares around its own means, batch by batch; its few
    numbers are written, and their squares are moved to the mean of all (a row for each column and task).
    """
    rows, size = doubles(df, cols), len(cols)
    if not size:
        return [], [], []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares, sizes = np.zeros(size, np.int64), np.zeros(size), np.zeros(size), np.zeros(size)
        for b in batches:
            x = matrix(b)
            has = ~np.isnan(x)
            k, own = has.sum(0), np.where(has, x, 0.0).sum(0)
            with np.errstate(invalid="ignore", over="ignore"):
                squares += np.where(has, (x - own / np.maximum(k, 1)) ** 2, 0.0).sum(0)
                gap = own / np.maximum(k, 1) - total / np.maximum(n, 1)
                squares += np.where((n > 0) & (k > 0), gap ** 2 * (n / np.maximum(n + k, 1) * k), 0.0)
                total += own
            n += k
            sizes += np.where(has, np.abs(x), 0.0).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), *map(pa.array, (n, total, squares, sizes))],
                                         names=["col", "n", "total", "squares", "sizes"])

    parts = cut_lineage(rows.mapInArrow(run, "col int, n long, total double, squares double, sizes double")
                        .where("n > 0"), "moments")
    n, total, sizes, squares = (np.zeros(size) for _ in range(4))
    for r in parts.groupBy("col").agg(F.sum("n"), F.sum("total"), F.sum("sizes")).collect():    # a row a column
        n[r[0]], total[r[0]], sizes[r[0]] = r[1:]
    mean = total / np.maximum(n, 1)
    means = df.sparkSession.createDataFrame(list(enumerate(mean.tolist())), "col int, mean double")
    gap = F.col("total") / F.col("n") - F.col("mean")
    for r in parts.join(F.broadcast(means), "col").groupBy("col").agg(
            F.sum(F.col("squares") + F.col("n") * gap * gap)).collect():
        squares[r[0]] = r[1]
    std = np.sqrt(squares / np.maximum(n, 1))
    return [int(k) for k in n], ((sizes / np.maximum(n, 1)) if absolute else mean).tolist(), std.tolist()
