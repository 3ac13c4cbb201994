"""Sharding by sampled splitters.

Rows are ordered by a key and cut into shards of equal bytes.  Size-weighted
samples of the keys give quantile boundaries that deal the rows into many
ranges; the exact bytes of every range are then counted, and ranges that came
out overfull (a hot key, an unlucky sample) are subdivided by new samples from
inside them.  With the ranges' exact totals known, a row's place in the whole
order is its range's offset plus its place in the range, so shards and slots
are exact, although no task sees more than a range.

What the driver holds is bounded by ``max_ranges``: the sampled keys, the
splitters and two totals a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, spare_name

#: Sampled keys for each range, and rounds of subdividing.
SAMPLES, ROUNDS = 32, 4


def _sample(rows: DataFrame, key: str, size: str, step: float, seed: int) -> list[tuple[str, float]]:
    """Keys drawn with probability ``size / step`` (1 at most) by a hash of the key, and the bytes each stands for.

    All rows of a key may be drawn together, so they are summed first: a key reaches the driver once.
    """
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11) / F.lit(float(1 << 53))
    got = rows.filter(draw < F.col(size) / F.lit(step)).groupBy(key).agg(F.sum(F.greatest(F.col(size), F.lit(step))))
    return sorted((k, float(w)) for k, w in got.collect())


def _quantiles(sample: list[tuple[str, float]], parts: int) -> list[str]:
    """The keys at the quantiles of the sampled bytes."""
    if not sample or parts < 2:
        return []
    run = np.cumsum([w for _, w in sample])
    at = np.searchsorted(run, run[-1] * np.arange(1, parts) / parts)
    return sorted({sample[min(i, len(sample) - 1)][0] for i in at})


def _with_range(rows: DataFrame, key: str, splitters: list[str], name: str) -> DataFrame:
    """``rows`` with the number of the range its key is in: the count of splitters at or below it."""
    edges = rows.sparkSession.sparkContext.broadcast(np.array([s.encode() for s in splitters], dtype=bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.array([x.encode() for x in b.column(key).to_pylist()], dtype=bytes)
            at = np.searchsorted(edges.value, keys, side="right") if len(edges.value) else np.zeros(len(keys), int)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], names=[*b.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.IntegerType())]))


def shard_by_bytes(df: DataFrame, key: str, size: str, shards: int = 16, group_chars: int = 0,
                   whole_share: float = 0.05, rows_per_range: int = 20_000, max_ranges: int = 16_384) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 in each shard).

    * ``key``: a string of printable ASCII, not null; rows are ordered by it.  ``size``: a positive long.
    * A row goes to the shard in which the middle of its bytes falls, in key order, so shards differ from the mean
      by a row's size at most.  Keys that agree in the first ``group_chars`` characters form a group; a group of at
      most ``whole_share`` of a shard goes whole to the shard of its middle.  Larger groups are split.
    * Reruns agree: neither shards nor slots depend on the sample.  Rows with the same key, which must be alike,
      get their slots in any order.  An empty table gives an empty result.  Columns of ``df`` named ``shard`` or
      ``slot``, in any case, are replaced.
    """
    df = df.drop("shard", "slot")
    part, run, count = (spare_name(df, x) for x in ("range", "run", "count"))
    rows = cut_lineage(df, "shard-rows")
    total, n = rows.agg(F.coalesce(F.sum(size), F.lit(0)), F.count(F.lit(1))).first()
    if not n:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    ranges = max(shards * 4, min(max_ranges, n // rows_per_range))
    mean = total / ranges
    splitters = _quantiles(_sample(rows, key, size, mean / SAMPLES, 1), ranges)
    # a group is in one range, unless it alone fills several
    if group_chars:
        by_group = {}
        for s in splitters:
            by_group.setdefault(s[:group_chars], []).append(s)
        splitters = sorted(x for g, own in by_group.items() for x in ([g] if len(own) == 1 else own))
    for seed in range(2, 2 + ROUNDS):
        ranged = _with_range(rows, key, splitters, part)
        stats = {r: (b, k) for r, b, k in ranged.groupBy(part).agg(
            F.sum(size), F.count(F.lit(1))).collect()}
        over = {r: int(np.ceil(max(b / mean, k * ranges / n))) for r, (b, k) in stats.items()
                if b > 3 * mean or k > 3 * n / ranges}
        if not over or seed == 1 + ROUNDS or len(splitters) > 2 * ranges:
            break
        more = set(splitters)
        inside = _sample(ranged.filter(F.col(part).isin(list(over))), key, size, mean / SAMPLES, seed)
        edges = np.array(splitters)
        for r, parts in over.items():
            own = [x for x in inside if np.searchsorted(edges, x[0], side="right") == r]
            more |= set(_quantiles(own, 2 * parts))
        if len(more) == len(splitters):
            break                               # nothing left to cut: single keys
        splitters = sorted(more)

    order = sorted(stats)
    before = np.cumsum([[0, 0], *[stats[r] for r in order]], axis=0)
    offsets = F.broadcast(rows.sparkSession.createDataFrame(
        [(r, int(b), int(k)) for r, (b, k) in zip(order, before[:-1].tolist(), strict=True)],
        f"{part} int, {run} long, {count} long"))       # one row a range
    placed = ranged.join(offsets, part)
    inside = W.partitionBy(part).orderBy(F.substring(key, 1, group_chars), key) if group_chars else \
        W.partitionBy(part).orderBy(key)
    upto = inside.rowsBetween(W.unboundedPreceding, 0)
    placed = placed.withColumns({run: F.col(run) + F.sum(size).over(upto),
                                 count: F.col(count) + F.row_number().over(inside) - 1})
    twice = 2 * F.col(run) - F.col(size)
    if group_chars:
        group = W.partitionBy(part, F.substring(key, 1, group_chars))
        end, bytes_ = F.max(run).over(group), F.sum(size).over(group)
        twice = F.when(bytes_ <= F.lit(whole_share * total / shards), 2 * end - bytes_).otherwise(twice)
    shard = F.least(F.floor(twice.cast("double") * F.lit(shards / (2 * total))), F.lit(shards - 1)).cast("int")
    placed = cut_lineage(placed.withColumn("shard", shard), "shard-places")
    first = placed.groupBy("shard").agg(F.min(count).alias(run))
    first = F.broadcast(rows.sparkSession.createDataFrame(first.collect(), f"shard int, {run} long"))   # one a shard
    return (placed.drop(part, run).join(first, "shard").withColumn("slot", F.col(count) - F.col(run))
            .drop(count, run).select(*df.columns, "shard", "slot"))
