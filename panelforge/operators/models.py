"""Shared pieces of the fitted models (family K): assembled vectors, global row indexes, contiguous folds.

Ridge, lasso and elastic net are in ``linear_gram.py``, forests and boosted trees in ``trees.py``, and all three
together in ``base_models.py``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..spec import DEFAULT_SPEC, PanelSpec

# The reference's penalties.
ALPHAS = (0.01, 0.1, 1.0, 10.0, 100.0)
ENET_ALPHAS = (0.01, 0.1, 1.0, 10.0)
L1_RATIOS = (0.1, 0.5, 0.7, 0.9, 0.95)


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def global_index(df: DataFrame, order: Sequence, out: str = "index") -> tuple[DataFrame, int]:
    """``df`` with each row's zero-based place in the global ``order``, and the number of rows.

    No single-partition window: range-partition and sort by ``order``, number the rows of each partition, and turn
    the partitions' counts (one small row each) into offsets, joined by broadcast.
    """
    # explicit partition count (AQE leaves it alone) and a written table, so the counting job and what
    # follows read the same numbered partitions
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    nparts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = df.repartitionByRange(nparts, *order).sortWithinPartitions(*order)
    part = part.withColumn("__mid", F.monotonically_increasing_id())
    part = cut_lineage(part.withColumn("__pid", F.shiftright("__mid", 33)).withColumn(
        "__idx", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))))
    offsets, total = [], 0
    for pid, n in sorted((r["__pid"], r["n"]) for r in part.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((pid, total))
        total += n
    starts = df.sparkSession.createDataFrame(offsets, "__pid long, __start long")     # one row a partition
    part = part.join(F.broadcast(starts), "__pid").withColumn(out, F.col("__start") + F.col("__idx"))
    return part.select(*[c for c in df.columns if c != out], out), total


def contiguous_folds(df: DataFrame, k: int, order: Sequence[str], out: str = "fold") -> DataFrame:
    """Unshuffled contiguous folds: rows in ``order`` split into k runs, first n % k one row longer.

    Same ids as ``ntile(k) - 1`` over the global order.  Only the columns of ``order`` are sorted, by
    ``global_index``; the rows are compared with the first one of each fold and stay where they are.  Where equal rows
    of ``order`` lie on both sides of a start, whole rows are indexed instead.
    """
    order = list(order)
    at, total = global_index(df.select(*order), order, "__at")
    q, r = divmod(total, k)
    starts = sorted({i * q + min(i, r) for i in range(k)} - {0, total})
    if starts:
        same = F.struct(*order)
        first = at.where(F.col("__at").isin(*starts)).select(same.alias("row"), F.col("__at").alias("start"))
        below = at.select(same.alias("own"), "__at").join(F.broadcast(first), F.expr("own <=> row"))      # k rows
        found = below.groupBy("start").agg(F.first("row").alias("row"), F.min("__at").alias("least")).collect()
        if any(x["least"] < x["start"] for x in found):
            return _indexed_folds(df, q, r, order, out)
    fold = F.lit(0)
    if starts:
        types = {f.name: f.dataType for f in at.schema.fields}
        of = {s: i for i in range(k) if (s := i * q + min(i, r))}       # the last fold that starts there
        for x in sorted(found, key=lambda x: x["start"]):
            start = F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(order, x["row"], strict=True)])
            fold = F.when(F.struct(*order) >= start, F.lit(of[x["start"]])).otherwise(fold)
    return df.withColumn(out, fold.cast("int")).select(*[c for c in df.columns if c != out], out)


def _indexed_folds(df: DataFrame, q: int, r: int, order: Sequence[str], out: str) -> DataFrame:
    """The same from the index of every whole row: q rows a fold, the first r folds one more."""
    part, _ = global_index(df, order, "__at")
    gi, big = F.col("__at"), F.lit(r * (q + 1))
    fold = F.when(gi < big, F.floor(gi / F.lit(q + 1))).otherwise(
        F.lit(r) + F.floor((gi - big) / F.lit(max(q, 1))))
    return part.withColumn(out, fold.cast("int")).select(*[c for c in df.columns if c != out], out)


def predict_all(models: dict[str, object], df: DataFrame, target: str, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Score one feature table with each model into the long prediction table."""
    out = None
    for name, m in models.items():
        p = m.transform(df).select(*spec.keys, F.lit(target).alias("target"), F.lit(name).alias("model"),
                                   F.col("prediction").cast("double").alias("prediction"),
                                   F.col(target).cast("double").alias("actual"))
        out = p if out is None else out.unionByName(p)
    return out
