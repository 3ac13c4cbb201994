"""Mixing sources to target weights by hash-threshold histograms.

Each source gets a target number of words.  A source below its target is
repeated whole as often as it fits; the rest of its target is drawn as the
documents whose hash lies below a threshold.  The threshold comes from nested
histograms: sum words by (source, hash bucket), find the bucket in which the
running sum crosses the budget, and refine only that bucket with the next bits
of the hash.  Nothing is sorted and no document list leaves the executors: one
level shuffles at most ``sources x 4096`` partial sums for each map task, and a
source that holds a third of all rows is pre-aggregated like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut_lineage, spare_name, text_of

#: Bits of one histogram level and number of levels; together the 60 bits of the hash.
LEVEL_BITS, LEVELS = 12, 5
#: Above this many sources the targets are joined without a broadcast (a row has a name and three numbers).
MAX_BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(*cols: Column) -> Column:
    """The first 60 bits of an MD5 over the columns (null as the empty string), as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("\x1f", *cols)), 1, 15), 16, 10).cast("long")


def capped_targets(sizes: Sequence[tuple[str | None, int]], weights: Callable[[int], int], cap: int
                   ) -> list[tuple[str | None, int, float]]:
    """(source, size, target): the total shared by weight, no target above ``cap`` times its source's size.

    The excess of capped sources is reshared by weight over the others until none is above.  ``weights(i)`` is
    the weight of the i-th source in code-point order, null last.
    """
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    rows = [(name, size, weights(i)) for i, (name, size) in enumerate(order)]
    total, open_, capped = sum(r[1] for r in rows), rows, {}
    while open_:
        left, weight = total - sum(capped.values()), sum(r[2] for r in open_)
        above = [r for r in open_ if left * r[2] > cap * r[1] * weight]
        if not above:
            return [(n, s, float(capped[n])) if n in capped else (n, s, left * w / weight) for n, s, w in rows]
        capped |= {r[0]: cap * r[1] for r in above}
        open_ = [r for r in open_ if r[0] not in capped]
    return [(n, s, float(capped[n])) for n, s, _ in rows]


def weights_5_2_1(i: int) -> int:
    return (5, 2, 1)[i % 3]


def mix_sources(df: DataFrame, text: str = "text", source: str = "source", key: Sequence[str] = ("doc_id",),
                weights: Callable[[int], int] = weights_5_2_1, cap: int = 3) -> DataFrame:
    """Every row of ``df`` with ``size``, ``source_size``, ``target`` and ``repeats`` (times the mix takes it).

    * ``size``: words of the text; null and empty texts have 0.
    * ``repeats`` is ``floor(target / source_size)``, plus 1 where the row's hash lies at or below its source's
      threshold.  The last hash taken is the one that brings the words nearest the target (ties: left out), so a
      source misses its target by half of its boundary document at most.
    * The hash is over ``key`` and the text, so reruns and any order of rows agree; rows alike in both are taken
      or left together.  A null source is a source of its own, after all others; null keys hash as empty.
    * An empty table gives an empty result.  Columns of ``df`` that bear one of the new names are replaced.
    """
    spark = df.sparkSession
    row = cut_lineage(df.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                                hash60(*[F.col(k).cast("string") for k in key], F.col(text)).alias("h")), "mix-rows")
    plan = _thresholds(spark, row, weights, cap)
    new = ["size", "source_size", "target", "repeats"]
    name, hash_ = spare_name(df, "mix_source"), spare_name(df, "mix_hash")
    out = df.drop(*[c for c in df.columns if c.lower() in new and c not in (text, source, *key)])
    out = out.withColumns({"size": word_count(F.col(text)), hash_: hash60(*[F.col(k).cast("string") for k in key],
                                                                       F.col(text))})
    out = out.join(plan.withColumnRenamed("source", name), F.col(source).eqNullSafe(F.col(name)), "left")
    take = F.col("whole") + F.when(F.col(hash_) <= F.col("threshold"), 1).otherwise(0)
    return out.withColumn("repeats", take.cast("long")).drop("whole", "threshold", name, hash_)


def _thresholds(spark, row: DataFrame, weights, cap: int) -> DataFrame:
    """source, source_size, target, whole (full copies), threshold (last hash of the partial copy; -1: none)."""
    sizes = [(r["source"], r["n"]) for r in row.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    targets = capped_targets(sizes, weights, cap)
    plan = [(n, s, t, int(t // s) if s else 0) for n, s, t in targets]
    table = spark.createDataFrame([(n, s, t, w, t - w * s) for n, s, t, w in plan],
                                  "source string, source_size long, target double, whole int, budget double")
    small = len(plan) <= MAX_BROADCAST_SOURCES
    hint = F.broadcast if small else (lambda x: x)
    state = table.withColumns({"lo": F.lit(0).cast("long"), "below": F.lit(0).cast("long")})
    shift = LEVEL_BITS * LEVELS
    for _ in range(LEVELS):
        # rows of the boundary bucket [lo, lo + 2^shift) of each source, histogrammed by the next bits
        shift -= LEVEL_BITS
        here = row.join(hint(state.select(F.col("source").alias("s"), "lo")), F.col("source").eqNullSafe(F.col("s")))
        here = here.filter(F.shiftright("h", shift + LEVEL_BITS) == F.shiftright("lo", shift + LEVEL_BITS))
        hist = here.groupBy("source", F.shiftright("h", shift).alias("b")).agg(F.sum("size").alias("n"))
        hist = hist.join(hint(state.select(F.col("source").alias("s"), "below", "budget")),
                         F.col("source").eqNullSafe(F.col("s"))).drop("s")
        run = F.sum("n").over(W.partitionBy("source").orderBy("b").rowsBetween(W.unboundedPreceding, 0))
        # the first bucket whose running sum passes the budget; none passes: the last one
        cross = (hist.withColumn("upto", F.col("below") + run)
                 .groupBy("source").agg(
                     F.min_by(F.struct("b", "upto", "n"),
                              F.when(F.col("upto") > F.col("budget"), F.col("b"))).alias("x"),
                     F.max_by(F.struct("b", "upto", "n"), "b").alias("y"), F.first("budget").alias("budget"))
                 .select("source", "budget", F.coalesce("x", "y").alias("x"))
                 .select("source", "budget", F.shiftleft("x.b", shift).alias("lo"),
                         (F.col("x.upto") - F.col("x.n")).alias("below"), F.col("x.n").alias("n")))
        state = spark.createDataFrame(cross.collect(), "source string, budget double, lo long, below long, n long")
    # lo is now one hash value: take it too if that ends nearer the budget
    nearer = F.col("below") + F.col("n") - F.col("budget") < F.col("budget") - F.col("below")
    end = F.when(F.col("budget") <= 0, -1).when(nearer, F.col("lo")).otherwise(F.col("lo") - 1).cast("long")
    last = state.select(F.col("source").alias("s"), end.alias("threshold"))
    plan_df = table.join(hint(last), F.col("source").eqNullSafe(F.col("s")), "left")
    out = plan_df.select("source", "source_size", "target", "whole",
                         F.coalesce("threshold", F.lit(-1).cast("long")).alias("threshold"))
    rows = out.collect()
    out = spark.createDataFrame(rows, "source string, source_size long, target double, whole int, threshold long")
    return F.broadcast(out) if small else out
