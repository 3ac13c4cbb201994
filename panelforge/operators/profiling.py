"""Aggregations and profiles (family D) and feature validation / selection (family H).

Wide profiles are ONE aggregate over all columns followed by ``unpivot`` to a
long (column, value...) table, never a job per column.  Only small,
schema-bounded results (a list of column names) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cols_if_present
from ..functions.sqltext import q
from ..spec import DEFAULT_SPEC, PanelSpec
from .cleaning import NUMERIC, numeric_columns
from .quantiles import column_moments, doubles, exact_quantiles


# --------------------------------------------------------------------------- D

def period_summary(df: DataFrame, stats: Sequence[str], period: str = "SEASON", entity: str = "PLAYER_ID") -> DataFrame:
    """Per period: number of entities and the mean of each chosen statistic."""
    stats = cols_if_present(df, stats)
    return df.groupBy(period).agg(F.count_distinct(entity).alias("n_entities"),
                                  *[F.avg(s).alias(f"avg_{s}") for s in stats])


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Frequency per value (nulls excluded, as pandas); optional share of non-null rows."""
    g = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = df.where(F.col(col).isNotNull()).count()          # one scalar
        g = g.select(col, "count", (F.col("count") / F.lit(float(total))).alias("share"))
    return g


def panel_overview(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows, distinct entities and periods, first and last period, mean age / experience."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_distinct(spec.entity).alias("entities"),
            F.count_distinct(spec.period).alias("periods"), F.min(spec.period).alias("first_period"),
            F.max(spec.period).alias("last_period")]
    for c in ("AGE", "YEARS_EXPERIENCE"):
        if c in df.columns:
            aggs.append(F.avg(c).alias(f"avg_{c}"))
    return df.agg(*aggs)


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear interpolation), max per column (long)."""
    cols = cols_if_present(df, cols)
    base = df.agg(*[x for c in cols for x in (
        F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
        F.min(F.col(c).cast("double")).alias(f"{c}__min"), F.max(F.col(c).cast("double")).alias(f"{c}__max"))]).first()
    qs = exact_quantiles(df, [(c, q) for c in cols for q in (0.25, 0.5, 0.75)])
    rows = [(c, int(base[f"{c}__count"]), base[f"{c}__mean"], base[f"{c}__std"], base[f"{c}__min"],
             qs[(c, 0.25)], qs[(c, 0.5)], qs[(c, 0.75)], base[f"{c}__max"]) for c in cols]
    schema = ("column string, count long, mean double, std double, min double, p25 double, p50 double, "
              "p75 double, max double")
    return df.sparkSession.createDataFrame(rows, schema)


def target_moments(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """mean / sample std / min / max per target, long form."""
    targets = cols_if_present(df, targets)
    wide = df.agg(*[x for t in targets for x in (
        F.avg(t).alias(f"{t}__mean"), F.stddev_samp(t).alias(f"{t}__std"),
        F.min(t).cast("double").alias(f"{t}__min"), F.max(t).cast("double").alias(f"{t}__max"))])
    items = [F.struct(F.lit(t).alias("target"), F.col(f"{t}__mean").alias("mean"), F.col(f"{t}__std").alias("std"),
                      F.col(f"{t}__min").alias("min"), F.col(f"{t}__max").alias("max")) for t in targets]
    return wide.select(F.explode(F.array(*items)).alias("m")).select("m.*")


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """Per column: missing count and pct of rows (ONE aggregate + unpivot); only > 0 by default.

    NaN is missing, as null is.
    """
    cols = list(cols or df.columns)
    real = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    gone = [f"{q(c)} IS NULL" + f" OR isnan({q(c)})" * (c in real) for c in cols]
    wide = df.selectExpr("count(1) AS __rows", *[f"count_if({x}) AS m{i}" for i, x in enumerate(gone)])
    items = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_count")) for i, c in enumerate(cols)]
    long = wide.select("__rows", F.explode(F.array(*items)).alias("e")).select(
        F.col("e.column").alias("column"), F.col("e.missing_count").alias("missing_count"),
        (F.col("e.missing_count") / F.col("__rows") * 100).alias("missing_pct"))
    return long.where(F.col("missing_count") > 0) if only_missing else long


def missing_severity(profile: DataFrame) -> DataFrame:
    """Number of columns with missing pct in (80, 100], (50, 80], (20, 50]."""
    p = F.col("missing_pct")
    return profile.agg(F.count_if(p > 80).alias("critical"), F.count_if((p > 50) & (p <= 80)).alias("high"),
                       F.count_if((p > 20) & (p <= 50)).alias("medium"))


def availability_breakdown(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Sum and share of each 0/1 flag (long)."""
    flags = cols_if_present(df, flags)
    wide = df.agg(*[x for f in flags for x in (F.sum(f).alias(f"{f}__n"), F.avg(f).alias(f"{f}__share"))])
    items = [F.struct(F.lit(f).alias("flag"), F.col(f"{f}__n").cast("long").alias("n"),
                      F.col(f"{f}__share").alias("share")) for f in flags]
    return wide.select(F.explode(F.array(*items)).alias("e")).select("e.*")


DEFAULT_RANGES = {"NEXT_PTS": (0.0, 50.0), "NEXT_MIN": (0.0, 48.0), "NEXT_FG_PCT": (0.0, 1.0)}


def target_range_check(df: DataFrame, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Count of rows outside each target's plausible [lo, hi] range."""
    ranges = {k: v for k, v in (ranges or DEFAULT_RANGES).items() if k in df.columns}
    wide = df.agg(*[F.count_if((F.col(t) > hi) | (F.col(t) < lo)).alias(t) for t, (lo, hi) in ranges.items()])
    items = [F.struct(F.lit(t).alias("target"), F.col(t).alias("out_of_range")) for t in ranges]
    return wide.select(F.explode(F.array(*items)).alias("e")).select("e.*")


def target_coverage(df: DataFrame, first_target: str) -> DataFrame:
    """Rows with and without the (first) target."""
    return df.agg(F.count_if(F.col(first_target).isNotNull()).alias("with_target"),
                  F.count_if(F.col(first_target).isNull()).alias("without_target"))


def _pair_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson r for all pairs of a few columns; null where a column is constant."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]

    def corr(a, b):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        return F.try_divide(F.covar_pop(a, b), F.stddev_pop(F.when(both, F.col(a))) * F.stddev_pop(F.when(both, F.col(b))))

    wide = df.agg(*[corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    items = [F.struct(F.lit(a).alias("feature1"), F.lit(b).alias("feature2"), F.col(f"c{i}").alias("correlation"))
             for i, (a, b) in enumerate(pairs)]
    return wide.select(F.explode(F.array(*items)).alias("e")).select("e.*")


def target_correlation_topk(df: DataFrame, targets: Sequence[str], k: int = 5) -> DataFrame:
    """Pearson over all target pairs, top ``k`` by correlation (descending)."""
    p = _pair_stats(df, cols_if_present(df, targets))
    return p.orderBy(F.col("correlation").desc_nulls_last(), "feature1", "feature2").limit(k)


def masked_correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson for MANY columns via masked sufficient statistics.

    Each task adds up, over its Arrow batches with value matrix X (nulls as 0)
    and null mask M, the matrices M'M, X'M, (X*X)'M and X'X and emits them
    once; a ``groupBy(i, j).sum`` shuffle reduces them, so no task ever holds
    more than one batch of rows.  Values are shifted by a per-column mean
    first for numerical stability.  A pair with an infinite value is NaN, as
    in pandas.
    """
    cols = list(cols)
    k = len(cols)
    # NaN counts as missing (pandas); values enter as doubles named v0..v{k-1}
    sel = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"v{i}")
                      for i, c in enumerate(cols)])
    means = sel.agg(*[F.avg(f"v{i}").alias(f"m{i}") for i in range(k)]).first()
    shift = np.nan_to_num(np.array([means[f"m{i}"] or 0.0 for i in range(k)], dtype="float64"), posinf=0.0, neginf=0.0)
    iu, ju = np.triu_indices(k, 1)

    def stats(batches):
        total = np.zeros((6, len(iu)))          # one set of sums for each task
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64", na_value=np.nan)
            m = (~np.isnan(x)).astype("float64")
            x = np.where(m > 0, x - shift, 0.0)
            with np.errstate(invalid="ignore"):
                mm, xm, x2m, xx = m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x
            total += [mm[iu, ju], xm[iu, ju], xm[ju, iu], x2m[iu, ju], x2m[ju, iu], xx[iu, ju]]
        yield pd.DataFrame({"i": iu, "j": ju, **dict(zip(("n", "sx", "sy", "sxx", "syy", "sxy"), total, strict=True))})

    schema = "i long, j long, n double, sx double, sy double, sxx double, syy double, sxy double"
    s = sel.mapInPandas(stats, schema).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in
                                                               ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n = F.col("n")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / n
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / n
    vy = F.col("syy") - F.col("sy") * F.col("sy") / n
    names = F.array(*[F.lit(c) for c in cols])
    r = F.when((n > 1) & (vx > 0) & (vy > 0), cov / F.sqrt(vx * vy))
    return s.select(F.element_at(names, F.col("i").cast("int") + 1).alias("feature1"),
                    F.element_at(names, F.col("j").cast("int") + 1).alias("feature2"), r.alias("correlation"))


def high_correlation_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Feature pairs with pairwise-complete |r| > threshold (informational); a NaN correlation is no pair."""
    r = F.abs("correlation")
    return masked_correlation(df, cols_if_present(df, cols)).where((r > threshold) & ~F.isnan(r)).select(
        "feature1", "feature2", r.alias("correlation"))


def career_totals(df: DataFrame, entity: str = "PLAYER_ID") -> DataFrame:
    """Per entity: total GP, MIN, PTS and number of periods."""
    return df.groupBy(entity).agg(F.sum("GP").cast("double").alias("CAREER_GP"), F.sum("MIN").alias("CAREER_MIN"),
                                  F.sum("PTS").alias("CAREER_PTS"), F.count(F.lit(1)).alias("SEASONS_PLAYED"))


def infinite_profile(df: DataFrame, cols: Sequence[str] | None = None, split: str = "split",
                     labels: Sequence[str] = ("train", "val", "pred")) -> DataFrame:
    """Count of +/-inf cells by the value of ``split``, in one pass; labels without rows have 0, other rows go."""
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
           and (cols is None or f.name in cols)]
    cells = " + ".join(["0L", *(f"IF(abs({q(c)}) = DOUBLE('Infinity'), 1L, 0L)" for c in dbl)])
    rows = df.where(F.col(split).isin(*labels)).selectExpr(f"{q(split)} AS split", f"{cells} AS inf_cells")
    none = df.sparkSession.createDataFrame([(x, 0) for x in labels], "split string, inf_cells long")
    return rows.unionByName(none).groupBy("split").agg(F.sum("inf_cells").alias("inf_cells"))


def feature_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean over features of the mean |x| and of the sample std of each column; NaN counts as missing.

    One pass over all columns; a column with an infinite value makes both infinite.
    """
    cols = cols_if_present(df, cols)
    n, size, std = column_moments(df, cols)
    size = [x for x, k in zip(size, n, strict=True) if k]
    std = [x * (k / (k - 1)) ** 0.5 for x, k in zip(std, n, strict=True) if k > 1]
    return df.sparkSession.createDataFrame(
        [(sum(size) / len(size) if size else None, sum(std) / len(std) if std else None)],
        "mean_abs_mean double, mean_std double")


# --------------------------------------------------------------------------- H

def high_missing_columns(df: DataFrame, threshold: float = 90.0, protect: Sequence[str] = ()) -> list[str]:
    prof = missing_profile(df).where(F.col("missing_pct") > threshold).collect()   # one row per column
    return [r["column"] for r in prof if r["column"] not in set(protect)]


def drop_high_missing(df: DataFrame, threshold: float = 90.0, protect: Sequence[str] = ()) -> DataFrame:
    """Drop non-target columns with missing pct > threshold."""
    return df.drop(*high_missing_columns(df, threshold, protect))


def constant_columns(df: DataFrame, exclude: Sequence[str] = (), top_share: float = 0.99) -> list[str]:
    """Numeric columns with one distinct value, or <= 2 distinct whose top non-null share > top_share.

    One pass over the numbers as Arrow batches: a task counts the values of
    every column until it has met three of one, which settles that column, so
    it holds and emits three numbers a column at most.  No ``countDistinct``
    (which would expand the input once per column).  NaN is a value; the two
    zeros are one.  Booleans are not examined (pandas ``np.number``).
    """
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in set(exclude)]
    if not cols:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[dict[float | None, int]] = [{} for _ in cols]         # None: NaN
        for b in batches:
            for own, column in zip(seen, b.columns, strict=True):
                if len(own) > 2:
                    continue
                x = column.drop_null().to_numpy(zero_copy_only=False) + 0.0
                first = set(x[:64][~np.isnan(x[:64])].tolist())
                if len(first) > 2:                                  # most columns end here
                    own |= dict.fromkeys(first, 0)
                    continue
                values, counts = np.unique(x, return_counts=True)
                for v, k in zip(values.tolist(), counts.tolist(), strict=True):
                    v = None if v != v else v
                    own[v] = own.get(v, 0) + k
        cells = [(i, v != v, 0.0 if v != v else v, k) for i, own in enumerate(seen)
                 for v, k in [(float("nan") if v is None else v, k) for v, k in own.items()][:3]]
        parts = list(zip(*cells, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts[0], pa.int32()), pa.array(parts[1], pa.bool_()), pa.array(parts[2], pa.float64()),
             pa.array(parts[3], pa.int64())], names=["col", "nan", "value", "n"])

    got = doubles(df, cols).mapInArrow(run, "col int, nan boolean, value double, n long")
    each = got.groupBy("col", "nan", "value").agg(F.sum("n").alias("n"))
    few = each.groupBy("col").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("top"), F.sum("n").alias("n"),
                                  F.bool_or("nan").alias("nan")).where("k <= 2").collect()      # a row a column
    by = {r["col"]: r for r in few}
    const = [i for i in sorted(by) if by[i]["k"] == 1 and not by[i]["nan"]]
    low = [i for i in sorted(by) if i not in const and by[i]["top"] / by[i]["n"] > top_share]
    return [cols[i] for i in const + low]


def drop_constant_features(df: DataFrame, exclude: Sequence[str] = (), top_share: float = 0.99) -> DataFrame:
    return df.drop(*constant_columns(df, exclude, top_share))


def separate_columns(df: DataFrame, targets: Sequence[str], metadata: Sequence[str], keys: Sequence[str] = ()
                     ) -> dict[str, DataFrame]:
    """Split into features / targets / metadata frames; ``keys`` are in each, so that rows can be matched again."""
    t = [c for c in df.columns if c in set(targets)]
    m = [c for c in df.columns if c in set(metadata)]
    f = [c for c in df.columns if c not in set(t) | set(m)]
    own = lambda cols: df.select(*keys, *[c for c in cols if c not in set(keys)])
    return {"features": own(f), "targets": own(t), "metadata": own(m)}


def validate_types(df: DataFrame) -> DataFrame:
    """Type of every column and exact distinct count of text columns (long: column, type, n_distinct).

    The distinct (column, value) pairs are counted in one pass, without a distinct aggregate for each column.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                            "column string, type string")
    if not text:
        return types.withColumn("n_distinct", F.lit(None).cast("long"))
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value"))
                                           for c in text])).alias("e")).select("e.*").distinct()
    n = values.groupBy("column").agg(F.count("value").alias("n_distinct"))
    return types.join(F.broadcast(n), "column", "left")             # one row for each column


def split_has_target(df: DataFrame, first_target: str) -> tuple[DataFrame, DataFrame]:
    """Training rows (first target present) and prediction rows (absent)."""
    return df.where(F.col(first_target).isNotNull()), df.where(F.col(first_target).isNull())
