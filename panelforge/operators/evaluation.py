"""Baselines, metrics and model comparison (family J) plus sort / top-k helpers (family M).

Predictions travel as a *long* table ``(keys..., target, model, prediction,
actual)``: every model family and baseline lands in the same shape, metrics
are one ``groupBy(model, target)`` with map-side partial aggregation, and
nothing relies on row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import cols_if_present, has
from ..spec import DEFAULT_SPEC, PanelSpec
from .bounded import join_small
from .quantiles import exact_quantiles


def _target_pairs(df: DataFrame, spec: PanelSpec) -> list[tuple[str, str]]:
    """(target, current stat) pairs whose target column exists."""
    return [(f"NEXT_{s}", s) for s in spec.target_stats if has(df, f"NEXT_{s}")]


def to_long(df: DataFrame, preds: Sequence[tuple[str, object]], model: str, spec: PanelSpec = DEFAULT_SPEC,
            keys: Sequence[str] | None = None) -> DataFrame:
    """Stack per-target prediction expressions into the long prediction table."""
    keys = list(keys or spec.keys)
    items = [F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("actual"),
                      (p if not isinstance(p, str) else F.col(p)).cast("double").alias("prediction"))
             for t, p in preds]
    return df.select(*keys, F.explode(F.array(*items)).alias("_p")).select(
        *keys, F.col("_p.target").alias("target"), F.lit(model).alias("model"),
        F.col("_p.prediction").alias("prediction"), F.col("_p.actual").alias("actual"))


def baseline_lag1(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, model: str = "Baseline_LAG1") -> DataFrame:
    """Prediction = ``<s>_LAG1``, or current ``<s>`` when the lag *column* is absent."""
    preds = [(t, f"{s}_LAG1" if has(df, f"{s}_LAG1") else s) for t, s in _target_pairs(df, spec) if has(df, s)]
    return to_long(df, preds, model, spec)


def baseline_persistence(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, model: str = "Baseline_Persistence") -> DataFrame:
    """Prediction = current ``<s>`` (next period = this period)."""
    return to_long(df, [(t, s) for t, s in _target_pairs(df, spec) if has(df, s)], model, spec)


def baseline_multi_year(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, model: str = "Baseline_3yr") -> DataFrame:
    """First existing column of ``_AVG3``, ``_AVG2``, ``_LAG1``, current; else target median.

    The choice is per column (plan time), not per row.
    """
    preds, need_median = [], []
    for t, s in _target_pairs(df, spec):
        for cand in (f"{s}_AVG3", f"{s}_AVG2", f"{s}_LAG1", s):
            if has(df, cand):
                preds.append((t, cand))
                break
        else:
            need_median.append(t)
    if need_median:
        med = exact_quantiles(df, [(t, 0.5) for t in need_median])
        preds += [(t, F.lit(med[(t, 0.5)])) for t in need_median]
    return to_long(df, preds, model, spec)


def group_mean_train(train: DataFrame, stats: Sequence[str], group: str = "POSITION") -> DataFrame:
    """Mean of each current statistic per group on the training rows (null group is a group)."""
    return train.groupBy(group).agg(*[F.avg(s).alias(s) for s in cols_if_present(train, stats)])


def baseline_group_average(val: DataFrame, train: DataFrame, spec: PanelSpec = DEFAULT_SPEC,
                           group: str = "POSITION", model: str = "Baseline_Position") -> DataFrame:
    """Training-period group mean of the current stat, joined on the group key.

    Rows whose group is null or unseen take the median of the validation
    target (the reference's fallback).  Joined on the key, not by row index.
    """
    pairs = [(t, s) for t, s in _target_pairs(val, spec) if has(train, s)]
    med = exact_quantiles(val, [(t, 0.5) for t, _ in pairs])
    if not has(val, group):
        return to_long(val, [(t, F.lit(med[(t, 0.5)])) for t, _ in pairs], model, spec)
    means = group_mean_train(train, [s for _, s in pairs], group).where(F.col(group).isNotNull())
    means = means.select(group, *[F.col(s).alias(f"__gm_{s}") for _, s in pairs])
    j = join_small(val, means, [group], derived=True)
    preds = [(t, F.coalesce(F.col(f"__gm_{s}"), F.lit(med[(t, 0.5)]))) for t, s in pairs]
    return to_long(j, preds, model, spec)


def _scored(pred: DataFrame) -> DataFrame:
    """Rows with both values, where NaN counts as missing."""
    ok = F.lit(True)
    for c in ("prediction", "actual"):
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return pred.where(ok)


def regression_metrics(pred: DataFrame, by: Sequence[str] = ("model", "target")) -> DataFrame:
    """MAE, RMSE, R2, MAPE per (model, target) over rows where both values exist.

    MAPE (x100) skips zero actuals.  SST is n * population variance of the
    actuals, so R2 = 1 - SSE / SST (null when SST = 0).
    """
    e = F.col("actual") - F.col("prediction")
    return _scored(pred).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("MAE"),
        F.sqrt(F.avg(e * e)).alias("RMSE"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop("actual") * F.count(F.lit(1)))).alias("R2"),
        (F.avg(F.abs(F.try_divide(e, F.nullif(F.col("actual"), F.lit(0.0))))) * 100).alias("MAPE"),
    )


def mape(pred: DataFrame, by: Sequence[str] = ("model", "target")) -> DataFrame:
    """Mean absolute percentage error x100; zero actuals excluded."""
    e = F.col("actual") - F.col("prediction")
    return _scored(pred).groupBy(*by).agg((F.avg(F.abs(F.try_divide(e, F.nullif(F.col("actual"), F.lit(0.0))))) * 100).alias("MAPE"))


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """Per model: mean MAE, mean R2, min and max MAE over targets."""
    return metrics.groupBy("model").agg(
        F.avg("MAE").alias("avg_MAE"), F.avg("R2").alias("avg_R2"),
        F.min("MAE").alias("min_MAE"), F.max("MAE").alias("max_MAE"))


# Metric values closer than this are ties: two approaches with identical predictions get
# MAEs that differ only by floating-point summation order.
TIE_DECIMALS = 12


def _tie_key(c):
    return F.round(c, TIE_DECIMALS)


def improvement_vs_baseline(metrics: DataFrame, model: str, baseline: str) -> DataFrame:
    """Per target ``(baseline - model) / baseline * 100`` and a win flag (a tie is no win)."""
    m = metrics.where(F.col("model") == model).select("target", F.col("MAE").alias("model_MAE"))
    b = metrics.where(F.col("model") == baseline).select("target", F.col("MAE").alias("baseline_MAE"))
    j = m.join(b, "target")
    return j.select("target", "model_MAE", "baseline_MAE",
                    (F.try_divide(F.col("baseline_MAE") - F.col("model_MAE"), F.nullif(F.col("baseline_MAE"), F.lit(0.0))) * 100)
                    .alias("improvement_pct"),
                    F.coalesce(_tie_key(F.col("model_MAE")) < _tie_key(F.col("baseline_MAE")), F.lit(False))
                    .cast("int").alias("win"))


def improvement_summary(improvement: DataFrame) -> DataFrame:
    """Mean improvement and number of wins over targets."""
    return improvement.agg(F.avg("improvement_pct").alias("avg_improvement_pct"),
                           F.sum("win").cast("long").alias("wins"), F.count(F.lit(1)).alias("n_targets"))


def best_model_per_target(metrics: DataFrame, model_order: Sequence[str] | None = None,
                          metric: str = "MAE") -> DataFrame:
    """Argmin of ``metric`` per target; nulls ignored; ties (to 1e-12) -> first in ``model_order``."""
    m = metrics.where(F.col(metric).isNotNull())
    if model_order:
        rank = F.create_map(*[x for i, n in enumerate(model_order) for x in (F.lit(n), F.lit(i))])
        ordk = F.coalesce(rank[F.col("model")], F.lit(len(model_order)))
    else:
        ordk = F.lit(0)
    key = F.struct(_tie_key(F.col(metric)), ordk, F.col("model"))
    return m.groupBy("target").agg(F.min_by(F.col("model"), key).alias("best_model"),
                                   F.min(F.col(metric)).alias(f"best_{metric}"))


def wins_by_approach(best: DataFrame, col: str = "best_model") -> DataFrame:
    """Number of targets won by each approach."""
    return best.groupBy(F.col(col).alias("approach")).agg(F.count(F.lit(1)).alias("wins"))


def wins_with_ties(metrics: DataFrame, metric: str = "MAE") -> DataFrame:
    """Targets on which no approach is better, for each approach: a tie counts for all that share it.

    Nulls and NaN are left out; the means are over the targets that an approach has a metric for.
    """
    m = metrics.where(F.col(metric).isNotNull() & ~F.isnan(F.col(metric)))
    least = F.min(_tie_key(F.col(metric))).over(Window.partitionBy("target"))      # one row for each approach
    m = m.withColumn("__won", (_tie_key(F.col(metric)) == least).cast("long"))
    return m.groupBy(F.col("model").alias("approach")).agg(
        F.sum("__won").alias("wins"), F.count(F.lit(1)).alias("n_targets"),
        F.avg(metric).alias(f"avg_{metric}"), F.avg("R2").alias("avg_R2"))


def best_overall_approach(metrics: DataFrame, metric: str = "MAE", model_order: Sequence[str] | None = None) -> DataFrame:
    """Approach with the least mean ``metric`` over targets (one row)."""
    avg = metrics.groupBy("model").agg(F.avg(metric).alias(f"avg_{metric}"))
    if model_order:
        rank = F.create_map(*[x for i, n in enumerate(model_order) for x in (F.lit(n), F.lit(i))])
        ordk = F.coalesce(rank[F.col("model")], F.lit(len(model_order)))
    else:
        ordk = F.lit(0)
    return avg.agg(F.min_by("model", F.struct(_tie_key(F.col(f"avg_{metric}")), ordk, F.col("model")))
                   .alias("best_approach"),
                   F.min(f"avg_{metric}").alias(f"best_avg_{metric}"))


# --- family M: sort / limit / top-k ---------------------------------------

def topk_by_column(df: DataFrame, col: str, k: int, ascending: bool = False,
                   tie: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows after a sort (planned as ``TakeOrderedAndProject``)."""
    o = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()
    return df.orderBy(o, *[F.col(t).asc() for t in tie]).limit(k)


def topk_per_group(df: DataFrame, group: str, col: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """Top ``k`` rows by ``col`` desc within each group (``row_number`` window)."""
    w = Window.partitionBy(group).orderBy(F.col(col).desc_nulls_last(), *[F.col(t).asc() for t in tie])
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def latest_row_per_entity(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, cols: Sequence[str] | None = None) -> DataFrame:
    """Most recent row per entity: ``max_by(struct, period)`` (partial aggregation, skew-safe)."""
    cols = [c for c in (cols or df.columns) if c != spec.entity]
    g = df.groupBy(spec.entity).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(spec.period)).alias("_r"))
    return g.select(spec.entity, *[F.col(f"_r.{c}").alias(c) for c in cols])


def first_matching_row(df: DataFrame, cond, order: Sequence[str], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """First row (by ``order``) satisfying ``cond``, unpivoted to (stat, current, next)."""
    row = df.where(cond).orderBy(*order).limit(1)
    items = [F.struct(F.lit(cur).alias("stat"), F.col(cur).cast("double").alias("current"),
                      F.col(nxt).cast("double").alias("next")) for cur, nxt in pairs]
    return row.select(*order, F.explode(F.array(*items)).alias("_s")).select(*order, "_s.*")
