"""Window / panel operators (family E).

All shifts are *positional*: partition by entity, order by period, and take
the next / previous existing row, so a missing period is bridged (the
reference's grouped ``shift``).  ``strict=True`` instead nulls a shift
unless the ordinal distance is exactly k.

Plan shape: every lead and lag is emitted in ONE ``select`` over ONE
``WindowSpec``, so the panel is exchanged once by entity and sorted once;
rolling, trend and consistency columns are plain arithmetic on those lags.
A panel has at most one row per (entity, period), so a window partition is
bounded by the number of periods, however hot an entity is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.window import Window

from .. import spec as S
from ..functions import cols_if_present, column_set, has
from ..functions import sqltext as X
from ..spec import DEFAULT_SPEC, PanelSpec


def _order_col(spec: PanelSpec, order_col: str | None) -> str:
    return order_col or spec.period


def panel_window(spec: PanelSpec = DEFAULT_SPEC, order_col: str | None = None):
    return Window.partitionBy(spec.entity).orderBy(_order_col(spec, order_col))


def _over(spec: PanelSpec, order_col: str | None) -> str:
    return f"OVER (PARTITION BY {X.q(spec.entity)} ORDER BY {X.q(_order_col(spec, order_col))})"


def _shift(c: str, k: int, spec: PanelSpec, order_col: str | None, strict: bool) -> str:
    """k > 0: lag by k rows; k < 0: lead by -k rows (SQL text)."""
    over = _over(spec, order_col)
    fn = "lag" if k > 0 else "lead"
    val = f"{fn}({X.q(c)}, {abs(k)}) {over}"
    if not strict:
        return val
    po = X.q(spec.period_order)
    other = f"{fn}({po}, {abs(k)}) {over}"
    return f"CASE WHEN abs({po} - {other}) = {abs(k)} THEN {val} END"


def create_targets(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, stats: Sequence[str] | None = None,
                   strict: bool = False, order_col: str | None = None) -> DataFrame:
    """``NEXT_<s> = lead(s, 1)`` per entity for each target statistic present."""
    stats = cols_if_present(df, stats or spec.target_stats)
    return df.selectExpr("*", *[f"{_shift(s, -1, spec, order_col, strict)} AS {X.q('NEXT_' + s)}" for s in stats])


def lag_columns(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, stats: Sequence[str] | None = None,
                periods: Sequence[int] | None = None, strict: bool = False,
                order_col: str | None = None) -> list[str]:
    stats = cols_if_present(df, stats or spec.lag_stats)
    periods = periods or spec.lag_periods
    return [f"{_shift(s, k, spec, order_col, strict)} AS {X.q(f'{s}_LAG{k}')}" for s in stats for k in periods]


def lag_features(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, stats: Sequence[str] | None = None,
                 periods: Sequence[int] | None = None, strict: bool = False,
                 order_col: str | None = None) -> DataFrame:
    """``<s>_LAG<k> = lag(s, k)`` for every lag statistic present, k in 1..3."""
    return df.selectExpr("*", *lag_columns(df, spec, stats, periods, strict, order_col))


def targets_and_lags(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, strict: bool = False,
                     order_col: str | None = None) -> DataFrame:
    """Targets and lags in one projection over one window (one exchange, one sort)."""
    tstats = cols_if_present(df, spec.target_stats)
    leads = [f"{_shift(s, -1, spec, order_col, strict)} AS {X.q('NEXT_' + s)}" for s in tstats]
    return df.selectExpr("*", *leads, *lag_columns(df, spec, None, None, strict, order_col))


def rolling_averages(df: DataFrame, stats: Sequence[str] = S.ROLLING_STATS) -> DataFrame:
    """``_AVG2``, ``_AVG3``, ``_WAVG`` from the lags; null if any term is null."""
    cs, done = column_set(df)
    for s in cols_if_present(cs, stats):
        if has(cs, f"{s}_LAG1", f"{s}_LAG2"):
            l1, l2 = cs.col(f"{s}_LAG1"), cs.col(f"{s}_LAG2")
            cs.add(f"{s}_AVG2", f"({l1} + {l2}) / 2")
        if has(cs, f"{s}_LAG1", f"{s}_LAG2", f"{s}_LAG3"):
            l3 = cs.col(f"{s}_LAG3")
            cs.add(f"{s}_AVG3", f"({l1} + {l2} + {l3}) / 3")
            cs.add(f"{s}_WAVG", f"0.5D * {l1} + 0.3D * {l2} + 0.2D * {l3}")
    return done(cs)


def trend_features(df: DataFrame, stats: Sequence[str] = S.TREND_STATS) -> DataFrame:
    """``_YOY_CHANGE = LAG1 - LAG2`` and ``_TREND = (LAG1 - LAG3) / 2``."""
    cs, done = column_set(df)
    c = cs.col
    for s in cols_if_present(cs, stats):
        if has(cs, f"{s}_LAG1", f"{s}_LAG2"):
            cs.add(f"{s}_YOY_CHANGE", f"{c(f'{s}_LAG1')} - {c(f'{s}_LAG2')}")
        if has(cs, f"{s}_LAG1", f"{s}_LAG2", f"{s}_LAG3"):
            cs.add(f"{s}_TREND", f"({c(f'{s}_LAG1')} - {c(f'{s}_LAG3')}) / 2")
    return done(cs)


def consistency_features(df: DataFrame, stats: Sequence[str] = S.CONSISTENCY_STATS) -> DataFrame:
    """``_STD3``: sample std of the non-null lags (needs two); ``_CV3 = STD3 / mean``, mean 0 -> null."""
    cs, done = column_set(df)
    for s in cols_if_present(cs, stats):
        lags = [f"{s}_LAG{k}" for k in (1, 2, 3)]
        if has(cs, *lags):
            cols = [cs.col(x) for x in lags]
            cs.add(f"{s}_STD3", X.row_std(cols))
            cs.add(f"{s}_CV3", f"try_divide({cs.col(f'{s}_STD3')}, NULLIF({X.row_mean(cols)}, 0.0D))")
    return done(cs)


def history_flags(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """``IS_ROOKIE`` (first LAG1 column null), ``IS_YOUNG_PLAYER`` (exp <= 2), ``HISTORICAL_SEASONS_AVAILABLE``."""
    cs, done = column_set(df)
    lag1 = [c for c in cs.columns if "_LAG1" in c]
    if lag1:
        cs.add("IS_ROOKIE", f"CAST({cs.col(lag1[0])} IS NULL AS INT)")
    if has(cs, "YEARS_EXPERIENCE"):
        cs.add("IS_YOUNG_PLAYER", X.flag(f"{cs.col('YEARS_EXPERIENCE')} <= 2"))
    avail = [f"CAST({cs.col(f'PTS_LAG{k}')} IS NOT NULL AS INT)" for k in (1, 2, 3) if has(cs, f"PTS_LAG{k}")]
    if avail:
        cs.add("HISTORICAL_SEASONS_AVAILABLE", " + ".join(avail))
    return done(cs)


def lag_chain(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, strict: bool = False,
              order_col: str | None = None, with_targets: bool = False) -> DataFrame:
    """Lags, rolling averages, trends, consistency, history flags (reference stage order)."""
    df = targets_and_lags(df, spec, strict, order_col) if with_targets else lag_features(
        df, spec, strict=strict, order_col=order_col)
    cs, done = column_set(df)               # one projection for everything after the window
    cs = rolling_averages(cs)
    cs = trend_features(cs)
    cs = consistency_features(cs)
    return done(history_flags(cs, spec))
