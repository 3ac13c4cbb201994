"""Availability / workload features (family G): row expressions over the lags.

Every comparison is coalesced to False *before* it is combined with
AND / OR (pandas: a NaN comparison is False), so flags are 0/1, never null.
Expressions are Spark SQL text chained through a :class:`ColumnSet`;
``availability_chain`` adds the whole family in one projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import spec as S
from ..functions import column_set, has
from ..functions import sqltext as X

TIER_EDGES = (0, 0.6, 0.8, 1.0)


def _games(max_games) -> str:
    """Scalar season length, or the name of a column holding the per-row season length."""
    return X.q(max_games) if isinstance(max_games, str) else X.d(max_games)


def games_played_features(df: DataFrame, max_games=S.MAX_GAMES) -> DataFrame:
    cs, done = column_set(df)
    if not has(cs, "GP"):
        return done(cs)
    c, g = cs.col, _games(max_games)
    gp = c("GP")
    cs.add("GP_RATE_CURRENT", f"{gp} / {g}")
    cs.add("GAMES_MISSED", f"{g} - {gp}")
    cs.add("HIGH_AVAILABILITY", X.flag(f"{gp} >= 70"))
    cs.add("MEDIUM_AVAILABILITY", X.flag(f"{gp} >= 50 AND {gp} < 70"))
    cs.add("LOW_AVAILABILITY", X.flag(f"{gp} < 50"))
    for k in (1, 2, 3):
        if has(cs, f"GP_LAG{k}"):
            cs.add(f"GP_LAG{k}_RATE", f"{c(f'GP_LAG{k}')} / {g}")
            cs.add(f"MISSED_GAMES_LAG{k}", f"{g} - {c(f'GP_LAG{k}')}")
    return done(cs)


def availability_trend(df: DataFrame) -> DataFrame:
    cs, done = column_set(df)
    c = cs.col
    if has(cs, "GP_LAG1", "GP_LAG2"):
        cs.add("GP_TREND", f"{c('GP_LAG1')} - {c('GP_LAG2')}")
        cs.add("GP_IMPROVING", X.flag(f"{c('GP_TREND')} > 5"))
        cs.add("GP_DECLINING", X.flag(f"{c('GP_TREND')} < -5"))
        cs.add("GP_AVG_2YR", f"({c('GP_LAG1')} + {c('GP_LAG2')}) / 2")
    if has(cs, "GP_LAG1", "GP_LAG2", "GP_LAG3"):
        cs.add("GP_AVG_3YR", f"({c('GP_LAG1')} + {c('GP_LAG2')} + {c('GP_LAG3')}) / 3")
    if has(cs, "GP_STD3"):
        cs.add("GP_CONSISTENCY", c("GP_STD3"))
        cs.add("HIGHLY_CONSISTENT_AVAILABILITY", X.flag(f"{c('GP_STD3')} < 10"))
    return done(cs)


def injury_proxy(df: DataFrame) -> DataFrame:
    cs, done = column_set(df)
    c = cs.col
    if has(cs, "AGE"):
        cs.add("AGE_INJURY_RISK", X.clip(f"({c('AGE')} - 25) / 10", lower=0.0))
    if has(cs, "AGE", "GP_LAG1"):
        cs.add("VETERAN_INJURY_RISK", X.flag(f"{X.b(c('AGE') + ' > 30')} AND {X.b(c('GP_LAG1') + ' < 65')}"))
    if has(cs, "MIN"):
        cs.add("HEAVY_MINUTES_LOAD", X.flag(f"{c('MIN')} > 34"))
        if has(cs, "AGE"):
            cs.add("AGE_MINUTES_RISK", f"({c('AGE')} / 10) * ({c('MIN')} / 48)")
    if has(cs, "GP_LAG1", "GP_LAG2", "GP_LAG3"):
        cs.add("INJURY_PRONE_PATTERN", X.flag(f"{X.b(c('GP_LAG1') + ' < 67')} AND {X.b(c('GP_LAG2') + ' < 67')}"))
    if has(cs, "GP_LAG1", "GP_LAG2"):
        cs.add("MAJOR_GP_DROP", X.flag(f"({c('GP_LAG2')} - {c('GP_LAG1')}) > 20"))
        cs.add("RECOVERY_YEAR", X.flag(f"{X.b(c('GP_LAG2') + ' < 50')} AND {X.b(c('GP_LAG1') + ' > 60')}"))
    return done(cs)


def workload_features(df: DataFrame, usage_threshold: float = 28.0) -> DataFrame:
    cs, done = column_set(df)
    c = cs.col
    if has(cs, "GP", "MIN"):
        cs.add("TOTAL_MINUTES", f"{c('GP')} * {c('MIN')}")
        t = c("TOTAL_MINUTES")
        cs.add("HIGH_WORKLOAD", X.flag(f"{t} > 2500"))
        cs.add("MEDIUM_WORKLOAD", X.flag(f"{t} >= 1500 AND {t} <= 2500"))
        cs.add("LOW_WORKLOAD", X.flag(f"{t} < 1500"))
    if has(cs, "GP_LAG1", "MIN_LAG1", "GP_LAG2", "MIN_LAG2"):
        cs.add("WORKLOAD_LAG1", f"{c('GP_LAG1')} * {c('MIN_LAG1')}")
        cs.add("WORKLOAD_LAG2", f"{c('GP_LAG2')} * {c('MIN_LAG2')}")
        cs.add("WORKLOAD_TREND", f"{c('WORKLOAD_LAG1')} - {c('WORKLOAD_LAG2')}")
        cs.add("INCREASING_WORKLOAD", X.flag(f"{c('WORKLOAD_TREND')} > 200"))
    if has(cs, "ADV_USG_PCT", "MIN"):
        cs.add("USAGE_MINUTES_PRODUCT", f"{c('ADV_USG_PCT')} * {c('MIN')}")
        cs.add("HIGH_USAGE_HIGH_MINUTES",
               X.flag(f"{X.b(c('ADV_USG_PCT') + ' > ' + X.d(usage_threshold))} AND {X.b(c('MIN') + ' > 33')}"))
    return done(cs)


def rest_recovery(df: DataFrame) -> DataFrame:
    cs, done = column_set(df)
    c = cs.col
    if has(cs, "MIN_LAG1", "MIN_LAG2"):
        cs.add("MIN_CHANGE", f"{c('MIN_LAG1')} - {c('MIN_LAG2')}")
        cs.add("REDUCED_MINUTES", X.flag(f"{c('MIN_CHANGE')} < -3"))
        cs.add("INCREASED_MINUTES", X.flag(f"{c('MIN_CHANGE')} > 3"))
    if has(cs, "AGE", "GP_LAG1", "TEAM_W_PCT"):
        cs.add("LOAD_MANAGEMENT", X.flag(f"{X.b(c('AGE') + ' > 32')} AND {X.b(c('GP_LAG1') + ' < 70')} "
                                          f"AND {X.b(c('TEAM_W_PCT') + ' > 0.5D')}"))
    if has(cs, "GP_LAG1", "MIN_LAG1"):
        cs.add("RECOVERING_FROM_LOW_PLAY", X.flag(f"{X.b(c('GP_LAG1') + ' < 60')} OR {X.b(c('MIN_LAG1') + ' < 25')}"))
    return done(cs)


def availability_score(df: DataFrame, max_games=S.MAX_GAMES) -> DataFrame:
    """Weighted recent availability x age adjustment; tier (0,.6],(.6,.8],(.8,1] -> 1..3."""
    cs, done = column_set(df)
    c, g = cs.col, _games(max_games)
    parts = [f"{c(f'GP_LAG{k}')} / {g} * {X.d(w)}" for k, w in ((1, 0.5), (2, 0.3), (3, 0.2))
             if has(cs, f"GP_LAG{k}")]
    if not parts:
        return done(cs)
    score = " + ".join(parts)
    if has(cs, "AGE"):
        age = c("AGE")
        score = f"({score}) * (1.0D - {X.clip(f'({age} - 25) / 100', 0.0, 0.15)})"
    cs.add("AVAILABILITY_SCORE", score)
    cs.add("AVAILABILITY_TIER", X.cut(c("AVAILABILITY_SCORE"), TIER_EDGES))
    return done(cs)


def season_max_games_rate(df: DataFrame, games_by_period: dict[str, int] | None = None,
                          period: str = "SEASON", default: int = S.MAX_GAMES) -> DataFrame:
    """``GP / games in that period`` from a small configured period table (documented)."""
    games_by_period = games_by_period or S.SHORT_SEASON_GAMES
    cs, done = column_set(df)
    whens = " ".join(f"WHEN {cs.col(period)} = '{k}' THEN {X.d(v)}" for k, v in games_by_period.items())
    cs.add("SEASON_MAX_GAMES", f"CASE {whens} ELSE {X.d(default)} END")
    cs.add("GP_RATE_ADJ", f"{cs.col('GP')} / {cs.col('SEASON_MAX_GAMES')}")
    return done(cs)


def availability_chain(df: DataFrame, max_games=S.MAX_GAMES) -> DataFrame:
    """All family-G features (one projection)."""
    cs, done = column_set(df)
    cs = games_played_features(cs, max_games)
    cs = availability_trend(cs)
    cs = injury_proxy(cs)
    cs = workload_features(cs)
    cs = rest_recovery(cs)
    return done(availability_score(cs, max_games))
