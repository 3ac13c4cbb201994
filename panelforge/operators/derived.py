"""Derived row-level features (family F).

Pure row expressions, added only for the inputs that exist (plan-time
``has`` guard).  Called on a DataFrame a function adds its columns in one
``selectExpr``; called on a :class:`ColumnSet` it chains, and
``derived_chain`` materializes the whole family in a single projection.
Guarded divisions give null on a zero denominator; the divisions the
reference leaves unguarded give +/-inf (replaced by 0 in preparation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import spec as S
from ..functions import column_set, has
from ..functions import sqltext as X

# Bin edges and thresholds.
AGE_EDGES = (0, 23, 27, 30, 33, 100)
HEIGHT_EDGES = (0, 75, 79, 82, 100)
WEIGHT_EDGES = (0, 190, 220, 250, 400)
LEAGUE_PACE = 100.0
LEAGUE_RATING = 110.0


def age_features(df: DataFrame) -> DataFrame:
    """``AGE_SQUARED``, ``IN_PRIME`` 27..30, ``IS_YOUNG`` < 25, ``IS_VETERAN`` > 32, ``AGE_BIN`` 1..5."""
    cs, done = column_set(df)
    if has(cs, "AGE"):
        a = cs.col("AGE")
        cs.add("AGE_SQUARED", f"power({a}, 2.0D)")
        cs.add("IN_PRIME", X.flag(f"{a} >= 27 AND {a} <= 30"))
        cs.add("IS_YOUNG", X.flag(f"{a} < 25"))
        cs.add("IS_VETERAN", X.flag(f"{a} > 32"))
        cs.add("AGE_BIN", X.cut(a, AGE_EDGES))
    return done(cs)


def efficiency_features(df: DataFrame, max_games: int = S.MAX_GAMES) -> DataFrame:
    cs, done = column_set(df)
    c = cs.col
    if has(cs, "PTS", "MIN"):
        cs.add("PTS_PER_MIN", X.safe_div(c("PTS"), c("MIN")))
    if has(cs, "AST", "TOV"):
        cs.add("AST_TO_RATIO", X.safe_div(c("AST"), c("TOV")))
    if has(cs, "PTS", "FGA", "FTA"):
        cs.add("PTS_PER_ATTEMPT", X.safe_div(c("PTS"), f"({c('FGA')} + 0.44D * {c('FTA')})"))
    if has(cs, "ADV_TS_PCT"):
        cs.add("SHOOTING_EFFICIENCY", c("ADV_TS_PCT"))
    elif has(cs, "PTS", "FGA", "FTA"):
        cs.add("SHOOTING_EFFICIENCY", X.safe_div(c("PTS"), f"(2.0D * ({c('FGA')} + 0.44D * {c('FTA')}))"))
    if has(cs, "MIN", "GP"):
        cs.add("MPG", c("MIN"))
        cs.add("GP_RATE", f"{c('GP')} / {X.d(max_games)}")
    return done(cs)


def role_features(df: DataFrame) -> DataFrame:
    cs, done = column_set(df)
    c = cs.col
    if has(cs, "ADV_USG_PCT"):
        cs.add("USAGE_RATE", c("ADV_USG_PCT"))
    if has(cs, "FGA", "MIN"):
        cs.add("FGA_PER_MIN", X.safe_div(c("FGA"), c("MIN")))
    if has(cs, "FG3A"):
        cs.add("THREE_PT_VOLUME", c("FG3A"))
        if has(cs, "FGA"):
            cs.add("THREE_PT_RATE", X.safe_div(c("FG3A"), c("FGA")))
    if has(cs, "FGA", "PTS"):
        cs.add("SCORER_ROLE", X.flag(f"{c('FGA')} > 12"))
    if has(cs, "AST"):
        cs.add("PLAYMAKER_ROLE", X.flag(f"{c('AST')} > 4"))
    if has(cs, "REB"):
        cs.add("REBOUNDER_ROLE", X.flag(f"{c('REB')} > 7"))
    if has(cs, "STL", "BLK"):
        cs.add("DEFENSIVE_STATS", f"{c('STL')} + {c('BLK')}")
        cs.add("DEFENDER_ROLE", X.flag(f"{c('DEFENSIVE_STATS')} > 2"))
    return done(cs)


def team_context_features(df: DataFrame) -> DataFrame:
    cs, done = column_set(df)
    c = cs.col
    if has(cs, "TEAM_PACE"):
        cs.add("PACE_ADJUSTMENT", f"{c('TEAM_PACE')} / {X.d(LEAGUE_PACE)}")
        for s in ("PTS", "AST", "REB"):
            if has(cs, s):
                cs.add(f"{s}_PACE_ADJ", X.raw_div(c(s), c("PACE_ADJUSTMENT")))
    if has(cs, "TEAM_W_PCT"):
        cs.add("ON_WINNING_TEAM", X.flag(f"{c('TEAM_W_PCT')} > 0.5D"))
        cs.add("ON_PLAYOFF_TEAM", X.flag(f"{c('TEAM_W_PCT')} > 0.45D"))
    if has(cs, "TEAM_OFF_RATING"):
        cs.add("TEAM_OFF_STRENGTH", f"{c('TEAM_OFF_RATING')} - {X.d(LEAGUE_RATING)}")
    if has(cs, "TEAM_DEF_RATING"):
        cs.add("TEAM_DEF_STRENGTH", f"{X.d(LEAGUE_RATING)} - {c('TEAM_DEF_RATING')}")
    if has(cs, "TEAM_NET_RATING"):
        cs.add("TEAM_NET_RATING_ABS", f"abs({c('TEAM_NET_RATING')})")
    return done(cs)


INTERACTIONS = (
    ("AGE", "ADV_USG_PCT", "AGE_USAGE_INTERACTION"),
    ("MIN", "ADV_TS_PCT", "MIN_EFFICIENCY_INTERACTION"),
    ("TEAM_PACE", "ADV_USG_PCT", "PACE_USAGE_INTERACTION"),
    ("AGE", "TEAM_W_PCT", "AGE_TEAM_QUALITY"),
    ("YEARS_EXPERIENCE", "MIN", "EXP_MIN_INTERACTION"),
)


def interaction_features(df: DataFrame) -> DataFrame:
    cs, done = column_set(df)
    for a, b, n in INTERACTIONS:
        if has(cs, a, b):
            cs.add(n, f"{cs.col(a)} * {cs.col(b)}")
    return done(cs)


def position_categories(df: DataFrame, col: str = "POSITION") -> list[str]:
    """Distinct observed categories (fit on the training data; bounded by the category count)."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


def position_one_hot(df: DataFrame, categories: Sequence[str], col: str = "POSITION") -> DataFrame:
    """One boolean ``POS_<value>`` per category; null -> all False.

    Categories are passed in (fixed from the training data) so the schema does
    not depend on the rows being scored.
    """
    cs, done = column_set(df)
    if has(cs, col):
        for v in categories:
            lit = "'" + v.replace("'", "''") + "'"
            cs.add(f"POS_{v}", X.b(f"{cs.col(col)} = {lit}"))
    return done(cs)


def position_groups(df: DataFrame, col: str = "POSITION") -> DataFrame:
    """``IS_GUARD/FORWARD/CENTER``: position contains G / F / C (case-sensitive, null -> 0)."""
    cs, done = column_set(df)
    if has(cs, col):
        p = cs.col(col)
        cs.add("IS_GUARD", X.flag(f"contains({p}, 'G')"))
        cs.add("IS_FORWARD", X.flag(f"contains({p}, 'F')"))
        cs.add("IS_CENTER", X.flag(f"contains({p}, 'C')"))
    return done(cs)


def physical_features(df: DataFrame) -> DataFrame:
    cs, done = column_set(df)
    c = cs.col
    if has(cs, "HEIGHT_INCHES", "WEIGHT"):
        h2 = f"power({c('HEIGHT_INCHES')}, 2.0D)"
        cs.add("BMI", f"({X.raw_div(c('WEIGHT'), h2)}) * 703.0D")
    if has(cs, "HEIGHT_INCHES"):
        cs.add("HEIGHT_CAT", X.cut(c("HEIGHT_INCHES"), HEIGHT_EDGES))
    if has(cs, "WEIGHT"):
        cs.add("WEIGHT_CAT", X.cut(c("WEIGHT"), WEIGHT_EDGES))
    return done(cs)


def team_derived_stats(df: DataFrame) -> DataFrame:
    """Team-table ratios, each only if absent: TS_PCT, FG3A_RATE, AST_RATIO, TOV_RATE, REB_PCT."""
    cs, done = column_set(df)
    c = cs.col
    if not has(cs, "TS_PCT") and has(cs, "PTS", "FGA", "FTA"):
        cs.add("TS_PCT", X.raw_div(c("PTS"), f"2.0D * ({c('FGA')} + 0.44D * {c('FTA')})"))
    if not has(cs, "FG3A_RATE") and has(cs, "FG3A", "FGA"):
        cs.add("FG3A_RATE", X.raw_div(c("FG3A"), c("FGA")))
    if not has(cs, "AST_RATIO") and has(cs, "AST", "FGA", "FTA", "OREB_PCT", "FGM", "TOV"):
        den = f"{c('FGA')} + 0.44D * {c('FTA')} - {c('OREB_PCT')} * ({c('FGA')} - {c('FGM')}) + {c('TOV')}"
        cs.add("AST_RATIO", f"100.0D * {X.raw_div(c('AST'), den)}")
    if not has(cs, "TOV_RATE"):
        if has(cs, "TM_TOV_PCT"):
            cs.add("TOV_RATE", c("TM_TOV_PCT"))
        elif has(cs, "TOV", "FGA", "FTA"):
            den = f"{c('FGA')} + 0.44D * {c('FTA')} + {c('TOV')}"
            cs.add("TOV_RATE", f"100.0D * {X.raw_div(c('TOV'), den)}")
    if not has(cs, "REB_PCT") and has(cs, "OREB_PCT"):
        cs.add("REB_PCT", c("OREB_PCT"))
    return done(cs)


def derived_chain(df: DataFrame, positions: Sequence[str] | None = None, max_games: int = S.MAX_GAMES) -> DataFrame:
    """All family-F features in the reference's stage order (one projection)."""
    cs, done = column_set(df)
    cs = age_features(cs)
    cs = efficiency_features(cs, max_games)
    cs = role_features(cs)
    cs = team_context_features(cs)
    cs = interaction_features(cs)
    if positions is not None:
        cs = position_one_hot(cs, positions)
    cs = position_groups(cs)
    return done(physical_features(cs))
