"""DuckDB expressions for the feature families (verification side).

Each function returns ``[(name, sql_expr), ...]`` for one family, written
against the columns of the ``lagged`` / ``chain`` CTEs.  A feature used by a
later feature of the same SELECT is written out again (no lateral aliases).
"""

from __future__ import annotations


def flag(cond: str) -> str:
    return f"CAST(coalesce({cond}, false) AS INTEGER)"


def b(cond: str) -> str:
    return f"coalesce({cond}, false)"


def sdiv(a: str, d: str) -> str:
    return f"({a}) / NULLIF({d}, 0)"


def rdiv(a: str, d: str) -> str:
    a, d = f"CAST({a} AS DOUBLE)", f"CAST({d} AS DOUBLE)"
    return (f"CASE WHEN {a} IS NULL OR {d} IS NULL THEN NULL WHEN {d} <> 0 THEN {a} / {d} "
            f"WHEN {a} > 0 THEN 'inf'::DOUBLE WHEN {a} < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END")


def cut(x: str, edges) -> str:
    whens = " ".join(f"WHEN {x} > {lo} AND {x} <= {hi} THEN {i + 1}.0::DOUBLE"
                     for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])))
    return f"CASE {whens} ELSE NULL::DOUBLE END"


def clip(x: str, lo=None, hi=None) -> str:
    out = f"CAST({x} AS DOUBLE)"
    if lo is not None:
        out = f"CASE WHEN {out} < {lo} THEN {lo}::DOUBLE ELSE {out} END"
    if hi is not None:
        out = f"CASE WHEN {out} > {hi} THEN {hi}::DOUBLE ELSE {out} END"
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE {out} END"


def nn_count(cols) -> str:
    return "(" + " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in cols) + ")"


def nn_mean(cols) -> str:
    n = nn_count(cols)
    s = " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in cols)
    return f"CASE WHEN {n} > 0 THEN ({s}) / {n} END"


def nn_std(cols) -> str:
    n = nn_count(cols)
    m = f"({nn_mean(cols)})"
    ss = " + ".join(f"coalesce(power(CAST({c} AS DOUBLE) - {m}, 2), 0.0)" for c in cols)
    return f"CASE WHEN {n} >= 2 THEN sqrt(({ss}) / ({n} - 1)) END"


# --- E ---------------------------------------------------------------------------------

def rolling():
    out = []
    for s in ("PTS", "AST", "REB", "STL", "BLK", "MIN", "TOV", "FG3M", "FGA", "FTA"):
        l1, l2, l3 = f"{s}_LAG1", f"{s}_LAG2", f"{s}_LAG3"
        out += [(f"{s}_AVG2", f"({l1} + {l2}) / 2"), (f"{s}_AVG3", f"({l1} + {l2} + {l3}) / 3"),
                (f"{s}_WAVG", f"0.5 * {l1} + 0.3 * {l2} + 0.2 * {l3}")]
    return out


def trend():
    out = []
    for s in ("PTS", "AST", "REB", "MIN", "FG_PCT", "ADV_TS_PCT"):
        out += [(f"{s}_YOY_CHANGE", f"{s}_LAG1 - {s}_LAG2"), (f"{s}_TREND", f"({s}_LAG1 - {s}_LAG3) / 2")]
    return out


def consistency():
    out = []
    for s in ("PTS", "MIN", "GP"):
        lags = [f"{s}_LAG{k}" for k in (1, 2, 3)]
        out += [(f"{s}_STD3", nn_std(lags)), (f"{s}_CV3", f"({nn_std(lags)}) / NULLIF({nn_mean(lags)}, 0)")]
    return out


def history():
    return [("IS_ROOKIE", "CAST(PTS_LAG1 IS NULL AS INTEGER)"),
            ("IS_YOUNG_PLAYER", flag("YEARS_EXPERIENCE <= 2")),
            ("HISTORICAL_SEASONS_AVAILABLE",
             " + ".join(f"CAST({f'PTS_LAG{k}'} IS NOT NULL AS INTEGER)" for k in (1, 2, 3)))]


# --- F ---------------------------------------------------------------------------------

def age():
    return [("AGE_SQUARED", "power(AGE, 2)"), ("IN_PRIME", flag("AGE >= 27 AND AGE <= 30")),
            ("IS_YOUNG", flag("AGE < 25")), ("IS_VETERAN", flag("AGE > 32")),
            ("AGE_BIN", cut("AGE", (0, 23, 27, 30, 33, 100)))]


def efficiency():
    return [("PTS_PER_MIN", sdiv("PTS", "MIN")), ("AST_TO_RATIO", sdiv("AST", "TOV")),
            ("PTS_PER_ATTEMPT", sdiv("PTS", "(FGA + 0.44 * FTA)")), ("SHOOTING_EFFICIENCY", "ADV_TS_PCT"),
            ("MPG", "MIN"), ("GP_RATE", "GP / 82.0")]


def role():
    return [("USAGE_RATE", "ADV_USG_PCT"), ("FGA_PER_MIN", sdiv("FGA", "MIN")), ("THREE_PT_VOLUME", "FG3A"),
            ("THREE_PT_RATE", sdiv("FG3A", "FGA")), ("SCORER_ROLE", flag("FGA > 12")),
            ("PLAYMAKER_ROLE", flag("AST > 4")), ("REBOUNDER_ROLE", flag("REB > 7")),
            ("DEFENSIVE_STATS", "STL + BLK"), ("DEFENDER_ROLE", flag("(STL + BLK) > 2"))]


def team_context():
    adj = "(TEAM_PACE / 100.0)"
    return [("PACE_ADJUSTMENT", "TEAM_PACE / 100.0"), ("PTS_PACE_ADJ", rdiv("PTS", adj)),
            ("AST_PACE_ADJ", rdiv("AST", adj)), ("REB_PACE_ADJ", rdiv("REB", adj)),
            ("ON_WINNING_TEAM", flag("TEAM_W_PCT > 0.5")), ("ON_PLAYOFF_TEAM", flag("TEAM_W_PCT > 0.45")),
            ("TEAM_OFF_STRENGTH", "TEAM_OFF_RATING - 110.0"), ("TEAM_DEF_STRENGTH", "110.0 - TEAM_DEF_RATING"),
            ("TEAM_NET_RATING_ABS", "abs(TEAM_NET_RATING)")]


def interaction():
    return [("AGE_USAGE_INTERACTION", "AGE * ADV_USG_PCT"), ("MIN_EFFICIENCY_INTERACTION", "MIN * ADV_TS_PCT"),
            ("PACE_USAGE_INTERACTION", "TEAM_PACE * ADV_USG_PCT"), ("AGE_TEAM_QUALITY", "AGE * TEAM_W_PCT"),
            ("EXP_MIN_INTERACTION", "YEARS_EXPERIENCE * MIN")]


POSITIONS = ("Center", "Forward", "Guard", "Guard-Forward")


def one_hot():
    return [(f"POS_{p}", b(f"POSITION = '{p}'")) for p in POSITIONS]


def groups():
    return [("IS_GUARD", flag("contains(POSITION, 'G')")), ("IS_FORWARD", flag("contains(POSITION, 'F')")),
            ("IS_CENTER", flag("contains(POSITION, 'C')"))]


def physical():
    return [("BMI", f"({rdiv('WEIGHT', 'power(HEIGHT_INCHES, 2)')}) * 703.0"),
            ("HEIGHT_CAT", cut("HEIGHT_INCHES", (0, 75, 79, 82, 100))),
            ("WEIGHT_CAT", cut("WEIGHT", (0, 190, 220, 250, 400)))]


# --- G ---------------------------------------------------------------------------------

def games_played():
    out = [("GP_RATE_CURRENT", "GP / 82.0"), ("GAMES_MISSED", "82.0::DOUBLE - GP"), ("HIGH_AVAILABILITY", flag("GP >= 70")),
           ("MEDIUM_AVAILABILITY", flag("GP >= 50 AND GP < 70")), ("LOW_AVAILABILITY", flag("GP < 50"))]
    for k in (1, 2, 3):
        out += [(f"GP_LAG{k}_RATE", f"GP_LAG{k} / 82.0"), (f"MISSED_GAMES_LAG{k}", f"82.0::DOUBLE - GP_LAG{k}")]
    return out


def avail_trend():
    return [("GP_TREND", "GP_LAG1 - GP_LAG2"), ("GP_IMPROVING", flag("(GP_LAG1 - GP_LAG2) > 5")),
            ("GP_DECLINING", flag("(GP_LAG1 - GP_LAG2) < -5")), ("GP_AVG_2YR", "(GP_LAG1 + GP_LAG2) / 2"),
            ("GP_AVG_3YR", "(GP_LAG1 + GP_LAG2 + GP_LAG3) / 3"), ("GP_CONSISTENCY", "GP_STD3"),
            ("HIGHLY_CONSISTENT_AVAILABILITY", flag("GP_STD3 < 10"))]


def injury():
    return [("AGE_INJURY_RISK", clip("(AGE - 25) / 10", lo=0)),
            ("VETERAN_INJURY_RISK", flag(f"{b('AGE > 30')} AND {b('GP_LAG1 < 65')}")),
            ("HEAVY_MINUTES_LOAD", flag("MIN > 34")), ("AGE_MINUTES_RISK", "(AGE / 10) * (MIN / 48)"),
            ("INJURY_PRONE_PATTERN", flag(f"{b('GP_LAG1 < 67')} AND {b('GP_LAG2 < 67')}")),
            ("MAJOR_GP_DROP", flag("(GP_LAG2 - GP_LAG1) > 20")),
            ("RECOVERY_YEAR", flag(f"{b('GP_LAG2 < 50')} AND {b('GP_LAG1 > 60')}"))]


def workload():
    w1, w2 = "(GP_LAG1 * MIN_LAG1)", "(GP_LAG2 * MIN_LAG2)"
    return [("TOTAL_MINUTES", "GP * MIN"), ("HIGH_WORKLOAD", flag("GP * MIN > 2500")),
            ("MEDIUM_WORKLOAD", flag("GP * MIN >= 1500 AND GP * MIN <= 2500")), ("LOW_WORKLOAD", flag("GP * MIN < 1500")),
            ("WORKLOAD_LAG1", w1), ("WORKLOAD_LAG2", w2), ("WORKLOAD_TREND", f"{w1} - {w2}"),
            ("INCREASING_WORKLOAD", flag(f"({w1} - {w2}) > 200")), ("USAGE_MINUTES_PRODUCT", "ADV_USG_PCT * MIN"),
            ("HIGH_USAGE_HIGH_MINUTES", flag(f"{b('ADV_USG_PCT > 28')} AND {b('MIN > 33')}"))]


def rest():
    return [("MIN_CHANGE", "MIN_LAG1 - MIN_LAG2"), ("REDUCED_MINUTES", flag("(MIN_LAG1 - MIN_LAG2) < -3")),
            ("INCREASED_MINUTES", flag("(MIN_LAG1 - MIN_LAG2) > 3")),
            ("LOAD_MANAGEMENT", flag(f"{b('AGE > 32')} AND {b('GP_LAG1 < 70')} AND {b('TEAM_W_PCT > 0.5')}")),
            ("RECOVERING_FROM_LOW_PLAY", flag(f"{b('GP_LAG1 < 60')} OR {b('MIN_LAG1 < 25')}"))]


def score():
    s = "(GP_LAG1 / 82.0 * 0.5 + GP_LAG2 / 82.0 * 0.3 + GP_LAG3 / 82.0 * 0.2)"
    s = f"({s} * (1.0 - {clip('(AGE - 25) / 100', 0, 0.15)}))"
    return [("AVAILABILITY_SCORE", s), ("AVAILABILITY_TIER", cut(s, (0, 0.6, 0.8, 1.0)))]


FAMILIES = {
    "rolling_averages": rolling, "trend_features": trend, "consistency_features": consistency,
    "history_flags": history, "age_features": age, "efficiency_features": efficiency, "role_features": role,
    "team_context_features": team_context, "interaction_features": interaction, "position_one_hot": one_hot,
    "position_groups": groups, "physical_features": physical, "games_played_features": games_played,
    "availability_trend": avail_trend, "injury_proxy": injury, "workload_features": workload,
    "rest_recovery": rest, "availability_score": score,
}
CHAIN = ("rolling_averages", "trend_features", "consistency_features", "history_flags")
DERIVED = ("age_features", "efficiency_features", "role_features", "team_context_features", "interaction_features",
           "position_one_hot", "position_groups", "physical_features")
AVAIL = ("games_played_features", "availability_trend", "injury_proxy", "workload_features", "rest_recovery",
         "availability_score")


def select_list(names) -> str:
    return ", ".join(f"{e} AS \"{n}\"" for fam in names for n, e in FAMILIES[fam]())
