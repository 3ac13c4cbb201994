"""DuckDB oracle SQL per query name (same names as ``panelforge.plans.catalog``).

Queries that fit ML models, write/read sinks or stores have no entry (the
driver's rows-only check applies to them).
"""

from __future__ import annotations

from panelforge import spec as S

from . import features_sql as FS
from .panel_sql import LABEL, TRAIN, VAL, season_case, with_chain

SQL: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    SQL[name] = text


def qi(name: str) -> str:
    return '"' + name + '"'


TRAIN_IN = "(" + ", ".join(f"'{t}'" for t in TRAIN) + ")"
TARGET_STATS = list(S.TARGET_STATS)
LAG_STATS = list(S.LAG_STATS) + list(S.ADVANCED_LAG_STATS)

PS_COLS = ["PLAYER_ID", "PLAYER_NAME", "TEAM_ABBREVIATION", "AGE", "YEARS_EXPERIENCE", "GP", "MIN", "PTS", "REB",
           "AST", "STL", "BLK", "TOV", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA", "FT_PCT",
           "SEASON"]
MASTER_COLS = PS_COLS + ["POSITION", "HEIGHT", "HEIGHT_INCHES", "WEIGHT", "DRAFT_YEAR", "DRAFT_ROUND",
                         "DRAFT_NUMBER", "COUNTRY", "TEAM_NAME", "TEAM_PACE", "TEAM_OFF_RATING", "TEAM_DEF_RATING",
                         "TEAM_NET_RATING", "TEAM_W", "TEAM_L", "TEAM_W_PCT", "ADV_USG_PCT", "ADV_AST_PCT",
                         "ADV_REB_PCT", "ADV_TS_PCT", "ADV_PIE", "SEASON_ORDER"]
TEXT_COLS = {"PLAYER_NAME", "TEAM_ABBREVIATION", "SEASON", "POSITION", "HEIGHT", "DRAFT_YEAR", "DRAFT_ROUND",
             "DRAFT_NUMBER", "COUNTRY", "TEAM_NAME"}
LAGGED_COLS = (MASTER_COLS + [f"NEXT_{s}" for s in TARGET_STATS]
               + [f"{s}_LAG{k}" for s in LAG_STATS for k in (1, 2, 3)])
CHAIN_COLS = LAGGED_COLS + [n for fam in FS.CHAIN for n, _ in FS.FAMILIES[fam]()]
FEAT_COLS = CHAIN_COLS + [n for fam in FS.DERIVED + FS.AVAIL for n, _ in FS.FAMILIES[fam]()]
BOOL_COLS = {n for n, _ in FS.one_hot()}

CHAIN_CTE = f"chain AS (SELECT *, {FS.select_list(FS.CHAIN)} FROM lagged)"
FEATS_CTE = f"feats AS (SELECT *, {FS.select_list(FS.DERIVED + FS.AVAIL)} FROM chain)"


def chain(select: str, *extra: str) -> str:
    return with_chain(select, CHAIN_CTE, *extra)


def feats(select: str, *extra: str) -> str:
    return with_chain(select, CHAIN_CTE, FEATS_CTE, *extra)


def union_all(parts) -> str:
    return "\nUNION ALL ".join(parts)


# ==== baseline prediction table (shared by J, L, N) ==========================================

def _pred_parts(model: str, expr, where: str, src: str = "chain") -> list[str]:
    return [f"SELECT PLAYER_ID, SEASON, 'NEXT_{s}' AS target, '{model}' AS model, "
            f"CAST({expr(s)} AS DOUBLE) AS prediction, CAST(NEXT_{s} AS DOUBLE) AS actual FROM {src} WHERE {where}"
            for s in TARGET_STATS]


ROLLING = {"PTS", "AST", "REB", "STL", "BLK", "MIN", "TOV", "FG3M", "FGA", "FTA"}


def _multi_year(s: str) -> str:
    return f"{s}_AVG3" if s in ROLLING else f"{s}_LAG1"


GM_CTE = ("gm AS (SELECT POSITION, " + ", ".join(f"avg({s}) AS gm_{s}" for s in TARGET_STATS)
          + f" FROM chain WHERE SEASON IN {TRAIN_IN} AND NEXT_PTS IS NOT NULL AND POSITION IS NOT NULL"
          + " GROUP BY POSITION)")
VMED_CTE = ("vmed AS (SELECT " + ", ".join(f"median(NEXT_{s}) AS med_{s}" for s in TARGET_STATS)
            + f" FROM chain WHERE SEASON = '{VAL}')")
POS_CTE = ("posval AS (SELECT c.*, " + ", ".join(f"coalesce(gm.gm_{s}, vmed.med_{s}) AS bp_{s}" for s in TARGET_STATS)
           + f" FROM chain c LEFT JOIN gm ON c.POSITION = gm.POSITION CROSS JOIN vmed WHERE c.SEASON = '{VAL}')")
PREDS_CTE = "preds AS (" + union_all(
    _pred_parts("Baseline_LAG1", lambda s: f"{s}_LAG1", f"SEASON = '{VAL}'")
    + _pred_parts("Baseline_3yr", _multi_year, f"SEASON = '{VAL}'")
    + _pred_parts("Baseline_Position", lambda s: f"bp_{s}", "true", "posval")) + ")"
BASE_CTES = (GM_CTE, VMED_CTE, POS_CTE, PREDS_CTE)


def metrics_cte(name: str = "metrics", src: str = "preds") -> str:
    return f"""{name} AS (
SELECT model, target, count(*) AS n,
       avg(abs(actual - prediction)) AS MAE,
       sqrt(avg((actual - prediction) * (actual - prediction))) AS RMSE,
       1.0 - sum((actual - prediction) * (actual - prediction)) / NULLIF(var_pop(actual) * count(*), 0) AS R2,
       avg(abs((actual - prediction) / NULLIF(actual, 0))) * 100 AS MAPE
FROM {src}
WHERE actual IS NOT NULL AND prediction IS NOT NULL AND NOT isnan(prediction)
GROUP BY model, target)"""


BASELINES = ("Baseline_LAG1", "Baseline_3yr", "Baseline_Position")


def _order_case(models) -> str:
    return "CASE model " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(models)) + f" ELSE {len(models)} END"


# ==== flagship ===============================================================================

sql("flagship_baseline_metrics", with_chain(
    "SELECT * FROM metrics",
    "preds AS (" + union_all(_pred_parts("Baseline_LAG1", lambda s: f"{s}_LAG1", f"SEASON = '{VAL}'", "lagged")) + ")",
    metrics_cte()))

# ==== A ======================================================================================

sql("scan_table", "SELECT * FROM customer")


def _csv_total(cols) -> str:
    return "sum(" + " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in cols) + ")"


_CSV = {"stats": ("ps", [c for c in PS_COLS if c not in ("PLAYER_NAME", "TEAM_ABBREVIATION", "SEASON")]),
        "team": ("team", ["TEAM_ID", "GP", "W", "L", "W_PCT", "PACE", "OFF_RATING", "DEF_RATING", "NET_RATING"]),
        "adv": ("adv", ["PLAYER_ID", "USG_PCT", "TS_PCT", "AST_PCT", "REB_PCT", "PIE"])}
_BAD = "(DRAFT_NUMBER IS NOT NULL AND try_cast(DRAFT_NUMBER AS INTEGER) IS NULL)"
sql("scan_table_csv", with_chain(union_all([
    *(f"SELECT '{t}' AS \"table\", true AS present, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_rejects, "
      f"{_csv_total(cols)} AS total FROM {src}" for t, (src, cols) in _CSV.items()),
    f"SELECT 'bio', true, count(*) FILTER (WHERE NOT {_BAD}), count(*) FILTER (WHERE {_BAD}), "
    f"sum(CASE WHEN NOT {_BAD} THEN coalesce(CAST(PERSON_ID AS DOUBLE), 0.0) + coalesce(try_cast(WEIGHT AS DOUBLE), 0.0) "
    f"+ coalesce(try_cast(DRAFT_NUMBER AS DOUBLE), 0.0) END) FROM bio_raw",
    "SELECT 'injuries', false, CAST(0 AS BIGINT), CAST(0 AS BIGINT), NULL"]), lagged=False))
sql("union_period_batches", with_chain("SELECT *, 'Base' AS MEASURE_TYPE FROM ps", lagged=False))

# ==== B ======================================================================================

sql("project_existing", with_chain(
    "SELECT " + ", ".join(c for c in ("PLAYER_ID", "PLAYER_NAME", "TEAM_ABBREVIATION", "AGE", "GP", "MIN", "PTS",
                                      "REB", "AST", "STL", "BLK", "TOV", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A",
                                      "FG3_PCT", "FTM", "FTA", "FT_PCT", "SEASON")) + " FROM ps", lagged=False))
sql("rename_map", with_chain(
    "SELECT PERSON_ID AS PLAYER_ID, DISPLAY_FIRST_LAST AS PLAYER_NAME, BIRTHDATE, COUNTRY, HEIGHT, WEIGHT, "
    "POSITION, DRAFT_YEAR, DRAFT_ROUND, DRAFT_NUMBER FROM bio_raw", lagged=False))
sql("prefix_columns", with_chain(
    "SELECT TEAM_ID AS TEAM_TEAM_ID, TEAM_NAME, SEASON, GP AS TEAM_GP, W AS TEAM_W, L AS TEAM_L, "
    "W_PCT AS TEAM_W_PCT, PACE AS TEAM_PACE, OFF_RATING AS TEAM_OFF_RATING, DEF_RATING AS TEAM_DEF_RATING, "
    "NET_RATING AS TEAM_NET_RATING FROM team", lagged=False))
sql("filter_min_games", with_chain("SELECT * FROM ps WHERE GP >= 10", lagged=False))
sql("filter_active_entities", with_chain(
    "SELECT * FROM ps WHERE PLAYER_ID IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)", lagged=False))
sql("filter_id_prefix", with_chain(
    "SELECT * FROM team WHERE starts_with(CAST(TEAM_ID AS VARCHAR), '161061270')", lagged=False))
sql("dedup_keep_first",
    "SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderdate, o_orderkey, o_totalprice, o_orderstatus "
    "FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) "
    "ORDER BY o_orderdate, o_orderkey) = 1")

PCT = ("FG_PCT", "FG3_PCT", "FT_PCT", "TEAM_W_PCT", "ADV_USG_PCT", "ADV_AST_PCT", "ADV_REB_PCT", "ADV_TS_PCT")
sql("fill_pct_zero", with_chain(
    "SELECT PLAYER_ID, SEASON, " + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in PCT) + " FROM master",
    lagged=False))
ADV = ("USG_PCT", "TS_PCT", "AST_PCT", "REB_PCT", "PIE")
sql("fill_global_median", with_chain(
    "SELECT PLAYER_ID, SEASON, " + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM adv)) AS {c}" for c in ADV)
    + " FROM adv", lagged=False))
PMEAN = ("MIN", "PTS", "REB", "AST", "FG_PCT", "TEAM_PACE", "TEAM_W_PCT", "ADV_USG_PCT", "ADV_PIE")
sql("fill_period_mean", with_chain(
    "SELECT PLAYER_ID, SEASON, GP, " + ", ".join(f"coalesce({c}, avg({c}) OVER (PARTITION BY SEASON)) AS {c}"
                                                for c in PMEAN) + " FROM master", lagged=False))
sql("fill_constant_default", with_chain(
    "SELECT PLAYER_ID, SEASON, coalesce(YEARS_EXPERIENCE, 0) AS YEARS_EXPERIENCE, "
    "coalesce(DRAFT_YEAR, 'Undrafted') AS DRAFT_YEAR, coalesce(TEAM_NAME, 'Unmapped') AS TEAM_NAME FROM master",
    lagged=False))
sql("coerce_numeric", with_chain(
    "SELECT PERSON_ID, coalesce(try_cast(trim(DRAFT_ROUND) AS DOUBLE), 0.0) AS DRAFT_ROUND, "
    "coalesce(try_cast(trim(DRAFT_NUMBER) AS DOUBLE), 0.0) AS DRAFT_NUMBER FROM bio_raw", lagged=False))
sql("coerce_timestamp", with_chain(
    "SELECT PERSON_ID, try_cast(BIRTHDATE AS TIMESTAMP) AS BIRTHDATE FROM bio_raw", lagged=False))
AGE_SQL = ("round_even(date_diff('day', CAST(BIRTHDATE AS DATE), DATE '2002-01-01') / 365.25, 1)")
sql("age_from_birthdate", with_chain(
    f"SELECT PLAYER_ID AS PERSON_ID, BIRTHDATE, {AGE_SQL} AS AGE FROM bio", lagged=False))
sql("parse_height", with_chain("SELECT PLAYER_ID AS PERSON_ID, HEIGHT, HEIGHT_INCHES FROM bio", lagged=False))
sql("map_lookup", with_chain(
    "SELECT PLAYER_ID, SEASON, TEAM_ABBREVIATION, lk.name AS TEAM_NAME FROM ps LEFT JOIN lk "
    "ON ps.TEAM_ABBREVIATION = lk.code", lagged=False))
sql("period_label", f"SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr, "
                    f"printf('%d-%02d', year(o_orderdate), (year(o_orderdate) + 1) % 100) AS SEASON FROM orders")
sql("period_ordinal", with_chain(f"SELECT PLAYER_ID, SEASON, {season_case()} AS SEASON_ORDER FROM ps", lagged=False))
sql("sort_rows", with_chain("SELECT PLAYER_ID, SEASON, GP, PTS FROM master ORDER BY PTS DESC, PLAYER_ID, SEASON",
                            lagged=False))
sql("text_contains_filter", with_chain(
    "SELECT PLAYER_ID, SEASON, PLAYER_NAME, PTS FROM master WHERE contains(lower(PLAYER_NAME), 'customer#0000001')",
    lagged=False))


def _inf0(x: str) -> str:
    return f"CASE WHEN isinf({x}) THEN 0.0 ELSE {x} END"


sql("replace_infinite", with_chain(
    f"SELECT PLAYER_ID, SEASON, {_inf0(FS.rdiv('AST', 'STL'))} AS AST_PER_STL, "
    f"{_inf0(FS.rdiv('FG3M', 'FG3A'))} AS FG3M_PER_FG3A FROM ps", lagged=False))
NUMERIC_MASTER = [c for c in MASTER_COLS if c not in TEXT_COLS]
sql("drop_non_numeric_features", with_chain(
    "SELECT SEASON, " + ", ".join(NUMERIC_MASTER) + " FROM master", lagged=False))
sql("clean_bio", with_chain(
    f"SELECT PLAYER_ID, PLAYER_NAME, BIRTHDATE, COUNTRY, HEIGHT, WEIGHT, POSITION, DRAFT_YEAR, DRAFT_ROUND, "
    f"DRAFT_NUMBER, {AGE_SQL} AS AGE, HEIGHT_INCHES FROM bio", lagged=False))

# ==== C ======================================================================================

sql("join_player_measures", with_chain(
    "SELECT a.PLAYER_ID, a.SEASON, a.TS_PCT, a.USG_PCT, u.USG_PCT AS USG_PCT_USAGE, u.AST_PCT, m.REB_PCT, s.PIE "
    "FROM adv a LEFT JOIN adv u ON a.PLAYER_ID = u.PLAYER_ID AND a.SEASON = u.SEASON "
    "LEFT JOIN adv m ON a.PLAYER_ID = m.PLAYER_ID AND a.SEASON = m.SEASON "
    "LEFT JOIN adv s ON a.PLAYER_ID = s.PLAYER_ID AND a.SEASON = s.SEASON", lagged=False))
sql("join_team_measures", with_chain(
    "SELECT b.TEAM_ID, b.SEASON, b.TEAM_NAME, b.GP, b.W, b.L, b.W_PCT, a.OFF_RATING, a.DEF_RATING, a.NET_RATING, "
    "a.PACE, f.W_PCT AS W_PCT_FOUR_FACTORS, m.GP AS GP_MISC FROM team b "
    "LEFT JOIN team a ON b.TEAM_ID = a.TEAM_ID AND b.SEASON = a.SEASON "
    "LEFT JOIN team f ON b.TEAM_ID = f.TEAM_ID AND b.SEASON = f.SEASON "
    "LEFT JOIN team m ON b.TEAM_ID = m.TEAM_ID AND b.SEASON = m.SEASON", lagged=False))
sql("join_bio", with_chain(
    "SELECT ps.*, b.POSITION, b.HEIGHT, b.HEIGHT_INCHES, b.WEIGHT, b.DRAFT_YEAR, b.DRAFT_ROUND, b.DRAFT_NUMBER, "
    "b.COUNTRY FROM ps LEFT JOIN bio b ON ps.PLAYER_ID = b.PLAYER_ID", lagged=False))
sql("join_team_context", with_chain(
    "SELECT ps.*, lk.name AS TEAM_NAME, t.PACE AS TEAM_PACE, t.OFF_RATING AS TEAM_OFF_RATING, "
    "t.DEF_RATING AS TEAM_DEF_RATING, t.NET_RATING AS TEAM_NET_RATING, t.W AS TEAM_W, t.L AS TEAM_L, "
    "t.W_PCT AS TEAM_W_PCT FROM ps LEFT JOIN lk ON ps.TEAM_ABBREVIATION = lk.code "
    "LEFT JOIN team t ON lk.name = t.TEAM_NAME AND ps.SEASON = t.SEASON", lagged=False))
sql("join_advanced", with_chain(
    "SELECT ps.*, a.USG_PCT AS ADV_USG_PCT, a.AST_PCT AS ADV_AST_PCT, a.REB_PCT AS ADV_REB_PCT, "
    "a.TS_PCT AS ADV_TS_PCT, a.PIE AS ADV_PIE FROM ps LEFT JOIN adv a "
    "ON ps.PLAYER_ID = a.PLAYER_ID AND ps.SEASON = a.SEASON", lagged=False))
sql("build_master_panel", with_chain("SELECT * FROM master", lagged=False))
SQL["sink_table"] = SQL["build_master_panel"]       # written and read back
sql("join_group_average", chain(
    "SELECT c.PLAYER_ID, c.SEASON, c.POSITION, coalesce(g.PTS, 0.0) AS PTS FROM chain c "
    f"LEFT JOIN (SELECT POSITION, avg(PTS) AS PTS FROM chain WHERE SEASON IN {TRAIN_IN} AND NEXT_PTS IS NOT NULL "
    f"AND POSITION IS NOT NULL GROUP BY POSITION) g ON c.POSITION = g.POSITION WHERE c.SEASON = '{VAL}'"))
sql("join_metrics_by_target", chain(
    "SELECT target, " + ", ".join(f"max(CASE WHEN model = '{m}' THEN MAE END) AS {m}" for m in BASELINES)
    + " FROM metrics GROUP BY target", *BASE_CTES, metrics_cte()))

# ==== D ======================================================================================

sql("period_summary", with_chain(
    "SELECT SEASON, count(DISTINCT PLAYER_ID) AS n_entities, "
    + ", ".join(f"avg({s}) AS avg_{s}" for s in ("GP", "MIN", "PTS", "REB", "AST")) + " FROM master GROUP BY SEASON",
    lagged=False))
sql("value_counts", with_chain(
    "SELECT POSITION, count(*) AS count, count(*) / (SELECT count(POSITION) FROM master) AS share "
    "FROM master WHERE POSITION IS NOT NULL GROUP BY POSITION", lagged=False))
sql("panel_overview", with_chain(
    "SELECT count(*) AS rows, count(DISTINCT PLAYER_ID) AS entities, count(DISTINCT SEASON) AS periods, "
    "min(SEASON) AS first_period, max(SEASON) AS last_period, avg(AGE) AS avg_AGE, "
    "avg(YEARS_EXPERIENCE) AS avg_YEARS_EXPERIENCE FROM master", lagged=False))
sql("describe_columns", chain(union_all(
    f"SELECT 'NEXT_{s}' AS \"column\", count(NEXT_{s}) AS count, avg(NEXT_{s}) AS mean, stddev_samp(NEXT_{s}) AS std, "
    f"min(NEXT_{s}) AS min, quantile_cont(NEXT_{s}, 0.25) AS p25, quantile_cont(NEXT_{s}, 0.5) AS p50, "
    f"quantile_cont(NEXT_{s}, 0.75) AS p75, max(NEXT_{s}) AS max FROM chain" for s in TARGET_STATS)))
sql("target_moments", chain(union_all(
    f"SELECT 'NEXT_{s}' AS target, avg(NEXT_{s}) AS mean, stddev_samp(NEXT_{s}) AS std, "
    f"CAST(min(NEXT_{s}) AS DOUBLE) AS min, CAST(max(NEXT_{s}) AS DOUBLE) AS max FROM chain" for s in TARGET_STATS)))


def missing_cte(src: str, cols, name: str = "mp") -> str:
    parts = [f"SELECT '{c}' AS \"column\", count(*) - count({qi(c)}) AS missing_count, "
             f"(count(*) - count({qi(c)})) / count(*) * 100 AS missing_pct FROM {src}" for c in cols]
    return f"{name} AS (" + union_all(parts) + ")"


sql("missing_profile", chain("SELECT * FROM mp WHERE missing_count > 0", missing_cte("chain", CHAIN_COLS)))
sql("missing_severity", chain(
    "SELECT count(*) FILTER (WHERE missing_pct > 80) AS critical, "
    "count(*) FILTER (WHERE missing_pct > 50 AND missing_pct <= 80) AS high, "
    "count(*) FILTER (WHERE missing_pct > 20 AND missing_pct <= 50) AS medium FROM mp WHERE missing_count > 0",
    missing_cte("chain", CHAIN_COLS)))
FLAGS = ("HIGH_AVAILABILITY", "MEDIUM_AVAILABILITY", "LOW_AVAILABILITY", "GP_IMPROVING", "GP_DECLINING",
         "VETERAN_INJURY_RISK", "HEAVY_MINUTES_LOAD", "INJURY_PRONE_PATTERN", "MAJOR_GP_DROP", "RECOVERY_YEAR",
         "HIGH_WORKLOAD", "INCREASING_WORKLOAD", "LOAD_MANAGEMENT", "RECOVERING_FROM_LOW_PLAY")
AVAIL_CTE = f"av AS (SELECT *, {FS.select_list(FS.AVAIL)} FROM chain)"
sql("availability_breakdown", chain(union_all(
    f"SELECT '{f}' AS flag, CAST(sum({f}) AS BIGINT) AS n, avg({f}) AS share FROM av" for f in FLAGS), AVAIL_CTE))
sql("target_range_check", chain(union_all(
    f"SELECT '{t}' AS target, count(*) FILTER (WHERE {t} > {hi} OR {t} < {lo}) AS out_of_range FROM chain"
    for t, (lo, hi) in (("NEXT_PTS", (0, 50)), ("NEXT_MIN", (0, 48)), ("NEXT_FG_PCT", (0, 1))))))
sql("target_coverage", chain(
    "SELECT count(NEXT_PTS) AS with_target, count(*) - count(NEXT_PTS) AS without_target FROM chain"))
TGT = [f"NEXT_{s}" for s in TARGET_STATS]
sql("target_correlation_topk", chain(
    "SELECT * FROM (" + union_all(f"SELECT '{a}' AS feature1, '{b}' AS feature2, corr({a}, {b}) AS correlation "
                                  f"FROM chain" for i, a in enumerate(TGT) for b in TGT[i + 1:])
    + ") ORDER BY correlation DESC NULLS LAST, feature1, feature2 LIMIT 5"))
TGT_META = set(TGT) | set(S.METADATA_COLS) | {"PLAYER_ID", "SEASON"}
NUM = [c for c in CHAIN_COLS if c not in TGT_META and c not in TEXT_COLS]
DOUBLES = ", ".join(f"CAST({qi(c)} AS DOUBLE) AS {qi(c)}" for c in NUM)
NUM_LIST = ", ".join(qi(c) for c in NUM)
PREP = [c for c in FEAT_COLS if c not in TGT_META and (c not in TEXT_COLS or c in ("DRAFT_ROUND", "DRAFT_NUMBER"))]
SPLIT = (f"CASE WHEN NEXT_PTS IS NULL THEN 'pred' WHEN SEASON IN {TRAIN_IN} THEN 'train' "
         f"WHEN SEASON = '{VAL}' THEN 'val' END")


def _prep_col(c: str) -> str:
    if c in ("DRAFT_ROUND", "DRAFT_NUMBER"):
        return f"coalesce(try_cast(trim({c}) AS DOUBLE), 0.0)"
    v = f"CAST({qi(c)} AS DOUBLE)"
    return f"CASE WHEN isnan({v}) THEN NULL ELSE {v} END"


PX = (f"px AS MATERIALIZED (SELECT PLAYER_ID, SEASON, {SPLIT} AS split, "
      + ", ".join(f"{_prep_col(c)} AS {qi(c)}" for c in PREP) + " FROM feats)")
sql("high_correlation_pairs", feats(
    "SELECT feature1, feature2, r AS correlation FROM (SELECT a.n AS feature1, b.n AS feature2, "
    "abs(corr(a.v, b.v)) AS r FROM ln a JOIN ln b ON a.rid = b.rid AND a.pos < b.pos GROUP BY a.n, b.n) "
    "WHERE r > 0.95 AND NOT isnan(r)", PX,
    "wd AS MATERIALIZED (SELECT row_number() OVER () AS rid, " + ", ".join(qi(c) for c in PREP) + " FROM px)",
    "up AS (UNPIVOT wd ON " + ", ".join(qi(c) for c in PREP) + " INTO NAME n VALUE v)",
    "nm AS (SELECT unnest([" + ", ".join(f"'{c}'" for c in PREP) + "]) AS n, unnest(range(" + str(len(PREP)) + ")) AS pos)",
    "ln AS MATERIALIZED (SELECT rid, pos, n, v FROM up JOIN nm USING (n))"))
sql("career_totals", with_chain(
    "SELECT PLAYER_ID, CAST(sum(GP) AS DOUBLE) AS CAREER_GP, sum(MIN) AS CAREER_MIN, sum(PTS) AS CAREER_PTS, "
    "count(*) AS SEASONS_PLAYED FROM master GROUP BY PLAYER_ID", lagged=False))
sql("group_mean_train", chain(
    "SELECT POSITION, " + ", ".join(f"avg({s}) AS {s}" for s in TARGET_STATS)
    + f" FROM chain WHERE SEASON IN {TRAIN_IN} AND NEXT_PTS IS NOT NULL GROUP BY POSITION"))
INF = [c for c in FEAT_COLS if c not in TEXT_COLS and c not in BOOL_COLS and c not in TGT_META] + ["AST_PER_STL"]
_inf_sum = " + ".join(f"count(*) FILTER (WHERE isinf(CAST({qi(c)} AS DOUBLE)))" for c in INF)
sql("infinite_profile", feats(union_all([
    f"SELECT 'train' AS split, CAST({_inf_sum} AS BIGINT) AS inf_cells FROM fx WHERE NEXT_PTS IS NOT NULL "
    f"AND SEASON IN {TRAIN_IN}",
    f"SELECT 'val' AS split, CAST({_inf_sum} AS BIGINT) AS inf_cells FROM fx WHERE NEXT_PTS IS NOT NULL "
    f"AND SEASON = '{VAL}'",
    f"SELECT 'pred' AS split, CAST({_inf_sum} AS BIGINT) AS inf_cells FROM fx WHERE NEXT_PTS IS NULL"]),
    f"fx AS (SELECT *, {FS.rdiv('AST', 'STL')} AS AST_PER_STL FROM feats)"))
sql("feature_stats", feats(
    "SELECT list_avg([" + ", ".join(f"avg(abs({qi(c)}))" for c in PREP) + "]) AS mean_abs_mean, list_avg(["
    + ", ".join(f"stddev_samp({qi(c)})" for c in PREP) + "]) AS mean_std FROM px", PX))

# ==== E ======================================================================================

sql("create_targets", with_chain(
    "SELECT PLAYER_ID, SEASON, " + ", ".join(f"NEXT_{s}" for s in TARGET_STATS) + " FROM lagged"))
sql("lag_features", with_chain(
    "SELECT PLAYER_ID, SEASON, " + ", ".join(f"{s}_LAG{k}" for s in LAG_STATS for k in (1, 2, 3)) + " FROM lagged"))
for fam in FS.CHAIN:
    sql(fam, chain("SELECT PLAYER_ID, SEASON, " + ", ".join(qi(n) for n, _ in FS.FAMILIES[fam]()) + " FROM chain"))
_strict = ", ".join(
    f"CASE WHEN abs(SEASON_ORDER - lag(SEASON_ORDER, {k}) OVER w) = {k} THEN lag({s}, {k}) OVER w END AS {s}_LAG{k}"
    for s in ("PTS", "GP") for k in (1, 2, 3))
sql("lag_features_strict", with_chain(
    f"SELECT PLAYER_ID, SEASON, {_strict} FROM master WINDOW w AS (PARTITION BY PLAYER_ID ORDER BY SEASON)",
    lagged=False))
SUPP = f"""sy AS (
  SELECT l_suppkey AS PLAYER_ID, {LABEL} AS SEASON, count(*) AS GP, avg(l_quantity) / 2 AS PTS,
         100.0 * avg(l_discount) AS AST, 100.0 * avg(l_tax) AS REB, avg(l_quantity) AS MIN
  FROM (SELECT *, year(l_shipdate) AS yr FROM lineitem) GROUP BY l_suppkey, yr)"""
sql("create_targets_supplier_year",
    f"WITH {SUPP} SELECT PLAYER_ID, SEASON, " + ", ".join(
        f"lead({s}) OVER (PARTITION BY PLAYER_ID ORDER BY SEASON) AS NEXT_{s}" for s in ("PTS", "AST", "REB", "MIN"))
    + " FROM sy")
sql("lag_features_user_day",
    "WITH ud AS (SELECT user_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS GP, sum(value) AS PTS "
    "FROM events GROUP BY user_id, strftime(CAST(ts AS DATE), '%Y-%m-%d')) SELECT user_id, day, " + ", ".join(
        f"lag({s}, {k}) OVER (PARTITION BY user_id ORDER BY day) AS {s}_LAG{k}" for s in ("GP", "PTS") for k in (1, 2, 3))
    + " FROM ud")

# ==== F / G ==================================================================================

for fam in FS.DERIVED + FS.AVAIL:
    sql(fam, chain(f"SELECT PLAYER_ID, SEASON, {FS.select_list([fam])} FROM chain"))
_TOV = FS.rdiv("TOV", "FGA + 0.44 * FTA + TOV")
_AST = FS.rdiv("AST", "FGA + 0.44 * FTA - OREB_PCT * (FGA - FGM) + TOV")
sql("team_derived_stats", with_chain(
    f"SELECT TEAM_ID, SEASON, {FS.rdiv('PTS', '2.0 * (FGA + 0.44 * FTA)')} AS TS_PCT, "
    f"{FS.rdiv('FG3A', 'FGA')} AS FG3A_RATE, 100.0 * ({_AST}) AS AST_RATIO, 100.0 * ({_TOV}) AS TOV_RATE, "
    "OREB_PCT AS REB_PCT FROM box",
    "box AS (SELECT 1610612700 + CAST(TEAM_ABBREVIATION AS BIGINT) AS TEAM_ID, SEASON, " + ", ".join(
        f"round(avg({c}), 10) AS {c}" for c in ("PTS", "AST", "TOV", "FGM", "FGA", "FG3A", "FTA"))
    + ", round(avg(FG3_PCT), 10) AS OREB_PCT FROM ps GROUP BY ALL)", lagged=False))
sql("team_derived_stats_players", with_chain(
    f"SELECT PLAYER_ID, SEASON, {FS.rdiv('PTS', '2.0 * (FGA + 0.44 * FTA)')} AS TS_PCT, "
    f"{FS.rdiv('FG3A', 'FGA')} AS FG3A_RATE, 100.0 * ({FS.rdiv('TOV', 'FGA + 0.44 * FTA + TOV')}) AS TOV_RATE "
    f"FROM ps", lagged=False))
sql("season_max_games_rate", with_chain(
    "SELECT PLAYER_ID, SEASON, CASE WHEN SEASON = '2001-02' THEN 48.0 ELSE 82.0 END::DOUBLE AS SEASON_MAX_GAMES, "
    "GP / (CASE WHEN SEASON = '2001-02' THEN 48.0 ELSE 82.0 END::DOUBLE) AS GP_RATE_ADJ FROM master", lagged=False))

# ==== H ======================================================================================

sql("drop_high_missing", feats(
    "SELECT \"column\" FROM mp WHERE missing_pct <= 90 OR \"column\" LIKE 'NEXT\\_%' ESCAPE '\\'",
    missing_cte("feats", FEAT_COLS)))
EXCLUDE = set(TGT) | set(S.METADATA_COLS)
CONST_CANDIDATES = [c for c in FEAT_COLS if c not in EXCLUDE and c not in TEXT_COLS and c not in BOOL_COLS]
sql("drop_constant_features", feats(
    "SELECT \"column\" FROM (" + union_all(f"SELECT '{c}' AS \"column\"" for c in FEAT_COLS) + ") "
    "WHERE \"column\" NOT IN (SELECT n FROM cst WHERE nd = 1 OR (nd = 2 AND top / nn > 0.99))",
    "wd AS MATERIALIZED (SELECT " + ", ".join(f"CAST({qi(c)} AS DOUBLE) AS {qi(c)}" for c in CONST_CANDIDATES)
    + " FROM feats)",
    "up AS (UNPIVOT wd ON " + ", ".join(qi(c) for c in CONST_CANDIDATES) + " INTO NAME n VALUE v)",
    "cst AS (SELECT n, count(*) AS nd, sum(k) AS nn, max(k) AS top FROM (SELECT n, v, count(*) AS k FROM up "
    "GROUP BY n, v) GROUP BY n)"))
_SEP_FEATURES = [c for c in FEAT_COLS if c not in TGT_META]
_SEP_METADATA = [c for c in FEAT_COLS if c in set(S.METADATA_COLS)]
sql("separate_columns", feats("SELECT " + ", ".join(qi(c) for c in [*_SEP_METADATA, *TGT, *_SEP_FEATURES])
                              + " FROM feats"))
sql("split_has_target", chain(
    "SELECT PLAYER_ID, SEASON, CASE WHEN NEXT_PTS IS NOT NULL THEN 'train' ELSE 'pred' END AS part FROM chain"))

# ==== I ======================================================================================

BOX = ("GP", "MIN", "PTS", "REB", "AST", "STL", "BLK", "TOV", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT",
       "FTM", "FTA", "FT_PCT")
PREP_CTES = (
    PX,
    "fm AS MATERIALIZED (SELECT " + ", ".join(
        f"CAST(median({qi(c)}) AS DOUBLE) AS m{i}, count(*) - count({qi(c)}) AS z{i}" for i, c in enumerate(PREP))
    + " FROM px WHERE split = 'train')",
    "pf AS MATERIALIZED (SELECT PLAYER_ID, SEASON, split, " + ", ".join(
        f"CASE WHEN fm.z{i} > 0 THEN coalesce({qi(c)}, fm.m{i}) ELSE {qi(c)} END AS {qi(c)}" for i, c in enumerate(PREP))
    + " FROM px CROSS JOIN fm WHERE split IS NOT NULL)",
    "zf AS MATERIALIZED (SELECT count(*) > 0 AS z FROM pf WHERE split IN ('train', 'val') AND ("
    + " OR ".join(f"{qi(c)} IS NULL" for c in PREP) + "))",
    "filled AS MATERIALIZED (SELECT PLAYER_ID, SEASON, split, " + ", ".join(
        f"CASE WHEN zf.z THEN coalesce({qi(c)}, 0.0) ELSE {qi(c)} END AS {qi(c)}" for c in PREP) + " FROM pf CROSS JOIN zf)",
)
sql("temporal_split", chain(f"SELECT PLAYER_ID, SEASON, {SPLIT} AS split FROM chain WHERE {SPLIT} IS NOT NULL"))
FILL_TEXT = ("POSITION", "HEIGHT", "DRAFT_YEAR", "COUNTRY", "TEAM_NAME")
sql("fit_fill_values", feats(union_all([
    *(f"SELECT '{c}' AS feature, m{i} AS fill_value, CAST(NULL AS VARCHAR) AS fill_text FROM fm WHERE z{i} > 0"
      for i, c in enumerate(PREP)),
    *(f"SELECT '{c}' AS feature, CAST(NULL AS DOUBLE) AS fill_value, v AS fill_text FROM (SELECT {c} AS v, count(*) AS k "
      f"FROM feats WHERE {SPLIT} = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY k DESC, v LIMIT 1) "
      f"WHERE (SELECT count(*) > count({c}) FROM feats WHERE {SPLIT} = 'train')" for c in FILL_TEXT)]), *PREP_CTES))
sql("apply_fill_values", feats("SELECT * FROM filled", *PREP_CTES))
SCALE_CTES = (
    "clean AS MATERIALIZED (SELECT PLAYER_ID, SEASON, split, " + ", ".join(
        f"CASE WHEN isinf({qi(c)}) THEN 0.0 ELSE {qi(c)} END AS {qi(c)}" for c in PREP) + " FROM filled)",
    "st AS (SELECT " + ", ".join(f"avg({qi(c)}) AS m{i}, stddev_pop({qi(c)}) AS s{i}" for i, c in enumerate(PREP))
    + " FROM clean WHERE split = 'train')",
    "scaled AS (SELECT PLAYER_ID, SEASON, split, " + ", ".join(
        f"({qi(c)} - st.m{i}) / CASE WHEN st.s{i} IS NULL OR st.s{i} = 0 THEN 1.0 ELSE st.s{i} END AS {qi(c)}"
        for i, c in enumerate(PREP)) + " FROM clean CROSS JOIN st)",
)
sql("standard_scale", feats("SELECT * FROM scaled", *PREP_CTES, *SCALE_CTES))
sql("scaling_check", feats(
    "SELECT list_avg([" + ", ".join(f"avg({qi(c)})" for c in PREP) + "]) AS mean_of_means, list_avg(["
    + ", ".join(f"stddev_samp({qi(c)})" for c in PREP) + "]) AS mean_of_stds FROM scaled WHERE split = 'train'",
    *PREP_CTES, *SCALE_CTES))
sql("prepare_training_data", feats("SELECT * FROM scaled", *PREP_CTES, *SCALE_CTES))

META = ("PLAYER_NAME", "TEAM_NAME", "TEAM_ABBREVIATION", "SEASON_ORDER", "COUNTRY", "DRAFT_YEAR", "HEIGHT")
sql("sink_prepared", feats(union_all([
    *(f"SELECT '{p}_{k}' AS part, (SELECT count(*) FROM px WHERE split = '{k}') AS n_rows, "
      f"CAST({n} AS BIGINT) AS n_columns, true AS same"
      for k in ("train", "val", "pred") for p, n in (("X", 2 + len(PREP)), ("y", 2 + len(TGT)), ("metadata", 2 + len(META)))),
    "SELECT 'fill_values', (SELECT " + " + ".join(f"CAST(z{i} > 0 AS BIGINT)" for i in range(len(PREP)))
    + " FROM fm), CAST(3 AS BIGINT), true"]), *PREP_CTES))

# ==== J ======================================================================================

_lag1 = union_all(_pred_parts("Baseline_LAG1", lambda s: f"{s}_LAG1", f"SEASON = '{VAL}'"))
sql("baseline_lag1", chain(_lag1))
sql("baseline_persistence", chain(union_all(_pred_parts("Baseline_Persistence", lambda s: s, f"SEASON = '{VAL}'"))))
sql("baseline_multi_year", chain(union_all(_pred_parts("Baseline_3yr", _multi_year, f"SEASON = '{VAL}'"))))
sql("baseline_group_average", chain(
    union_all(_pred_parts("Baseline_Position", lambda s: f"bp_{s}", "true", "posval")), GM_CTE, VMED_CTE, POS_CTE))
sql("regression_metrics", chain("SELECT * FROM metrics", *BASE_CTES, metrics_cte()))
sql("scan_metrics_json", chain(
    "SELECT * FROM (" + union_all(f"SELECT target, model, '{m}' AS metric, {m} AS value FROM metrics"
                                  for m in ("MAE", "RMSE", "R2", "MAPE")) + ") WHERE value IS NOT NULL",
    *BASE_CTES, metrics_cte()))
sql("mape", chain("SELECT model, target, MAPE FROM metrics", *BASE_CTES, metrics_cte()))
sql("metrics_summary", chain(
    "SELECT model, avg(MAE) AS avg_MAE, avg(R2) AS avg_R2, min(MAE) AS min_MAE, max(MAE) AS max_MAE "
    "FROM metrics GROUP BY model", *BASE_CTES, metrics_cte()))
IMP_CTE = ("imp AS (SELECT m.target, m.MAE AS model_MAE, b.MAE AS baseline_MAE, "
           "(b.MAE - m.MAE) / NULLIF(b.MAE, 0) * 100 AS improvement_pct, "
           "CAST(coalesce(round(m.MAE, 12) < round(b.MAE, 12), false) AS INTEGER) AS win "
           "FROM metrics m JOIN metrics b ON m.target = b.target "
           "WHERE m.model = 'Baseline_3yr' AND b.model = 'Baseline_LAG1')")
sql("improvement_vs_baseline", chain("SELECT * FROM imp", *BASE_CTES, metrics_cte(), IMP_CTE))
sql("improvement_summary", chain(
    "SELECT avg(improvement_pct) AS avg_improvement_pct, CAST(sum(win) AS BIGINT) AS wins, count(*) AS n_targets "
    "FROM imp", *BASE_CTES, metrics_cte(), IMP_CTE))
BEST_CTE = ("best AS (SELECT target, model AS best_model, MAE AS best_MAE FROM metrics WHERE MAE IS NOT NULL "
            f"QUALIFY row_number() OVER (PARTITION BY target ORDER BY round(MAE, 12), {_order_case(BASELINES)}, model) = 1)")
sql("best_model_per_target", chain("SELECT * FROM best", *BASE_CTES, metrics_cte(), BEST_CTE))
sql("wins_by_approach", chain("SELECT best_model AS approach, count(*) AS wins FROM best GROUP BY best_model",
                              *BASE_CTES, metrics_cte(), BEST_CTE))
sql("wins_with_ties", chain(
    "SELECT model AS approach, CAST(sum(CASE WHEN round(MAE, 12) = least THEN 1 ELSE 0 END) AS BIGINT) AS wins, "
    "count(*) AS n_targets, avg(MAE) AS avg_MAE, avg(R2) AS avg_R2 FROM (SELECT *, min(round(MAE, 12)) OVER "
    "(PARTITION BY target) AS least FROM metrics WHERE MAE IS NOT NULL) GROUP BY model",
    *BASE_CTES, metrics_cte()))
sql("best_overall_approach", chain(
    "SELECT model AS best_approach, avg_MAE AS best_avg_MAE FROM (SELECT model, avg(MAE) AS avg_MAE FROM metrics "
    f"GROUP BY model) ORDER BY round(avg_MAE, 12), {_order_case(BASELINES)}, model LIMIT 1", *BASE_CTES, metrics_cte()))

# ==== K (SQL-expressible part) ===============================================================

sql("contiguous_folds", chain(
    "SELECT PLAYER_ID, SEASON, CAST(ntile(5) OVER (ORDER BY PLAYER_ID, SEASON) - 1 AS INTEGER) AS fold FROM chain "
    f"WHERE SEASON IN {TRAIN_IN} AND NEXT_PTS IS NOT NULL"))

# ==== L ======================================================================================

APPROACHES = BASELINES + ("Simple_Average", "Weighted_Average")
ENS_CTES = (
    "w AS (SELECT target, model, MAE, (1.0 / MAE) / sum(1.0 / MAE) OVER (PARTITION BY target) AS weight "
    "FROM metrics)",
    "sa AS (SELECT PLAYER_ID, SEASON, target, 'Simple_Average' AS model, avg(prediction) AS prediction, "
    "any_value(actual) AS actual FROM preds GROUP BY PLAYER_ID, SEASON, target)",
    "wa AS (SELECT PLAYER_ID, SEASON, p.target, 'Weighted_Average' AS model, "
    "CASE WHEN count(w.weight * p.prediction) = count(*) THEN sum(w.weight * p.prediction) END AS prediction, "
    "any_value(actual) AS actual FROM preds p JOIN w ON p.target = w.target AND p.model = w.model "
    "GROUP BY PLAYER_ID, SEASON, p.target)",
    "allp AS (SELECT * FROM preds UNION ALL SELECT * FROM sa UNION ALL SELECT * FROM wa)",
)
sql("ensemble_simple_average", chain("SELECT * FROM sa", *BASE_CTES, metrics_cte(), *ENS_CTES))
sql("ensemble_inverse_mae_weights", chain("SELECT * FROM w", *BASE_CTES, metrics_cte(), *ENS_CTES))
sql("ensemble_weighted_average", chain("SELECT * FROM wa", *BASE_CTES, metrics_cte(), *ENS_CTES))
BEST_ALL = ("ball AS (SELECT target, model AS best_model, MAE AS best_MAE FROM m2 WHERE MAE IS NOT NULL "
            f"QUALIFY row_number() OVER (PARTITION BY target ORDER BY round(MAE, 12), {_order_case(APPROACHES)}, model) = 1)")
sql("ensemble_comparison", chain(
    "SELECT m.target, " + ", ".join(f"max(CASE WHEN m.model = '{a}' THEN m.MAE END) AS {a}" for a in APPROACHES)
    + ", any_value(b.best_model) AS Best FROM m2 m LEFT JOIN ball b ON m.target = b.target GROUP BY m.target",
    *BASE_CTES, metrics_cte(), *ENS_CTES, metrics_cte("m2", "allp"), BEST_ALL))
sql("ensemble_select", chain(
    "SELECT m.*, b.best_model, b.best_MAE FROM m2 m LEFT JOIN ball b ON m.target = b.target",
    *BASE_CTES, metrics_cte(), *ENS_CTES, metrics_cte("m2", "allp"), BEST_ALL))

# ==== M ======================================================================================

sql("topk_by_column", feats(
    "SELECT * FROM mp WHERE missing_count > 0 ORDER BY missing_pct DESC, \"column\" LIMIT 10",
    missing_cte("feats", FEAT_COLS)))
sql("latest_row_per_entity", with_chain(
    "SELECT PLAYER_ID, SEASON, GP, PTS, AGE FROM master "
    "QUALIFY row_number() OVER (PARTITION BY PLAYER_ID ORDER BY SEASON DESC) = 1", lagged=False))
sql("first_matching_row", chain(
    "SELECT PLAYER_ID, SEASON, stat, current, next FROM (SELECT * FROM chain WHERE NEXT_PTS IS NOT NULL "
    "ORDER BY PLAYER_ID, SEASON LIMIT 1) r, LATERAL (VALUES "
    + ", ".join(f"('{s}', CAST(r.{s} AS DOUBLE), CAST(r.NEXT_{s} AS DOUBLE))" for s in TARGET_STATS)
    + ") v(stat, current, next)"))

# ==== N ======================================================================================

FP_EXPR = ("PTS * 1.0 + REB * 1.0 + AST * 2.0 + STL * 4.0 + BLK * 4.0 + {fgm} * 2.0 + FGA * -1.0 + TOV * -2.0 "
           "+ FG3M * 1.0 + (FTA - {ftm}) * -1.0")
sql("fantasy_points", with_chain(
    f"SELECT PLAYER_ID, SEASON, {FP_EXPR.format(fgm='FGM', ftm='FTM')} AS FANTASY_POINTS FROM master", lagged=False))
COUNTING = ("PTS", "AST", "REB", "BLK", "STL", "TOV", "MIN", "FG3M", "FGA", "FTA")
_is_count = "target IN (" + ", ".join(f"'NEXT_{s}'" for s in COUNTING) + ")"
sql("prediction_interval", chain(
    "SELECT p.PLAYER_ID, p.SEASON, p.target, p.model, p.prediction, "
    f"CASE WHEN {_is_count.replace('target', 'p.target')} AND p.prediction - 1.96 * r.resid_std < 0 THEN 0.0 "
    "ELSE p.prediction - 1.96 * r.resid_std END AS low, p.prediction + 1.96 * r.resid_std AS high "
    "FROM pp p LEFT JOIN rs r ON p.model = r.model AND p.target = r.target",
    "vp AS (" + _lag1 + ")",
    "rs AS (SELECT model, target, stddev_samp(actual - prediction) AS resid_std FROM vp "
    "WHERE prediction IS NOT NULL AND actual IS NOT NULL GROUP BY model, target)",
    "pp AS (" + union_all(_pred_parts("Baseline_LAG1", lambda s: f"{s}_LAG1", "NEXT_PTS IS NULL")) + ")"))
PROJ_CTE = "proj AS (SELECT PLAYER_ID, SEASON, " + ", ".join(TARGET_STATS) + " FROM chain WHERE NEXT_PTS IS NULL)"
sql("rank_projections", chain(
    "SELECT *, CAST(row_number() OVER (ORDER BY FANTASY_POINTS DESC NULLS LAST, PLAYER_ID) AS INTEGER) AS RANK "
    "FROM fpj ORDER BY FANTASY_POINTS DESC NULLS LAST, PLAYER_ID LIMIT 100", PROJ_CTE,
    f"fpj AS (SELECT *, {FP_EXPR.format(fgm='(FGA * FG_PCT)', ftm='(FTA * FT_PCT)')} AS FANTASY_POINTS FROM proj)"))
sql("projection_summary", chain(
    "SELECT count(*) AS n_projected, " + ", ".join(f"avg({s}) AS avg_{s}" for s in TARGET_STATS) + " FROM proj",
    PROJ_CTE))
_FPJ = FP_EXPR.format(fgm="(FGA * FG_PCT)", ftm="(FTA * FT_PCT)")
_BOARD = [*TARGET_STATS, "FANTASY_POINTS"]
sql("projection_board", chain(
    "SELECT 'board' AS section, CAST(r AS INTEGER) AS rank, PLAYER_ID, PLAYER_NAME, stat, value FROM top, "
    "LATERAL (VALUES " + ", ".join(f"('{s}', CAST({s} AS DOUBLE))" for s in _BOARD) + ") v(stat, value) UNION ALL "
    "SELECT 'league', NULL, NULL, NULL, stat, value FROM (SELECT CAST(count(*) AS DOUBLE) AS n_projected, "
    + ", ".join(f"avg({s}) AS {s}" for s in _BOARD) + " FROM pf) a, LATERAL (VALUES "
    + ", ".join(f"('{s}', CAST({s} AS DOUBLE))" for s in ["n_projected", *_BOARD]) + ") v(stat, value)",
    f"pf AS (SELECT *, {_FPJ} AS FANTASY_POINTS FROM (SELECT PLAYER_ID, PLAYER_NAME, "
    + ", ".join(TARGET_STATS) + " FROM chain WHERE NEXT_PTS IS NULL))",
    "top AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY FANTASY_POINTS DESC NULLS LAST, PLAYER_ID) AS r "
    "FROM pf) WHERE r <= 10)"))
BT = ("PTS", "REB", "AST", "STL", "BLK", "TOV", "FGA", "FTA")
sql("backtest_accuracy", with_chain(
    "SELECT stat, count(*) AS n, avg(abs(p - a)) AS MAE, avg(p - a) AS bias, "
    "avg(abs((p - a) / NULLIF(a, 0))) * 100 AS MAPE FROM ("
    + union_all(f"SELECT '{s}' AS stat, CAST(x.{s} AS DOUBLE) AS p, CAST(y.{s} AS DOUBLE) AS a FROM master x "
                f"JOIN master y ON x.PLAYER_ID = y.PLAYER_ID WHERE x.SEASON = '1999-00' AND y.SEASON = '{VAL}'"
                for s in BT)
    + ") WHERE p IS NOT NULL AND a IS NOT NULL GROUP BY stat", lagged=False))
sql("position_from_height", with_chain(
    "SELECT PLAYER_ID, SEASON, HEIGHT_INCHES, coalesce(POSITION, CASE WHEN HEIGHT_INCHES <= 76 THEN 'Guard' "
    "WHEN HEIGHT_INCHES <= 80 THEN 'Forward' WHEN HEIGHT_INCHES IS NOT NULL THEN 'Center' END) AS POSITION "
    "FROM master", lagged=False))
