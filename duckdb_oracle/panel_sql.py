"""DuckDB reference SQL for the driver panel (verification only, not used by the engine).

The CTE chain mirrors, in plain SQL, the stand-in tables of
``panelforge.sources.driver_tables`` and the master / lagged panel the
engine builds.  Each registered query appends its own SELECT.
"""

from __future__ import annotations

from panelforge import spec as S

TRAIN = ("1995-96", "1996-97", "1997-98", "1998-99", "1999-00")
VAL = "2000-01"


def season_case(col: str = "SEASON") -> str:
    whens = " ".join(f"WHEN '{y}-{(y + 1) % 100:02d}' THEN {y - 1994}" for y in range(1995, 2002))
    return f"CAST(CASE {col} {whens} END AS INTEGER)"


def share(cond: str) -> str:
    return f"avg(CASE WHEN {cond} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


LABEL = "printf('%d-%02d', yr, (yr + 1) % 100)"

RAW = f"""
om AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty, avg(l_quantity) AS avg_qty,
         avg(l_discount) AS disc, avg(l_tax) AS tax,
         {share("l_returnflag = 'A'")} AS sh_a, {share("l_returnflag = 'R'")} AS sh_r,
         {share("l_returnflag = 'N'")} AS sh_n, {share("l_linestatus = 'F'")} AS sh_f,
         {share("l_tax > 0.04")} AS sh_tax, {share("l_discount > 0.05")} AS sh_disc,
         avg(l_linenumber) AS ln, {share("l_quantity > 25")} AS sh_q,
         avg(p_size) AS psize,
         avg(p_retailprice / NULLIF(p_retailprice + l_extendedprice / NULLIF(l_quantity, 0), 0)) AS pie
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey),
cy AS (
  SELECT o_custkey, year(o_orderdate) AS yr, count(*) AS n_orders, avg(qty) AS avg_order_qty,
         avg(o_totalprice) AS avg_price, avg(disc) AS disc, avg(tax) AS tax,
         avg(sh_a) AS sh_a, avg(sh_r) AS sh_r, avg(sh_n) AS sh_n, avg(n_lines) AS lines,
         avg(sh_f) AS sh_f, avg(sh_tax) AS sh_tax, avg(sh_disc) AS sh_disc, avg(ln) AS ln,
         avg(sh_q) AS sh_q, avg(avg_qty) AS avg_qty, avg(psize) AS psize, avg(pie) AS pie
  FROM orders LEFT JOIN om ON o_orderkey = l_orderkey
  GROUP BY o_custkey, year(o_orderdate)),
cyr AS (
  SELECT o_custkey, yr, n_orders, round(avg_order_qty, 10) AS avg_order_qty, round(avg_price, 10) AS avg_price, round(disc, 10) AS disc, round(tax, 10) AS tax, round(sh_a, 10) AS sh_a, round(sh_r, 10) AS sh_r, round(sh_n, 10) AS sh_n, round(lines, 10) AS lines, round(sh_f, 10) AS sh_f, round(sh_tax, 10) AS sh_tax, round(sh_disc, 10) AS sh_disc, round(ln, 10) AS ln, round(sh_q, 10) AS sh_q, round(avg_qty, 10) AS avg_qty, round(psize, 10) AS psize, round(pie, 10) AS pie
  FROM cy),
ps AS (
  SELECT o_custkey AS PLAYER_ID, c_name AS PLAYER_NAME, CAST(c_nationkey AS VARCHAR) AS TEAM_ABBREVIATION,
         CAST(19 + (yr - min(yr) OVER (PARTITION BY o_custkey)) + o_custkey % 16 AS DOUBLE) AS AGE,
         CAST(yr - min(yr) OVER (PARTITION BY o_custkey) AS DOUBLE) AS YEARS_EXPERIENCE,
         9 * n_orders AS GP, avg_order_qty / 4 AS MIN, avg_price / 10000 AS PTS,
         100.0 * tax AS REB, 100.0 * disc AS AST, 3.0 * sh_a AS STL, 3.0 * sh_r AS BLK, 4.0 * sh_n AS TOV,
         (2.5 * lines) * sh_f AS FGM, 2.5 * lines AS FGA, sh_f AS FG_PCT,
         (sh_tax * (2.5 * lines)) * sh_disc AS FG3M, sh_tax * (2.5 * lines) AS FG3A, sh_disc AS FG3_PCT,
         ln * sh_q AS FTM, ln AS FTA, sh_q AS FT_PCT,
         {LABEL} AS SEASON
  FROM cyr LEFT JOIN customer ON o_custkey = c_custkey),
adv AS (
  SELECT o_custkey AS PLAYER_ID, {LABEL} AS SEASON, avg_qty / 50 AS USG_PCT, 1.0 - 5.0 * disc AS TS_PCT,
         psize / 50 AS AST_PCT, 10.0 * tax AS REB_PCT, pie AS PIE
  FROM cyr),
bio_raw AS (
  SELECT c_custkey AS PERSON_ID, c_name AS DISPLAY_FIRST_LAST,
         CASE WHEN c_custkey % 30 = 0 THEN 'unknown'
              ELSE printf('%04d-%02d-%02dT00:00:00', 1970 + c_custkey % 20, 1 + c_custkey % 12, 1 + c_custkey % 28)
         END AS BIRTHDATE,
         n_name AS COUNTRY,
         CASE WHEN c_custkey % 50 = 0 THEN '6-' ELSE printf('6-%d', c_custkey % 12) END AS HEIGHT,
         CASE WHEN c_custkey % 40 = 0 THEN '' ELSE CAST(180 + c_custkey % 100 AS VARCHAR) END AS WEIGHT,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Guard' WHEN 'BUILDING' THEN 'Forward'
              WHEN 'FURNITURE' THEN 'Center' WHEN 'HOUSEHOLD' THEN 'Guard-Forward' END AS POSITION,
         CASE WHEN c_custkey % 7 = 0 THEN 'Undrafted' ELSE CAST(1990 + c_custkey % 20 AS VARCHAR) END AS DRAFT_YEAR,
         CASE WHEN c_custkey % 7 = 0 THEN 'Undrafted' ELSE CAST(1 + c_custkey % 2 AS VARCHAR) END AS DRAFT_ROUND,
         CASE WHEN c_custkey % 7 = 0 THEN 'Undrafted' ELSE CAST(1 + c_custkey % 60 AS VARCHAR) END AS DRAFT_NUMBER
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
bio AS (
  SELECT PERSON_ID AS PLAYER_ID, DISPLAY_FIRST_LAST AS PLAYER_NAME,
         try_cast(BIRTHDATE AS TIMESTAMP) AS BIRTHDATE, COUNTRY, HEIGHT,
         CASE WHEN len(string_split(HEIGHT, '-')) = 2
               AND try_cast(split_part(HEIGHT, '-', 1) AS INTEGER) IS NOT NULL
               AND try_cast(split_part(HEIGHT, '-', 2) AS INTEGER) IS NOT NULL
              THEN CAST(try_cast(split_part(HEIGHT, '-', 1) AS INTEGER) * 12
                        + try_cast(split_part(HEIGHT, '-', 2) AS INTEGER) AS DOUBLE) END AS HEIGHT_INCHES,
         try_cast(trim(WEIGHT) AS DOUBLE) AS WEIGHT, POSITION,
         coalesce(DRAFT_YEAR, 'Undrafted') AS DRAFT_YEAR, DRAFT_ROUND, DRAFT_NUMBER
  FROM bio_raw),
tm AS (
  SELECT c_nationkey, year(o_orderdate) AS yr, count(*) AS GP,
         CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS W,
         round(avg(o_totalprice), 10) AS avg_price, round({share("o_orderstatus = 'F'")}, 10) AS sh_f,
         round({share("o_orderstatus = 'O'")}, 10) AS sh_o
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY c_nationkey, year(o_orderdate)),
team AS (
  SELECT CAST(1610612700 + c_nationkey AS BIGINT) AS TEAM_ID, n_name AS TEAM_NAME, {LABEL} AS SEASON,
         GP, W, GP - W AS L, sh_f AS W_PCT, 90.0 + avg_price / 15000 AS PACE,
         100.0 + 20.0 * sh_f AS OFF_RATING, 100.0 + 20.0 * sh_o AS DEF_RATING,
         (100.0 + 20.0 * sh_f) - (100.0 + 20.0 * sh_o) AS NET_RATING
  FROM tm LEFT JOIN nation ON c_nationkey = n_nationkey),
lk AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name FROM nation WHERE n_nationkey NOT IN (23, 24))
"""

MASTER = f"""
joined AS (
  SELECT ps.*, b.POSITION, b.HEIGHT, b.HEIGHT_INCHES, b.WEIGHT, b.DRAFT_YEAR, b.DRAFT_ROUND, b.DRAFT_NUMBER,
         b.COUNTRY, lk.name AS TEAM_NAME,
         t.PACE AS TEAM_PACE, t.OFF_RATING AS TEAM_OFF_RATING, t.DEF_RATING AS TEAM_DEF_RATING,
         t.NET_RATING AS TEAM_NET_RATING, t.W AS TEAM_W, t.L AS TEAM_L, t.W_PCT AS TEAM_W_PCT,
         a.USG_PCT AS ADV_USG_PCT, a.AST_PCT AS ADV_AST_PCT, a.REB_PCT AS ADV_REB_PCT,
         a.TS_PCT AS ADV_TS_PCT, a.PIE AS ADV_PIE
  FROM ps
  LEFT JOIN bio b ON ps.PLAYER_ID = b.PLAYER_ID
  LEFT JOIN lk ON ps.TEAM_ABBREVIATION = lk.code
  LEFT JOIN team t ON lk.name = t.TEAM_NAME AND ps.SEASON = t.SEASON
  LEFT JOIN adv a ON ps.PLAYER_ID = a.PLAYER_ID AND ps.SEASON = a.SEASON),
master AS (
  SELECT *, {season_case()} AS SEASON_ORDER FROM joined
  WHERE GP >= 10
  QUALIFY row_number() OVER (PARTITION BY PLAYER_ID, SEASON ORDER BY GP, MIN, PTS) = 1)
"""


def _lag_list():
    return list(S.LAG_STATS) + list(S.ADVANCED_LAG_STATS)


def lagged_cte() -> str:
    leads = ", ".join(f"lead({s}) OVER w AS NEXT_{s}" for s in S.TARGET_STATS)
    lags = ", ".join(f"lag({s}, {k}) OVER w AS {s}_LAG{k}" for s in _lag_list() for k in (1, 2, 3))
    return f"""
lagged AS (
  SELECT *, {leads}, {lags}
  FROM master
  WINDOW w AS (PARTITION BY PLAYER_ID ORDER BY SEASON))
"""


def with_chain(select: str, *extra_ctes: str, lagged: bool = True) -> str:
    ctes = [RAW.strip(), MASTER.strip()]
    if lagged:
        ctes.append(lagged_cte().strip())
    ctes += [c.strip() for c in extra_ctes]
    return "WITH " + ",\n".join(ctes) + "\n" + select
