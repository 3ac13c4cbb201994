"""Joins with a measured side, ties among winners, the projection board, team ratios."""

import pytest

from panelforge.operators import derived as D
from panelforge.operators import evaluation as J
from panelforge.operators import projections as N
from panelforge.operators.bounded import join_small


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_join_small_same_rows_on_both_ways(spark, max_bytes):
    left = spark.createDataFrame([(i, "ab"[i % 2] if i % 3 else None, 2000 + i % 2) for i in range(60)],
                                 "id int, team string, season int")
    small = spark.createDataFrame([("a", 2000, 1.5), ("b", 2001, 2.5), (None, 2000, 9.0)],
                                  "team string, season int, v double")
    got = join_small(left, small, ["team", "season"], max_bytes)
    assert got.columns == ["team", "season", "id", "v"]
    assert {r.id: r.v for r in got.collect()} == {
        i: None if i % 3 == 0 else (1.5, 2.5)[i % 2] for i in range(60)}
    assert join_small(left, small.limit(0), ["team", "season"], max_bytes, derived=True).count() == 60


def test_join_small_spreads_rows_without_a_key(spark):
    left = spark.range(2000).selectExpr("id", "cast(null as string) as team")
    small = spark.createDataFrame([("a", 1.0)], "team string, v double")
    plan = join_small(left, small, ["team"], 0)
    text = plan._jdf.queryExecution().analyzed().toString()
    assert "__salt" in text and plan.where("v is null").count() == 2000
    assert plan.columns == ["team", "id", "v"]


def test_wins_with_ties(spark):
    nan = float("nan")
    m = spark.createDataFrame([("x", "t1", 1.0, 0.5), ("y", "t1", 1.0, 0.4), ("x", "t2", 3.0, 0.1), ("y", "t2", 2.0, 0.2),
                               ("x", "t3", nan, 0.0), ("y", "t3", 5.0, 0.0), ("x", "t4", None, 0.0)],
                              "model string, target string, MAE double, R2 double")
    got = {r.approach: (r.wins, r.n_targets, r.avg_MAE) for r in J.wins_with_ties(m).collect()}
    assert got == {"x": (1, 2, 2.0), "y": (3, 3, pytest.approx(8 / 3))}


def test_metrics_leave_out_nan_on_either_side(spark):
    nan = float("nan")
    p = spark.createDataFrame([("m", "t", 1.0, 2.0), ("m", "t", nan, 2.0), ("m", "t", 1.0, nan), ("m", "t", None, 1.0)],
                              "model string, target string, prediction double, actual double")
    r = J.regression_metrics(p).first()
    assert (r.n, r.MAE) == (1, 1.0) and J.mape(p).first().MAPE == 50.0


def test_projection_board(spark):
    df = spark.createDataFrame([(i, f"p{i}", float(i % 7), float(i // 7)) for i in range(30)],
                               "PLAYER_ID long, PLAYER_NAME string, PTS double, FANTASY_POINTS double")
    rows = N.projection_board(df, ["PTS"], k=10).collect()
    board = [r for r in rows if r.section == "board" and r.stat == "FANTASY_POINTS"]
    want = sorted(range(30), key=lambda i: (-(i // 7), i))[:10]
    assert [r.PLAYER_ID for r in sorted(board, key=lambda r: r.rank)] == want
    league = {r.stat: r.value for r in rows if r.section == "league"}
    assert league["n_projected"] == 30 and league["PTS"] == pytest.approx(sum(i % 7 for i in range(30)) / 30)
    empty = N.projection_board(df.limit(0), ["PTS"]).collect()
    assert {(r.section, r.stat, r.value) for r in empty} == {
        ("league", "n_projected", 0.0), ("league", "PTS", None), ("league", "FANTASY_POINTS", None)}


def test_team_ratios_only_where_absent(spark):
    t = spark.createDataFrame([(1, 100.0, 20.0, 10.0, 40.0, 80.0, 30.0, 25.0, 0.25)],
                              "TEAM_ID long, PTS double, AST double, TOV double, FGM double, FGA double, FG3A double, "
                              "FTA double, OREB_PCT double")
    r = D.team_derived_stats(t).first()
    assert r.TS_PCT == pytest.approx(100 / (2 * 91)) and r.FG3A_RATE == 0.375 and r.REB_PCT == 0.25
    assert r.AST_RATIO == pytest.approx(100 * 20 / (80 + 11 - 10 + 10)) and r.TOV_RATE == pytest.approx(1000 / 101)
    kept = D.team_derived_stats(t.selectExpr("*", "7D AS TS_PCT", "8D AS TM_TOV_PCT")).first()
    assert (kept.TS_PCT, kept.TOV_RATE) == (7.0, 8.0)
