"""Derived / availability / cleaning expressions: null rules, zero denominators, bin edges."""

import math

from pyspark.sql import functions as F

from panelforge.functions import parse_height, raw_div, replace_inf
from panelforge.functions import sqltext as X
from panelforge.operators import availability as G
from panelforge.operators import derived as D


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(10.0, 0.0, 3.0, 0.0, 0.0, 0.0, 70)],
                               "PTS double, MIN double, AST double, TOV double, FGA double, FTA double, GP long")
    r = D.efficiency_features(df).first()
    assert r["PTS_PER_MIN"] is None and r["AST_TO_RATIO"] is None and r["PTS_PER_ATTEMPT"] is None


def test_null_comparisons_give_zero(spark):
    df = spark.createDataFrame([(None, None, None, None, None, None, None, None, None)],
                               "AGE double, GP_LAG1 double, GP_LAG2 double, GP_LAG3 double, MIN double, "
                               "MIN_LAG1 double, MIN_LAG2 double, TEAM_W_PCT double, GP long")
    r = G.availability_chain(df).first()
    for c in ("VETERAN_INJURY_RISK", "INJURY_PRONE_PATTERN", "RECOVERY_YEAR", "LOAD_MANAGEMENT",
              "RECOVERING_FROM_LOW_PLAY", "REDUCED_MINUTES", "HEAVY_MINUTES_LOAD", "GP_IMPROVING"):
        assert r[c] == 0, c
    assert r["AGE_INJURY_RISK"] is None                   # clip keeps null


def test_age_bins_right_closed(spark):
    ages = [0.0, 23.0, 23.5, 27.0, 30.0, 33.0, 100.0, 101.0]
    df = spark.createDataFrame([(a,) for a in ages], "AGE double")
    got = {r["AGE"]: r["AGE_BIN"] for r in D.age_features(df).collect()}
    assert got == {0.0: None, 23.0: 1.0, 23.5: 2.0, 27.0: 2.0, 30.0: 3.0, 33.0: 4.0, 100.0: 5.0, 101.0: None}


def test_availability_tier_edges(spark):
    # right-closed tier bins on exact edge values
    df = spark.createDataFrame([(v,) for v in (0.0, 0.6, 0.61, 0.8, 1.0, 1.01)], "s double")
    got = [r[0] for r in df.selectExpr(X.cut("s", G.TIER_EDGES)).collect()]
    assert got == [None, 1.0, 2.0, 2.0, 3.0, None]
    # scores that are exact in binary (AGE 25: no age adjustment)
    rows = [(25.0, 0.0, 0.0, 0.0), (25.0, 41.0, 41.0, 41.0), (25.0, 82.0, 82.0, 82.0), (25.0, 83.0, 83.0, 83.0)]
    df = spark.createDataFrame(rows, "AGE double, GP_LAG1 double, GP_LAG2 double, GP_LAG3 double")
    got = [(r["AVAILABILITY_SCORE"], r["AVAILABILITY_TIER"]) for r in G.availability_score(df).collect()]
    assert got[:3] == [(0.0, None), (0.5, 1.0), (1.0, 3.0)] and got[3][1] is None


def test_physical_bins(spark):
    df = spark.createDataFrame([(75.0, 190.0), (79.0, 220.0), (82.0, 250.0), (83.0, 400.0), (0.0, 401.0)],
                               "HEIGHT_INCHES double, WEIGHT double")
    got = [(r["HEIGHT_CAT"], r["WEIGHT_CAT"]) for r in D.physical_features(df).collect()]
    assert got == [(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (4.0, 4.0), (None, None)]
    bmi = D.physical_features(df).collect()[-1]["BMI"]
    assert bmi == math.inf                                # unguarded division, as the reference


def test_parse_height(spark):
    cases = [("6-7", 79.0), ("6-", None), ("67", None), ("", None), (None, None), ("6-7-1", None), ("a-b", None)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "h string")
    got = [r[0] for r in df.select(parse_height("h")).collect()]
    assert got == [v for _, v in cases]


def test_raw_div_and_replace_inf(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (6.0, 3.0)], "a double, b double")
    vals = [r[0] for r in df.select(raw_div("a", "b")).collect()]
    assert vals[0] == math.inf and vals[1] == -math.inf and math.isnan(vals[2]) and vals[3] is None and vals[4] == 2.0
    rep = [r[0] for r in df.select(replace_inf(raw_div("a", "b"))).collect()]
    assert rep[0] == 0.0 and rep[1] == 0.0 and math.isnan(rep[2])


def test_position_one_hot_and_groups(spark):
    df = spark.createDataFrame([("Guard",), ("Forward-Center",), (None,)], "POSITION string")
    out = D.position_groups(D.position_one_hot(df, ["Guard", "Forward-Center"])).collect()
    assert [(r["POS_Guard"], r["POS_Forward-Center"]) for r in out] == [(True, False), (False, True), (False, False)]
    assert [(r["IS_GUARD"], r["IS_FORWARD"], r["IS_CENTER"]) for r in out] == [(1, 0, 0), (0, 1, 1), (0, 0, 0)]


def test_flags_are_integers(spark):
    df = spark.createDataFrame([(30.0, 13.0, 5.0, 8.0, 1.5, 1.0, 40.0, 5.0, 20.0)],
                               "MIN double, FGA double, AST double, REB double, STL double, BLK double, PTS double, "
                               "FG3A double, FTA double")
    r = D.role_features(df).first()
    assert (r["SCORER_ROLE"], r["PLAYMAKER_ROLE"], r["REBOUNDER_ROLE"], r["DEFENDER_ROLE"]) == (1, 1, 1, 1)
    assert dict(D.role_features(df).dtypes)["SCORER_ROLE"] == "int"
    assert F is not None
