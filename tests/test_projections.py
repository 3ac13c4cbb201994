"""Documented projection formulas: fantasy points, intervals, ranking, backtest."""

import numpy as np

from panelforge.operators import projections as N


def test_fantasy_points_formula(spark):
    df = spark.createDataFrame([(20.0, 5.0, 4.0, 1.0, 0.5, 15.0, 0.5, 2.0, 2.0, 6.0, 0.75)],
                               "PTS double, REB double, AST double, STL double, BLK double, FGA double, "
                               "FG_PCT double, TOV double, FG3M double, FTA double, FT_PCT double")
    fp = N.fantasy_points(df).first()["FANTASY_POINTS"]
    fgm, ftm = 15.0 * 0.5, 6.0 * 0.75
    expect = 20 + 5 + 2 * 4 + 4 * 1 + 4 * 0.5 + 2 * fgm - 15 - 2 * 2 + 2 - (6 - ftm)
    assert abs(fp - expect) < 1e-12


def test_prediction_interval_clips_counting_stats(spark):
    pred = spark.createDataFrame([(1, "s", "NEXT_PTS", "m", 1.0), (1, "s", "NEXT_FG_PCT", "m", 0.1)],
                                 "PLAYER_ID long, SEASON string, target string, model string, prediction double")
    resid = spark.createDataFrame([("m", "NEXT_PTS", 2.0), ("m", "NEXT_FG_PCT", 0.1)],
                                  "model string, target string, resid_std double")
    got = {r["target"]: (r["low"], r["high"]) for r in N.prediction_interval(pred, resid).collect()}
    assert got["NEXT_PTS"] == (0.0, 1.0 + 1.96 * 2.0)                 # counting stat clipped at 0
    assert abs(got["NEXT_FG_PCT"][0] - (0.1 - 0.196)) < 1e-12       # percentage not clipped


def test_rank_and_backtest(spark):
    proj = spark.createDataFrame([(i, float(i % 7), float(i)) for i in range(50)],
                                 "PLAYER_ID long, FANTASY_POINTS double, PTS double")
    top = N.rank_projections(proj, k=5).collect()
    assert [r["RANK"] for r in top] == [1, 2, 3, 4, 5] and all(r["FANTASY_POINTS"] == 6.0 for r in top)
    assert [r["PLAYER_ID"] for r in top] == [6, 13, 20, 27, 34]     # ties broken by key
    actual = spark.createDataFrame([(i, float(i) + (1.0 if i % 2 else -1.0)) for i in range(1, 50)],
                                   "PLAYER_ID long, PTS double")
    r = N.backtest_accuracy(proj, actual, ["PTS"]).first()
    p = np.arange(1, 50, dtype=float)
    a = p + np.where(np.arange(1, 50) % 2, 1.0, -1.0)
    assert r["n"] == 49 and abs(r["MAE"] - 1.0) < 1e-12 and abs(r["bias"] - np.mean(p - a)) < 1e-12
    assert abs(r["MAPE"] - 100 * np.mean(np.abs((p - a) / a))) < 1e-9


def test_rank_all_rows(spark):
    df = spark.createDataFrame([(i, float((i * 37) % 101 // 3)) for i in range(200)], "PLAYER_ID long, FANTASY_POINTS double")
    got = N.rank_projections(df.repartition(5), k=None).collect()
    want = sorted(((i, float((i * 37) % 101 // 3)) for i in range(200)), key=lambda x: (-x[1], x[0]))
    assert [(r["PLAYER_ID"], r["FANTASY_POINTS"]) for r in sorted(got, key=lambda r: r["RANK"])] == want
    assert sorted(r["RANK"] for r in got) == list(range(1, 201))


def test_position_groups_score_rows_without_a_group(spark):
    rows = [(i, "1", p, float(i)) for i, p in enumerate(["Guard", "Center", None, "Guard", "Forward"])]
    df = spark.createDataFrame(rows, "PLAYER_ID long, SEASON string, POSITION string, y double")
    seen = []

    class Mean:
        def __init__(self, v):
            self.v = v

        def transform(self, frame):
            from pyspark.sql import functions as F

            return frame.withColumn("prediction", F.lit(self.v))

    def fit(frame):
        seen.append(sorted(r["PLAYER_ID"] for r in frame.collect()))
        return Mean(float(len(seen)))

    got = N.position_group_models(df.where("POSITION is null or POSITION != 'Forward'"), df, fit, "y").collect()
    assert seen == [[0, 3], [1], [0, 1, 2, 3]]
    assert {r["PLAYER_ID"]: r["prediction"] for r in got} == {0: 1.0, 3: 1.0, 1: 2.0, 2: 3.0, 4: 3.0}
