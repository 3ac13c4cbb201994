"""Window operators on inline edge frames (FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from panelforge.operators import availability as G
from panelforge.operators import cleaning as B
from panelforge.operators import panel_windows as E
from panelforge.spec import DEFAULT_SPEC

SCHEMA = "PLAYER_ID long, SEASON string, SEASON_ORDER int, PTS double, MIN double, GP long, AGE double"


def _rows(df, *cols):
    return {(r["PLAYER_ID"], r["SEASON"]): tuple(r[c] for c in cols) for r in df.collect()}


def test_single_period_entity(spark):
    df = spark.createDataFrame([(1, "2000-01", 1, 10.0, 30.0, 70, 25.0)], SCHEMA)
    out = E.lag_chain(df, DEFAULT_SPEC, with_targets=True)
    r = out.first()
    assert r["NEXT_PTS"] is None and r["PTS_LAG1"] is None
    assert r["IS_ROOKIE"] == 1 and r["PTS_STD3"] is None and r["HISTORICAL_SEASONS_AVAILABLE"] == 0


def test_two_lags_only(spark):
    rows = [(1, "2000-01", 1, 10.0, 30.0, 60, 25.0), (1, "2001-02", 2, 14.0, 32.0, 70, 26.0),
            (1, "2002-03", 3, 20.0, 35.0, 80, 27.0)]
    out = G.availability_chain(E.lag_chain(spark.createDataFrame(rows, SCHEMA), DEFAULT_SPEC))
    last = out.where(F.col("SEASON") == "2002-03").first()
    assert last["PTS_LAG1"] == 14.0 and last["PTS_LAG2"] == 10.0 and last["PTS_LAG3"] is None
    # sample std of the two available lags, CV = std / mean
    assert abs(last["PTS_STD3"] - 2.8284271247461903) < 1e-12
    assert abs(last["PTS_CV3"] - 2.8284271247461903 / 12.0) < 1e-12
    assert last["PTS_AVG2"] == 12.0 and last["PTS_AVG3"] is None and last["PTS_WAVG"] is None
    assert last["AVAILABILITY_SCORE"] is None          # GP_LAG3 missing -> null
    assert last["HISTORICAL_SEASONS_AVAILABLE"] == 2 and last["IS_ROOKIE"] == 0


def test_gap_positional_vs_strict(spark):
    rows = [(1, "1995-96", 1, 10.0, 30.0, 60, 25.0), (1, "1997-98", 3, 14.0, 32.0, 70, 27.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    pos = _rows(E.lag_features(df, DEFAULT_SPEC, stats=["PTS"]), "PTS_LAG1")
    strict = _rows(E.lag_features(df, DEFAULT_SPEC, stats=["PTS"], strict=True), "PTS_LAG1")
    assert pos[(1, "1997-98")] == (10.0,)          # the gap is bridged
    assert strict[(1, "1997-98")] == (None,)        # not adjacent periods
    tgt = _rows(E.create_targets(df, DEFAULT_SPEC, stats=["PTS"]), "NEXT_PTS")
    assert tgt[(1, "1995-96")] == (14.0,)


def test_lead_lag_inverse(spark):
    rows = [(p, f"{1995 + y}-{(1996 + y) % 100:02d}", y + 1, float(p * 10 + y), 30.0, 70, 25.0)
            for p in range(1, 4) for y in range(4)]
    out = E.targets_and_lags(spark.createDataFrame(rows, SCHEMA), DEFAULT_SPEC)
    got = _rows(out, "PTS", "NEXT_PTS", "PTS_LAG1")
    for (p, season), (pts, nxt, lag1) in got.items():
        nxt_key = [k for k in got if k[0] == p and k[1] > season]
        if nxt_key:
            assert got[min(nxt_key)][2] == pts            # lag of the next row is this row
        else:
            assert nxt is None


def test_dedup_keep_first_tie_break(spark):
    df = spark.createDataFrame([(1, "2000-01", 1, 10.0, 30.0, 70, 25.0), (1, "2000-01", 1, 12.0, 31.0, 50, 25.0)],
                               SCHEMA)
    out = B.dedup_keep_first(df, ["PLAYER_ID", "SEASON"], ["GP", "MIN"]).collect()
    assert len(out) == 1 and out[0]["GP"] == 50       # first by the explicit tie-break


def test_one_window_exchange(spark):
    rows = [(p, f"{1995 + y}-{(1996 + y) % 100:02d}", y + 1, 1.0, 1.0, 70, 25.0) for p in range(5) for y in range(3)]
    out = E.lag_chain(spark.createDataFrame(rows, SCHEMA), DEFAULT_SPEC, with_targets=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(PLAYER_ID") <= 1
