"""Cleaning operators (family B) on inline frames."""

from pyspark.sql import functions as F

from panelforge.operators import cleaning as B


def test_fill_period_mean_all_null_period_stays_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None), ("b", None)], "SEASON string, x double")
    got = sorted((r["SEASON"], r["x"]) for r in B.fill_period_mean(df, "SEASON").collect())
    assert got == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", None), ("b", None)]


def test_coerce_numeric_undrafted(spark):
    df = spark.createDataFrame([("12",), ("Undrafted",), (None,), (" 7 ",)], "DRAFT_NUMBER string")
    got = [r[0] for r in B.coerce_numeric(df, ["DRAFT_NUMBER"], fill=0.0).collect()]
    assert got == [12.0, 0.0, 0.0, 7.0]


def test_map_lookup_unmapped_and_period_label(spark):
    df = spark.createDataFrame([("ATL", 2023), ("XXX", 1999)], "TEAM_ABBREVIATION string, yr int")
    out = B.period_label(B.map_lookup(df, {"ATL": "Atlanta Hawks"}, "TEAM_ABBREVIATION", "TEAM_NAME"), "yr")
    got = sorted((r["TEAM_ABBREVIATION"], r["TEAM_NAME"], r["SEASON"]) for r in out.collect())
    assert got == [("ATL", "Atlanta Hawks", "2023-24"), ("XXX", None, "1999-00")]


def test_fill_global_median_and_pct_zero(spark):
    df = spark.createDataFrame([(1.0, None), (None, 0.5), (3.0, None), (10.0, 0.25)], "PACE double, FG_PCT double")
    med = sorted(r["PACE"] for r in B.fill_global_median(df, ["PACE"]).collect())
    assert med == [1.0, 3.0, 3.0, 10.0]
    pct = [r["FG_PCT"] for r in B.fill_pct_zero(df).collect()]
    assert pct == [0.0, 0.5, 0.0, 0.25]
    assert F is not None


def test_dedup_keep_first_holds_a_row_once(spark):
    df = spark.createDataFrame([("a", 2, 1.0, "x"), ("a", 1, None, "y"), ("a", 1, None, None), ("a", 1, 3.0, "w"),
                                (None, 1, 5.0, "z"), (None, 1, 4.0, "z"), ("b", None, 7.0, None)],
                               "k string, o int, v double, t string")
    out = B.dedup_keep_first(df, ["k"], ["o", "v"])
    got = {r["k"]: (r["o"], r["v"], r["t"]) for r in out.collect()}
    assert got == {"a": (1, None, None), None: (1, 4.0, "z"), "b": (None, 7.0, None)}
    assert out.schema == df.schema
    # the row is shuffled in one struct, not in one for the order and one for the row
    assert "min_by" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_dedup_keep_first_with_a_column_that_has_no_order(spark):
    df = spark.createDataFrame([("a", 2, {"p": 1}), ("a", 1, {"q": 2})], "k string, o int, m map<string,int>")
    assert [tuple(r) for r in B.dedup_keep_first(df, ["k"], ["o"]).collect()] == [("a", 1, {"q": 2})]
