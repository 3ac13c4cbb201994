"""Validation, preparation, evaluation and ensemble operators vs brute force."""

from decimal import Decimal

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from panelforge.operators import ensembles as L
from panelforge.operators import evaluation as J
from panelforge.operators import models as K
from panelforge.operators import preparation as I
from panelforge.operators import profiling as P
from panelforge.operators.quantiles import exact_quantiles


def test_constant_and_near_constant(spark):
    rows = [(1.0, 0.0 if i < 995 else 1.0, 0.0 if i < 990 else 1.0, float(i % 3)) for i in range(1000)]
    df = spark.createDataFrame(rows, "const double, share995 double, share990 double, varied double")
    dropped = set(P.constant_columns(df))
    assert dropped == {"const", "share995"}               # 99.0 % top share is kept (must exceed .99)


def test_constant_columns_in_one_pass(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    nan = float("nan")
    rows = [(7, nan, None if i % 2 else nan, 0.0 if i % 2 else -0.0, None, i % 2, nan if i else 1.0, float("inf"),
             float(i == 399) + float(i == 398) * 2, Decimal(i // 399)) for i in range(400)]
    df = spark.createDataFrame(rows, "one int, nans double, gap double, zeros double, empty double, half int, "
                                     "rare double, inf double, three double, dec decimal(5,1)").repartition(3)
    df = df.mapInArrow(counted, df.schema)
    assert P.constant_columns(df) == ["one", "zeros", "inf", "nans", "gap", "rare", "dec"]
    assert read.value == 400


def test_missing_thresholds(spark):
    rows = [(None if i < 90 else 1.0, None if i < 91 else 1.0, 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "p90 double, p91 double, full double")
    assert P.drop_high_missing(df, 90.0).columns == ["p90", "full"]


def test_all_null_train_column_filled_then_scaled_to_zero(spark):
    train = spark.createDataFrame([(None, float(i)) for i in range(10)], "empty double, x double")
    val = spark.createDataFrame([(None, 3.0)], "empty double, x double")
    fv = I.FillValues.fit(train, ["empty", "x"])
    assert fv.values == {"empty": None}
    sp = I.apply_fill_values(fv, {"train": train, "val": val}, ["empty", "x"])
    sc = I.StandardScale.fit(sp["train"], ["empty", "x"])
    out = sc.transform(sp["val"]).first()
    assert out["empty"] == 0.0
    assert abs(out["x"] - (3.0 - 4.5) / np.std(np.arange(10.0))) < 1e-12     # population std


def test_fill_and_scale_depend_on_train_only(spark):
    train = spark.createDataFrame([(float(i) if i % 4 else None,) for i in range(40)], "x double")
    val1 = spark.createDataFrame([(None,), (1.0,)], "x double")
    val2 = spark.createDataFrame([(None,), (1e6,)], "x double")
    f1 = I.FillValues.fit(train, ["x"])
    s1 = I.StandardScale.fit(f1.transform(train), ["x"])
    assert f1.values["x"] == float(np.median([i for i in range(40) if i % 4]))
    a = s1.transform(f1.transform(val1)).collect()[0]["x"]
    b = s1.transform(f1.transform(val2)).collect()[0]["x"]
    assert a == b                                          # validation rows change nothing fitted


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=5003)
    x[::17] = np.nan
    pdf = pd.DataFrame({"x": x, "y": rng.integers(0, 5, size=5003).astype(float)})
    df = spark.createDataFrame(pdf)
    got = exact_quantiles(df, [("x", q) for q in (0.25, 0.5, 0.75)] + [("y", 0.5)], accuracy=100)
    for q in (0.25, 0.5, 0.75):
        assert abs(got[("x", q)] - np.nanquantile(x, q)) < 1e-12
    assert got[("y", 0.5)] == np.median(pdf["y"])


def test_regression_metrics_and_mape(spark):
    rows = [(1, "a", "NEXT_PTS", "m", 1.0, 2.0), (2, "a", "NEXT_PTS", "m", 3.0, 0.0), (3, "a", "NEXT_PTS", "m", 5.0, 4.0)]
    pred = spark.createDataFrame(rows, "PLAYER_ID long, SEASON string, target string, model string, "
                                       "prediction double, actual double")
    r = J.regression_metrics(pred).first()
    y, p = np.array([2.0, 0.0, 4.0]), np.array([1.0, 3.0, 5.0])
    assert abs(r["MAE"] - np.mean(np.abs(y - p))) < 1e-12
    assert abs(r["RMSE"] - np.sqrt(np.mean((y - p) ** 2))) < 1e-12
    assert abs(r["R2"] - (1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))) < 1e-12
    assert abs(r["MAPE"] - 100 * np.mean([0.5, 0.25])) < 1e-12            # zero actual skipped


def test_best_model_tie_first_in_order(spark):
    m = spark.createDataFrame([("t", "B", 1.0), ("t", "A", 1.0), ("t", "C", 2.0)], "target string, model string, MAE double")
    assert J.best_model_per_target(m, ["A", "B", "C"]).first()["best_model"] == "A"
    assert J.best_model_per_target(m, ["B", "A", "C"]).first()["best_model"] == "B"


def test_inverse_mae_weights_sum_to_one(spark):
    m = spark.createDataFrame([("t", "A", 1.0), ("t", "B", 2.0), ("u", "A", 4.0), ("u", "B", 4.0)],
                              "target string, model string, MAE double")
    w = {(r["target"], r["model"]): r["weight"] for r in L.ensemble_inverse_mae_weights(m).collect()}
    assert abs(w[("t", "A")] - 2 / 3) < 1e-12 and abs(w[("u", "B")] - 0.5) < 1e-12


def test_contiguous_folds_match_ntile(spark):
    n, k = 103, 5
    df = spark.createDataFrame([(i, f"s{i % 3}") for i in range(n)], "PLAYER_ID long, SEASON string")
    got = {(r["PLAYER_ID"], r["SEASON"]): r["fold"] for r in K.contiguous_folds(df, k, ["PLAYER_ID", "SEASON"]).collect()}
    order = sorted(got)
    sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
    expect, start = {}, 0
    for f, size in enumerate(sizes):
        for key in order[start:start + size]:
            expect[key] = f
        start += size
    assert got == expect


@pytest.mark.parametrize(("keys", "k"), [
    ([None, 3, 1, None, 2, 9, 7, 4], 3), ([5] * 7 + [None, 6, 1], 4), ([2, 1], 5), ([], 3), ([None] * 4, 2)])
def test_contiguous_folds_of_null_and_equal_keys(spark, keys, k):
    """Nulls come first; equal keys on both sides of a fold's start are dealt so that sizes stay those of ntile."""
    df = spark.createDataFrame([(i, x, "s") for i, x in enumerate(keys)], "id long, PLAYER_ID long, SEASON string")
    rows = K.contiguous_folds(df, k, ["PLAYER_ID", "SEASON"]).collect()
    got = sorted(((r["PLAYER_ID"] is not None, r["PLAYER_ID"] or 0), r["fold"]) for r in rows)
    n = len(keys)
    folds = [f for f in range(k) for _ in range(n // k + (f < n % k))]
    assert got == list(zip(sorted((x is not None, x or 0) for x in keys), folds, strict=True))
    assert sorted(r["id"] for r in rows) == list(range(n))


def test_contiguous_folds_leave_wide_rows_where_they_are(spark):
    df = spark.range(50).select(F.col("id").alias("PLAYER_ID"), F.lit("s").alias("SEASON"), F.lit(1.0).alias("x"))
    plan = K.contiguous_folds(df, 3, ["PLAYER_ID", "SEASON"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan" not in plan


def test_masked_correlation_pairwise_complete(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=400)
    b = a * 2 + rng.normal(size=400) * 0.1
    c = rng.normal(size=400)
    b[::9] = np.nan
    pdf = pd.DataFrame({"a": a, "b": b, "c": c})
    got = {(r["feature1"], r["feature2"]): r["correlation"]
           for r in P.masked_correlation(spark.createDataFrame(pdf), ["a", "b", "c"]).collect()}
    ok = ~np.isnan(b)
    assert abs(got[("a", "b")] - np.corrcoef(a[ok], b[ok])[0, 1]) < 1e-9
    assert abs(got[("a", "c")] - np.corrcoef(a, c)[0, 1]) < 1e-9
    assert F is not None


def test_null_counts_of_every_type_by_split(spark):
    nan, one = float("nan"), Decimal("1.5")
    rows = [("a", 1.0, 1, True, "x", one), ("a", nan, None, None, None, None), ("a", None, 2, False, "", one),
            ("b", nan, 3, None, "y", None), (None, None, None, True, None, one)]
    df = spark.createDataFrame(rows, "split string, `d.e` double, i int, f boolean, t string, n decimal(10,2)")
    cols = ["d.e", "i", "f", "t", "n"]
    nulls, n = I.null_counts(df, cols, "split")
    assert n == {"a": 3, "b": 1, None: 1}
    assert nulls["a"] == {"d.e": 2, "i": 1, "f": 1, "t": 1, "n": 1}
    assert nulls["b"] == {"d.e": 1, "i": 0, "f": 1, "t": 0, "n": 1}
    assert I.null_counts(df, cols) == ({None: {"d.e": 4, "i": 2, "f": 2, "t": 2, "n": 2}}, {None: 5})
    assert I.null_counts(df.where("false"), cols) == ({None: dict.fromkeys(cols, 0)}, {None: 0})
