"""Exact quantiles on any pattern of ties."""

import numpy as np
import pytest

from panelforge.operators.quantiles import exact_quantiles

QS = (0.0, 0.25, 0.5, 0.75, 1.0)


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_ties_and_continuous_data(spark, accuracy):
    n = 200_000
    df = spark.range(n, numPartitions=4).selectExpr(
        "CAST(id % 2 AS DOUBLE) AS half", "CAST(id % 7 AS INT) AS few", "rand(3) AS real",
        "CAST(NULL AS DOUBLE) AS none", "IF(id % 3 = 0, double('NaN'), CAST(id AS DOUBLE)) AS gaps",
        "IF(id < 3, CAST(id AS DOUBLE), NULL) AS three")
    want = df.toPandas()
    got = exact_quantiles(df, [(c, q) for c in df.columns for q in QS], accuracy=accuracy)
    for c in df.columns:
        v = want[c].dropna().to_numpy(dtype=float)
        for q in QS:
            assert got[c, q] == (pytest.approx(np.quantile(v, q), rel=1e-12) if len(v) else None)


def test_moments_take_one_pass_over_the_rows(spark):
    from panelforge.operators.quantiles import column_moments

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    source = spark.range(3000, numPartitions=5).selectExpr(
        "1e6D + rand(5) AS far", "CAST(id AS DOUBLE) AS id", "IF(id < 2990, NULL, CAST(id AS DOUBLE)) AS late",
        "IF(id % 3 = 0, double('NaN'), id * id * 1D) AS gaps", "CAST(NULL AS DOUBLE) AS none", "7.5D AS same")
    rows = source.mapInArrow(counted, source.schema)
    want = source.toPandas()
    n, mean, std = column_moments(rows, rows.columns, absolute=False)
    assert seen.value == 3000
    for c, k, m, s in zip(rows.columns, n, mean, std, strict=True):
        v = want[c].dropna().to_numpy()
        assert k == len(v)
        assert (m, s) == ((pytest.approx(v.mean(), rel=1e-12), pytest.approx(v.std(), rel=1e-9)) if k else (0.0, 0.0))
