"""Whitening against eigendecompositions of the whole covariance and exact integers."""

import math

import numpy as np
import pytest
from panelforge.llm import queries as Q
from panelforge.llm import whitening as Wh


def symmetric(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * values) @ q.T


@pytest.mark.parametrize("values", [
    np.linspace(100, 1, 40), np.linspace(10, 9.9, 64), 0.97 ** np.arange(400), np.repeat([5.0, 3.0, 1.0], 20),
    np.r_[7.0, 2.0, np.zeros(30)], np.r_[1e12, np.linspace(3, 1, 50)], np.array([4.0]), np.array([3.0, 3.0])],
    ids=["even", "close", "restarts", "repeated", "low rank", "spike", "one", "two"])
def test_eigenpairs_equal_those_of_the_whole_matrix(values):
    m = symmetric(values)
    r = Wh.jacobi_davidson(lambda w: m @ w, len(values), 8)
    k = min(8, len(values))
    assert np.allclose(r.values, np.sort(values)[::-1][:k], rtol=0, atol=1e-12 * values.max())
    assert np.abs(m @ r.vectors - r.vectors * r.values).max() < 1e-13 * values.max() * len(values) ** 0.5
    assert np.allclose(r.vectors.T @ r.vectors, np.eye(k), atol=1e-12)


def test_minres_solves_each_column():
    m = symmetric(np.r_[np.linspace(-3, -1, 10), np.linspace(1, 4, 20)])
    b = np.random.default_rng(2).standard_normal((30, 4))
    b[:, 3] = 0
    x = Wh.minres(lambda v: m @ v, b, 60, 1e-12)
    assert np.abs(m @ x - b).max() < 1e-8


def plain(rows, components=8):
    """id, deviation, whitened (up to sign) and explained from a full eigendecomposition; rows: (id, vector)."""
    fine = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in fine]
    d = max(set(lengths), key=lambda n: (lengths.count(n), n))
    x = [(i, [math.floor(1024 * c) + 100000 for c in v]) for i, v in fine if len(v) == d]
    n, sums = len(x), [sum(v[j] for _, v in x) for j in range(d)]
    a = np.array([[(n * e - s) / n for e, s in zip(v, sums, strict=True)] for _, v in x])
    cov = a.T @ a / n
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    dev = [sum((n * e - s) ** 2 for e, s in zip(v, sums, strict=True)) for _, v in x]
    return [i for i, _ in x], n, dev, a @ vector / np.sqrt(value), value / np.trace(cov)


def compare(got, rows, components=8):
    ids, n, dev, white, explained = plain(rows, components)
    assert len(got) == len(ids) * white.shape[1] and {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-7
    for k in range(white.shape[1]):
        own = [r for r in got if r["component"] == k + 1]
        assert {round(r["explained"] / explained[k], 9) for r in own} == {1.0}
        mine = sorted((str(r["id"]), r["deviation"], r["whitened"]) for r in own)
        for sign in (1, -1):
            theirs = sorted((str(i), v, sign * w) for i, v, w in zip(ids, dev, white[:, k], strict=True))
            if all(m[:2] == t[:2] and abs(m[2] - t[2]) < 1e-6 for m, t in zip(mine, theirs, strict=True)):
                break
        else:
            raise AssertionError(f"component {k + 1}")


def test_query_over_the_given_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = Q.op12_embedding_whitening(spark, d)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(got.withColumnRenamed("vec_id", "id").collect(), rows)


def test_edge_rows(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(0, [3, 2, 1.5, 1, .5, 30], (200, 6)))]
    rows += [rows[0]] * 5 + [(None, [0.1] * 6), (7, [1e3] + [0.0] * 5)]
    bad = [(900, None), (901, []), (902, [1.0] * 5 + [None]), (903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5),
           (905, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 as x", "2 as id", "3 as COMPONENT", "4 as n")
    compare(Wh.whiten(df.repartition(5)).collect(), rows, 6)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])]])
def test_no_variance_gives_no_rows(spark, rows):
    out = Wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert out.collect() == [] and out.columns[1:3] == ["component", "n"]


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(c)]) for i, c in enumerate([1e13, -1e13, 0.0])]
    got = Wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["id"]: r["deviation"] for r in got}[0] is None and len(got) == 3
