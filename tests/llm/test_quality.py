"""The quality model against sums over all label sequences, finite differences, plain features and held-out labels."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from panelforge.llm import quality as C
from panelforge.llm import queries as Q

TEXTS = ["One line.", "", "A b c\n\nA b c\nlast! ||", "x x x y\n" * 5, "ÄÖ 漢字\t#$%\r\nNo. 12\n", "a\n" * 9 + "end", None]


def weights(seed=0):
    return np.random.default_rng(seed).normal(0, 0.7, C.SIZE)


def test_forward_backward_equals_sum_over_all_sequences():
    w = weights()
    x = C.lines_of(pa.array(TEXTS))
    u = C.emissions(x, w)
    t = w[C._CHAIN].reshape(2, 2)
    ahead, back, log_z = C.forward_backward(x, u, w[C._CHAIN])
    for d, (s, n) in enumerate(zip(x.start, x.count, strict=True)):
        total, good = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            p = math.exp(sum(u[s + i] * y[i] for i in range(n)) + sum(t[a, b] for a, b in itertools.pairwise(y)))
            total += p
            good += p * np.array(y)
        assert log_z[d] == pytest.approx(math.log(total))
        assert 1 / (1 + np.exp(-(ahead + back)[s:s + n])) == pytest.approx(good / total)


def test_gradient_equals_finite_differences():
    x, good, w = C.lines_of(pa.array(TEXTS)), np.array([1, 0, 1, 0, 1, 0, 1]), weights(1)
    _, grad = C.loss(x, good, w)
    for k in [*range(0, C.SIZE, 7), *range(256, C.SIZE)]:
        e = np.zeros(C.SIZE)
        e[k] = 1e-5
        slope = (C.loss(x, good, w + e)[0] - C.loss(x, good, w - e)[0]) / 2e-5
        assert grad[k] == pytest.approx(slope, abs=1e-7, rel=1e-5), k


def test_single_features_equal_a_plain_version():
    x = C.lines_of(pa.array(TEXTS))
    rows = []
    for d, text in enumerate(TEXTS):
        lines = (text or "").split("\n")
        words = [[w for w in line.replace("\t", " ").replace("\r", " ").split(" ") if w] for line in lines]
        for i, (line, own) in enumerate(zip(lines, words, strict=True)):
            n = len(line.encode())
            rep = sum(a == b for a, b in itertools.pairwise(own)) / max(len(own), 1)
            rows.append((d, n + 1, rep, 1 - len(set(own)) / len(own) if own else 0.0,
                         float(i > 0 and lines[i - 1] == line), float(bool(n) and line in lines[:i]), float(n == 0),
                         float(i == 0), float(i == len(lines) - 1)))
    got = zip(x.doc, x.size, *(x.single[:, C._SINGLE.index(c)] for c in (
        "repeated_words", "distinct_words", "as_before", "seen", "empty", "first", "last")), strict=True)
    assert np.array(list(got), float) == pytest.approx(np.array(rows, float))


def test_scores_do_not_depend_on_the_batch():
    w = weights(2)
    together = C.qualities(pa.array(TEXTS), w)
    assert together == pytest.approx([C.qualities(pa.array([t], pa.string()), w)[0] for t in TEXTS])
    long = "word " * 50000 + "\n" + "\n" * 3000
    assert 0 <= C.qualities(pa.array([long]), w)[0] <= 1


def test_minimise_reaches_the_least_value():
    m = np.diag(np.linspace(1, 50, 12))
    x = C.minimise(lambda v: (0.5 * v @ m @ v - v.sum(), m @ v - 1), np.zeros(12), 200)
    assert x == pytest.approx(1 / np.diag(m), abs=1e-4)


def test_query_on_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in Q.op11_quality_classifier(spark, d).collect()}
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    marks = [r for r in spark.read.parquet(f"{d}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    right = [got[r["doc_id"]]["predicted"] == r["quality"] for r in marks]
    assert len(right) > 80 and np.mean(right) > 0.95
    assert all((r["score"] >= 0.5) == r["predicted"] and 0 <= r["score"] <= 1 for r in got.values())


def test_edge_rows_and_clashing_columns(spark):
    good = [(i, f"A plain sentence of some words, number {i}.\nAnother line here.") for i in range(30)]
    bad = [(100 + i, f"BUY!! NOW!! {i}!! || $$$ $$$ $$$") for i in range(30)]
    odd = [(500, None), (501, ""), (None, "A plain sentence."), (100, good[0][1]), (502, "\n\n\n"), (503, "x" * 40000)]
    schema = "doc_id long, text string"
    docs = spark.createDataFrame(good + bad + odd, schema).selectExpr("*", "1 as SCORE", "2 as good", "3 as key")
    labels = spark.createDataFrame(
        [(i, 1, 7) for i, _ in good] + [(i, 0, 7) for i, _ in bad] + [(None, 1, 7), (501, None, 7), (999, 1, 7), (502, 5, 7)],
        "doc_id long, quality int, text int")
    out = C.score(docs, C.fit(docs, labels))
    assert out.columns == ["doc_id", "text", "good", "key", "score"] and out.count() == len(good + bad + odd)
    s = {(r["doc_id"], r["text"]): r["score"] for r in out.collect()}
    assert all(s[r] > 0.5 for r in good) and all(s[r] < 0.5 for r in bad)
    assert s[500, None] == pytest.approx(s[501, ""])


def test_tables_without_rows_or_labels(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert C.fit(docs, none) is None
    assert [r["score"] for r in C.score(docs, None).collect()] == [0.5]
    assert C.score(docs.limit(0), weights()).collect() == []
    one = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    assert C.score(docs, C.fit(docs, one)).first()["score"] < 0.5


def test_labels_of_held_out_documents_are_not_used(spark, tmp_path):
    rows = [(i, "Plain words in a line." if i % 2 else "!! $$ !!") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    turned = labels.withColumn("quality", (labels.quality != C.held_out().cast("int")).cast("int"))
    results = []
    for k, marks in enumerate((labels, turned)):
        docs.write.parquet(str(tmp_path / f"{k}/documents.parquet"))
        marks.write.parquet(str(tmp_path / f"{k}/labels.parquet"))
        results.append({r["doc_id"]: r["score"] for r in Q.op11_quality_classifier(spark, str(tmp_path / str(k))).collect()})
    assert results[0] == pytest.approx(results[1])
