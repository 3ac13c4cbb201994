"""The pipeline's stages on rows with null and repeated ids, and whole runs."""

import corpus_pipeline as P
from panelforge.llm import langid

A = "one text of quite a few words that is here as an example of a document for the test"
B = "another text with other words in it which has nothing in common with any of the others"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    out = P.near_dedup(spark, docs, "")
    assert out.columns == list(P.COLUMNS)
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)


def test_near_dedup_tells_rows_without_an_id_apart(spark):
    assert set(kept(spark, [(5, A), (None, A), (None, B)])) == {(5, A), (None, B)}
    got = kept(spark, [(None, A), (None, A), (None, B), (None, None), (None, "")])
    assert sorted((t or "") for _, t in got) == sorted([A, B, ""])
    assert set(kept(spark, [(1, A), (1, B), (2, B), (3, A + " more")])) == {(1, A), (1, B)}


def brute_near_dedup(rows):
    """Smallest (null last, id, digest) of each component of texts alike in 0.8 of their five-word shingles."""
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    import hashlib

    nodes = sorted({(i is None, i or 0, hashlib.md5((t or "").encode()).hexdigest(), t or "") for i, t in rows})
    sets = [shingles(n[3]) for n in nodes]
    root = list(range(len(nodes)))
    for x in range(len(nodes)):
        for y in range(x):
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                a, b = root[x], root[y]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return sorted(str((None if n[0] else n[1], n[3])) for k, n in enumerate(nodes) if root[k] == k)


def test_near_dedup_equals_brute_force(spark, rows):
    pairs = [(r[0], r[1]) for r in rows if r[1] is None or r[1].isascii()] + [(None, rows[0][1]), (900, rows[1][1] + " x")]
    got = sorted(str((i, t or "")) for i, t in kept(spark, pairs))
    assert got == brute_near_dedup(pairs)


def test_language_id_stage(spark, docs):
    out = P.language_id(spark, docs, "").collect()
    assert out and all(any(c.isalpha() for c in r["text"]) and r["lang"] for r in out)


def test_run_on_edge_rows(spark, docs, tmp_path):
    docs.selectExpr("*", "1 as SCORE", "2 as token_IDS").write.parquet(str(tmp_path / "documents.parquet"))
    out = P.run(spark, str(tmp_path)).collect()
    assert out and all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in out)
    stages = docs.select(*P.COLUMNS)
    for _, stage in P.STAGES:
        stages = stage(spark, stages, str(tmp_path))
    key = sorted(str((r["doc_id"], r["text_sha256"])) for r in stages.collect())
    assert key == sorted(str((r["doc_id"], r["text_sha256"])) for r in out)
    assert langid.UNKNOWN not in {r["lang"] for r in out}


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []
