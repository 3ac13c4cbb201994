"""Every operator against brute force on one table with all edge rows, on an empty table and with clashing columns."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from panelforge.llm import (bpe, exact_dedup, fingerprints, langid, licenses, line_dedup, minhash, mixing, queries, sharding,
                            suffix_dedup)

SPACE = r"[\x20\x09-\x0D]+"


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def listed(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


# --- 1 -------------------------------------------------------------------------------------------

def removed(rows, length):
    last = (1 << 63) - 1
    held, out = defaultdict(lambda: last), []
    data = [(last if r[0] is None else r[0], (r[1] or "").encode(), r[0]) for r in rows]
    for i, b, _ in data:
        for k in range(len(b) - length + 1):
            held[b[k:k + length]] = min(held[b[k:k + length]], i)
    for i, b, doc in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if held[b[k:k + length]] < i:
                gone[k:k + length] = b"\x01" * length
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((doc, len(b), sum(gone), spans, sha(bytes(x for x, y in zip(b, gone, strict=True) if not y))))
    return Counter(out)


@pytest.mark.parametrize("hot", [4096, 2])
def test_suffix_dedup(docs, rows, clashing, hot):
    frame = docs if hot == 2 else clashing
    out = suffix_dedup.remove_repeats(frame, hot=hot).withColumn("sha", F.sha2("kept_bytes", 256))
    assert listed(out, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == removed(rows, 50)


# --- 2 -------------------------------------------------------------------------------------------

def identity(text):
    lanes = [0] * 16
    for p in text.split("\n"):
        if p:
            h = hashlib.sha512(p.encode()).hexdigest()
            lanes = [(x + int(h[8 * i:8 * i + 8], 16)) % 2 ** 32 for i, x in enumerate(lanes)]
    return "".join(f"{x:08x}" for x in lanes)


def test_fingerprints(docs, rows):
    got = fingerprints.compare_with_edit(docs).collect()
    distinct = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    assert len(got) == len(distinct)
    by = defaultdict(list)
    for none, i, text in distinct:
        by[None if none else i].append(text)
    order = [(None if none else i, text) for none, i, text in distinct]
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert r["n_chars"] in [len(t) for t in by[r["doc_id"]]]
    got = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for (i, text), (_, after) in zip(order, order[1:], strict=False):
        if i is None or (after is None) or len(by[i]) > 1 or i == 408:
            continue
        n = len(text) // 4
        edited = text[:len(text) - n] + after[:n]
        r = got[i]
        assert (r["edited_sha256"], r["fingerprint"][:128], r["edited_fingerprint"][:128]) == (
            sha(edited), identity(text), identity(edited)), i
    assert got[0]["fingerprint"] == got[200]["fingerprint"]
    long = [got[i * 3] for i in range(60)]
    assert sum(r["near_edited"] > r["near_next"] for r in long) >= 55


def test_fingerprint_sums_add(spark):
    a, b = "one line here.\ntwo lines there.", "three more,\nand four."
    df = spark.createDataFrame([(1, a), (2, b), (3, b + "\n" + a), (4, None), (5, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(df).collect()}
    assert [x + y for x, y in zip(got[1]["sums"], got[2]["sums"], strict=True)] == got[3]["sums"]
    assert set(got[4]["sums"]) == set(got[5]["sums"]) == {0}


def test_likeness_follows_from_the_printed_fingerprint(spark):
    df = spark.createDataFrame([(1, "one a two e. " * 40000), (2, "three o four e. " * 300), (3, None)],
                               "doc_id long, text string")          # over 2^16 phrases in the first

    def lanes(printed):
        words = [int(printed[i:i + 8], 16) for i in range(0, len(printed), 8)]
        assert len(words) == 16 + 1 + 128
        return [2 * x - words[16] for x in words[17:]]

    for r in fingerprints.compare_with_edit(df).collect():
        a, b = lanes(r["fingerprint"]), lanes(r["edited_fingerprint"])
        dot = lambda x, y: sum(p * q for p, q in zip(x, y, strict=True))           # noqa: E731
        norm = math.sqrt(dot(a, a) * dot(b, b))
        want = 1.0 if r["fingerprint"] == r["edited_fingerprint"] else min(max(dot(a, b) / norm, 0), 1) if norm else 0.0
        assert r["near_edited"] == pytest.approx(want, abs=1e-9)


# --- 3 -------------------------------------------------------------------------------------------

def lines_left(rows, rare=100):
    sig = {t: None for t in {r[1] or "" for r in rows}}
    docs = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    assert sig is not None
    ties = []
    for d in docs:
        lines = d[2].split("\n")
        own = {(1, x) for x in lines if len(x.strip(" ")) >= 20}
        own |= {(2, x, y) for x, y in zip(lines, lines[1:], strict=False)
                if min(len(x.strip(" ")), len(y.strip(" "))) >= 1 and len(x.strip(" ")) + len(y.strip(" ")) >= 20}
        if len(lines) == 1:
            own |= {(3, x) for x in lines if len(x.strip(" ")) >= 20}
        ties.append(own)
    held = defaultdict(list)
    for k, own in enumerate(ties):
        for x in own:
            held[x].append(k)
    out = {}
    for k, d in enumerate(docs):
        partners = {held[x][0] for x in ties[k] if held[x][0] < k and (x[0] > 1 or len(held[x]) <= rare)}
        lines, gone = d[2].split("\n"), set()
        for p in partners:
            for x, _, n in line_dedup.patience_blocks(lines, docs[p][2].split("\n")):
                if sum(len(y.strip(" ")) for y in lines[x:x + n]) >= 60:
                    gone |= set(range(x, x + n))
        out[(None if d[0] else d[1], d[2])] = "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)
    return out


@pytest.mark.parametrize("rare", [100, 3])
def test_line_dedup(docs, rows, clashing, rare):
    # documents that share an id are ordered by a hash, so only their number is compared
    want = lines_left(rows, rare)
    out = line_dedup.remove_common_lines(clashing, rare=rare)
    got = Counter((r["doc_id"], r["text"], r["n_removed"]) for r in out.collect())
    expected = Counter((r[0], want[r[0], r[1] or ""][0] if r[1] is not None else None, want[r[0], r[1] or ""][1])
                       for r in rows)
    unclear = {None}
    assert {k: v for k, v in got.items() if k[0] not in unclear} == {
        k: v for k, v in expected.items() if k[0] not in unclear}
    assert sum(got.values()) == len(rows)


# --- 4 -------------------------------------------------------------------------------------------

def test_mixing(docs, rows, clashing):
    got = mixing.mix_sources(clashing).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    target = {n: t for n, _, t in mixing.capped_targets(list(size.items()), mixing.weights_5_2_1, 3)}
    assert math.isclose(sum(target.values()), sum(size.values()))
    taken, largest = Counter(), Counter()
    for r in got:
        assert (r["source_size"], r["target"]) == (size[r["source"]], target[r["source"]])
        assert 0 <= r["size"] * r["repeats"] <= 3 * r["size"]
        taken[r["source"]] += r["size"] * r["repeats"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)
    assert all(target[s] <= 3 * size[s] for s in size)
    again = mixing.mix_sources(docs.repartition(5))
    assert listed(again, "doc_id", "repeats") == Counter((r["doc_id"], r["repeats"]) for r in got)


# --- 5 -------------------------------------------------------------------------------------------

def test_sharding(spark, docs, rows, sf_dir):
    got = queries.op5_shard_by_bytes(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(16))


@pytest.mark.parametrize("group", [0, 4])
def test_sharding_of_a_hot_key(spark, group):
    rows = [(f"{0:04d}{i:06d}", 10) for i in range(2000)] + [(f"{i:04d}{0:06d}", 1 + i % 30) for i in range(1, 3000)]
    df = spark.createDataFrame(rows, "key string, size long")
    out = sharding.shard_by_bytes(df, "key", "size", shards=8, group_chars=group, rows_per_range=50).collect()
    total, load = sum(s for _, s in rows), Counter()
    for r in out:
        load[r["shard"]] += r["size"]
    assert all(abs(load[s] - total / 8) <= 40 for s in range(8))
    order = sorted((r["shard"], r["slot"], r["key"]) for r in out)
    assert [k for *_, k in order] == sorted(k for k, _ in rows)
    assert len({(r["shard"], r["slot"]) for r in out}) == len(rows)


# --- 6 -------------------------------------------------------------------------------------------

def test_language_id(spark, docs, rows, clashing, empty):
    model = langid.fit(docs.filter(~langid.held_out()))
    got = langid.predict(clashing, model).collect()
    assert len(got) == len(rows) and {"own id", None} >= {r["id"] for r in got} - {"own id"}
    for r in got:
        if not re.search(r"[^\W\d_]", r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "de") and 0 < r["score"] <= 1
    sure = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 200 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(sure) > 5 and all(r["lang"] == r["lang_pred"] for r in sure)
    assert langid.fit(empty) is None
    assert langid.predict(docs.limit(2), None).collect()[0]["lang_pred"] == "und"


def test_kernel_is_the_cosine_of_ngram_sets():
    import numpy as np
    import pyarrow as pa

    a, b = "The cat, the hat", "that cat sat"
    x = langid.scaled(langid.presence(pa.array([a, b, None, ""])))
    grams = lambda t, n: {t[i:i + n] for i in range(len(t) - n + 1)}                    # noqa: E731
    clean = lambda t: re.sub(r"[^a-z]", " ", t.lower())                                 # noqa: E731
    want = np.mean([len(grams(clean(a), n) & grams(clean(b), n)) / math.sqrt(len(grams(clean(a), n)) * len(grams(clean(b), n)))
                    for n in range(1, 5)])
    assert abs(float(x[0] @ x[1]) - want) < 0.02 and not x[2:].any()


# --- 7 -------------------------------------------------------------------------------------------

def near(rows, width):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(low))
        sets.append(set(zip(*[w[k:] for k in range(width)], strict=False)) if len(w) >= width else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return Counter((r[0], len(s), least.get(find(i)), r[0] == least.get(find(i))) for i, (r, s) in
                   enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, rows, clashing, width):
    out = minhash.near_duplicates(clashing if width == 5 else docs, width=width)
    assert listed(out, "doc_id", "n_shingles", "component_id", "kept") == near(rows, width)


def test_chains_in_shared_buckets(spark):
    """Documents that differ step by step: links between neighbours only, one component by reachability."""
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[8 * k:8 * k + 100])) for k in range(30)]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2)
    assert listed(out, "doc_id", "n_shingles", "component_id", "kept") == near(rows, 2)


# --- 9 -------------------------------------------------------------------------------------------

def test_licenses(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/x.txt", "nothing here"),
            (3, "a/b/y.txt", "prose\n" + apache + " More prose follows here."), (4, "a/b/c/z.txt", None),
            (5, "a/b/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
            (6, "ab/q.txt", "no licence nearby"), (7, None, apache), (8, "a/b/c/LICENSE", "just some license talk of mine"),
            (9, "r.txt", ""), (2, "a/x.txt", "nothing here")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("score", F.lit(1))
    got = {r["doc_id"]: (r["own_license"], r["license"], r["license_dir"]) for r in licenses.scan_licenses(df).collect()}
    assert got == {1: ("MIT", "MIT", None), 2: (None, "MIT", "a"), 3: ("Apache-2.0", "Apache-2.0", None),
                   4: (None, "GPL-3.0", "a/b"), 5: ("GPL-3.0", "GPL-3.0", None), 6: (None, None, None),
                   7: ("Apache-2.0", "Apache-2.0", None), 8: (None, "GPL-3.0", "a/b"), 9: (None, None, None)}


def test_license_scores(spark):
    texts = ["released under mit license", "a licensed thing", "Licensed under CC BY-NC 4.0."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    vocabulary = sorted({t for v in licenses.TEMPLATES.values() for x in v for t in licenses._template_terms(x)})
    idf, unseen = licenses.idf_weights(df, "text", vocabulary)
    units = df.select(F.col("text").alias("unit"), F.col("text").alias("uid"))
    got = {r["uid"]: (r["license"], r["score"]) for r in licenses.score_units(units, idf, unseen).collect()}

    def cosine(a, b):
        va, vb = ({t: n * idf.get(t, unseen) for t, n in Counter(licenses._template_terms(x)).items()} for x in (a, b))
        dot = sum(v * vb.get(t, 0) for t, v in va.items())
        return dot / math.sqrt(sum(v * v for v in va.values()) * sum(v * v for v in vb.values()))

    for unit, (name, score) in got.items():
        best = max((round(cosine(unit, t), 12), n) for n, v in licenses.TEMPLATES.items() for t in v)
        assert abs(best[0] - score) < 1e-9 and (score == 0 or name in [
            n for n, v in licenses.TEMPLATES.items() if any(abs(cosine(unit, t) - score) < 1e-9 for t in v)])


# --- 10 ------------------------------------------------------------------------------------------

def test_exact_dedup(spark, rows, sf_dir):
    got = exact_dedup.streaming_exact_dedup(spark, f"{sf_dir}/documents.parquet", max_bytes_per_trigger=1).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(SPACE, " ", r[1] or "")].append(r[0])
    want = Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += Counter((i, keep, len(ids), sha(text)) for i in ids)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter({sha(t): 1 for t in groups})


def test_exact_dedup_keeps_its_state(spark, tmp_path):
    path, state = str(tmp_path / "t.parquet"), str(tmp_path / "state")
    spark.createDataFrame([(5, "a b"), (7, "c")], "doc_id long, text string").write.parquet(path)
    exact_dedup.streaming_exact_dedup(spark, path, checkpoint=state).collect()
    spark.createDataFrame([(3, "a  b"), (9, "d")], "doc_id long, text string").write.mode("append").parquet(path)
    got = exact_dedup.streaming_exact_dedup(spark, path, checkpoint=state)
    assert listed(got, "doc_id", "keep_id", "group_size") == Counter([(5, 3, 2), (3, 3, 2), (7, 7, 1), (9, 9, 1)])


# --- all -----------------------------------------------------------------------------------------

def test_empty_tables(spark, empty, tmp_path):
    path = str(tmp_path / "documents.parquet")
    empty.write.parquet(path)
    for table, schema in (("labels", "doc_id long, quality int, toxic int"), ("embeddings", "vec_id long, embedding array<float>"),
                          ("conversations", "conv_id long, turn long, role string, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{table}.parquet"))
    for name, query in queries.QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name


def test_pairs_inside_a_family(spark):
    # 1,000 documents at a mutual similarity of 0.75, among them 500 pairs at 0.81
    base = [f"b{i}" for i in range(150)]
    texts = [" ".join(base + [f"p{i // 2}x{j}" for j in range(7)] + [f"o{i}x{j}" for j in range(18)])
             for i in range(1000)]
    out = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), width=1)
    got = {r["doc_id"]: r["component_id"] for r in out.collect()}
    assert all(c in (i, i // 2 * 2) for i, c in got.items())
    assert sum(got[2 * i + 1] == 2 * i for i in range(500)) >= 498          # a pair at 0.81 is missed once in 1,600


def test_copies_with_blank_lines(spark):
    text = "\n\n".join(f"Paragraph {i} of a text that is held by very many documents, with blank lines." for i in range(3))
    out = line_dedup.remove_common_lines(spark.createDataFrame([(i, text) for i in range(150)], "doc_id long, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in out.collect()} == {i: 5 if i else 0 for i in range(150)}


def test_blocks_are_tied_to_a_holder_of_all(spark):
    a, b, c = ("first line number 1234567", "second line number 345678", "third line number 5678901")
    texts = [f"{a}\n{b}\nown A", f"own B\n{b}\n{c}", f"{a}\n{b}\n{c}\nown C", f"{a}\n{b}\n{c}\nown D"]
    out = line_dedup.remove_common_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {**dict(enumerate(texts)), 3: "own D"}


def test_frequent_long_lines(spark, tmp_path):
    line = "A passage of one line that many documents hold, each between other lines."
    docs = spark.createDataFrame([(i, f"before {i}\n{line}\nafter {i}") for i in range(150)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["n_removed"] for r in queries.op3_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {i: int(i > 0) for i in range(150)}


def test_wrapped_headers(spark):
    import textwrap

    mit, bsd, apache = (licenses.TEMPLATES[x][1] for x in ("MIT", "BSD-3-Clause", "Apache-2.0"))
    mit = mit + (", subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
                 "included in all copies or substantial portions of the Software.")
    rows = []
    for i, (body, sign) in enumerate([(mit, "# "), (bsd + ":", " * "), (apache, "// "), (apache, "")]):
        lines = [sign + x for p in ["Copyright (c) 2020 Some One", *body.split("\n\n")]
                 for x in [*textwrap.wrap(p, 80 - len(sign)), ""]]
        rows.append((i, f"src/f{i}.c", "\n".join(lines) + "\n\nint main(void) {\n  return 0;\n}\n"))
    rows.append((4, "src/g.c", "int x;\n\nint y;\nint z;\n"))
    got = {r["doc_id"]: r["own_license"] for r in licenses.scan_licenses(
        spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert got == {0: "MIT", 1: "BSD-3-Clause", 2: "Apache-2.0", 3: "Apache-2.0", 4: None}


# --- columns of the input named as new ones, in any case --------------------------------------------

def test_names_in_any_case_are_replaced(docs):
    import public_tokenizers

    own = docs.filter("doc_id < 30").withColumns({x: F.lit("own") for x in ("SCORE", "Lang_Pred", "TOKEN_IDS", "Shard", "SLOT")})
    model = langid.fit(docs)
    for m in (model, None):
        out = langid.predict(own, m)
        assert [c for c in out.columns if c.lower() in ("score", "lang_pred")] == ["lang_pred", "score"]
        assert all(0 <= r[0] <= 1 for r in out.select("score").collect())
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode_texts(own, path, public_tokenizers.PATTERN)
    back = bpe.decode_ids(coded.withColumn("TEXT", F.lit("own")), path)
    assert listed(back, "doc_id", "text") == listed(own, "doc_id", "text")
    rows = own.withColumns({"key": F.md5("text"), "size": F.length("text").cast("long")})
    out = sharding.shard_by_bytes(rows, "key", "size", shards=4)
    assert out.columns == [c for c in rows.columns if c not in ("Shard", "SLOT")] + ["shard", "slot"]
    assert {r["shard"] for r in out.collect()} == {0, 1, 2, 3}


def test_a_key_reaches_the_driver_once(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.md5(F.col("id").cast("string")))
                                      .alias("key"), F.lit(5).cast("long").alias("size"))
    got = sharding._sample(rows, "key", "size", 5.0, 1)
    assert len(got) == 10_001 and dict(got)["hot"] == 50_000
