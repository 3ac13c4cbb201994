import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EN = "the of and to in that was for on are with they at be this from have or by one had not but what all".split()
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden".split()


def sentence(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "ing", "ed", "ly", "s"]) * (words is EN) for _ in range(n))


def make_rows(seed=5, n=60):
    """Documents with copies, near copies, shared passages and lines, and every kind of edge row."""
    rng = random.Random(seed)
    passage = sentence(rng, EN, 70)
    common = "A line that very many documents of this table hold, as a footer does."
    rows = []
    for i in range(n):
        words = DE if i % 3 == 2 else EN
        lines = [sentence(rng, words, rng.randint(8, 25)).capitalize() + "." for _ in range(rng.randint(2, 8))]
        if i % 4 == 0:
            lines.insert(rng.randrange(len(lines)), common)
        if i % 9 == 0:
            lines.insert(1, passage)
        rows.append([i * 3, "\n".join(lines), "de" if words is DE else "en", f"s{i % 4}", 0])
    rows += [[200 + i, rows[i * 5][1], rows[i * 5][2], rows[i * 5][3], 0] for i in range(6)]          # copies
    for i in range(6):                                                                              # near copies
        words = rows[i * 4 + 1][1].split(" ")
        words[len(words) // 2] = "changed"
        rows.append([300 + i, " ".join(words), "en", "s0", 0])
    rows += [[400, None, None, None, None], [401, "", "en", "s1", 0], [402, " \n\t ", None, "s2", 3],
             [403, "12 34 !!", "en", None, 8], [404, "word", "en", "s1", 4], [405, "äöü 漢字 🙂", "de", "s3", 8],
             [406, "aaaa " * 4000, "en", "s0", 20000], [407, "x" * 3000, "en", "s0", 3000],
             [None, "A document without an id but with some words in it.", "en", "s1", 5],
             [None, rows[3][1], "en", "s1", 5]]
    rows += [list(rows[0]), list(rows[0]), [408, rows[1][1].replace("\n", "  \n"), "en", "s0", 0]]     # repeated rows
    for r in rows:
        r[4] = len(r[1]) if r[1] is not None and r[4] == 0 else r[4]
    return [tuple(r) for r in rows]


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    """The rows as a written table over several files, with columns whose names clash with the operators' own."""
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def sf_dir(docs):
    return docs.inputFiles()[0].rsplit("/documents.parquet", 1)[0].removeprefix("file://")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    from pyspark.sql import functions as F

    names = ("id", "size", "score", "kept", "n_removed", "sig", "token_ids", "range", "shard", "component_id", "digest",
             "repeats", "SPANS")
    return docs.withColumns({x: F.lit(f"own {x}") for x in names})
