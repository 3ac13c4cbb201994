"""Conversation repair against exhaustive search and a plain version of the whole query."""

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from panelforge.llm import conversations as C
from panelforge.llm import queries as Q

GOOD = re.compile(r"(s?(ua)+)?\Z")


def brute(symbols):
    """Cost and audit by dynamic programming over whole strings: for each state the least (cost, audit)."""
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def inserted(best):
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                t = 3 if s == 2 else 2
                best[t] = min(best.get(t, (c + 2, a + "I")), (c + 2, a + "I"))
        return best

    best = inserted({0: (0, "")})
    for c in symbols:
        new = {}

        def put(s, v):
            new[s] = min(new.get(s, v), v)

        for s, (cost, a) in best.items():
            put(s, (cost + 3, a + "D"))
            if c != "x":
                more = c.isupper()
                put(3 if s == 2 else 2, (cost + 2 + more, a + "R"))
                if c.lower() in step[s]:
                    put(step[s][c.lower()], (cost + more, a + "K"))
        best = inserted(new)
    return min(best[s] for s in (0, 3) if s in best)


def test_search_equals_brute_force_on_all_short_conversations():
    for n in range(6):
        for symbols in itertools.product("suaoxUA", repeat=n):
            assert C.cheapest_edits("".join(symbols)) == brute(symbols), symbols


@settings(max_examples=150, deadline=None)
@given(st.text("suaosuauauaSUAOx", min_size=6, max_size=60))
def test_search_equals_brute_force(symbols):
    assert C.cheapest_edits(symbols) == brute(symbols)


def plain(rows):
    """The query's result by hand; rows: (conv_id, turn, role, text)."""
    out = {}
    def w(x):
        return " " if x is None else str(x)

    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{w(conv)}:{w(turn)}".encode()) % 20
        role, text = "user" if kind == 4 else w(role), "" if kind == 1 else w(text)
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        out.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    result = {}
    for conv, own in out.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, symbols, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            c = role[:1] if role[:1] in ("s", "u", "a") else "o"
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            if not last:
                faults["blank"] += 1
                c = "x"
            elif (role, text) in seen:
                faults["duplicate"] += 1
                c = "x"
            elif last[0] not in ".!?":
                faults["truncated"] += 1
                c = c.upper()
            seen.add((role, text))
            symbols.append(c)
        cost, audit = brute(symbols)
        turns = {t for t, _, _ in own if t is not None}
        first = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(first))
        kept, at, initials = [], 0, ""
        for edit in audit:
            due = "assistant" if initials.endswith("u") else "user"
            if edit == "I":
                kept.append((due, ""))
            else:
                _, role, text = own[at]
                at += 1
                if edit == "D":
                    continue
                kept.append((role if edit == "K" else due, text))
            initials += kept[-1][0][0]
        assert GOOD.match(initials) and at == len(own)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        result[conv] = (gaps, *faults.values(), illegal, cost, audit,
                        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return result


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def found(df):
    return {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    talk = [(c, t, ("user", "assistant")[t % 2], f"Text {c} of {t}.") for c in range(60) for t in range(c % 9)]
    odd = [(None, 0, "user", "Hi."), (None, None, None, None), (None, 3, "assistant", "Ho!"),
           (100, None, "system", "Be kind."), (100, 0, "user", "a\x0b\n"), (100, 9, "tool", "x"), (100, 5, "", "y."),
           (101, 1, "user", ""), (101, 1, "user", ""), (102, None, "user", "Same."), (102, None, "user", "Same."),
           (103, 7, "assistant", "É" * 5000 + "\x85"), (104, 2, "system", "Only."), (105, 1, "System", "Big!"),
           *[(106, t, "user", "Again and again.") for t in range(300)], (107, 2, "user", " "),
           (108, 4, "assistant", "Q?  \n"), (108, 2, "user", "no end"), (108, -5, "assistant", "end. ")]
    return talk + odd


def test_query_equals_plain_version(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as place", "'x' as TEXT_2", "2 as audit", "3 as there")
    df.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = found(Q.op13_conversation_repair(spark, str(tmp_path)))
    assert got == plain(rows)


def test_query_over_the_given_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert found(Q.op13_conversation_repair(spark, d)) == plain(rows)


def test_repaired_rows_are_well_formed(spark, rows):
    marked = C.damage(spark.createDataFrame(rows, SCHEMA))
    audits = C.audit_conversations(marked).cache()
    by = {}
    for r in sorted(C.repair_rows(marked, audits).collect(), key=lambda r: r["place"]):
        by.setdefault(r["conv_id"], []).append(r)
    for a in audits.collect():
        own = by.get(a["conv_id"], [])
        assert GOOD.match("".join(r["role"][0] for r in own))
        assert [r["edit"] for r in own] == [e for e in a["audit"] if e != "D"]
        assert [r["place"] for r in own] == list(range(1, len(own) + 1))


def test_empty_table(spark):
    out = C.repair_conversations(C.damage(spark.createDataFrame([], SCHEMA)))
    assert out.collect() == [] and out.columns == ["conv_id", *FIELDS]
