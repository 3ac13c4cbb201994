"""Suffix arrays, anchors, shingles: against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa

from panelforge.llm.line_dedup import patience_blocks
from panelforge.llm.shingles import shingle_sets, word_hashes
from panelforge.llm.suffixes import anchors, common_prefixes, deciding, suffix_array


def test_suffix_array_and_prefixes():
    rng = random.Random(3)
    for _ in range(200):
        alphabet = rng.choice([b"a", b"ab", b"abc ", bytes(range(97, 123))])
        s = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 150)))
        s += s[:rng.randint(0, len(s))] + s if rng.random() < 0.5 else b""
        data, depth = np.frombuffer(s, np.uint8), rng.choice([50, 16])
        order = suffix_array(data, depth)
        assert sorted(order.tolist()) == list(range(len(s)))
        cut = [s[i:i + depth] for i in order]
        assert cut == sorted(cut)
        for k, n in enumerate(common_prefixes(data, order, depth)):
            a, b = s[order[k]:order[k] + depth], s[order[k + 1]:order[k + 1] + depth]
            assert n == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_equal_strings_have_equal_anchors():
    rng = random.Random(4)
    passage = bytes(rng.randrange(97, 123) for _ in range(50))
    texts = [bytes(rng.randrange(97, 123) for _ in range(rng.randint(0, 300))) for _ in range(40)]
    texts = [t + passage + t[::-1] for t in texts] + [passage, b"", passage[:49]]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    at, h = anchors(data, offsets, 50)
    first, last = deciding(at, h, offsets, 50)
    place, decided = {}, []
    for x, y, i, j in zip(at.tolist(), h.tolist(), first.tolist(), last.tolist(), strict=True):
        for k in range(i, j + 1):                       # each string's anchor and its place depend on the string only
            decided.append(k)
            assert place.setdefault(bytes(data[k:k + 50]), (y, x - k)) == (y, x - k)
    starts = [k for a, b in zip(offsets, offsets[1:], strict=False) for k in range(a, b - 49)]
    assert sorted(decided) == starts and passage in place


def test_anchors_do_not_depend_on_blocks(monkeypatch):
    from panelforge.llm import suffixes

    rng = random.Random(6)
    texts = [b"ab" * 90 + bytes(rng.randrange(97, 101) for _ in range(rng.randint(0, 400))) for _ in range(20)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    whole = anchors(data, offsets, 50)
    monkeypatch.setattr(suffixes, "_BLOCK", 256)
    assert all((x == y).all() for x, y in zip(whole, anchors(data, offsets, 50), strict=True))


def test_word_and_shingle_hashes():
    texts = ["a b c a b", "A b", "", None, "  \t", "one", "x" * 10, "a b c", "b a", "é à é à"] * 3
    sets = list(shingle_sets(pa.array(texts, pa.string()), 2))
    for t, s in zip(texts, sets, strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").replace("A", "a"))
        assert len(s) == (len(set(zip(w, w[1:], strict=False))) if len(w) > 1 else len(w))
    assert (sets[0] == sets[10]).all() and set(sets[1]) <= set(sets[0]) and set(sets[7]) <= set(sets[0])
    assert not set(sets[8]) & set(sets[1]) and not set(sets[5]) & set(sets[6])


def test_long_text_is_read_in_blocks(monkeypatch):
    from panelforge.llm import shingles

    text = " ".join(f"w{i % 97}" for i in range(4000)) + " " + "y" * 900 + " end"
    whole = word_hashes(pa.array([text, "w1 w2", text]))
    monkeypatch.setattr(shingles, "_BLOCK", 256)
    parts = word_hashes(pa.array([text, "w1 w2", text]))
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_patience_blocks_match_equal_lines():
    rng = random.Random(9)
    for _ in range(200):
        a = [rng.randrange(30) for _ in range(rng.randint(0, 25))]
        b = [x for x in a if rng.random() > 0.2] + [rng.randrange(30) for _ in range(rng.randint(0, 5))]
        last = (-1, -1)
        for x, y, n in patience_blocks(a, b):
            assert a[x:x + n] == b[y:y + n] and x > last[0] and y > last[1]
            last = (x + n - 1, y + n - 1)
    assert patience_blocks([1, 2, 3, 4], [1, 2, 3, 4]) == [(0, 0, 4)]
    assert patience_blocks([1, 2, 3], [4, 2, 5]) == [(1, 1, 1)]
