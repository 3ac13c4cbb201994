"""BPE against the tiktoken library, and the decoder on ill-formed input."""

import base64
import random

import public_tokenizers as P
import pytest
import tiktoken

from panelforge.llm import bpe

DATA = open(P.path("byte_bpe_50k.tiktoken"), "rb").read()
RANKS = bpe.read_ranks(DATA)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_encoding_matches(reference, rows):
    encoder, decoder = bpe.Encoder(RANKS, P.PATTERN), bpe.Decoder(RANKS)
    rng = random.Random(1)
    pool = "aeiou thesTHE  \n\t123 éßñ漢字🙂'\"$%-_="
    texts = [r[1] for r in rows if r[1] is not None]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randint(1, 60))) for _ in range(500)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 127), rng.randint(160, 0x2FF), rng.randint(0x4E00, 0x9FFF)]))
                      for _ in range(30)) for _ in range(300)]
    texts += ["a" * 6000, " " * 700, "ab" * 3000, "<|endoftext|>", "\x1c\x1f x\x85y", "it's we'LL"]
    for t in texts:
        ids = encoder(t)
        assert ids == reference.encode_ordinary(t)
        assert decoder(ids) == t


def test_small_tables_give_the_same(reference):
    small = bpe.Encoder(RANKS, P.PATTERN)
    small.pieces.limit = 3
    small.pieces.transducer.max_states = small.pieces.transducer.max_pairs = 5
    text = "Thanonontioniner erreththe anlyor, whntesor " * 20
    assert small(text) == reference.encode_ordinary(text)


def test_long_texts_stream(reference, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 50)
    encoder = bpe.Encoder(RANKS, P.PATTERN)
    text = "some words with é and 漢字 in them, again " * 40
    assert sum(encoder.stream(text, block=7), []) == reference.encode_ordinary(text)
    assert "".join(bpe.Decoder(RANKS).stream(encoder(text), block=1)) == text


def test_decoder_replaces_ill_formed_bytes():
    single = [RANKS[bytes([b])] for b in range(256)]
    decode = bpe.Decoder(RANKS)
    for raw in (b"a\xffb", b"\xe4\xb8", b"\xe4\xb8\xad!", b"\xc0\xaf", b"\xf0\x9f\x99\x82\x80", b"\xed\xa0\x80"):
        ids = [single[b] for b in raw]
        assert decode(ids) == raw.decode("utf-8", "replace")
        assert "".join(decode.stream(ids, block=1)).replace("�", "") == raw.decode("utf-8", "ignore")
    assert decode([10 ** 7]) == "�" and decode(None) == "" and decode([]) == ""


def test_frames(spark, docs, clashing, empty, reference):
    path = P.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode_texts(clashing, path, P.PATTERN)
    assert set(ids.columns) == set(clashing.columns) - {"text"}
    back = bpe.decode_ids(ids.select("doc_id", "source", "token_ids"), path)
    want = sorted((r["doc_id"] or -1, r["text"] or "") for r in docs.collect())
    assert sorted((r["doc_id"] or -1, r["text"]) for r in back.collect()) == want
    assert bpe.encode_texts(empty, path, P.PATTERN).count() == 0


def test_vocabulary_must_have_all_bytes():
    with pytest.raises(ValueError):
        bpe.Encoder(bpe.read_ranks(base64.b64encode(b"a") + b" 0"), P.PATTERN)


def test_round_trip_equals_encoding_and_decoding(spark, docs):
    path, pattern = P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    rows = docs.selectExpr("*", "1 as TOKEN_IDS", "2 as Decoded", "3 as kept")
    both = bpe.round_trip(rows, path, pattern)
    assert both.columns == ["doc_id", "lang", "source", "n_chars", "kept", "token_ids", "decoded"]
    ids = bpe.encode_texts(docs, path, pattern)
    apart = sorted(map(str, ids.select("doc_id", "token_ids").collect()))
    assert sorted(map(str, both.select("doc_id", "token_ids").collect())) == apart
    want = sorted(str((r["doc_id"], r["text"] or "")) for r in docs.collect())
    assert sorted(str((r["doc_id"], r["decoded"])) for r in both.collect()) == want
