"""Byte-level BPE: a lazily determinised transducer for encoding, a UTF-8 state machine for decoding.

A byte string has exactly one BPE encoding, and a token sequence is that
encoding if and only if every token encodes to itself and every adjacent pair
does (the pair test).  That makes BPE a finite-state relation: a thread of the
nondeterministic transducer is a node of the vocabulary's trie (the token being
read) and the token before it.  The machine is determinised as bytes are read:
a state is the set of live threads, and a transition yields the one token that
ends at this byte.  A thread dies when no token continues it, so what the live
threads agree on is settled a bounded number of bytes behind the input and is
emitted, at the end of a piece or, in a long piece, after each block.  States,
transitions and pair tests are remembered.  When the table of states is full,
pieces that leave it go on with their threads undetermined; the states it has
are those of the beginnings that came first, which are the frequent ones.

The rank file and the pattern that cuts text into pieces are parameters.  The
driver reads the file once and broadcasts it; its size is that of the
vocabulary, whatever the input.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices

#: Larger rank files than this are not broadcast.
MAX_VOCABULARY_BYTES = 64 << 20
#: Texts above this many characters are cut into pieces as a stream, not as one list.
LONG_TEXT = 1 << 20


def read_ranks(data: bytes) -> dict[bytes, int]:
    """token bytes -> id, from lines ``base64 rank``."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class Transducer:
    """Encodes single pieces; see the module's text."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 60_000, max_pairs: int = 400_000):
        self.ranks, self.max_states, self.max_pairs = ranks, max_states, max_pairs
        self.token = {v: k for k, v in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        # trie: child[node << 8 | byte] -> node, ends[node] -> token id; inner: nodes with children
        self.child, self.ends, self.inner, nodes = {}, {}, {0}, 1
        for token, rank in ranks.items():
            node = 0
            for b in token:
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = self.child[node << 8 | b] = nodes
                    self.inner.add(node)
                    nodes += 1
                node = nxt
            self.ends[node] = rank
        self.size = {v: len(k) for k, v in ranks.items()}
        self.pairs, self.split = {}, {}
        start = ((-1, 0),)                      # one thread: (token before, trie node)
        self.ids, self.states, self.moves = {start: 0}, [start], {}

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens of the last merge that makes ``token``; None for a single byte.  (-1, -1): no merges
        make it."""
        known = self.split.get(token, 0)
        if known != 0:
            return known
        data, ranks = self.token[token], self.ranks
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 2:
            found = [ranks.get(x + y, 1 << 60) for x, y in zip(parts, parts[1:], strict=False)]
            low = min(found)
            if low == 1 << 60:
                break
            best = found.index(low)
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        made = None if len(parts) == 1 else tuple(ranks[p] for p in parts) if len(parts) == 2 else (-1, -1)
        self.split[token] = made
        return made

    def _stands(self, before: int, token: int) -> bool:
        """Does ``token`` keep its shape after ``before`` (-1: at the start)?

        Takes the merges of both back, the later one first, and looks whether the two tokens that then meet would
        have been merged before the one taken back.  Of equal ranks the left one is merged first.
        """
        halves = self._halves(token)
        if halves == (-1, -1):
            return False
        if before < 0:
            return True
        known = self.pairs.get((before, token))
        if known is None:
            if len(self.pairs) >= self.max_pairs:
                self.pairs.clear()
            known = self.pairs[before, token] = self._meet(before, token)
        return known

    def _meet(self, left: int, right: int) -> bool:
        limit = 1 << 60
        while True:
            if self.ranks.get(self.token[left] + self.token[right], 1 << 60) < limit:
                return False
            a, b = self._halves(left), self._halves(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                limit, left = left, a[1]
            else:
                limit, right = right + 1, b[0]

    def _step(self, threads: Sequence[tuple[int, int]], byte: int) -> tuple[list[tuple[int, int]], int]:
        """The threads after ``byte`` and the token that ends there."""
        child, ends, inner, pairs = self.child, self.ends, self.inner, self.pairs
        live, done = [], -1
        for before, node in threads:
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            if done < 0:
                token = ends.get(node)
                if token is not None:
                    stands = pairs.get((before, token))
                    if stands is None:
                        stands = self._stands(before, token)
                    if stands:
                        done = token
            if node in inner:
                live.append((before, node))
        live.append((done, 0))
        return live, done

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        """Build the transition: the next state (-1: the table is full) and the token that ends here."""
        live, done = self._step(self.states[state], byte)
        key = tuple(live)
        to = self.ids.get(key, -1)
        if to < 0:
            if len(self.states) >= self.max_states:
                return -1, done
            to = self.ids[key] = len(self.states)
            self.states.append(key)
        self.moves[state << 8 | byte] = to, done
        return to, done

    def _path(self, ends: list[int], at: int) -> list[int]:
        """The tokens of the encoding of the first ``at`` bytes, back to front."""
        out, size = [], self.size
        while at > 0:
            token = ends[at - 1]
            out.append(token)
            at -= size[token]
        return out

    def _settled(self, threads: Sequence[tuple[int, int]], ends: list[int]) -> tuple[list[int], int]:
        """Tokens that all live threads agree on, and the bytes they cover."""
        depth = self._depths(threads)
        paths = [self._path(ends, len(ends) - d)[::-1] for d in depth]
        common, shortest = 0, min(map(len, paths))
        while common < shortest and len({p[common] for p in paths}) == 1:
            common += 1
        out = paths[0][:common]
        return out, sum(self.size[t] for t in out)

    def _depths(self, threads: Sequence[tuple[int, int]]) -> list[int]:
        if not hasattr(self, "depth"):
            self.depth = {0: 0}
            for edge, to in self.child.items():     # parents come before their children
                self.depth[to] = self.depth[edge >> 8] + 1
        return [self.depth[node] for _, node in threads]

    def encode(self, piece: bytes, block: int = 4096) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, threads, out, ends, moves = 0, None, [], [], self.moves
        for byte in piece:
            if threads is None:
                was = state
                state, token = moves.get(state << 8 | byte) or self._move(state, byte)
                if state < 0:
                    threads = self._step(self.states[was], byte)[0]
            else:
                threads, token = self._step(threads, byte)
            ends.append(token)
            if len(ends) >= block and len(ends) % block == 0:
                settled, covered = self._settled(threads or self.states[state], ends)
                out += settled
                del ends[:covered]
        return out + self._path(ends, len(ends))[::-1]


class Pieces(dict):
    """piece -> ids, computed on first use.  Of two generations the older is dropped when the younger is full."""

    def __init__(self, transducer: Transducer, limit: int = 150_000):
        super().__init__()
        self.transducer, self.limit, self.old = transducer, limit, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        if ids is None:
            ids = tuple(self.transducer.encode(piece.encode("utf-8", "surrogatepass")))
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def ascii_pattern(pattern: str) -> str:
    r"""The pattern for ASCII text, in the syntax of ``re`` with its ASCII flag: \p{L} and \p{N} spelled out."""
    out, in_class = [], False
    for part in regex.findall(r"\\p\{[LN]\}|\\.|.", pattern):
        if part in (r"\p{L}", r"\p{N}"):
            chars = "A-Za-z" if "L" in part else "0-9"
            part = chars if in_class else f"[{chars}]"
        elif part in "[]":
            in_class = part == "["
        out.append(part)
    return "".join(out)


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pieces, self.pattern = Pieces(Transducer(ranks)), regex.compile(pattern)
        try:
            self.plain = re.compile(ascii_pattern(pattern), re.ASCII)
        except re.error:                        # syntax that only the regex library has
            self.plain = self.pattern

    def stream(self, text: str, block: int = 1 << 16) -> Iterator[list[int]]:
        """Ids of the text, in blocks; a long text is never cut into pieces all at once."""
        get, pattern = self.pieces.__getitem__, self.plain if text.isascii() else self.pattern
        if len(text) <= LONG_TEXT:
            yield list(chain.from_iterable(map(get, pattern.findall(text))))
            return
        found = (m.group() for m in pattern.finditer(text))
        while ids := list(chain.from_iterable(map(get, islice(found, block)))):
            yield ids

    def __call__(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.stream(text))) if text else []


def _utf8_step(state: int, byte: int) -> int:
    """One byte of the UTF-8 machine.  0: between characters; 1-3: that many continuation bytes to come;
    4-7: after E0, ED, F0, F4, whose next byte is restricted; -1: ill-formed."""
    if state == 0:
        if byte < 0x80:
            return 0
        special = {0xE0: 4, 0xED: 5, 0xF0: 6, 0xF4: 7}.get(byte)
        if special:
            return special
        return 1 if 0xC2 <= byte <= 0xDF else 2 if 0xE1 <= byte <= 0xEF else 3 if 0xF1 <= byte <= 0xF3 else -1
    low, high, to = {4: (0xA0, 0xBF, 1), 5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)
                     }.get(state, (0x80, 0xBF, state - 1))
    return to if low <= byte <= high else -1


def whole_characters(data: bytes) -> int:
    """Length of ``data`` up to the character that its last bytes begin but do not end."""
    for back in range(1, min(3, len(data)) + 1):
        if data[-back] >= 0xC0 or data[-back] < 0x80:
            state = 0
            for b in data[-back:]:
                state = _utf8_step(state, b)
                if state < 0:
                    break
            return len(data) - back if state > 0 else len(data)
    return len(data)


class Decoder:
    """Ids to text, as they come: after each block the machine finds the character that is still open."""

    def __init__(self, ranks: dict[bytes, int]):
        self.token = {v: k for k, v in ranks.items()}

    def stream(self, ids: Iterable[int], block: int = 1 << 16) -> Iterator[str]:
        """Text of whole characters after each block; ill-formed bytes and unknown ids become U+FFFD."""
        ids, held, token = iter(ids), b"", self.token
        while part := list(islice(ids, block)):
            try:
                data = held + b"".join(map(token.__getitem__, part))
            except KeyError:
                data = held + b"".join(token.get(i, b"\xff") for i in part)
            end = whole_characters(data)
            held = data[end:]
            yield data[:end].decode("utf-8", "replace")
        if held:
            yield held.decode("utf-8", "replace")

    def __call__(self, ids: Iterable[int] | None) -> str:
        return "".join(self.stream(ids)) if ids is not None else ""


_MADE: dict[tuple, object] = {}


def _made(kind: type, vocabulary: Broadcast, *args):
    """One encoder or decoder for each vocabulary in a Python worker; tasks after the first find it warm."""
    data = vocabulary.value
    key = (kind, hash(data), len(data), *args)
    if key not in _MADE:
        _MADE.clear() if len(_MADE) > 4 else None
        _MADE[key] = kind(read_ranks(data), *args)
    return _MADE[key]


def load_vocabulary(df: DataFrame, path: str) -> Broadcast:
    """Read the rank file on the driver and broadcast it, checked against ``MAX_VOCABULARY_BYTES``."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY_BYTES} bytes")
    return df.sparkSession.sparkContext.broadcast(data)


def _with(batch: pa.RecordBatch, name: str, values: pa.Array, drop: str) -> pa.RecordBatch:
    keep = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != drop and n != name]
    return pa.RecordBatch.from_arrays([*(c for _, c in keep), values], names=[*(n for n, _ in keep), name])


def encode_texts(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``df`` with the ids of each whole text as ``array<int>`` in place of ``text``.

    Each match of ``pattern`` is encoded by itself; special tokens have no meaning.  Null and empty texts get an
    empty array.  A column of ``df`` named as ``ids``, in any case, is replaced; all others are kept.
    """
    data = load_vocabulary(df, vocabulary)
    kept = [f for f in df.schema.fields if f.name.lower() not in (text.lower(), ids.lower())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _made(Encoder, data, pattern)
        for batch in slices(batches, text):
            found = pa.array([encoder(x.as_py()) for x in batch.column(text)], pa.list_(pa.int32()))
            yield _with(batch, ids, found, text)

    names = [f.name for f in kept]
    return df.select(*[df[f"`{n}`"] for n in names], df[f"`{text}`"]).mapInArrow(
        run, T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode_ids(df: DataFrame, vocabulary: str, ids: str = "token_ids", text: str = "text") -> DataFrame:
    """``df`` with the text of each id array in place of ``ids``; a null array gives the empty text.

    Ids outside the vocabulary and bytes that are not UTF-8 become U+FFFD.  A column of ``df`` named as ``text``, in
    any case, is replaced; all others are kept.
    """
    data = load_vocabulary(df, vocabulary)
    kept = [f for f in df.schema.fields if f.name.lower() not in (text.lower(), ids.lower())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _made(Decoder, data)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [decoder(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else ""
                         for x in part.column(ids)]
                yield _with(part, text, pa.array(found, pa.string()), ids)

    names = [f.name for f in kept]
    return df.select(*[df[f"`{n}`"] for n in names], df[f"`{ids}`"]).mapInArrow(
        run, T.StructType([*kept, T.StructField(text, T.StringType())]))


def round_trip(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "token_ids",
               decoded: str = "decoded") -> DataFrame:
    """``df`` with the ids of each whole text and the text that they decode to, both in place of ``text``.

    One Python worker a task encodes and decodes, with the results of ``encode_texts`` and ``decode_ids``.  Columns of
    ``df`` named as the new ones, in any case, are replaced; all others are kept.
    """
    data = load_vocabulary(df, vocabulary)
    gone = {text.lower(), ids.lower(), decoded.lower()}
    kept = [f for f in df.schema.fields if f.name.lower() not in gone]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _made(Encoder, data, pattern), _made(Decoder, data)
        for batch in slices(batches, "__text"):
            found = [encoder(x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found, pa.list_(pa.int32())),
                 pa.array([decoder(x) for x in found], pa.string())], names=[*(f.name for f in kept), ids, decoded])

    rows = df.select(df[f"`{text}`"].alias("__text"), *[df[f"`{f.name}`"] for f in kept])
    return rows.mapInArrow(run, T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType())),
                                              T.StructField(decoded, T.StringType())]))
