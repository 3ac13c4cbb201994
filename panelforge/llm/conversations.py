"""Repair of conversation structure by a shortest path over an edit lattice.

A conversation is well formed when its role initials match ``(s?(ua)+)?``.  The lattice of a conversation of ``n``
rows has the nodes (rows passed, state of that pattern); edges keep, rerole or delete the next row or insert a row.
``cheapest_edits`` searches it from both ends: a forward and a reverse heap meet, all crossings of equal cost are
finished, and of the cheapest paths the one with the ASCII-least audit (initials of its edits) is taken.

On Spark, rows are ranked and their faults found by windows over one exchange of narrow rows (texts as digests).  A
sorted stream then turns each conversation into its audit, holding one number a row and no texts, and a second sorted
stream applies the audits to the texts row by row, so a conversation of any length needs no memory for its texts.

Defined results: a null conv_id is a conversation of its own; a null turn sorts first and has no part in gaps; null
roles and texts are one space; rows with the same turn are ordered by role and digest of the text; an empty table
gives an empty result.  Columns besides the four are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut_lineage

#: What an edit costs; an undeleted truncated row costs one more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Faults of a row.
SOUND, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
#: States: nothing yet, after system, after user, after assistant; the last and the first may end.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_AFTER = {"s": {_START: _SYSTEM}, "u": {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER}, "a": {_USER: _ASSISTANT}}
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}


def _due(state: int) -> int:
    """The state after the only row of a user or an assistant that fits."""
    return _ASSISTANT if state == _USER else _USER


def _forward(symbols: str, node: tuple[int, int]) -> list[tuple[str, int, tuple[int, int]]]:
    """(edit, cost, next node) of the edges that leave a node."""
    i, state = node
    edges = [("I", INSERT, (i, _due(state)))]
    if i < len(symbols):
        c = symbols[i]
        edges.append(("D", DELETE, (i + 1, state)))
        if c != "x":
            more = TRUNCATED if c.isupper() else 0
            edges.append(("R", REROLE + more, (i + 1, _due(state))))
            after = _AFTER.get(c.lower(), {}).get(state)
            if after is not None:
                edges.append(("K", KEEP + more, (i + 1, after)))
    return edges


def _backward(symbols: str, node: tuple[int, int]) -> list[tuple[str, int, tuple[int, int]]]:
    """(edit, cost, previous node) of the edges that enter a node."""
    i, state = node
    before = {_USER: (_START, _SYSTEM, _ASSISTANT), _ASSISTANT: (_USER,)}.get(state, ())
    edges = [("I", INSERT, (i, s)) for s in before]
    if i > 0:
        c = symbols[i - 1]
        edges.append(("D", DELETE, (i - 1, state)))
        if c != "x":
            more = TRUNCATED if c.isupper() else 0
            edges += [("R", REROLE + more, (i - 1, s)) for s in before]
            edges += [("K", KEEP + more, (i - 1, s)) for s, after in _AFTER.get(c.lower(), {}).items() if after == state]
    return edges


class _Search:
    """Dijkstra's search from some nodes: the settled distances, and the heap of those to come."""

    def __init__(self, symbols: str, edges, sources: list[tuple[int, int]]) -> None:
        self.symbols, self.edges = symbols, edges
        self.settled: dict[tuple[int, int], int] = {}
        self.reached = dict.fromkeys(sources, 0)
        self.heap = [(0, s) for s in sources]

    def least(self) -> int | None:
        while self.heap and self.heap[0][1] in self.settled:
            heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self) -> tuple[int, int]:
        cost, node = heappop(self.heap)
        self.settled[node] = cost
        for _, more, to in self.edges(self.symbols, node):
            if to not in self.settled and cost + more < self.reached.get(to, cost + more + 1):
                self.reached[to] = cost + more
                heappush(self.heap, (cost + more, to))
        return node


@lru_cache(maxsize=4096)
def cheapest_edits(symbols: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair.

    ``symbols`` has a character a row: ``s u a`` by its role's initial, in upper case if it is truncated, ``o`` or
    ``O`` for any other initial, ``x`` for a row that has to be deleted.
    """
    n = len(symbols)
    ends = [(n, _START), (n, _ASSISTANT)]
    ahead, back = _Search(symbols, _forward, [(0, _START)]), _Search(symbols, _backward, ends)
    best: int | None = None
    while True:
        a, b = ahead.least(), back.least()
        if best is not None and (a is None or b is None or a + b > best):
            break
        side, other = (ahead, back) if b is None or a is not None and a <= b else (back, ahead)
        node = side.settle()
        # every edge from a settled node of one side to one of the other closes a path
        for _, more, to in side.edges(symbols, node):
            if to in other.settled:
                total = side.settled[node] + more + other.settled[to]
                best = total if best is None or total < best else best
        if node in other.settled:
            total = side.settled[node] + other.settled[node]
            best = total if best is None or total < best else best

    # crossings of equal cost, and all nodes before them on paths that are as cheap
    rest = {v: best - d for v, d in ahead.settled.items() if back.settled.get(v) == best - d}
    rest |= {v: c for v, d in ahead.settled.items() for _, more, to in _forward(symbols, v)
             if (c := best - d) == more + back.settled.get(to, best + 1)}
    stack = list(rest)
    while stack:
        node = stack.pop()
        for _, more, to in _backward(symbols, node):
            if to in ahead.settled and to not in rest and ahead.settled[to] + more == ahead.settled[node]:
                rest[to] = best - ahead.settled[to]
                stack.append(to)
    # the least concatenation of a forward and a reverse audit: edits that leave a node differ, so the least one at
    # every node makes the least audit
    audit, node, left = [], (0, _START), best
    while left > 0 or node not in ends:
        edit, more, to = min((e, c, t) for e, c, t in _forward(symbols, node)
                             if rest.get(t, back.settled.get(t)) == left - c)
        audit.append(edit)
        node, left = to, left - more
    return best, "".join(audit)


def damage(df: DataFrame) -> DataFrame:
    """``conversations`` with a reproducible fault by the CRC-32 of ``conv_id:turn`` modulo 20 (0 drops a row, 1
    empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it a user's); nulls count as one space.

    Columns: conv_id, turn, role, text and ``there``, which is false in rows that were dropped.
    """
    def worded(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(worded("conv_id"), F.lit(":"), worded("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(worded("text"), "[.!?]", "")).otherwise(worded("text"))
    out = df.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(worded("role")).alias("role"),
                    text.alias("text"), (kind != 0).alias("there"), kind.alias("kind"))
    again = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.withColumn("copy", F.explode(again)).select("conv_id", "turn", "role", "text", "there")


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with the digest that orders rows of one turn."""
    return rows.withColumn("digest", F.sha2("text", 256))


_ORDER = ("turn", "role", "digest")


def row_faults(rows: DataFrame) -> DataFrame:
    """One narrow row for each row: conv_id, turn, place in its conversation (0: not there), symbol and fault."""
    t = F.col("text")
    narrow = _ordered(rows).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", "digest", "there", (~t.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~t.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"))
    place = F.row_number().over(W.partitionBy("conv_id", "there").orderBy(*_ORDER))
    # the same exchange serves: equal conv_id, role and text are in the task of their conversation
    nth = F.row_number().over(W.partitionBy("conv_id", "there", "role", "digest").orderBy("place"))
    out = narrow.repartition("conv_id").withColumn("place", place).withColumn("nth", nth)
    fault = (F.when(F.col("blank"), BLANK).when(F.col("nth") > 1, DUPLICATE).when(F.col("cut"), CUT).otherwise(SOUND))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return out.select("conv_id", "turn", F.when(F.col("there"), F.col("place")).otherwise(0).alias("place"),
                      known.alias("initial"), fault.alias("fault"))


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audit_conversations(rows: DataFrame) -> DataFrame:
    """For each conv_id: gaps, counts of faults, illegal neighbours, cost and audit of the cheapest repair.

    ``rows`` has conv_id, turn, role, text and there; a conversation without rows that are there has zeros and an
    empty audit.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    faults = row_faults(rows).sortWithinPartitions("conv_id", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        ids = None

        def close(conv, open_) -> None:
            initials, faults, turns = open_
            symbols = "".join("x" if f in (BLANK, DUPLICATE) else c.upper() if f == CUT else c
                              for c, f in zip(initials, faults, strict=True))
            cost, audit = cheapest_edits(symbols)
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairwise(initials))
            done.append((conv, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost,
                         audit))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], ids), *[pa.array(c, pa.int64()) for c in cols[1:7]], pa.array(cols[7], pa.string())],
                names=["conv_id", *_COUNTS, "audit"])

        conv, open_ = None, None
        for b in batches:
            ids = b.column(0).type
            for c, turn, place, initial, fault in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if open_ is None or c != conv:
                    if open_ is not None:
                        close(conv, open_)
                    conv, open_ = c, [[], bytearray(), None]
                if place == 0:
                    continue
                open_[0].append(initial)
                open_[1].append(fault)
                if turn is not None:        # rows come by turn
                    t = open_[2]
                    open_[2] = [turn, turn, 1] if t is None else [t[0], turn, t[2] + (turn != t[1])]
            if len(done) >= 4096:
                yield flush()
        if open_ is not None:
            close(conv, open_)
        if done:
            yield flush()

    return faults.mapInArrow(run, f"conv_id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """From rows sorted by (conv_id, audit first, order): (conv_id, None, audit, counts) once a conversation, then
    (conv_id, edit, role, text) for each row that stays or is new."""
    state, audit, at, conv = _START, "", 0, None

    def step(to_row: bool, role=None, text=None) -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and (to_row or audit[at] == "I"):
            edit = audit[at]
            at += 1
            if edit == "K":
                state = _AFTER[role[0]][state]
                yield conv, edit, role, text
            elif edit in "IR":
                state = _due(state)
                yield conv, edit, _ROLE[state], text if edit == "R" else ""
            if edit != "I":
                return

    for b in batches:
        cols = [x.to_pylist() for x in b.columns]
        for c, first, role, text, *rest in zip(*cols, strict=True):
            if first == 0:
                yield from step(False)
                conv, state, audit, at = c, _START, text, 0
                yield conv, None, audit, rest
            else:
                yield from step(True, role, text)
    yield from step(False)


def _joined(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Texts and audits dealt by conv_id and sorted, each audit before its rows."""
    counts = [F.col(c) for c in _COUNTS]
    heads = audits.select("conv_id", F.lit(0).alias("first"), F.lit("").alias("role"), F.col("audit").alias("text"),
                          *counts, F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
                          F.lit("").alias("digest"))
    texts = _ordered(rows.filter("there")).select(
        "conv_id", F.lit(1).alias("first"), "role", "text", *[F.lit(None).cast("long").alias(c) for c in _COUNTS],
        "turn", "digest")
    both = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "first", *_ORDER)
    return both.select("conv_id", "first", "role", "text", *_COUNTS)


def repair_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The rows after repair: conv_id, place (from 1), edit (K, R or I), role and text."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        ids, place, size = None, 0, 0

        def typed(batches):
            nonlocal ids
            for b in batches:
                ids = b.column(0).type
                yield b

        def flush() -> pa.RecordBatch:
            cols = list(zip(*held, strict=True))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], ids), pa.array(cols[1], pa.int64()),
                                               *[pa.array(c, pa.string()) for c in cols[2:]]],
                                              names=["conv_id", "place", "edit", "role", "text"])

        for conv, edit, role, text in _repaired(typed(batches)):
            if edit is None:
                place = 0
                continue
            place, size = place + 1, size + len(text)
            held.append((conv, place, edit, role, text))
            if len(held) >= 4096 or size >= 1 << 22:
                size = 0
                yield flush()
        if held:
            yield flush()

    return _joined(rows, audits).mapInArrow(run, f"conv_id {kind}, place long, edit string, role string, text string")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation.

    The digest is the SHA-256 of the repaired ``role:text`` rows joined by newlines, hashed as they pass;
    ``repair_rows`` gives the rows themselves.
    """
    audits = cut_lineage(audit_conversations(rows), "audits")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        ids, head, digest, gap = None, None, hashlib.sha256(), ""

        def typed(batches):
            nonlocal ids
            for b in batches:
                ids = b.column(0).type
                yield b

        def flush() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], ids), *[pa.array(c, pa.int64()) for c in cols[1:7]],
                                               *[pa.array(c, pa.string()) for c in cols[7:]]],
                                              names=["conv_id", *_COUNTS, "audit", "repaired_sha256"])

        for conv, edit, role, text in _repaired(typed(batches)):
            if edit is None:
                if head is not None:
                    done.append((*head, digest.hexdigest()))
                    if len(done) >= 4096:
                        yield flush()
                head, digest, gap = (conv, *text, role), hashlib.sha256(), ""
            else:
                digest.update(f"{gap}{role}:".encode())
                digest.update(text.encode())
                gap = "\n"
        if head is not None:
            done.append((*head, digest.hexdigest()))
        if done:
            yield flush()

    return _joined(rows, audits).mapInArrow(
        run, f"conv_id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired_sha256 string")
