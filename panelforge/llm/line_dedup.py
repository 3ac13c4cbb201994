"""Line dedup by pairwise alignment.

Documents that overlap are found through line hashes, aligned by patience diff,
and the common blocks are deleted from the later one.  Two kinds of hashes tie
documents together: lines that are rare (held by at most ``RARE`` documents),
and pairs of adjacent lines (blank lines between them do not count) however
frequent, which also ties large groups of copies, none of whose lines is rare.  A lone frequent line (a heading, a
footer) ties nothing, unless it is a block by itself and ``long_lines`` is set,
as the queries do: then it ties at any frequency.

So that a common block is tied to a document that holds all of it, windows of
lines are keys too: from each line on, and up to each line, the shortest run
that reaches ``MIN_BLOCK`` characters.  Any block of the wanted size is covered
by such runs inside it.  Each tie has one partner, so what patience diff leaves
out against the first holder of a window (repeated or in another order there)
stays, though a later holder might align.

A later document is paired with the first holder of each hash it has, so pairs
never outnumber hashes and no group is expanded; the first holder is an
aggregate with map-side combining.  What travels is hashes and lengths of
lines; texts are read again at the end to take the deleted lines out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, spare_name, text_of

#: A line held by more documents than this ties documents only together with its neighbour, or as a long line.
RARE = 100
#: Lines shorter than this are no anchors; common blocks with fewer characters are kept.
MIN_LINE, MIN_BLOCK = 20, 60


def patience_blocks(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int, int]]:
    """Common blocks (start in a, start in b, length) of two line sequences by patience diff.

    Matches the equal lines at both ends, then the longest rising run of lines unique in both, and goes on between
    them; adjoining matches are one block.
    """
    matched, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            matched.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            matched.append((j, m))
        if i == j or k == m:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:m])
        place = {line: y for y, line in enumerate(b[k:m], k) if in_b[line] == 1}
        unique = [(x, place[line]) for x, line in enumerate(a[i:j], i) if in_a[line] == 1 and line in place]
        tops, links, ends = [], [], []          # patience sorting: piles by their top's place in b
        for n, (_, y) in enumerate(unique):
            p = bisect_left(tops, y)
            links.append(ends[p - 1] if p else -1)
            tops[p:p + 1], ends[p:p + 1] = [y], [n]
        chain, n = [], ends[-1] if ends else -1
        while n >= 0:
            chain.append(unique[n])
            n = links[n]
        x0, y0 = i, k
        for x, y in reversed(chain):
            matched.append((x, y))
            todo.append((x0, x, y0, y))
            x0, y0 = x + 1, y + 1
        if chain:
            todo.append((x0, j, y0, m))
    blocks: list[list[int]] = []
    for x, y in sorted(matched):
        if blocks and blocks[-1][0] + blocks[-1][2] == x and blocks[-1][1] + blocks[-1][2] == y:
            blocks[-1][2] += 1
        else:
            blocks.append([x, y, 1])
    return [tuple(x) for x in blocks]


_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _windows(docs: DataFrame, min_block: int, long_lines: bool) -> DataFrame:
    """(rid, kind, key): the windows of every document, as hashes of their lines; those of one line only
    with ``long_lines``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                at = b.column("sizes").offsets.to_numpy().astype(np.int64)
                at -= at[0]
                sizes = b.column("sizes").flatten().to_numpy().astype(np.int64)
                hashes = b.column("hashes").flatten().to_numpy().view(np.uint64)
                n = len(sizes)
                doc = np.repeat(np.arange(b.num_rows), np.diff(at))
                upto = np.concatenate([[0], np.cumsum(sizes)])          # characters before each line
                line = np.flatnonzero(sizes > 0)
                last = np.searchsorted(upto, upto[line] + min_block) - 1
                ok = last < at[doc[line] + 1]
                first = np.searchsorted(upto, upto[line + 1] - min_block, "right") - 1
                fine = (upto[line + 1] >= min_block) & (first >= at[doc[line]])
                spans = np.unique(np.concatenate([line[ok] * n + last[ok], first[fine] * n + line[fine]]))
                i, j = spans // max(n, 1), spans % max(n, 1)
                i, j = (i, j) if long_lines else (i[j > i], j[j > i])
                # sums of hashes times powers by place, taken back to the window's start
                power = np.cumprod(np.r_[np.uint64(1), np.full(n, _ODD)], dtype=np.uint64)
                back = np.cumprod(np.r_[np.uint64(1), np.full(n, _INVERSE)], dtype=np.uint64)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:n], dtype=np.uint64)])
                key = (sums[j + 1] - sums[i]) * back[i]
                rid = b.column("rid").to_numpy()[doc[i]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid, pa.int64()), pa.array(np.full(len(rid), 4, np.int32)), pa.array(key.view(np.int64))],
                    names=["rid", "kind", "key"])

    return docs.select("rid", "hashes", "sizes").mapInArrow(run, "rid long, kind int, key long")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _doc_key(df: DataFrame, id_col: str, text: str) -> list[Column]:
    return [df[f"`{id_col}`"].alias("id"), F.xxhash64(text_of(df[f"`{text}`"])).alias("sig")]


def deleted_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", rare: int = RARE, min_line: int = MIN_LINE,
                  min_block: int = MIN_BLOCK, long_lines: bool = False) -> DataFrame:
    """(id, sig, lines): for documents that lose lines, their zero-based numbers; ``sig`` is a hash of the text."""
    body = text_of(df[f"`{text}`"])
    docs = df.select(*_doc_key(df, id_col, text), F.transform(_lines(body), lambda x: F.xxhash64(x)).alias("hashes"),
                     F.transform(_lines(body), lambda x: F.length(F.trim(x))).alias("sizes"))
    docs = docs.dropDuplicates(["id", "sig"])
    order = [F.col("id").asc_nulls_last(), F.col("sig").asc()]
    # a number that rises with the order; written once, so that it stays what it is
    docs = cut_lineage(docs.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("rid", F.monotonically_increasing_id()), "lines")
    n = F.size("sizes")
    single = F.filter(F.arrays_zip("hashes", "sizes"), lambda x: x["sizes"] >= min_line)
    filled = F.filter(F.arrays_zip("hashes", "sizes"), lambda x: x["sizes"] >= 1)       # blank lines part no pair
    pairs = F.when(F.size(filled) > 1, F.zip_with(
        filled, F.slice(filled, F.lit(2), F.greatest(F.size(filled), F.lit(1))),
        lambda x, y: F.when(x["sizes"] + y["sizes"] >= min_line, F.xxhash64(x["hashes"], y["hashes"])))
    ).otherwise(F.array().cast("array<long>"))
    keys = docs.select("rid", F.explode(F.array_distinct(F.concat(
        F.transform(single, lambda x: F.struct(F.lit(1).alias("kind"), x["hashes"].alias("key"))),
        F.transform(F.filter(pairs, lambda x: x.isNotNull()), lambda x: F.struct(F.lit(2).alias("kind"), x.alias("key"))),
        # a document of one line is tied by that line, however frequent
        F.when(n == 1, F.transform(single, lambda x: F.struct(F.lit(3).alias("kind"), x["hashes"].alias("key"))))
        .otherwise(F.array().cast("array<struct<kind:int,key:long>>"))))).alias("k")).select("rid", "k.kind", "k.key")
    keys = keys.unionAll(_windows(docs, min_block, long_lines))
    first = (keys.groupBy("kind", "key").agg(F.min("rid").alias("first"), F.count(F.lit(1)).alias("held"))
             .filter((F.col("held") > 1) & ((F.col("kind") > 1) | (F.col("held") <= rare))))
    ties = cut_lineage(keys.join(first, ["kind", "key"]).filter("first < rid").select("rid", "first").distinct(), "ties")

    later = docs.select("rid", F.col("hashes").alias("a"), F.col("sizes").alias("a_sizes"))
    earlier = docs.select(F.col("rid").alias("first"), F.col("hashes").alias("b"))
    both = ties.join(later, "rid").join(earlier, "first").select("rid", "a", "a_sizes", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                rids, lines = [], []
                for rid, a, sizes, b in zip(*(batch.column(c) for c in ("rid", "a", "a_sizes", "b")), strict=True):
                    sizes, gone = sizes.as_py(), []
                    for x, _, size in patience_blocks(a.as_py(), b.as_py()):
                        if sum(sizes[x:x + size]) >= min_block:
                            gone.extend(range(x, x + size))
                    if gone:
                        rids.append(rid.as_py())
                        lines.append(gone)
                yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(lines, pa.list_(pa.int32()))],
                                                 names=["rid", "lines"])

    gone = both.mapInArrow(run, "rid long, lines array<int>")
    gone = gone.groupBy("rid").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines"))
    return cut_lineage(docs.select("rid", "id", "sig").join(gone, "rid").select("id", "sig", "lines"), "deleted")


def remove_common_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", rare: int = RARE,
                        min_line: int = MIN_LINE, min_block: int = MIN_BLOCK, long_lines: bool = False) -> DataFrame:
    """``df`` with common blocks of lines taken out of ``text``, and ``n_lines`` and ``n_removed``.

    * A document is aligned with the first holder of each of its ties (see the module's text); a block of adjacent
      lines that the alignment finds common is deleted from the later document if it has at least ``min_block``
      characters besides spaces at line ends.  Judged on the input, so what is deleted here still counts there.
    * ``long_lines``: lines of at least ``min_block`` characters tie however frequent they are.
    * Later: the larger id; null ids come last; the same id: the larger hash of the text.  Rows alike in id and text
      are one document and treated alike.  Null texts stay null and empty texts empty; neither is tied.
    * Columns of ``df`` named as the new ones are replaced.  An empty table gives an empty result.
    """
    id_, sig, at = (spare_name(df, x) for x in ("line_id", "line_sig", "line_list"))
    gone = deleted_lines(df, id_col, text, rare, min_line, min_block, long_lines).toDF(id_, sig, at)
    rows = df.withColumn(sig, F.xxhash64(text_of(df[f"`{text}`"])))
    # the same plan at every size: texts are shuffled by id, never held against a broadcast
    rows = rows.join(gone.hint("merge"), (rows[f"`{id_col}`"].eqNullSafe(gone[id_])) & (rows[sig] == gone[sig]), "left").drop(gone[sig])
    body = F.col(f"`{text}`")
    kept = F.array_join(F.filter(_lines(body), lambda x, i: ~F.array_contains(F.col(at), i)), "\n")
    return rows.withColumns({
        "n_lines": F.when(text_of(body) == "", 0).otherwise(F.size(_lines(body))).cast("long"),
        "n_removed": F.coalesce(F.size(at), F.lit(0)).cast("long"),
        text: F.when(F.col(at).isNull(), body).otherwise(kept)}).drop(id_, sig, at)
