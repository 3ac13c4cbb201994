"""MinHash near-dedup with tensored banding.

Table keys pair a half key from one small collection of minhashes with a half
key from another: 14 half keys of four minhashes and 11 of three make 154
tables of seven from 89 minhashes, where 154 tables of their own would take
1,078.  A pair is a candidate if some half key of each collection agrees; at a
similarity of 0.8 that fails for about one pair in 1,000, at 0.85 for one in
50,000.

Documents with equal sets are one node, so copies never meet each other.  In a
bucket every node is compared with the bucket's smallest node only (a star, in
all no more pairs than bucket entries), and what is linked is joined.  Of the
buckets that are left with several components, all pairs of members of
different components are looked at, except members of a bucket's main component
that cannot be similar to any outsider (distances are metric: two members whose
distances to the bucket's smallest node differ by more than 0.2 are not).  For
that, members meet by half keys of the first collection in blocks of bounded
size, and a pair is taken once, if it shares a bucket and exact bounds of its
similarity (set sizes, counts of shingles by bins) do not exclude it.  So every
candidate pair is in one component, compared or excluded by a bound.  All links
are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, slices
from .graph import components
from .shingles import shingle_sets

#: (half keys, minhashes in each) of the two collections that are paired.
COLLECTIONS = ((14, 4), (11, 3))
#: Members of a block of pairs (twice), bins of a set's sketch, and pairs looked at together.
CHUNK, BINS, SLAB = 256, 256, 1 << 19
#: Bytes of text whose shingles are made together.
_SLICE = 1 << 19
_RNG = np.random.default_rng(711)
_N = sum(m * r for m, r in COLLECTIONS)
_A = _RNG.integers(0, 1 << 63, _N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 64, _N, dtype=np.uint64)


def _half_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Half keys of nonempty sets, one row each: minhashes combined by their collection's width."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    low = np.stack([np.minimum.reduceat(flat * a + b, starts) for a, b in zip(_A, _B, strict=True)], 1)
    out, at = [], 0
    for m, r in COLLECTIONS:
        for _ in range(m):
            key = low[:, at].copy()
            for k in range(1, r):
                key = key * np.uint64(0x9FB21C651E98DF25) + low[:, at + k]
            out.append(key ^ (key >> np.uint64(29)))
            at += r
    return np.stack(out, 1).view(np.int64)


def _digest(s: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def signatures(df: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """id, n (set size), digest (of the set; null if empty), halves for every row of ``df``."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", _SLICE):
            sets = list(shingle_sets(b.column("text"), width))
            full = [s for s in sets if len(s)]
            halves = iter(_half_keys(full).tolist() if full else ())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([next(halves) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                names=["id", "n", "digest", "halves"])

    return rows.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, n long, digest binary, "
                                "halves array<long>")


def _sets_of(df: DataFrame, wanted: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """(nid, shingles) of the wanted nodes (nid, rep, digest), from the text of the row with the node's rep id."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.join(wanted, F.col("id").eqNullSafe(F.col("rep"))).select("nid", "digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", _SLICE):
            got = [(n, s) for n, d, s in zip(b.column("nid").to_pylist(), b.column("digest").to_pylist(),
                                            shingle_sets(b.column("text"), width), strict=True)
                   if len(s) and _digest(s) == d]
            sizes = np.cumsum([0, *(len(s) for _, s in got)]).astype(np.int32)
            flat = np.concatenate([s for _, s in got]).view(np.int64) if got else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in got], pa.int64()), pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))],
                names=["nid", "shingles"])

    # rows that repeat an id and a text are alike
    return rows.mapInArrow(run, "nid long, shingles array<long>").dropDuplicates(["nid"])


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs (x, y) with ``distance`` (1 - Jaccard) and ``linked``, on full sets."""
    a = sets.select(F.col("nid").alias("x"), F.col("shingles").alias("a"))
    b = sets.select(F.col("nid").alias("y"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b")).cast("long")
    out = pairs.join(a, "x").join(b, "y").select("x", "y", both.alias("i"),
                                                 (F.size("a") + F.size("b") - both).alias("u"))
    return out.select("x", "y", (1 - F.col("i") / F.col("u")).alias("distance"),
                      (100 * F.col("i") >= percent * F.col("u")).alias("linked"))


def _sketches(sets: DataFrame) -> DataFrame:
    """nid, n, sketch: how many shingles of the set fall into each bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = np.diff(b.column("shingles").offsets.to_numpy())
            flat = b.column("shingles").flatten().to_numpy().view(np.uint64)
            bins = ((flat * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % BINS
            out, at = [], 0
            for n in sizes:
                counts = np.bincount(bins[at:at + n], minlength=BINS)
                at += n
                # too many for the type: a count that bounds nothing
                out.append((counts if counts.max() < 1 << 16 else np.full(BINS, (1 << 16) - 1)).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("nid"), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())],
                                             names=["nid", "n", "sketch"])

    return sets.mapInArrow(run, "nid long, n long, sketch binary")


def _cross_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (x > y) of ``members`` (nid, root, halves, n, sketch) of different roots that share a bucket and
    that bounds do not exclude."""
    m, k = (x for x, _ in COLLECTIONS)
    entries = members.select("nid", "root", F.posexplode(F.slice("halves", 1, m)).alias("i", "a"))
    entries = cut_lineage(entries.select("nid", "root", "i", F.xxhash64("i", "a").alias("key")), "entries")
    sizes = entries.groupBy("key", "root").agg(F.count(F.lit(1)).alias("k"))
    sizes = sizes.groupBy("key").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.max("k").alias("m"),
                                     F.sum("k").alias("k")).filter("k > m")
    # chunks of outsiders come first; they meet all chunks, those of the main component meet outsiders only
    chunks = sizes.select("key", "main", F.ceil((F.col("k") - F.col("m")) / CHUNK).alias("o"),
                          F.ceil(F.col("m") / CHUNK).alias("c"))
    inner = F.col("root") == F.col("main")
    spread = F.xxhash64("nid", "key")
    placed = entries.join(chunks, "key").select(
        "key", "nid", "i", F.when(inner, F.col("o") + F.pmod(spread, F.col("c"))).otherwise(F.pmod(spread, F.col("o")))
        .alias("at"), F.explode(F.sequence(F.lit(0).cast("long"), F.when(inner, F.col("o")).otherwise(
            F.col("o") + F.col("c")) - 1)).alias("to"))
    placed = placed.select("key", "nid", "i", "at", F.least("at", "to").alias("low"), F.greatest("at", "to").alias("high"))
    blocks = placed.join(members, "nid").groupBy("key", "low", "high").agg(F.collect_list(F.struct(
        "i", "at", "nid", "root", "n", "halves", "sketch")).alias("members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 64) for i in range(0, whole.num_rows, 64)):
                rows = b.column("members")
                f = {x.name: c for x, c in zip(rows.type.value_type, rows.flatten().flatten(), strict=True)}
                i, at, nid, root, n = (f[x].to_numpy() for x in ("i", "at", "nid", "root", "n"))
                halves = f["halves"].flatten().to_numpy().reshape(-1, m + k)
                sketch = np.frombuffer(b"".join(f["sketch"].to_pylist()), np.uint16).reshape(-1, BINS)
                ends = np.cumsum(np.diff(rows.offsets.to_numpy()))
                block = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                within = (b.column("low").to_numpy() == b.column("high").to_numpy())[block]
                rest = ends[block] - np.arange(len(nid)) - 1          # members after this one in its block
                total = np.cumsum(rest)
                start = 0
                while start < len(nid):
                    done = total[start - 1] if start else 0
                    stop = max(start + 1, int(np.searchsorted(total, done + SLAB, "right")))
                    count = rest[start:stop]
                    x = np.repeat(np.arange(start, stop), count)
                    y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)
                    start = stop
                    ok = (root[x] != root[y]) & (within[x] | (at[x] != at[y]))
                    ok &= 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
                    x, y = x[ok], y[ok]
                    alike = halves[x] == halves[y]
                    # of the keys by which the pair meets, the first one takes it
                    ok = (alike[:, :m].argmax(1) == i[x]) & alike[:, :m].any(1) & alike[:, m:].any(1)
                    x, y = x[ok], y[ok]
                    most = np.concatenate([np.zeros(0, np.int64), *(
                        np.minimum(sketch[x[j:j + 8192]], sketch[y[j:j + 8192]]).sum(1, dtype=np.int64)
                        for j in range(0, len(x), 8192))])
                    ok = (100 + percent) * most >= percent * (n[x] + n[y])
                    x, y = nid[x[ok]], nid[y[ok]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))],
                                                     names=["x", "y"])

    return blocks.mapInArrow(run, "x long, y long")


def _table_keys(nodes: DataFrame) -> DataFrame:
    """(nid, key) of the tables in which a node can meet another.

    A table key is held twice only if both of its half keys are, so half keys are counted first, 25 rows a node in
    place of 154, and only those that several nodes hold are paired.
    """
    m = COLLECTIONS[0][0]
    half = nodes.select("nid", F.posexplode("halves").alias("h", "v"))
    several = half.groupBy("h", "v").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("h", "v")
    held = half.join(several, ["h", "v"]).groupBy("nid").agg(F.collect_list(F.struct("h", "v")).alias("halves"))
    first = F.filter("halves", lambda x: x["h"] < m)
    second = F.filter("halves", lambda x: x["h"] >= m)
    return (held.select("nid", F.explode(first).alias("a"), second.alias("second"))
            .select("nid", "a", F.explode("second").alias("b"))
            .select("nid", F.xxhash64("a.h", "b.h", "a.v", "b.v").alias("key")))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
                    ) -> DataFrame:
    """id, n_shingles, component_id, kept for every row of ``df``.

    Two documents are linked if ``100 x intersection >= percent x union`` of their sets of ``width``-word shingles
    (words are runs of non-space; A-Z lower-cased; a text with fewer words has its whole sequence as one shingle).

    * ``component_id`` is the smallest id reachable by links, ``kept`` says that it is the row's own.
    * Null, empty and wordless texts are linked with nothing: ``component_id`` is their own id.
    * Repeated rows are linked; null ids come after all others and share a component only by their texts.
    * An empty table gives an empty result; other columns are ignored.
    """
    signed = cut_lineage(signatures(df, id_col, text, width), "signatures")
    nodes = cut_lineage(
        signed.filter("digest is not null").groupBy("digest").agg(F.min("id").alias("rep"),
                                                                  F.min("halves").alias("halves"))
        .withColumn("nid", F.monotonically_increasing_id()), "nodes")      # fixed by being written
    entries = _table_keys(nodes)
    heads = entries.groupBy("key").agg(F.min("nid").alias("head"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    shared = cut_lineage(entries.join(heads, "key"), "buckets")

    pairs = cut_lineage(shared.filter("nid != head").select(F.col("nid").alias("x"), F.col("head").alias("y"))
                        .distinct(), "pairs")
    ends = pairs.select(F.explode(F.array("x", "y")).alias("nid")).distinct()
    sets = cut_lineage(_sets_of(df, nodes.select("nid", "rep", "digest").join(ends, "nid"), id_col, text, width), "sets")
    stars = cut_lineage(_verify(pairs, sets, percent), "links")
    links = stars.filter("linked").select(F.col("x").alias("u"), F.col("y").alias("v"))
    roots = components(links)

    # buckets whose members are in several components
    root = F.coalesce("root", "nid").alias("root")
    placed = shared.filter("k > 2").join(roots.withColumnRenamed("node", "nid"), "nid", "left").select(
        "key", "nid", "head", root)
    sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("key").agg(F.max_by("root", F.struct("k", "root")).alias("main"),
                                    F.count(F.lit(1)).alias("parts")).filter("parts > 1").drop("parts")
    reach = F.lit((100 - percent) / 100 + 1e-9)
    far = stars.select(F.col("x").alias("nid"), F.col("y").alias("head"), "distance")
    # by head and node, as the distance is theirs: a range over all buckets of a head is no narrower than that of one
    mixed = placed.filter("nid != head").join(main, "key").groupBy("head", "nid", "root").agg(
        F.max(F.col("root") != F.col("main")).alias("outer"))
    mixed = cut_lineage(mixed.join(far, ["nid", "head"]).select("head", "nid", "root", "outer", "distance"), "mixed")
    near = mixed.filter("outer").groupBy("head").agg((F.min("distance") - reach).alias("low"),
                                                     (F.max("distance") + reach).alias("high"))
    close = mixed.filter("not outer").join(near, "head").filter("distance between low and high").select(*mixed.columns)
    taking = mixed.filter("outer").unionByName(close).select("nid", "root").distinct()
    taking = cut_lineage(taking.join(nodes.select("nid", "halves"), "nid").join(
        _sketches(sets.join(taking.select("nid"), "nid")), "nid"), "members")
    more = cut_lineage(_cross_pairs(taking, percent).join(stars.select("x", "y"), ["x", "y"], "left_anti"), "pairs")
    if not more.isEmpty():
        found = cut_lineage(_verify(more, sets, percent).filter("linked").select(
            F.col("x").alias("u"), F.col("y").alias("v")), "links")
        if not found.isEmpty():
            roots = components(links.unionAll(found))

    label = nodes.select("digest", "nid", "rep").join(roots.withColumnRenamed("node", "nid"), "nid", "left").select(
        "digest", "rep", root)
    least = label.groupBy("root").agg(F.min("rep").alias("least"))
    label = label.join(least, "root").select("digest", "least")
    return signed.select("id", "n", "digest").join(label, "digest", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id")).withColumn(
        "kept", F.col(id_col).eqNullSafe(F.col("component_id")))
