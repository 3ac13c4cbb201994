"""Document fingerprints: homomorphic multiset hashes of paragraphs, in DataFrame functions only.

Every paragraph (the text between line breaks) is hashed to a wide vector, and
a document's fingerprint is the sum of its paragraphs' vectors.  So the order
of paragraphs does not matter, and paragraphs are inserted or deleted by adding
or subtracting their vectors.  A vector has two parts:

* 16 identity lanes of 32 bits, the SHA-512 of the paragraph, summed modulo
  2^32: multisets of paragraphs are equal when these are (up to collisions);
* 128 likeness lanes and one count, modulo 2^32: the paragraph is cut into
  phrases after words that end in a set of characters (so a cut depends on the
  text around it only), each phrase adds the 128 bits of its hash to the lanes
  and 1 to the count.  ``2 x lane - count`` is then a sum of random signs, and
  the cosine of two such vectors estimates the cosine of the phrase multisets.

Sums are grouped by document; phrases of one document never leave the task
that reads it, and partial sums have a fixed width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut_lineage, text_of

#: 64-bit hashes of a phrase (64 likeness lanes each) and identity lanes.
HASHES, IDENTITY = 2, 16
_PAIR = 0x0000000100000001          # two 32-bit lanes in one long
#: A phrase ends before white space that follows one of these characters.
PHRASE_END = r"(?<=[eEaAoOtT.,;:!?*&%$#|])[\x20\x09-\x0D]+"


def _sums(weight: Column) -> list[Column]:
    """Aggregates over the rows of ``_phrases`` that ``weight`` picks."""
    one = F.when(weight, 1).otherwise(0).cast("long")
    first = F.when(weight & (F.col("at") == 0), 1).otherwise(0).cast("long")
    out = [F.sum(F.col(f"d{i}") * first) for i in range(IDENTITY)]
    for k in range(HASHES):
        out += [F.sum(F.shiftrightunsigned(F.col(f"h{k}"), i).bitwiseAND(F.lit(_PAIR)) * one) for i in range(32)]
    return [*out, F.sum(one)]


def _fingerprint(parts: Column) -> Column:
    """The sums as hexadecimal text: identity lanes, count, likeness lanes (two a long)."""
    word = lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")             # noqa: E731
    n = HASHES * 32
    return F.lower(F.concat(
        F.array_join(F.transform(F.slice(parts, 1, IDENTITY), word), ""), word(F.element_at(parts, -1)),
        F.array_join(F.transform(F.slice(parts, IDENTITY + 1, n), word), ""),
        F.array_join(F.transform(F.slice(parts, IDENTITY + 1, n), lambda x: word(F.shiftrightunsigned(x, 32))), "")))


def _signs(parts: Column) -> Column:
    count, lanes = F.element_at(parts, -1), F.slice(parts, IDENTITY + 1, HASHES * 32)
    sign = lambda x: (2 * x - count).cast("double")                                     # noqa: E731
    return F.concat(F.transform(lanes, lambda x: sign(x.bitwiseAND(F.lit(0xFFFFFFFF)))),
                    F.transform(lanes, lambda x: sign(F.shiftrightunsigned(x, 32))))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two arrays of sums: 1 for equal fingerprints, else the cosine of their signs, 0 at least."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    x, y = _signs(a), _signs(b)
    norm = F.sqrt(dot(x, x) * dot(y, y))
    return F.when(a == b, 1.0).when(norm == 0, 0.0).otherwise(F.least(F.greatest(dot(x, y) / norm, F.lit(0.0)), F.lit(1.0)))


def _phrases(df: DataFrame, parts: Column, keep: list[str]) -> DataFrame:
    """A row for each phrase of each paragraph of the texts in the array ``parts``: its hashes, its paragraph's
    digest lanes, its place in the paragraph (``at``) and which text it is from (``side``; -1 for an empty
    paragraph, which has no vector but keeps its document in the result)."""
    rows = df.select(*keep, F.posexplode(parts).alias("side", "body"))
    rows = rows.select(*keep, "side", F.explode(F.split("body", "\n")).alias("paragraph"))
    # digests before phrases: what stands beside a generator is computed for each of its rows
    rows = rows.select(*keep, F.when(F.col("paragraph") == "", -1).otherwise(F.col("side")).alias("side"), "paragraph",
                       F.sha2("paragraph", 512).alias("digest"))
    rows = rows.select(*keep, "side", "digest", F.posexplode(F.split("paragraph", PHRASE_END)).alias("at", "phrase"))
    lanes = [F.when(F.col("at") == 0, F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long")).otherwise(0)
             .alias(f"d{i}") for i in range(IDENTITY)]
    return rows.select(*keep, "side", "at", *lanes, *[F.xxhash64(F.lit(k), "phrase").alias(f"h{k}") for k in range(HASHES)])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, sums, fingerprint for each key of ``df``; the sums add and subtract (modulo 2^32 a lane).

    Null and empty texts have the zero vector.  Rows that share a key are one document, the sum of their texts.
    """
    sums = _phrases(df, F.array(text_of(text)), [key]).groupBy(key).agg(F.array(*_sums(F.col("side") >= 0)).alias("sums"))
    return sums.withColumn("fingerprint", _fingerprint(F.col("sums")))


def _next_in_order(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """rk, id, n_chars, next_rk: each distinct (id, text) with the next one by id, the first after the last.

    Rows are dealt into ranges of the order; ``lead`` runs inside a range and the driver passes on the first key
    of each range to the range before it, so it holds one key for each partition.
    """
    spark = df.sparkSession
    rows = df.select(_row_key(id_col, text).alias("rk"), F.col(id_col).alias("id"),
                     F.length(text_of(text)).alias("n_chars")).distinct()
    order = [F.col("id").asc_nulls_last(), F.col("rk").asc()]
    rows = cut_lineage(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "order")
    heads = sorted((r["range"], r["head"]["rk"]) for r in rows.groupBy("range").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rk")).alias("head")).collect())
    after = [(part, heads[(i + 1) % len(heads)][1]) for i, (part, _) in enumerate(heads)]
    heads = F.broadcast(spark.createDataFrame(after, "range int, head string"))        # one row a partition
    lead = F.lead("rk").over(W.partitionBy("range").orderBy(*order))
    return (rows.withColumn("lead", lead).join(heads, "range")
            .select("rk", "id", "n_chars", F.coalesce("lead", "head").alias("next_rk")))


def _row_key(id_col: str, text: str) -> Column:
    return F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.hex(F.xxhash64(text_of(text))))


def compare_with_edit(df: DataFrame, id_col: str = "doc_id", text: str = "text", share: int = 4) -> DataFrame:
    """Fingerprint every text and its edited text, and how alike they and the next document's are.

    The edited text has the last ``floor(n_chars / share)`` code points replaced by the first as many (or all) of
    the next document by ascending id (after the last: the first; a sole document is its own next).  Its
    fingerprint is made incrementally: whole paragraphs before the cut keep their sums, those from the cut on are
    subtracted and the new ones added.

    * Result: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    * Null texts count as empty; null ids come last.  Rows alike in id and text are one document and give one row;
      rows with the same id and other texts are documents of their own, ordered by a hash of the text.
    * Other columns are ignored; an empty table gives an empty result.
    """
    order = cut_lineage(_next_in_order(df, id_col, text), "next")
    docs = df.select(_row_key(id_col, text).alias("rk"), text_of(text).alias("body"))
    docs = (docs.withColumn("copy", F.row_number().over(W.partitionBy("rk").orderBy("rk"))).filter("copy = 1")
            .drop("copy"))
    # the beginning of each document, as long as the document before it needs, sent to that document
    need = order.select(F.col("next_rk").alias("rk"), F.col("rk").alias("to"),
                        F.floor(F.col("n_chars") / share).cast("int").alias("cut"))
    heads = docs.join(need, "rk").select(F.col("to").alias("rk"), "cut", F.expr("left(body, cut)").alias("head"))
    both = docs.join(heads, "rk")
    keep = F.expr("left(body, char_length(body) - cut)")
    both = both.select("rk", "body", keep.alias("stem"), "head")
    # text = before + gone, edited = before + come: "before" are the whole paragraphs ahead of the cut
    both = both.withColumn("whole", F.length("stem") - F.coalesce(
        F.length(F.substring_index("stem", "\n", -1)), F.lit(0)))
    edited = F.concat("stem", "head")
    both = both.select("rk", F.sha2(edited, 256).alias("edited_sha256"), F.array(
        F.expr("left(body, whole)"), F.expr("substr(body, whole + 1)"),
        F.expr("concat(substr(stem, whole + 1), head)")).alias("parts"))
    # both joins and the sums are by rk: one shuffle of the texts serves them all
    rows = _phrases(both, F.col("parts"), ["rk", "edited_sha256"])
    side = F.col("side")
    sums = cut_lineage(rows.groupBy("rk", "edited_sha256").agg(
        F.array(*_sums((side == 0) | (side == 1))).alias("sums"),
        F.array(*_sums((side == 0) | (side == 2))).alias("edited_sums")), "fingerprints")
    nexts = sums.select(F.col("rk").alias("next_rk"), F.col("sums").alias("next_sums"))
    return order.join(sums, "rk").join(nexts, "next_rk").select(
        F.col("id").alias(id_col), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        _fingerprint(F.col("sums")).alias("fingerprint"), _fingerprint(F.col("edited_sums")).alias("edited_fingerprint"),
        likeness(F.col("sums"), F.col("edited_sums")).alias("near_edited"),
        likeness(F.col("sums"), F.col("next_sums")).alias("near_next"))
