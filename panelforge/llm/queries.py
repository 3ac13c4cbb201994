"""The queries ``opN_<name>`` of the training-data operators and their DuckDB SQL.

Each applies its operator with production parameters to its whole table and
derives the columns of the result from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import bpe, conversations, exact_dedup, fingerprints, langid, licenses, line_dedup, minhash, mixing, quality, sharding, suffix_dedup, whitening
from .common import documents, text_of


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edit(documents(spark, sf_dir).select("doc_id", "text"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_common_lines(documents(spark, sf_dir).select("doc_id", "text"), long_lines=True)
    return out.select("doc_id", "n_lines", "n_removed", F.length(text_of("text")).cast("long").alias("kept_chars"),
                      F.sha2(text_of("text"), 256).alias("kept_sha256"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def op5_shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_of("text")
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.concat(F.md5(text), F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 16))
        .alias("key"))
    out = sharding.shard_by_bytes(rows, "key", "size", shards=16, group_chars=32)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.filter(~langid.held_out()))
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), width=2, percent=80)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = bpe.round_trip(docs, vocabulary, public_tokenizers.PATTERN)
    listed = F.concat_ws(" ", F.col("token_ids").cast("array<string>"))
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def file_paths(docs: DataFrame) -> DataFrame:
    """``documents`` as files: a path from source and id alone.  Ids divisible by 1000, 100 and 10 are files named
    LICENSE at the three levels of directories; the operator decides by their texts whether they hold a licence."""
    n = F.col("doc_id")
    level = F.when(n % 1000 == 0, F.array()).when(n % 100 == 0, F.array(F.expr("concat('p', doc_id div 100)"))).otherwise(
        F.array(F.expr("concat('p', doc_id div 100)"), F.expr("concat('m', doc_id div 10 % 10)")))
    name = F.when(n % 10 == 0, "LICENSE").otherwise(F.concat(F.lit("d"), n.cast("string"), F.lit(".txt")))
    return docs.select("doc_id", F.array_join(F.concat(F.array(F.coalesce("source", F.lit("none"))), level,
                                                       F.array(name)), "/").alias("path"), "text")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(file_paths(documents(spark, sf_dir)))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.streaming_exact_dedup(spark, f"{sf_dir}/documents.parquet")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = quality.fit(docs, labels.filter(~quality.held_out()))
    out = quality.score(docs, weights)
    return out.select("doc_id", quality.held_out().alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(conversations.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_fingerprints": op2_fingerprints,
    "op3_line_dedup": op3_line_dedup,
    "op4_mix_sources": op4_mix_sources,
    "op5_shard_by_bytes": op5_shard_by_bytes,
    "op6_language_id": op6_language_id,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_bpe": op8_bpe,
    "op9_license_scan": op9_license_scan,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL = {
    "op4_mix_sources": r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         ('0x' || substr(md5(concat_ws(chr(31), doc_id::varchar, text)), 1, 15))::bigint as h
  from documents),
s as (
  select source, sum(size)::bigint as n,
         case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w
  from d group by source),
f as (  -- capped sources are the first ones by size over weight
  select *, (sum(n) over ())::bigint
            - 3 * coalesce(sum(n) over (order by n::double / w, source nulls last
                                        rows between unbounded preceding and 1 preceding), 0) as rest,
         sum(w) over (order by n::double / w, source nulls last
                      rows between current row and unbounded following) as rest_w
  from s),
c as (select *, rest * w > 3 * n * rest_w as capped from f),
t as (
  select source, n, case when capped then (3 * n)::double
    else (((sum(n) over ())::bigint - sum(case when capped then 3 * n else 0 end) over ()) * w)::double
         / (sum(case when capped then 0 else w end) over ())::double end as target
  from c),
p as (select *, case when n = 0 then 0 else floor(target / n)::int end as whole,
             target - (case when n = 0 then 0 else floor(target / n)::int end) * n as budget from t),
r as (
  select source, h, sum(size)::bigint as n from d group by source, h),
u as (
  select r.source, r.h, r.n, p.budget,
         (sum(r.n) over (partition by r.source order by r.h))::bigint as upto
  from r join p on r.source is not distinct from p.source),
x as (
  select source, arg_min(struct_pack(h := h, n := n, below := upto - n, budget := budget), h) as b
  from u where upto > budget group by source),
e as (
  select source, case when b.budget <= 0 then -1
                      when b.below + b.n - b.budget < b.budget - b.below then b.h else b.h - 1 end as threshold
  from x)
select d.doc_id, d.size::bigint as size, p.n as source_size, p.target,
       (d.size * (p.whole + case when d.h <= coalesce(e.threshold, -1) then 1 else 0 end))::bigint as taken
from d join p on d.source is not distinct from p.source
left join e on d.source is not distinct from e.source
""",
    "op10_exact_dedup": r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as x from documents)
select doc_id, min(doc_id) over (partition by x) as keep_id, count(*) over (partition by x) as group_size,
       doc_id = min(doc_id) over (partition by x) as kept, sha256(x) as text_sha256
from t
""",
}
