"""Exact dedup as a stateful stream: keyed state without expiry, full bytes checked on hits.

A structured stream reads the table's files and aggregates by the SHA-256 of
the normalised text.  Its state lives in RocksDB on the executors' disks,
backed by the checkpoint folder, has no watermark and so never expires, and
keeps for each digest the stable identifier (smallest id) and the content
locator (file and row) of the row that stays, and the number of rows seen.
Each run of the stream takes what files are new, so a later run adds to the
same state.  The state is then read as a table (``statestore`` source) and
joined to the rows.  Rows that hit an entry of another row are fetched by
locator and compared byte for byte, grouped by (digest, text): two texts under
one digest would form two groups and each is kept apart.

Every aggregate combines on the map side, so a text that makes up a third of
all rows reaches a reducer as one partial row a task; the one join on the
digest has single rows on the state's side, and Spark splits its skewed
partitions.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, cut_lineage, scratch_path, text_of

_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",   # else each partition reserves megabytes
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


@contextmanager
def _conf(spark: SparkSession, values: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: str | Column) -> Column:
    """The text with each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(text_of(text), SPACE, " ")


def _locator() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]


def _glob(path: str) -> str:
    """The path as a glob that matches only itself: a stream may then start at a file as well as at a folder."""
    return f"{path[:-1]}[{path[-1]}]"


def update_state(spark: SparkSession, path: str, checkpoint: str, id_col: str = "doc_id", text_col: str = "text",
                 max_bytes_per_trigger: int = 256 << 30) -> DataFrame:
    """Run the stream over the files of ``path`` not yet taken, and return its state: digest, first, n.

    ``first`` is (id_missing, id, file, row) of the row that stays: the smallest id, a null id after all others,
    then by file and row.
    """
    schema = spark.read.parquet(path).schema
    with _conf(spark, _ROCKSDB):
        rows = (spark.readStream.schema(schema).option("maxBytesPerTrigger", str(max_bytes_per_trigger))
                .parquet(_glob(path)))
        rows = rows.select(F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"),
                           F.struct(F.col(id_col).isNull().alias("id_missing"), F.col(id_col).alias("id"),
                                    *_locator()).alias("at"))
        state = rows.groupBy("digest").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        run = (state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
        run.awaitTermination()
        return (spark.read.format("statestore").load(checkpoint)
                .select(F.col("key.digest").alias("digest"), "value.*").toDF("digest", "first", "n"))


def streaming_exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                          checkpoint: str | None = None, max_bytes_per_trigger: int = 256 << 30) -> DataFrame:
    """One row for each row of the Parquet table at ``path``: id, keep_id, group_size, kept, text_sha256.

    * Texts are equal when identical after each run of ASCII white space is replaced by one space; a null text
      counts as empty.  Of equal texts the row with the smallest id stays; null ids come after all others, and of
      rows with the same id (repeated rows) the first by file and row stays, so exactly one row of a group has
      ``kept``.
    * Rows are known by their locator, so ids may repeat or be null.  Other columns, whatever their names, are
      never read.  An empty table gives an empty result.
    * ``checkpoint`` keeps the state between runs; by default each call starts a new one in the shared folder.
    """
    state_at = checkpoint or scratch_path(spark, "dedup-state")
    state = cut_lineage(update_state(spark, path, state_at, id_col, text_col, max_bytes_per_trigger), "dedup-index")
    table = spark.read.parquet(path)
    rows = cut_lineage(table.select(F.col(id_col).alias("id"), F.unhex(F.sha2(normalised(text_col), 256))
                                    .alias("digest"), *_locator()), "dedup-rows")
    found = rows.join(state.select("digest", "first", "n"), "digest")

    # full bytes on hits: the rows whose digest another row has too, fetched by locator
    hits = found.filter(F.col("n") > 1).select("file", "row", "digest")
    texts = (table.select(*_locator(), F.col(id_col).alias("id"), normalised(text_col).alias("content"))
             .join(hits, ["file", "row"]))
    contents = cut_lineage(
        texts.groupBy("digest", "content").agg(
            F.min(F.struct(F.col("id").isNull().alias("id_missing"), "id", "file", "row")).alias("first"),
            F.count(F.lit(1)).alias("n"))
        .withColumn("part", F.sha2(F.concat(F.lit("\x01"), "content"), 512)).drop("content"), "dedup-hits")
    clashes = contents.groupBy("digest").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("digest")
    if clashes.isEmpty():
        return _result(found, id_col)
    # two texts under one digest: their rows are told apart by the text itself
    apart = contents.join(clashes, "digest", "left_semi")
    clear = found.join(clashes, "digest", "left_anti")
    split = (texts.join(clashes, "digest", "left_semi")
             .select("id", "file", "row", "digest", F.sha2(F.concat(F.lit("\x01"), "content"), 512).alias("part"))
             .join(apart, ["digest", "part"]))
    return _result(clear.select("id", "file", "row", "digest", "first", "n").unionByName(
        split.select("id", "file", "row", "digest", "first", "n")), id_col)


def _result(found: DataFrame, id_col: str) -> DataFrame:
    mine = (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))
    return found.select(F.col("id").alias(id_col), F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
                        mine.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
