"""SparkSession helpers: one place for configuration and the checkpoint dir."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "panelforge") -> SparkSession:
    """Return the active session or build a local one sized for tests/bench.

    On a cluster the session already exists (spark-submit) and this returns
    it untouched; the local settings below are only used when none exists.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to a shared file system and it is only
    read here; when it is unset there, this raises, because a machine-local
    folder would leave every executor's output on its own disk.  In a
    single-JVM ``local[..]`` session (tests), driver and tasks share one file
    system, so an unset value is set to a scratch folder.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="panelforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one written table under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared checkpoint dir and read it back.

    One job (``Dataset.checkpoint`` would compute its input twice unless
    cached), the files survive executor loss, and later scans of the wide
    table prune columns and push filters, which an RDD checkpoint cannot.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table of ``cut_lineage`` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
