"""Shared pieces of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..session import scratch_path

__all__ = ["WORD", "cut_lineage", "scratch_path", "documents", "text_of", "slices", "spare_name"]

#: A word: a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


#: Shuffle files of a finished write are deleted at once; the written table takes their place.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, read it back and let go of the shuffles that made it."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN_UP, "false")
    conf.set(_CLEAN_UP, "true")
    try:
        return session.cut_lineage(df, name)
    finally:
        conf.set(_CLEAN_UP, before)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(col: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def spare_name(df: DataFrame, stem: str) -> str:
    """``stem``, with underscores put before it until no column of ``df`` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one slice holds at most ``max_bytes`` of text, or a single row.

    Bounds what vectorised code allocates for each slice, whatever the Arrow batch size is.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(sizes):
            yield batch.slice(start)
