"""Left joins with a side that is expected to be small, such as seasons, teams or groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: Size of a side, as JSON text, up to which every task gets a copy of it.
BROADCAST_BYTES = 32 << 20
_SALTS = 4096


def join_small(df: DataFrame, small: DataFrame, on: Sequence[str], max_bytes: int = BROADCAST_BYTES,
               derived: bool = False) -> DataFrame:
    """``df`` left join ``small`` on columns of the same names.

    ``small`` is measured first: up to ``max_bytes`` it is broadcast and ``df`` keeps its partitions.  Beyond it both
    sides are shuffled, where rows without a key, which match nothing, are spread by a hash of the row and not sent
    to one task.  ``derived=True`` writes ``small`` once before, so that what it is made from runs once.
    """
    if derived:
        small = cut_lineage(small, "small-side")
    size = small.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("n")).first()["n"] or 0
    if size <= max_bytes:
        return df.join(F.broadcast(small), list(on), "left")
    missing = F.lit(False)
    for c in on:
        missing = missing | F.col(c).isNull()
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salted = df.withColumn("__salt", F.when(missing, F.pmod(F.xxhash64(*hashed), F.lit(_SALTS)) + 1).otherwise(F.lit(0)))
    return salted.join(small.withColumn("__salt", F.lit(0).cast("long")), [*on, "__salt"], "left").drop("__salt")
