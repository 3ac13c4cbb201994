"""Score a stream of feature rows with fitted preparation and a fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import replace_inf
from ..operators.models import assemble
from ..operators.preparation import FillValues, StandardScale


def score_stream(stream: DataFrame, features: Sequence[str], fill: FillValues, scale: StandardScale, model,
                 keys: Sequence[str], target: str) -> DataFrame:
    """Fill (train values) -> inf to 0 -> scale (train statistics) -> assemble -> predict.

    Works on a streaming or a batch DataFrame: every step is a per-row
    expression fitted beforehand on the training split, so no state is kept
    between micro-batches.  Features still missing after the fill (a column
    that was all-null in training) are set to 0, as the batch preparation
    does.
    """
    df = stream.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) if c in features
                         else F.col(c) for c in stream.columns])
    df = fill.transform(df).fillna(0, subset=list(features))
    df = df.select(*[replace_inf(c).alias(c) if c in features and isinstance(df.schema[c].dataType, T.DoubleType)
                     else F.col(c) for c in df.columns])
    df = scale.transform(df)
    scored = model.transform(assemble(df, features))
    return scored.select(*keys, F.lit(target).alias("target"),
                         F.col("prediction").cast("double").alias("prediction"))
