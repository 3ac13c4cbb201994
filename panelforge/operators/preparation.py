"""Split, impute, scale (family I) without leakage.

``FillValues`` and ``StandardScale`` are estimators: ``fit`` runs one or a
few aggregates on the TRAINING rows only and keeps a small per-column
parameter table (bounded by the number of features, like MLlib's fitted
vectors); ``transform`` is a pure column expression, so the same fitted
object scores batch or streaming input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cols_if_present, replace_inf
from ..functions.sqltext import agg_row, lit_double, q
from ..session import cut_lineage
from .cleaning import NUMERIC, coerce_numeric
from .quantiles import column_moments, exact_quantiles


def temporal_split(df: DataFrame, train_periods: Sequence[str], val_period: str, period: str = "SEASON",
                   first_target: str | None = None) -> dict[str, DataFrame]:
    """train = configured periods, val = one later period (rows with a target); pred = rows without one."""
    has_t = F.col(first_target).isNotNull() if first_target else F.lit(True)
    out = {"train": df.where(has_t & F.col(period).isin(*train_periods)),
           "val": df.where(has_t & (F.col(period) == val_period))}
    if first_target:
        out["pred"] = df.where(F.col(first_target).isNull())
    return out


def split_label(df: DataFrame, train_periods: Sequence[str], val_period: str, period: str = "SEASON",
                first_target: str = "NEXT_PTS") -> DataFrame:
    """The same split as a column (``train``/``val``/``pred``/null) for one-pass use."""
    t = F.col(first_target)
    lab = (F.when(t.isNull(), F.lit("pred"))
           .when(F.col(period).isin(*train_periods), F.lit("train"))
           .when(F.col(period) == val_period, F.lit("val")))
    return df.withColumn("split", lab)


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC + (T.BooleanType,))


def null_counts(df: DataFrame, cols: Sequence[str], split: str | None = None
                ) -> tuple[dict[str | None, dict[str, int]], dict[str | None, int]]:
    """Missing values (null; of numbers NaN, too) of each column, and rows, by the value of ``split`` (null: no row),
    in one pass over the columns' validity."""
    # numbers go out as they are: a test of each in Spark is a projection too wide to be compiled well
    num = {c for c in cols if _is_numeric(df, c)}
    parts = [F.col(split).alias("split") if split else F.lit(None).cast("string").alias("split")]
    cells = df.select(*parts, *[(F.col(q(c)) if c in num else F.when(F.col(q(c)).isNotNull(), True)).alias(f"c{i}")
                                for i, c in enumerate(cols)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str | None, np.ndarray] = {}
        for b in batches:
            labels = np.array(b.column(0).to_pylist(), dtype=object)
            m = np.column_stack([np.ones(len(b), bool), *(
                pc.is_null(x, nan_is_null=pa.types.is_floating(x.type)).to_numpy(zero_copy_only=False) for x in b.columns[1:])])
            for name in set(labels.tolist()):
                total[name] = total.get(name, 0) + m[labels == name].sum(0)
        for name, counts in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(counts), pa.string()), pa.array(np.arange(len(counts), dtype=np.int32)),
                 pa.array(counts.astype(np.int64))], names=["split", "col", "n"])

    names = [None] if split is None else []
    nulls: dict[str | None, dict[str, int]] = {k: dict.fromkeys(cols, 0) for k in names}
    rows: dict[str | None, int] = dict.fromkeys(names, 0)
    got = cells.mapInArrow(run, "split string, col int, n long").groupBy("split", "col").agg(F.sum("n").alias("n")).collect()
    for r in got:                                                           # splits x columns numbers
        if r["col"] == 0:
            rows[r["split"]] = r["n"]
        else:
            nulls.setdefault(r["split"], dict.fromkeys(cols, 0))[cols[r["col"] - 1]] = r["n"]
    for k in rows:
        nulls.setdefault(k, dict.fromkeys(cols, 0))
    return nulls, rows


@dataclass
class FillValues:
    """Per feature with a null in train: median (numeric) or mode (text, smallest on ties)."""

    values: dict[str, object] = field(default_factory=dict)

    @classmethod
    def fit(cls, train: DataFrame, cols: Sequence[str], nulls: dict[str, int] | None = None) -> "FillValues":
        """``nulls``: the missing values of each column, where they are known already."""
        cols = cols_if_present(train, cols)
        if nulls is None:
            nulls = null_counts(train, cols)[0][None]
        with_null = [c for c in cols if nulls[c] > 0]
        num = [c for c in with_null if _is_numeric(train, c)]
        text = [c for c in with_null if c not in set(num)]
        values: dict[str, object] = {c: v for (c, _), v in exact_quantiles(train, [(c, 0.5) for c in num]).items()}
        values |= dict.fromkeys(text, 0)
        if text:        # one aggregate of (column, value, count) for the modes of all text columns
            long = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                                    for c in text])).alias("e")).select("e.*")
            counts = long.where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
            modes = counts.groupBy("c").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("m"))
            values |= {r["c"]: r["m"] for r in modes.collect()}             # a row a column
        return cls({c: values[c] for c in with_null})

    def table(self, spark: SparkSession) -> DataFrame:
        """feature, fill_value (numeric features), fill_text (text features)."""
        number = lambda v: isinstance(v, (int, float))
        rows = [(k, float(v) if number(v) else None, None if v is None or number(v) else str(v))
                for k, v in self.values.items()]
        return spark.createDataFrame(rows, "feature string, fill_value double, fill_text string")

    def transform(self, df: DataFrame) -> DataFrame:
        def fill(c):
            v = self.values.get(c)
            if c not in self.values or v is None:
                return q(c)
            if isinstance(v, (int, float)) and _is_numeric(df, c):
                return f"coalesce(CAST({q(c)} AS DOUBLE), {lit_double(v)}) AS {q(c)}"
            text = str(v).replace("'", "''")
            return f"coalesce({q(c)}, '{text}') AS {q(c)}"
        return df.selectExpr(*[fill(c) for c in df.columns])


def remaining_nulls(df: DataFrame, cols: Sequence[str]) -> int:
    if not cols:
        return 0
    return agg_row(df, ["count_if(" + " OR ".join(f"{q(c)} IS NULL" for c in cols) + ") AS n"])["n"]


def apply_fill_values(fv: FillValues, splits: dict[str, DataFrame], cols: Sequence[str]) -> dict[str, DataFrame]:
    """Fill every split with train values; if train or val still has a null, fill 0 everywhere."""
    out = {k: fv.transform(v) for k, v in splits.items()}
    cols = cols_if_present(out["train"], cols)
    if remaining_nulls(out["train"], cols) > 0 or ("val" in out and remaining_nulls(out["val"], cols) > 0):
        out = {k: v.fillna(0, subset=cols) for k, v in out.items()}
    return out


@dataclass
class StandardScale:
    """(x - mean) / population std fitted on train; zero std -> scale 1 (so a constant train column -> 0)."""

    mean: dict[str, float] = field(default_factory=dict)
    std: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fit(cls, train: DataFrame, cols: Sequence[str]) -> "StandardScale":
        cols = cols_if_present(train, cols)
        n, mean, std = column_moments(train, cols, absolute=False)
        return cls({c: m if k else None for c, m, k in zip(cols, mean, n, strict=True)},
                   {c: v if k else None for c, v, k in zip(cols, std, n, strict=True)})

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(c, self.mean[c], self.std[c]) for c in self.mean],
                                     "feature string, mean double, std double")

    def transform(self, df: DataFrame) -> DataFrame:
        def sc(c):
            if c not in self.mean:
                return q(c)
            m = self.mean[c] if self.mean[c] is not None else 0.0
            s = self.std[c] if self.std[c] not in (None, 0.0) else 1.0
            return f"(CAST({q(c)} AS DOUBLE) - {lit_double(m)}) / {lit_double(s)} AS {q(c)}"
        return df.selectExpr(*[sc(c) for c in df.columns])


def scaling_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean of column means and mean of column (sample) stds after scaling."""
    cols = cols_if_present(df, cols)
    r = df.agg(*[x for i, c in enumerate(cols) for x in (F.avg(c).alias(f"a{i}"), F.stddev_samp(c).alias(f"s{i}"))])
    items = [F.struct(F.col(f"a{i}").alias("m"), F.col(f"s{i}").alias("s")) for i in range(len(cols))]
    return r.select(F.explode(F.array(*items)).alias("e")).agg(
        F.avg("e.m").alias("mean_of_means"), F.avg("e.s").alias("mean_of_stds"))


def feature_columns(df: DataFrame, targets: Sequence[str], metadata: Sequence[str]) -> list[str]:
    """Numeric / boolean columns that are neither targets nor metadata."""
    ex = set(targets) | set(metadata)
    return [f.name for f in df.schema.fields if f.name not in ex
            and isinstance(f.dataType, NUMERIC + (T.BooleanType,))]


@dataclass
class Prepared:
    splits: dict[str, DataFrame]
    features: list[str]
    fill: FillValues
    scale: StandardScale


def prepare_training_data(df: DataFrame, train_periods: Sequence[str], val_period: str, targets: Sequence[str],
                          metadata: Sequence[str], features: Sequence[str] | None = None,
                          period: str = "SEASON") -> Prepared:
    """coerce draft text -> split -> fill (train stats) -> inf to 0 -> scale (train stats)."""
    df = coerce_numeric(df, [c for c in ("DRAFT_ROUND", "DRAFT_NUMBER") if c in df.columns and c not in metadata],
                        fill=0.0)
    feats = list(features) if features is not None else feature_columns(df, targets, metadata)
    # the feature matrix is all doubles (booleans and counts included); NaN is missing, as in pandas
    fset = set(feats)
    df = df.selectExpr(*[f"nanvl(CAST({q(c)} AS DOUBLE), CAST(NULL AS DOUBLE)) AS {q(c)}" if c in fset else q(c)
                         for c in df.columns])
    # written once with the split as a column: all fits read this table
    df = cut_lineage(split_label(df, train_periods, val_period, period, targets[0]).where(F.col("split").isNotNull()))
    nulls, rows = null_counts(df, feats, "split")
    none = dict.fromkeys(feats, 0)
    train = df.where(F.col("split") == "train")
    fv = FillValues.fit(train, feats, nulls.get("train", none))
    # train values fill every split; what is missing in train or validation after that makes the rest 0 everywhere
    open_ = [c for c in feats if fv.values.get(c) is None]
    rest = any(nulls.get(k, none)[c] for k in ("train", "val") for c in open_)

    def filled(c: str) -> str:
        value = fv.values.get(c)
        ends = [q(c), *([lit_double(float(value))] if value is not None else []), *(["0.0D"] if rest else [])]
        return f"coalesce({', '.join(ends)})" if len(ends) > 1 else ends[0]

    def finite(c: str) -> str:
        return f"CASE WHEN abs({filled(c)}) = CAST('Infinity' AS DOUBLE) THEN 0.0D ELSE {filled(c)} END"

    clean = df.selectExpr(*[f"{finite(c)} AS {q(c)}" if c in fset else q(c) for c in df.columns])
    sc = StandardScale.fit(clean.where(F.col("split") == "train").select(*[F.col(q(c)) for c in feats]), feats)
    scaled = sc.transform(clean)
    splits = {k: scaled.where(F.col("split") == k).drop("split") for k in ("train", "val", "pred")}
    return Prepared(splits, feats, fv, sc)
