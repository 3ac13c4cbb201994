"""Projection products (family N, documented behaviour): fantasy points,
intervals, rankings, summaries, backtests and per-group models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import spec as S
from ..session import cut_lineage
from ..spec import DEFAULT_SPEC, PanelSpec
from . import trees as TR
from .models import global_index

COUNTING = ("PTS", "AST", "REB", "BLK", "STL", "TOV", "MIN", "FG3M", "FGA", "FTA")


def fantasy_points(df: DataFrame, weights: Mapping[str, float] | None = None, prefix: str = "",
                   out: str = "FANTASY_POINTS") -> DataFrame:
    """Weighted sum of (projected) stats; FGM = FGA*FG_PCT and FTM = FTA*FT_PCT when not present."""
    w = dict(weights or S.FANTASY_WEIGHTS)
    c = lambda s: F.col(f"{prefix}{s}")
    cols = set(df.columns)
    fgm = c("FGM") if f"{prefix}FGM" in cols else c("FGA") * c("FG_PCT")
    ftm = c("FTM") if f"{prefix}FTM" in cols else c("FTA") * c("FT_PCT")
    terms = {"FGM": fgm, "FT_MISSED": c("FTA") - ftm}
    total = None
    for stat, wt in w.items():
        term = (terms[stat] if stat in terms else c(stat)) * F.lit(wt)
        total = term if total is None else total + term
    return df.withColumn(out, total)


def residual_std(pred: DataFrame) -> DataFrame:
    """Sample std of validation residuals per (model, target)."""
    ok = pred.where(F.col("prediction").isNotNull() & F.col("actual").isNotNull())
    return ok.groupBy("model", "target").agg(F.stddev_samp(F.col("actual") - F.col("prediction")).alias("resid_std"))


def prediction_interval(pred: DataFrame, resid: DataFrame, z: float = 1.96,
                        counting: Sequence[str] = COUNTING) -> DataFrame:
    """prediction +/- z * residual std; the low end of counting stats is clipped at 0."""
    r = F.broadcast(resid.select("model", "target", "resid_std"))   # models x targets rows
    j = pred.join(r, ["model", "target"], "left")
    half = F.lit(z) * F.col("resid_std")
    low = F.col("prediction") - half
    is_count = F.col("target").isin(*[f"NEXT_{s}" for s in counting])
    low = F.when(is_count & (low < 0), F.lit(0.0)).otherwise(low)
    return j.select(*[c for c in pred.columns], low.alias("low"), (F.col("prediction") + half).alias("high"))


def rank_projections(df: DataFrame, score: str = "FANTASY_POINTS", k: int | None = 100,
                     tie: Sequence[str] = ("PLAYER_ID",)) -> DataFrame:
    """Rank by score (desc, ties by key); keep the top ``k`` (a top-k report), or rank all rows (``None``)."""
    ordered = [F.col(score).desc_nulls_last(), *[F.col(t).asc() for t in tie]]
    if k is None:
        # full ranking: places in a range-partitioned sort, no single-task window
        ranked, _ = global_index(df, ordered, "RANK")
        return ranked.withColumn("RANK", (F.col("RANK") + 1).cast("int"))
    top = df.orderBy(*ordered).limit(k)        # TakeOrderedAndProject: per-task top-k, then merge
    return top.withColumn("RANK", F.row_number().over(Window.orderBy(*ordered)))


def projection_summary(df: DataFrame, stats: Sequence[str]) -> DataFrame:
    """League-wide averages of the projected stats and the number of projected rows."""
    return df.agg(F.count(F.lit(1)).alias("n_projected"), *[F.avg(s).alias(f"avg_{s}") for s in stats])


def projection_board(df: DataFrame, stats: Sequence[str], k: int = 10, score: str = "FANTASY_POINTS",
                     entity: str = "PLAYER_ID", name: str = "PLAYER_NAME") -> DataFrame:
    """The summary report in long form: the best ``k`` rows by ``score`` and the league's averages.

    Rows ``board`` carry place, entity, name and one statistic (the score included); rows ``league`` carry the mean of
    a statistic over all projected rows, and ``n_projected``.  Equal scores are placed by entity.
    """
    report = ["section", "rank", entity, name, "stat", "value"]

    def long(values: dict) -> Column:
        return F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), v.cast("double").alias("value"))
                                   for s, v in values.items()])).alias("__e")

    top = rank_projections(df, score, k, (entity,))
    board = top.select(F.lit("board").alias("section"), F.col("RANK").cast("int").alias("rank"), entity, name,
                       long({s: F.col(s) for s in (*stats, score)})).select("*", "__e.*")
    league = df.agg(F.count(F.lit(1)).alias("n_projected"), *[F.avg(s).alias(s) for s in (*stats, score)])
    league = league.select(F.lit("league").alias("section"), F.lit(None).cast("int").alias("rank"),
                           F.lit(None).cast(df.schema[entity].dataType).alias(entity),
                           F.lit(None).cast(df.schema[name].dataType).alias(name),
                           long({s: F.col(s) for s in ("n_projected", *stats, score)})).select("*", "__e.*")
    return board.select(*report).unionByName(league.select(*report))


def backtest_accuracy(proj: DataFrame, actual: DataFrame, stats: Sequence[str], entity: str = "PLAYER_ID") -> DataFrame:
    """Projections inner-joined to realised stats on entity: MAE, bias (pred - actual), MAPE per stat."""
    p = proj.select(entity, *[F.col(s).alias(f"p_{s}") for s in stats])
    a = actual.select(entity, *[F.col(s).alias(f"a_{s}") for s in stats])
    j = p.join(a, entity)
    items = [F.struct(F.lit(s).alias("stat"), F.col(f"p_{s}").cast("double").alias("p"),
                      F.col(f"a_{s}").cast("double").alias("a")) for s in stats]
    long = j.select(F.explode(F.array(*items)).alias("e")).select("e.*").where(
        F.col("p").isNotNull() & F.col("a").isNotNull())
    e = F.col("p") - F.col("a")
    return long.groupBy("stat").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("MAE"), F.avg(e).alias("bias"),
        (F.avg(F.abs(F.try_divide(e, F.nullif(F.col("a"), F.lit(0.0))))) * 100).alias("MAPE"))


def position_from_height(df: DataFrame, guard_max: float = 76.0, forward_max: float = 80.0,
                         position: str = "POSITION", height: str = "HEIGHT_INCHES") -> DataFrame:
    """Missing position inferred from height (cut-points are parameters; none are documented)."""
    h = F.col(height)
    guess = F.when(h <= guard_max, F.lit("Guard")).when(h <= forward_max, F.lit("Forward")).when(
        h.isNotNull(), F.lit("Center"))
    return df.withColumn(position, F.coalesce(F.col(position), guess))


def position_group(position: str = "POSITION"):
    """Guard / Wing / Big from the position text (C -> Big, else F -> Wing, else G -> Guard)."""
    p = F.col(position)
    return (F.when(p.contains("C"), F.lit("Big")).when(p.contains("F"), F.lit("Wing"))
            .when(p.contains("G"), F.lit("Guard")))


def position_group_models(train: DataFrame, score: DataFrame, fit, label: str, spec: PanelSpec = DEFAULT_SPEC,
                          groups: Sequence[str] = ("Guard", "Wing", "Big"), position: str = "POSITION",
                          name: str = "Position_Model") -> DataFrame:
    """One model per position group (``fit(df) -> model``); scored rows of all groups unioned.

    Rows without a position, or of a group without training rows, are scored by a model fitted on all rows.
    """
    g = F.coalesce(position_group(position), F.lit(""))
    seen = {r[0] for r in train.select(g.alias("g")).distinct().collect()} & set(groups)     # a few groups
    out = None
    for grp in [*(x for x in groups if x in seen), None]:
        tr = train.where(g == grp) if grp else train
        sc = score.where(g == grp) if grp else score.where(~g.isin(*sorted(seen)) if seen else F.lit(True))
        m = fit(tr)
        p = m.transform(sc).select(*spec.keys, F.lit(label).alias("target"), F.lit(name).alias("model"),
                                   F.col("prediction").cast("double").alias("prediction"),
                                   F.col(label).cast("double").alias("actual"))
        out = p if out is None else out.unionByName(p)
    return out


def position_group_trees(train: DataFrame, score: DataFrame, data: TR.Binned, chosen: dict, spec: PanelSpec = DEFAULT_SPEC,
                         groups: Sequence[str] = ("Guard", "Wing", "Big"), position: str = "POSITION",
                         name: str = "Position_Model") -> DataFrame:
    """Boosted trees of every (target, position group) in one job; scored rows of all groups and targets.

    ``data`` has the edges of the features and ``chosen`` the point of each target.  Rows without a position, or of a
    group without training rows, are scored by the target's trees of all rows.
    """
    of = F.lit(len(groups))
    for i, g in enumerate(groups):
        of = F.when(position_group(position) == g, i).otherwise(of)
    of = of.cast("int")
    rows = TR.bin_rows(train.withColumn("group", of), data.features, data.edges, [*spec.keys, "group", *data.targets])
    grouped = TR.Binned(cut_lineage(rows, "binned-groups"), data.features, data.targets, data.edges, "group", data.keys,
                        data.fit_rows)
    models = TR.refit(grouped, "boosted", chosen, folds=True, within=True)
    models.fits = {(t, g): fit for (t, g), fit in models.fits.items() if g != len(groups)}
    return models.out_of_fold(score.withColumn("group", of), name, "group", spec).drop("group")
