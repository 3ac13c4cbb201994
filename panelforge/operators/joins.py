"""Joins (family C): all equi left joins on (entity, period) or entity.

Sides keyed by season, team or group go through :func:`bounded.join_small`.
Elsewhere join strategy is left to Catalyst + AQE: a side whose runtime size is under
``spark.sql.autoBroadcastJoinThreshold`` is broadcast, anything larger is a
sort-merge join, and AQE splits skewed partitions.  Only fixed lookup
tables (a handful of codes) are inlined as map literals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import spec as S
from ..functions import cols_if_present
from ..spec import DEFAULT_SPEC, PanelSpec
from .bounded import join_small
from .cleaning import dedup_keep_first, filter_min_games, map_lookup, prefix_columns


def join_measures(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left-join measure frames onto the first one, column-existence tolerant.

    Absent (``None``) frames are skipped; a non-key column already present is
    renamed ``<col>_<measure>`` on the right side before the join.
    """
    items = [(k, v) for k, v in frames.items() if v is not None]
    if not items:
        raise ValueError("no measure frames")
    base_name, out = items[0]
    for name, df in items[1:]:
        if not all(k in df.columns for k in keys):
            continue
        clash = {c: f"{c}_{name.upper()}" for c in df.columns if c in out.columns and c not in keys}
        out = out.join(df.withColumnsRenamed(clash), list(keys), "left")
    return out


def join_player_measures(frames: Mapping[str, DataFrame], spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Advanced left join Usage, Misc, Scoring on (entity, period)."""
    return join_measures(frames, spec.keys)


def join_team_measures(frames: Mapping[str, DataFrame], keys: Sequence[str] = ("TEAM_ID", "SEASON")) -> DataFrame:
    """Base left join Advanced, Four Factors, Misc on (team, period)."""
    return join_measures(frames, keys)


def join_bio(panel: DataFrame, bio: DataFrame, spec: PanelSpec = DEFAULT_SPEC,
             tie_break: Sequence[str] | None = None) -> DataFrame:
    """Panel left join the de-duplicated bio subset on entity."""
    cols = cols_if_present(bio, S.BIO_COLS)
    sub = bio.select(*cols)
    order = list(tie_break) if tie_break else [c for c in cols if c != spec.entity]
    sub = dedup_keep_first(sub, [spec.entity], order)
    # a bio column the panel already has is kept from the panel
    sub = sub.select(spec.entity, *[c for c in sub.columns if c != spec.entity and c not in panel.columns])
    return panel.join(sub, spec.entity, "left")


def join_team_context(panel: DataFrame, team: DataFrame, lookup: DataFrame | Mapping[str, str] | None = None,
                      spec: PanelSpec = DEFAULT_SPEC, abbrev: str = "TEAM_ABBREVIATION") -> DataFrame:
    """Map abbreviation -> team name, then left join ``TEAM_``-prefixed team stats on (name, period)."""
    if abbrev not in panel.columns:
        return panel
    lookup = S.TEAM_ABBREVIATIONS if lookup is None else lookup
    cols = cols_if_present(team, list(S.TEAM_COLS) + list(S.TEAM_OPTIONAL_COLS))
    sub = prefix_columns(team.select(*cols), "TEAM_", keep=("TEAM_NAME", spec.period))
    df = map_lookup(panel, lookup, abbrev, "TEAM_NAME")
    return join_small(df, sub, ["TEAM_NAME", spec.period])


def join_advanced(panel: DataFrame, adv: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Left join ``ADV_``-prefixed advanced stats on (entity, period)."""
    cols = cols_if_present(adv, list(S.ADVANCED_COLS) + list(S.ADVANCED_OPTIONAL_COLS))
    sub = prefix_columns(adv.select(*cols), "ADV_", keep=spec.keys)
    return panel.join(sub, spec.keys, "left")


def build_master_panel(stats: DataFrame, bio: DataFrame | None = None, team: DataFrame | None = None,
                       adv: DataFrame | None = None, lookup=None, spec: PanelSpec = DEFAULT_SPEC,
                       min_games: int = S.MIN_GAMES, tie_break: Sequence[str] | None = None) -> DataFrame:
    """The three joins, then one row per (entity, period) and ``GP >= min_games``.

    The reference then sorts by (entity, period); a set-valued DataFrame needs
    no global sort (use ``sort_rows`` where order is the feature).
    """
    df = stats
    if bio is not None:
        df = join_bio(df, bio, spec)
    if team is not None:
        df = join_team_context(df, team, lookup, spec)
    if adv is not None:
        df = join_advanced(df, adv, spec)
    order = list(tie_break) if tie_break else [c for c in ("GP", "MIN", "PTS") if c in df.columns]
    df = dedup_keep_first(df, spec.keys, order)
    return filter_min_games(df, min_games)


def join_group_average(df: DataFrame, group_means: DataFrame, group: str, value: str,
                       fallback: float | None) -> DataFrame:
    """Attach a group mean to each row; unmatched or null group -> ``fallback``."""
    gm = group_means.select(group, F.col(value).alias("__gm"))
    j = join_small(df, gm, [group], derived=True).select(*df.columns, "__gm")
    return j.withColumn(value, F.coalesce(F.col("__gm"), F.lit(fallback).cast("double"))).drop("__gm")


def join_metrics_by_target(metrics: DataFrame, metric: str = "MAE", models: Sequence[str] | None = None,
                           target: str = "target", model: str = "model") -> DataFrame:
    """Line up one metric of several model families per target (wide)."""
    g = metrics.groupBy(target)
    p = g.pivot(model, list(models)) if models is not None else g.pivot(model)
    return p.agg(F.first(F.col(metric), ignorenulls=True))
