"""Feature-panel plan: raw landed tables -> master panel -> features.

One lazy DataFrame from the joins to the last feature column; Catalyst sees
it whole.  The panel is exchanged once by entity for every lead/lag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import availability as G
from ..operators import derived as D
from ..operators import panel_windows as E
from ..operators.cleaning import clean_bio, period_ordinal
from ..operators.joins import build_master_panel
from ..sources import driver_tables as T
from ..spec import DEFAULT_SPEC, PanelSpec

# Split configuration for the driver panel (years 1995-2001).
TRAIN_PERIODS = ("1995-96", "1996-97", "1997-98", "1998-99", "1999-00")
VAL_PERIOD = "2000-01"


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    years = T.written_years(spark, sf_dir)      # the lines are added up once for both
    return {
        "stats": T.player_stats(spark, sf_dir, years),
        "bio": T.player_bio(spark, sf_dir),
        "team": T.team_stats(spark, sf_dir),
        "adv": T.advanced_stats(spark, sf_dir, years),
        "lookup": T.team_lookup(spark, sf_dir),
    }


def master_panel(spark: SparkSession, sf_dir: str, spec: PanelSpec = DEFAULT_SPEC,
                 min_games: int = 10, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    t = tables or raw_tables(spark, sf_dir)
    bio = clean_bio(t["bio"])
    panel = build_master_panel(t["stats"], bio, t["team"], t["adv"], lookup=t["lookup"], spec=spec,
                               min_games=min_games)
    return period_ordinal(panel, T.season_ordinals(), spec.period, spec.period_order)


def with_lags(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC, strict: bool = False) -> DataFrame:
    """Targets + lag chain (one window exchange)."""
    return E.lag_chain(panel, spec, strict=strict, with_targets=True)


def add_features(df: DataFrame, positions: Sequence[str] | None = None, max_games=82) -> DataFrame:
    df = D.derived_chain(df, positions, max_games)
    return G.availability_chain(df, max_games)


def feature_panel(spark: SparkSession, sf_dir: str, spec: PanelSpec = DEFAULT_SPEC,
                  positions: Sequence[str] | None = None, tables=None) -> DataFrame:
    panel = master_panel(spark, sf_dir, spec, tables=tables)
    df = with_lags(panel, spec)
    if positions is None:
        positions = D.position_categories(panel.where(F.col(spec.period).isin(*TRAIN_PERIODS)))
    return add_features(df, positions)
