"""Named queries: one callable per operator ID of the blueprint, ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (through the stand-in raw tables of
:mod:`panelforge.sources.driver_tables`) and runs the operator it is named
after on the whole input.  Queries whose output SQL can express have a
DuckDB oracle of the same name in ``duckdb_oracle``.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import spec as S
from ..functions import raw_div
from ..operators import availability as G
from ..operators import base_models as BM
from ..operators import cleaning as B
from ..operators import derived as D
from ..operators import ensembles as L
from ..operators import evaluation as J
from ..operators import joins as C
from ..operators import linear_gram as LG
from ..operators import models as K
from ..operators import panel_windows as E
from ..operators import preparation as I
from ..operators import profiling as P
from ..operators import projections as N
from ..operators import trees as TR
from ..sources import driver_tables as T
from ..sources import io as A
from ..sources import model_store as MS
from ..session import cut_lineage
from ..spec import DEFAULT_SPEC
from . import feature_panel as FP

SPEC = DEFAULT_SPEC
KEYS = SPEC.keys
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

TRAIN = FP.TRAIN_PERIODS
VAL = FP.VAL_PERIOD
BASELINES = ("Baseline_LAG1", "Baseline_3yr", "Baseline_Position")
# Partial last year of the driver data: Jan-Aug of 2001 -> 7/12 of a full season.
FIXTURE_SEASON_GAMES = {"2001-02": 48}
ADV_STATS = ("USG_PCT", "TS_PCT", "AST_PCT", "REB_PCT", "PIE")
BOX = ("GP", "MIN", "PTS", "REB", "AST", "STL", "BLK", "TOV", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A",
       "FG3_PCT", "FTM", "FTA", "FT_PCT")


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# --- shared inputs ------------------------------------------------------------

def _master(spark, d):
    return FP.master_panel(spark, d, SPEC)


def _lagged(spark, d):
    """Master panel + targets + lag chain (lags, rolling, trend, consistency, history)."""
    return FP.with_lags(_master(spark, d), SPEC)


def _lagged_again(spark, d):
    """The same over the master panel written once, a fifth as wide: for plans that read it several times."""
    return FP.with_lags(cut_lineage(_master(spark, d), "master"), SPEC)


def _featured(spark, d):
    lag = _lagged_again(spark, d)
    return FP.add_features(lag, D.position_categories(_train(lag)))


def _added(before: DataFrame, after: DataFrame) -> DataFrame:
    new = [c for c in after.columns if c not in set(before.columns)]
    return after.select(*KEYS, *new)


def _val(df):
    return df.where(F.col(SPEC.period) == VAL)


def _train(df):
    return df.where(F.col(SPEC.period).isin(*TRAIN) & F.col("NEXT_PTS").isNotNull())


def _lagged_materialized(spark, d):
    """The lagged panel written once: evaluation reads it for train, validation and medians."""
    return cut_lineage(_lagged(spark, d), "lagged")


def _baseline_columns(lag):
    """What the baselines read of the lagged panel."""
    stats = [f"{s}{x}" for s in S.TARGET_STATS for x in ("", "_LAG1", "_AVG2", "_AVG3")]
    own = {*KEYS, "POSITION", *stats, *(f"NEXT_{s}" for s in S.TARGET_STATS)}
    return lag.select(*[c for c in lag.columns if c in own])


def _baseline_preds(spark, d):
    """The long prediction table of the three baselines on the validation period, written once:
    metrics, weights and ensembles all read it."""
    lag = cut_lineage(_baseline_columns(_lagged(spark, d)), "lagged")
    val = _val(lag)
    preds = (J.baseline_lag1(val, SPEC).unionByName(J.baseline_multi_year(val, SPEC))
             .unionByName(J.baseline_group_average(val, _train(lag), SPEC)))
    return cut_lineage(preds, "predictions")


def _baseline_metrics(spark, d):
    return J.regression_metrics(_baseline_preds(spark, d))


# --- flagship -------------------------------------------------------------------

@query("flagship_baseline_metrics")
def flagship_baseline_metrics(spark, d):
    """Customer-year panel -> GP filter -> targets + lags -> LAG1 baseline -> metrics on the validation period."""
    df = E.targets_and_lags(_master(spark, d), SPEC)
    return J.regression_metrics(J.baseline_lag1(_val(df), SPEC))


# --- A: scans, sources, sinks ------------------------------------------------------

CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("scan_table")
def q_scan_table(spark, d):
    return A.scan_table(spark, f"{d}/customer.parquet", CUSTOMER_SCHEMA)


#: The raw bio landing with numbers where its text says so: a line without a draft number does not fit.
BIO_CSV = ("PERSON_ID long, DISPLAY_FIRST_LAST string, BIRTHDATE string, COUNTRY string, HEIGHT string, WEIGHT int, "
           "POSITION string, DRAFT_YEAR string, DRAFT_ROUND string, DRAFT_NUMBER int")


@query("scan_table_csv")
def q_scan_table_csv(spark, d):
    """The four raw tables written as headered CSV and read back typed; a fifth, optional one is absent."""
    raw = FP.raw_tables(spark, d)
    base = A.scratch_path(spark, "csv")
    bio = raw["bio"].select(*[c.split()[0] for c in BIO_CSV.split(", ")])
    out = None
    for name, df, schema in (("stats", raw["stats"], None), ("bio", bio, BIO_CSV), ("team", raw["team"], None),
                             ("adv", raw["adv"], None), ("injuries", None, "PERSON_ID long")):
        if df is not None:
            A.sink_table(df, f"{base}/{name}", "csv")
        got = A.scan_csv(spark, f"{base}/{name}", schema or df.schema, optional=df is None)
        if got is None:
            one = spark.createDataFrame([(name, False, 0, 0, None)],
                                        "table string, present boolean, n_rows long, n_rejects long, total double")
        else:
            good, bad = got
            number = [F.col(f.name).cast("double") for f in good.schema.fields if f.dataType.simpleString() in (
                "double", "int", "bigint")]
            total = sum((F.coalesce(c, F.lit(0.0)) for c in number[1:]), F.coalesce(number[0], F.lit(0.0)))
            one = (good.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(total).alias("total"))
                   .crossJoin(bad.agg(F.count("line").alias("n_rejects")))          # one row each
                   .select(F.lit(name).alias("table"), F.lit(True).alias("present"), "n_rows", "n_rejects", "total"))
        out = one if out is None else out.unionByName(one)
    return out


@query("union_period_batches")
def q_union_period_batches(spark, d):
    """Seasons landed as one batch each, in one pass, and read back; a season that was not fetched is skipped."""
    stats = T.player_stats(spark, d)
    base = A.scratch_path(spark, "batches")
    A.sink_table(stats.withColumnRenamed("SEASON", "batch"), base, partition_by=["batch"])
    schema = stats.drop("SEASON").schema
    batches = {lab: A.scan_table(spark, f"{base}/batch={lab}", schema, optional=True)
               for lab in ("1994-95", *T.season_ordinals())}
    return A.union_period_batches(batches, "SEASON", {"MEASURE_TYPE": "Base"})


@query("scan_metrics_json")
def q_scan_metrics_json(spark, d):
    path = A.scratch_path(spark, "metrics-json")
    A.sink_metrics_json(_baseline_metrics(spark, d), path)
    return A.scan_metrics_json(spark, path)


@query("sink_table")
def q_sink_table(spark, d):
    path = A.scratch_path(spark, "master")
    A.sink_table(_master(spark, d), path)
    return spark.read.parquet(path)


@query("sink_prepared")
def q_sink_prepared(spark, d):
    """Every part of the prepared set as it is read back: its rows and columns, and whether its cells are the same."""
    prep = _prepared(spark, d)
    base = A.scratch_path(spark, "prepared")
    splits = {k: cut_lineage(v, "prepared-split") for k, v in prep.splits.items()}
    A.sink_prepared(splits, base, KEYS, prep.features, SPEC.targets, S.METADATA_COLS,
                    extra={"fill_values": prep.fill.table(spark)})
    tables = A.read_committed(spark, base)
    source = {f"{part}_{k}": v for k, v in splits.items() for part in ("X", "y", "metadata")}
    source["fill_values"] = prep.fill.table(spark)
    out = None
    for name, df in tables.items():
        def digest(rows, names=df.columns):
            return rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in names])
                                                                .cast("decimal(38,0)")).alias("h"))
        one = digest(df).join(digest(source[name]).select(F.col("n").alias("m"), F.col("h").alias("g")))     # a row each
        one = one.select(F.lit(name).alias("part"), F.col("n").alias("n_rows"),
                         F.lit(len(df.columns)).cast("long").alias("n_columns"),
                         (F.col("n").eqNullSafe(F.col("m")) & F.col("h").eqNullSafe(F.col("g"))).alias("same"))
        out = one if out is None else out.unionByName(one)
    return out


@query("sink_metrics_json")
def q_sink_metrics_json(spark, d):
    path = A.scratch_path(spark, "metrics")
    A.sink_metrics_json(_baseline_metrics(spark, d), path)
    return spark.read.json(path)


@query("model_store")
def q_model_store(spark, d):
    """A chain fitted for all targets, stored, loaded (one family that was never stored is skipped), and applied to
    rows of the lagged panel."""
    lag = _lagged_materialized(spark, d)
    categories = D.position_categories(_train(lag))
    prep = I.prepare_training_data(FP.add_features(lag, categories), TRAIN, VAL, SPEC.targets, S.METADATA_COLS)
    train = cut_lineage(K.contiguous_folds(prep.splits["train"], 3, KEYS), "train")
    models = BM.fit_base_models(train, prep.features, SPEC.targets, "fold", spec=SPEC)
    base = MS.save_chain(spark, MS.FittedChain(categories, prep.features, prep.fill, prep.scale, models),
                         A.scratch_path(spark, "models"))
    return MS.load_chain(spark, base, [*BM.NAMES, "NeuralNet"]).predict(_val(lag).where(F.col("NEXT_PTS").isNotNull()), SPEC)


# --- B: projection, predicates, cleaning -------------------------------------------

@query("project_existing")
def q_project_existing(spark, d):
    return B.project_existing(T.player_stats(spark, d), S.PLAYER_KEEP)


@query("rename_map")
def q_rename_map(spark, d):
    return B.rename_map(T.player_bio(spark, d), {"PERSON_ID": "PLAYER_ID", "DISPLAY_FIRST_LAST": "PLAYER_NAME",
                                                 "SEASON_EXP": "YEARS_EXPERIENCE"})


@query("prefix_columns")
def q_prefix_columns(spark, d):
    return B.prefix_columns(T.team_stats(spark, d), "TEAM_", keep=("TEAM_NAME", "SEASON"))


@query("filter_min_games")
def q_filter_min_games(spark, d):
    return B.filter_min_games(T.player_stats(spark, d), 10)


@query("filter_active_entities")
def q_filter_active_entities(spark, d):
    active = T.table(spark, d, "customer").select(F.col("c_custkey").alias("id"),
                                                  (F.col("c_acctbal") > 0).alias("is_active"))
    return B.filter_active_entities(T.player_stats(spark, d), active, "PLAYER_ID")


@query("filter_id_prefix")
def q_filter_id_prefix(spark, d):
    return B.filter_id_prefix(T.team_stats(spark, d), "TEAM_ID", "161061270")


@query("dedup_keep_first")
def q_dedup_keep_first(spark, d):
    o = T.table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("yr"), "o_orderdate",
                                           "o_orderkey", "o_totalprice", "o_orderstatus")
    return B.dedup_keep_first(o, ["o_custkey", "yr"], ["o_orderdate", "o_orderkey"])


PCT_COLS = ("FG_PCT", "FG3_PCT", "FT_PCT", "TEAM_W_PCT", "ADV_USG_PCT", "ADV_AST_PCT", "ADV_REB_PCT", "ADV_TS_PCT")


@query("fill_pct_zero")
def q_fill_pct_zero(spark, d):
    return B.fill_pct_zero(_master(spark, d)).select(*KEYS, *PCT_COLS)


@query("fill_global_median")
def q_fill_global_median(spark, d):
    return B.fill_global_median(T.advanced_stats(spark, d), list(ADV_STATS))


PERIOD_MEAN_COLS = ("MIN", "PTS", "REB", "AST", "FG_PCT", "TEAM_PACE", "TEAM_W_PCT", "ADV_USG_PCT", "ADV_PIE")


@query("fill_period_mean")
def q_fill_period_mean(spark, d):
    m = _master(spark, d).select(*KEYS, "GP", *PERIOD_MEAN_COLS)
    return B.fill_period_mean(m, "SEASON", skip=("PLAYER_ID", "GP"))


@query("fill_constant_default")
def q_fill_constant_default(spark, d):
    m = _master(spark, d)
    out = B.fill_constant_default(m, {"YEARS_EXPERIENCE": 0, "DRAFT_YEAR": "Undrafted", "TEAM_NAME": "Unmapped"})
    return out.select(*KEYS, "YEARS_EXPERIENCE", "DRAFT_YEAR", "TEAM_NAME")


@query("coerce_numeric")
def q_coerce_numeric(spark, d):
    b = T.player_bio(spark, d)
    return B.coerce_numeric(b, ["DRAFT_ROUND", "DRAFT_NUMBER"], fill=0.0).select(
        "PERSON_ID", "DRAFT_ROUND", "DRAFT_NUMBER")


@query("coerce_timestamp")
def q_coerce_timestamp(spark, d):
    return B.coerce_timestamp(T.player_bio(spark, d), "BIRTHDATE").select("PERSON_ID", "BIRTHDATE")


AS_OF = "2002-01-01"


@query("age_from_birthdate")
def q_age_from_birthdate(spark, d):
    b = B.coerce_timestamp(T.player_bio(spark, d), "BIRTHDATE")
    return B.age_from_birthdate(b, AS_OF).select("PERSON_ID", "BIRTHDATE", "AGE")


@query("parse_height")
def q_parse_height(spark, d):
    return B.parse_height(T.player_bio(spark, d)).select("PERSON_ID", "HEIGHT", "HEIGHT_INCHES")


@query("map_lookup")
def q_map_lookup(spark, d):
    out = B.map_lookup(T.player_stats(spark, d), T.team_lookup(spark, d), "TEAM_ABBREVIATION", "TEAM_NAME")
    return out.select(*KEYS, "TEAM_ABBREVIATION", "TEAM_NAME")


@query("period_label")
def q_period_label(spark, d):
    o = T.table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("yr"))
    return B.period_label(o, "yr", "SEASON")


@query("period_ordinal")
def q_period_ordinal(spark, d):
    return B.period_ordinal(T.player_stats(spark, d), T.season_ordinals()).select(*KEYS, "SEASON_ORDER")


@query("sort_rows")
def q_sort_rows(spark, d):
    return B.sort_rows(_master(spark, d).select(*KEYS, "GP", "PTS"), ["PTS", "PLAYER_ID", "SEASON"],
                       [False, True, True])


@query("text_contains_filter")
def q_text_contains_filter(spark, d):
    return B.text_contains_filter(_master(spark, d), "PLAYER_NAME", "customer#0000001").select(
        *KEYS, "PLAYER_NAME", "PTS")


@query("replace_infinite")
def q_replace_infinite(spark, d):
    s = T.player_stats(spark, d).select(*KEYS, raw_div("AST", "STL").alias("AST_PER_STL"),
                                        raw_div("FG3M", "FG3A").alias("FG3M_PER_FG3A"))
    return B.replace_infinite(s)


@query("drop_non_numeric_features")
def q_drop_non_numeric_features(spark, d):
    return B.drop_non_numeric_features(_master(spark, d), keep=KEYS)


@query("clean_bio")
def q_clean_bio(spark, d):
    return B.clean_bio(T.player_bio(spark, d), as_of=AS_OF)


# --- C: joins -----------------------------------------------------------------------

def _adv_measures(spark, d):
    a = T.advanced_stats(spark, d)
    return {"Advanced": a.select(*KEYS, "TS_PCT", "USG_PCT"), "Usage": a.select(*KEYS, "USG_PCT", "AST_PCT"),
            "Misc": a.select(*KEYS, "REB_PCT"), "Scoring": a.select(*KEYS, "PIE"), "Defense": None}


@query("join_player_measures")
def q_join_player_measures(spark, d):
    return C.join_player_measures(_adv_measures(spark, d), SPEC)


@query("join_team_measures")
def q_join_team_measures(spark, d):
    t = T.team_stats(spark, d)
    k = ["TEAM_ID", "SEASON"]
    frames = {"Base": t.select(*k, "TEAM_NAME", "GP", "W", "L", "W_PCT"),
              "Advanced": t.select(*k, "OFF_RATING", "DEF_RATING", "NET_RATING", "PACE"),
              "Four_Factors": t.select(*k, "W_PCT"), "Misc": t.select(*k, "GP")}
    return C.join_team_measures(frames, k)


@query("join_bio")
def q_join_bio(spark, d):
    return C.join_bio(T.player_stats(spark, d), B.clean_bio(T.player_bio(spark, d)), SPEC)


@query("join_team_context")
def q_join_team_context(spark, d):
    return C.join_team_context(T.player_stats(spark, d), T.team_stats(spark, d), T.team_lookup(spark, d), SPEC)


@query("join_advanced")
def q_join_advanced(spark, d):
    return C.join_advanced(T.player_stats(spark, d), T.advanced_stats(spark, d), SPEC)


@query("build_master_panel")
def q_build_master_panel(spark, d):
    return _master(spark, d)


@query("join_group_average")
def q_join_group_average(spark, d):
    lag = _lagged(spark, d)
    means = J.group_mean_train(_train(lag), ["PTS"], "POSITION").where(F.col("POSITION").isNotNull())
    return C.join_group_average(_val(lag).select(*KEYS, "POSITION"), means, "POSITION", "PTS", 0.0)


@query("join_metrics_by_target")
def q_join_metrics_by_target(spark, d):
    return C.join_metrics_by_target(_baseline_metrics(spark, d), "MAE", BASELINES)


# --- D: aggregations ---------------------------------------------------------------

@query("period_summary")
def q_period_summary(spark, d):
    return P.period_summary(_master(spark, d), ["GP", "MIN", "PTS", "REB", "AST"])


@query("value_counts")
def q_value_counts(spark, d):
    return P.value_counts(_master(spark, d), "POSITION", normalize=True)


@query("panel_overview")
def q_panel_overview(spark, d):
    return P.panel_overview(_master(spark, d), SPEC)


@query("describe_columns")
def q_describe_columns(spark, d):
    return P.describe_columns(_lagged_materialized(spark, d), SPEC.targets)


@query("target_moments")
def q_target_moments(spark, d):
    return P.target_moments(_lagged(spark, d), SPEC.targets)


@query("missing_profile")
def q_missing_profile(spark, d):
    return P.missing_profile(_lagged(spark, d))


@query("missing_severity")
def q_missing_severity(spark, d):
    return P.missing_severity(P.missing_profile(_lagged(spark, d)))


AVAIL_FLAGS = ("HIGH_AVAILABILITY", "MEDIUM_AVAILABILITY", "LOW_AVAILABILITY", "GP_IMPROVING", "GP_DECLINING",
               "VETERAN_INJURY_RISK", "HEAVY_MINUTES_LOAD", "INJURY_PRONE_PATTERN", "MAJOR_GP_DROP",
               "RECOVERY_YEAR", "HIGH_WORKLOAD", "INCREASING_WORKLOAD", "LOAD_MANAGEMENT", "RECOVERING_FROM_LOW_PLAY")


@query("availability_breakdown")
def q_availability_breakdown(spark, d):
    return P.availability_breakdown(G.availability_chain(_lagged(spark, d)), AVAIL_FLAGS)


@query("target_range_check")
def q_target_range_check(spark, d):
    return P.target_range_check(_lagged(spark, d))


@query("target_coverage")
def q_target_coverage(spark, d):
    return P.target_coverage(_lagged(spark, d), "NEXT_PTS")


@query("target_correlation_topk")
def q_target_correlation_topk(spark, d):
    return P.target_correlation_topk(_lagged(spark, d), SPEC.targets, 5)


def _numeric_features(df: DataFrame) -> list[str]:
    """Every numeric column that is no key, target or metadata."""
    return B.numeric_columns(df, exclude=[*KEYS, *SPEC.targets, *S.METADATA_COLS])


@query("high_correlation_pairs")
def q_high_correlation_pairs(spark, d):
    rows, cols = _prep_input(spark, d)
    return P.high_correlation_pairs(rows, cols, 0.95)


@query("career_totals")
def q_career_totals(spark, d):
    return P.career_totals(_master(spark, d))


@query("group_mean_train")
def q_group_mean_train(spark, d):
    return J.group_mean_train(_train(_lagged(spark, d)), list(S.TARGET_STATS), "POSITION")


@query("infinite_profile")
def q_infinite_profile(spark, d):
    f = _featured(spark, d).select("*", raw_div("AST", "STL").alias("AST_PER_STL"))
    return P.infinite_profile(I.split_label(f, TRAIN, VAL, SPEC.period))


@query("feature_stats")
def q_feature_stats(spark, d):
    rows, cols = _prep_input(spark, d)
    return P.feature_stats(rows, cols)


# --- E: window / panel -------------------------------------------------------------

@query("create_targets")
def q_create_targets(spark, d):
    m = _master(spark, d)
    return _added(m, E.create_targets(m, SPEC))


@query("lag_features")
def q_lag_features(spark, d):
    m = _master(spark, d)
    return _added(m, E.lag_features(m, SPEC))


@query("rolling_averages")
def q_rolling_averages(spark, d):
    base = E.lag_features(_master(spark, d), SPEC)
    return _added(base, E.rolling_averages(base))


@query("trend_features")
def q_trend_features(spark, d):
    base = E.lag_features(_master(spark, d), SPEC)
    return _added(base, E.trend_features(base))


@query("consistency_features")
def q_consistency_features(spark, d):
    base = E.lag_features(_master(spark, d), SPEC)
    return _added(base, E.consistency_features(base))


@query("history_flags")
def q_history_flags(spark, d):
    base = E.lag_features(_master(spark, d), SPEC)
    return _added(base, E.history_flags(base, SPEC))


@query("lag_features_strict")
def q_lag_features_strict(spark, d):
    m = _master(spark, d)
    return _added(m, E.lag_features(m, SPEC, stats=["PTS", "GP"], strict=True))


@query("create_targets_supplier_year")
def q_create_targets_supplier_year(spark, d):
    sy = T.supplier_year(spark, d)
    return _added(sy, E.create_targets(sy, SPEC, stats=["PTS", "AST", "REB", "MIN"]))


@query("lag_features_user_day")
def q_lag_features_user_day(spark, d):
    ud = T.user_day(spark, d)
    spec = SPEC.with_(entity="user_id", period="day")
    out = E.lag_features(ud, spec, stats=["GP", "PTS"])
    return out.select("user_id", "day", *[c for c in out.columns if "_LAG" in c])


# --- F: derived row-level features ----------------------------------------------------

def _family(fn):
    def q(spark, d):
        base = _lagged(spark, d)
        return _added(base, fn(base))
    return q


for _name, _fn in {
    "age_features": D.age_features,
    "efficiency_features": D.efficiency_features,
    "role_features": D.role_features,
    "team_context_features": D.team_context_features,
    "interaction_features": D.interaction_features,
    "position_one_hot": lambda df: D.position_one_hot(df, D.position_categories(_train(df))),
    "position_groups": D.position_groups,
    "physical_features": D.physical_features,
    "games_played_features": G.games_played_features,
    "availability_trend": G.availability_trend,
    "injury_proxy": G.injury_proxy,
    "workload_features": G.workload_features,
    "rest_recovery": G.rest_recovery,
    "availability_score": G.availability_score,
}.items():
    query(_name)(_family(_fn))


@query("team_derived_stats")
def q_team_derived_stats(spark, d):
    t = T.team_box(spark, d)
    out = D.team_derived_stats(t)
    return out.select("TEAM_ID", "SEASON", *[c for c in out.columns if c not in t.columns])


@query("team_derived_stats_players")
def q_team_derived_stats_players(spark, d):
    """The same ratios where the table has no offensive rebounds."""
    s = T.player_stats(spark, d)
    return _added(s, D.team_derived_stats(s))


@query("season_max_games_rate")
def q_season_max_games_rate(spark, d):
    m = _master(spark, d)
    return _added(m, G.season_max_games_rate(m, FIXTURE_SEASON_GAMES, "SEASON"))


# --- H: validation / selection ----------------------------------------------------------

def _featured_materialized(spark, d):
    """The feature panel written once before validation: profiles make several passes over it."""
    return cut_lineage(_featured(spark, d))


@query("drop_high_missing")
def q_drop_high_missing(spark, d):
    f = _featured_materialized(spark, d)
    kept = P.drop_high_missing(f, 90.0, protect=SPEC.targets)
    return P.missing_profile(kept, only_missing=False).select("column")


@query("drop_constant_features")
def q_drop_constant_features(spark, d):
    f = _featured_materialized(spark, d)
    kept = P.drop_constant_features(f, exclude=list(SPEC.targets) + list(S.METADATA_COLS))
    return P.missing_profile(kept, only_missing=False).select("column")


@query("separate_columns")
def q_separate_columns(spark, d):
    parts = P.separate_columns(_featured_materialized(spark, d), SPEC.targets, S.METADATA_COLS, keys=KEYS)
    # the narrow parts are hashed, so that the wide one is shuffled once and never sorted
    return parts["targets"].hint("shuffle_hash").join(parts["features"], KEYS).join(
        parts["metadata"].hint("shuffle_hash"), KEYS)


@query("validate_types")
def q_validate_types(spark, d):
    return P.validate_types(_featured(spark, d))


@query("split_has_target")
def q_split_has_target(spark, d):
    train, pred = P.split_has_target(_lagged(spark, d), "NEXT_PTS")
    return train.select(*KEYS, F.lit("train").alias("part")).unionByName(pred.select(*KEYS, F.lit("pred").alias("part")))


# --- I: split, impute, scale --------------------------------------------------------------

TEXT = ("POSITION", "HEIGHT", "DRAFT_YEAR", "COUNTRY", "TEAM_NAME")


def _prep_input(spark, d):
    """Keys, the split, texts and every feature of the whole panel as doubles (NaN: missing), written once: what
    follows makes several passes over it."""
    f = B.coerce_numeric(_featured(spark, d), ["DRAFT_ROUND", "DRAFT_NUMBER"], fill=0.0)
    cols = I.feature_columns(f, SPEC.targets, [*S.METADATA_COLS, *KEYS])
    f = I.split_label(f, TRAIN, VAL, SPEC.period)
    number = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c) for c in cols]
    return cut_lineage(f.select(*KEYS, "split", *TEXT, *number), "prep-input"), cols


def _prepared(spark, d, features=None):
    f = _featured(spark, d)
    return I.prepare_training_data(f, TRAIN, VAL, SPEC.targets, S.METADATA_COLS, features=features)


@query("temporal_split")
def q_temporal_split(spark, d):
    sp = I.temporal_split(_lagged(spark, d), TRAIN, VAL, first_target="NEXT_PTS")
    out = None
    for k, v in sp.items():
        p = v.select(*KEYS, F.lit(k).alias("split"))
        out = p if out is None else out.unionByName(p)
    return out


@query("fit_fill_values")
def q_fit_fill_values(spark, d):
    rows, cols = _prep_input(spark, d)
    return I.FillValues.fit(rows.where("split = 'train'"), [*cols, *TEXT]).table(spark)


def _filled(spark, d):
    rows, cols = _prep_input(spark, d)
    fv = I.FillValues.fit(rows.where("split = 'train'"), cols)
    parts = {k: rows.where(F.col("split") == k).select(*KEYS, *[F.col(f"`{c}`") for c in cols])
             for k in ("train", "val", "pred")}
    return I.apply_fill_values(fv, parts, cols), cols


def _union_splits(sp):
    out = None
    for k, v in sp.items():
        p = v.withColumn("split", F.lit(k))
        out = p if out is None else out.unionByName(p)
    return out


@query("apply_fill_values")
def q_apply_fill_values(spark, d):
    return _union_splits(_filled(spark, d)[0])


def _scaled(spark, d):
    sp, cols = _filled(spark, d)
    sp = {k: B.replace_infinite(v, cols) for k, v in sp.items()}
    sc = I.StandardScale.fit(sp["train"], cols)
    return {k: sc.transform(v) for k, v in sp.items()}, cols


@query("standard_scale")
def q_standard_scale(spark, d):
    return _union_splits(_scaled(spark, d)[0])


@query("scaling_check")
def q_scaling_check(spark, d):
    sp, cols = _scaled(spark, d)
    return I.scaling_check(sp["train"], cols)


@query("prepare_training_data")
def q_prepare_training_data(spark, d):
    prep = _prepared(spark, d)
    return _union_splits({k: v.select(*KEYS, *[F.col(f"`{c}`") for c in prep.features]) for k, v in prep.splits.items()})


# --- J: baselines and evaluation ------------------------------------------------------------

@query("baseline_lag1")
def q_baseline_lag1(spark, d):
    return J.baseline_lag1(_val(_lagged(spark, d)), SPEC)


@query("baseline_persistence")
def q_baseline_persistence(spark, d):
    return J.baseline_persistence(_val(_lagged(spark, d)), SPEC)


@query("baseline_multi_year")
def q_baseline_multi_year(spark, d):
    return J.baseline_multi_year(_val(_lagged(spark, d)), SPEC)


@query("baseline_group_average")
def q_baseline_group_average(spark, d):
    lag = cut_lineage(_baseline_columns(_lagged(spark, d)), "lagged")
    return J.baseline_group_average(_val(lag), _train(lag), SPEC)


@query("regression_metrics")
def q_regression_metrics(spark, d):
    return _baseline_metrics(spark, d)


@query("mape")
def q_mape(spark, d):
    return J.mape(_baseline_preds(spark, d))


@query("metrics_summary")
def q_metrics_summary(spark, d):
    return J.metrics_summary(_baseline_metrics(spark, d))


@query("improvement_vs_baseline")
def q_improvement_vs_baseline(spark, d):
    return J.improvement_vs_baseline(_baseline_metrics(spark, d), "Baseline_3yr", "Baseline_LAG1")


@query("improvement_summary")
def q_improvement_summary(spark, d):
    return J.improvement_summary(J.improvement_vs_baseline(_baseline_metrics(spark, d), "Baseline_3yr",
                                                           "Baseline_LAG1"))


@query("best_model_per_target")
def q_best_model_per_target(spark, d):
    return J.best_model_per_target(_baseline_metrics(spark, d), BASELINES)


@query("wins_by_approach")
def q_wins_by_approach(spark, d):
    return J.wins_by_approach(J.best_model_per_target(_baseline_metrics(spark, d), BASELINES))


@query("wins_with_ties")
def q_wins_with_ties(spark, d):
    return J.wins_with_ties(_baseline_metrics(spark, d))


@query("best_overall_approach")
def q_best_overall_approach(spark, d):
    return J.best_overall_approach(_baseline_metrics(spark, d), "MAE", BASELINES)


# --- K: models (rows-only: no SQL oracle for ML fits) ------------------------------------------

#: Of the reference's grid of boosted trees, what the query searches; the rest is in README with its time.
BOOSTED_QUERY_GRID = {**TR.BOOSTED_GRID, "max_depth": (3, 5), "subsample": (0.8,), "colsample_bytree": (0.8,),
                      "min_child_weight": (1,), "gamma": (0.0,)}


def _ml_data(spark, d, folds=5):
    """The preparation, training rows in contiguous folds (a written table), and validation rows."""
    prep = _prepared(spark, d)
    return prep, cut_lineage(K.contiguous_folds(prep.splits["train"], folds, KEYS), "train"), prep.splits["val"]


def _linear(spark, d, families):
    """The metrics of linear families with the chosen penalties: all targets, full grids, contiguous folds."""
    prep, train, val = _ml_data(spark, d)
    out = None
    for name, penalties in families.items():
        fit = LG.fit_grid(train, prep.features, SPEC.targets, penalties)
        m = J.regression_metrics(fit.predict(val, name, SPEC))
        m = m.join(F.broadcast(fit.report(spark, name)), ["model", "target"])       # a row a target
        out = m if out is None else out.unionByName(m)
    return out


RIDGE = {"Ridge": LG.ridge_penalties(K.ALPHAS)}
LASSO = {"Lasso": LG.lasso_penalties(K.ALPHAS)}
ELASTIC = {"ElasticNet": LG.elasticnet_penalties(K.ENET_ALPHAS, K.L1_RATIOS)}


@query("ridge_grid")
def q_ridge_grid(spark, d):
    return _linear(spark, d, RIDGE)


@query("lasso_grid")
def q_lasso_grid(spark, d):
    return _linear(spark, d, LASSO)


@query("elasticnet_grid")
def q_elasticnet_grid(spark, d):
    return _linear(spark, d, ELASTIC)


@query("linear_best")
def q_linear_best(spark, d):
    metrics = cut_lineage(_linear(spark, d, {**RIDGE, **LASSO, **ELASTIC}), "linear-metrics")
    best = J.best_model_per_target(metrics, ("Ridge", "Lasso", "ElasticNet"))
    return metrics.join(F.broadcast(best.select("target", F.col("best_model").alias("model"))), ["target", "model"])


def _tree_grid(spark, d, kind, name, grid):
    """Metrics on validation rows of each target's chosen point, with the point and its cross-validated MAE."""
    prep, train, val = _ml_data(spark, d, 3)
    fit = TR.fit_grid(TR.binned(train, prep.features, SPEC.targets, "fold", SPEC), kind, grid)
    chosen = spark.createDataFrame([(t, json.dumps(p, sort_keys=True), float(e)) for t, (p, e) in fit.chosen.items()],
                                   "target string, point string, cv_mae double")
    return J.regression_metrics(fit.predict(val, name, SPEC)).join(F.broadcast(chosen), "target")   # a row a target


@query("random_forest_grid")
def q_random_forest_grid(spark, d):
    return _tree_grid(spark, d, "forest", "RF", TR.FOREST_GRID)


@query("boosted_trees_grid")
def q_boosted_trees_grid(spark, d):
    return _tree_grid(spark, d, "boosted", "XGBoost", BOOSTED_QUERY_GRID)


@query("contiguous_folds")
def q_contiguous_folds(spark, d):
    return K.contiguous_folds(cut_lineage(_train(_lagged(spark, d)).select(*KEYS), "fold-keys"), 5, KEYS)


def _base_models(spark, d, folds=False, **families):
    """Tuned models of all targets, the training rows in three folds, and validation rows."""
    prep, train, val = _ml_data(spark, d, 3)
    return BM.fit_base_models(train, prep.features, SPEC.targets, "fold", folds=folds, spec=SPEC, **families), train, val


@query("feature_importance")
def q_feature_importance(spark, d):
    return _base_models(spark, d, linear=())[0].importance(spark)


@query("importance_topk")
def q_importance_topk(spark, d):
    return J.topk_per_group(_base_models(spark, d, linear=())[0].importance(spark), ["model", "target"], "importance", 10,
                            tie=("feature",))


@query("predict_all")
def q_predict_all(spark, d):
    models, _, val = _base_models(spark, d)
    return models.predict(val, SPEC)


# --- L: ensembles (over the baseline prediction table: SQL-checkable) ---------------------------

@query("ensemble_simple_average")
def q_ensemble_simple_average(spark, d):
    return L.ensemble_simple_average(_baseline_preds(spark, d), SPEC)


@query("ensemble_inverse_mae_weights")
def q_ensemble_inverse_mae_weights(spark, d):
    return L.ensemble_inverse_mae_weights(_baseline_metrics(spark, d), BASELINES)


@query("ensemble_weighted_average")
def q_ensemble_weighted_average(spark, d):
    preds = _baseline_preds(spark, d)
    w = L.ensemble_inverse_mae_weights(J.regression_metrics(preds), BASELINES)
    return L.ensemble_weighted_average(preds, w, SPEC)


@query("ensemble_comparison")
def q_ensemble_comparison(spark, d):
    preds = _baseline_preds(spark, d)
    w = L.ensemble_inverse_mae_weights(J.regression_metrics(preds), BASELINES)
    allp = preds.unionByName(L.ensemble_simple_average(preds, SPEC)).unionByName(
        L.ensemble_weighted_average(preds, w, SPEC))
    order = list(BASELINES) + ["Simple_Average", "Weighted_Average"]
    return L.ensemble_comparison(J.regression_metrics(allp), order, order)


@query("ensemble_select")
def q_ensemble_select(spark, d):
    preds = _baseline_preds(spark, d)
    w = L.ensemble_inverse_mae_weights(J.regression_metrics(preds), BASELINES)
    order = list(BASELINES) + ["Simple_Average", "Weighted_Average"]
    return L.ensemble_select(preds, w, None, SPEC, order)


@query("ensemble_stacking")
def q_ensemble_stacking(spark, d):
    models, train, val = _base_models(spark, d, folds=True)
    return L.ensemble_stacking(models.out_of_fold(train, "fold", SPEC), models.predict(val, SPEC), BM.NAMES, 1.0, SPEC)


@query("cv_inverse_mae_weights")
def q_cv_inverse_mae_weights(spark, d):
    models, train, _ = _base_models(spark, d, folds=True)
    return L.ensemble_inverse_mae_weights(BM.cv_metrics(models.out_of_fold(train, "fold", SPEC)))


#: Fitted models and their ensembles, in the order in which ties are decided.
FITTED = (*BM.NAMES, "Simple_Average", "Weighted_Average", "Stacking")


def _fitted_predictions(spark, d):
    """Base predictions of the validation rows, weights by their MAE, and stacked predictions."""
    models, train, val = _base_models(spark, d, folds=True)
    preds = cut_lineage(models.predict(val, SPEC), "fitted")
    stacked = L.ensemble_stacking(models.out_of_fold(train, "fold", SPEC), preds, BM.NAMES, 1.0, SPEC)
    return preds, L.ensemble_inverse_mae_weights(J.regression_metrics(preds), BM.NAMES), stacked


@query("ensemble_select_fitted")
def q_ensemble_select_fitted(spark, d):
    preds, weights, stacked = _fitted_predictions(spark, d)
    return L.ensemble_select(preds, weights, stacked, SPEC, FITTED)


@query("ensemble_comparison_fitted")
def q_ensemble_comparison_fitted(spark, d):
    preds, weights, stacked = _fitted_predictions(spark, d)
    every = (preds.unionByName(L.ensemble_simple_average(preds, SPEC))
             .unionByName(L.ensemble_weighted_average(preds, weights, SPEC)).unionByName(stacked))
    return L.ensemble_comparison(J.regression_metrics(every), FITTED, FITTED)


# --- M: sort / limit / top-k ---------------------------------------------------------------

@query("topk_by_column")
def q_topk_by_column(spark, d):
    return J.topk_by_column(P.missing_profile(_featured(spark, d)), "missing_pct", 10, tie=("column",))


@query("latest_row_per_entity")
def q_latest_row_per_entity(spark, d):
    return J.latest_row_per_entity(_master(spark, d), SPEC, cols=["SEASON", "GP", "PTS", "AGE"])


@query("first_matching_row")
def q_first_matching_row(spark, d):
    lag = _lagged(spark, d)
    pairs = [(s, f"NEXT_{s}") for s in S.TARGET_STATS]
    return J.first_matching_row(lag, F.col("NEXT_PTS").isNotNull(), ["PLAYER_ID", "SEASON"], pairs)


# --- N: projections (documented) -------------------------------------------------------------

@query("fantasy_points")
def q_fantasy_points(spark, d):
    return N.fantasy_points(_master(spark, d)).select(*KEYS, "FANTASY_POINTS")


def _projections(spark, d):
    """Persistence projections for the rows without a next period (the prediction set)."""
    lag = _lagged(spark, d)
    pred_rows = lag.where(F.col("NEXT_PTS").isNull())
    return pred_rows.select(*KEYS, *[F.col(s).alias(s) for s in S.TARGET_STATS])


@query("prediction_interval")
def q_prediction_interval(spark, d):
    lag = _lagged(spark, d)
    resid = N.residual_std(J.baseline_lag1(_val(lag), SPEC))
    pred = J.baseline_lag1(lag.where(F.col("NEXT_PTS").isNull()), SPEC)
    return N.prediction_interval(pred.drop("actual"), resid)


@query("rank_projections")
def q_rank_projections(spark, d):
    return N.rank_projections(N.fantasy_points(_projections(spark, d)), "FANTASY_POINTS", 100)


@query("projection_summary")
def q_projection_summary(spark, d):
    return N.projection_summary(_projections(spark, d), list(S.TARGET_STATS))


@query("projection_board")
def q_projection_board(spark, d):
    rows = _lagged(spark, d).where(F.col("NEXT_PTS").isNull()).select(*KEYS, "PLAYER_NAME", *S.TARGET_STATS)
    return N.projection_board(cut_lineage(N.fantasy_points(rows), "projections"), list(S.TARGET_STATS))


@query("backtest_accuracy")
def q_backtest_accuracy(spark, d):
    m = _master(spark, d)
    proj = m.where(F.col("SEASON") == "1999-00")          # persistence projection made from 1999-00
    actual = m.where(F.col("SEASON") == VAL)              # realised 2000-01 stats
    return N.backtest_accuracy(proj, actual, ["PTS", "REB", "AST", "STL", "BLK", "TOV", "FGA", "FTA"])


@query("position_from_height")
def q_position_from_height(spark, d):
    return N.position_from_height(_master(spark, d)).select(*KEYS, "HEIGHT_INCHES", "POSITION")


@query("position_group_models")
def q_position_group_models(spark, d):
    """Boosted trees of each position group and target, with the points that were chosen on all rows."""
    prep, train, val = _ml_data(spark, d, 3)
    data = TR.binned(train, prep.features, SPEC.targets, "fold", SPEC)
    chosen = TR.choose(TR.search(data, "boosted", BM.BOOSTED_LIGHT), BM.BOOSTED_LIGHT)
    return N.position_group_trees(train, val, data, chosen, SPEC)
