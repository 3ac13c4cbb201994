"""Stand-in raw tables built from the driver's TPC-H-like parquet.

The reference starts from four landed tables (player stats per season,
player bio, team stats per season, advanced stats per season).  The test
data is a TPC-H-like star schema, so this module only *shapes* driver rows
into those schemas (see FIXTURES.md section 2); it does none of the
library's work.  All cleaning, joining, windowing and feature building is
done by the operators in :mod:`panelforge.operators` on these tables.

Mapping (entity = customer, period = order year):

* line-level measures are aggregated per order first, then averaged over the
  orders of the customer-year; orders without lines give natural nulls;
* the bio table carries raw text (height ``6-<k%12>``, weight text, birth
  date text, draft text with ``Undrafted``) for the cleaning operators;
* team stats are nation-year aggregates; the abbreviation of a customer's
  team is the text of its nation key, and two codes are left unmapped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import period_label
from ..session import cut_lineage

# Landed precision of the stand-in measures (decimal places): fixes the inputs bit-for-bit,
# independent of the summation order an engine used to produce them.
PRECISION = 10
FIRST_YEAR = 1995
LAST_YEAR = 2001
UNMAPPED_NATIONS = (23, 24)


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet relation for a driver table, resolved once per session (listing + footers)."""
    key = (id(spark), f"{sf_dir}/{name}.parquet")
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(key[1])
    return _TABLES[key]


_LANDED: dict[tuple[int, str, str], DataFrame] = {}


def land(spark: SparkSession, sf_dir: str, base: str) -> dict[str, str]:
    """Write the stand-in raw tables once as Parquet under ``base`` (the ingest step).

    Later stand-in calls in this session read the landed tables instead of
    re-deriving them, as the engine's stages read landed raw tables.
    """
    builders = {"player_stats": player_stats, "player_bio": player_bio, "team_stats": team_stats,
                "advanced_stats": advanced_stats, "team_lookup": team_lookup}
    paths = {}
    for name, fn in builders.items():
        path = f"{base.rstrip('/')}/{name}"
        fn(spark, sf_dir).write.mode("overwrite").parquet(path)
        _LANDED[(id(spark), sf_dir, name)] = spark.read.parquet(path)
        paths[name] = path
    return paths


def _landed(fn):
    def wrapper(spark: SparkSession, sf_dir: str, *args) -> DataFrame:
        hit = _LANDED.get((id(spark), sf_dir, fn.__name__))
        return hit if hit is not None else fn(spark, sf_dir, *args)
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def _share(cond) -> F.Column:
    return F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))


def order_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order aggregates of lineitem (partial aggregation before the shuffle)."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    li = li.join(part, li.l_partkey == part.p_partkey, "left")
    unit_price = F.try_divide(F.col("l_extendedprice"), F.nullif(F.col("l_quantity"), F.lit(0.0)))
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"),
        F.avg("l_quantity").alias("avg_qty"),
        F.avg("l_discount").alias("disc"),
        F.avg("l_tax").alias("tax"),
        _share(F.col("l_returnflag") == "A").alias("sh_a"),
        _share(F.col("l_returnflag") == "R").alias("sh_r"),
        _share(F.col("l_returnflag") == "N").alias("sh_n"),
        _share(F.col("l_linestatus") == "F").alias("sh_f"),
        _share(F.col("l_tax") > 0.04).alias("sh_tax"),
        _share(F.col("l_discount") > 0.05).alias("sh_disc"),
        F.avg("l_linenumber").alias("ln"),
        _share(F.col("l_quantity") > 25).alias("sh_q"),
        F.avg("p_size").alias("psize"),
        F.avg(F.try_divide(F.col("p_retailprice"), F.col("p_retailprice") + unit_price)).alias("pie"),
    )


def customer_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer-year aggregates shared by the player and advanced stand-ins."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("yr"))
    om = order_measures(spark, sf_dir)
    j = o.join(om, o.o_orderkey == om.l_orderkey, "left")
    return j.groupBy("o_custkey", "yr").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.avg("qty").alias("avg_order_qty"),
        F.avg("o_totalprice").alias("avg_price"),
        F.avg("disc").alias("disc"), F.avg("tax").alias("tax"),
        F.avg("sh_a").alias("sh_a"), F.avg("sh_r").alias("sh_r"), F.avg("sh_n").alias("sh_n"),
        F.avg("n_lines").alias("lines"), F.avg("sh_f").alias("sh_f"),
        F.avg("sh_tax").alias("sh_tax"), F.avg("sh_disc").alias("sh_disc"),
        F.avg("ln").alias("ln"), F.avg("sh_q").alias("sh_q"),
        F.avg("avg_qty").alias("avg_qty"), F.avg("psize").alias("psize"), F.avg("pie").alias("pie"),
    )


def written_years(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """``customer_year`` written once, where both of the stand-ins made from it are read; None if they have landed."""
    if all((id(spark), sf_dir, name) in _LANDED for name in ("player_stats", "advanced_stats")):
        return None
    return cut_lineage(customer_year(spark, sf_dir), "customer-year")


@_landed
def player_stats(spark: SparkSession, sf_dir: str, years: DataFrame | None = None) -> DataFrame:
    """Raw per-season box stats (PLAYER_ID, SEASON grain); ``years``: the customer-years, where they are written."""
    cy = customer_year(spark, sf_dir) if years is None else years
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    first = F.min("yr").over(Window.partitionBy("o_custkey"))
    fga = F.lit(2.5) * F.col("lines")
    fg3a = F.col("sh_tax") * fga
    r = lambda c: F.round(c, PRECISION)
    cy = cy.select("o_custkey", "yr", "n_orders", *[r(F.col(c)).alias(c) for c in cy.columns
                                                     if c not in ("o_custkey", "yr", "n_orders")])
    df = cy.join(cust, cy.o_custkey == cust.c_custkey, "left").select(
        F.col("o_custkey").alias("PLAYER_ID"),
        F.col("c_name").alias("PLAYER_NAME"),
        F.col("c_nationkey").cast("string").alias("TEAM_ABBREVIATION"),
        (F.lit(19) + (F.col("yr") - first) + F.col("o_custkey") % 16).cast("double").alias("AGE"),
        (F.col("yr") - first).cast("double").alias("YEARS_EXPERIENCE"),
        (F.lit(9) * F.col("n_orders")).alias("GP"),
        (F.col("avg_order_qty") / 4).alias("MIN"),
        (F.col("avg_price") / 10000).alias("PTS"),
        (F.lit(100.0) * F.col("tax")).alias("REB"),
        (F.lit(100.0) * F.col("disc")).alias("AST"),
        (F.lit(3.0) * F.col("sh_a")).alias("STL"),
        (F.lit(3.0) * F.col("sh_r")).alias("BLK"),
        (F.lit(4.0) * F.col("sh_n")).alias("TOV"),
        (fga * F.col("sh_f")).alias("FGM"),
        fga.alias("FGA"),
        F.col("sh_f").alias("FG_PCT"),
        (fg3a * F.col("sh_disc")).alias("FG3M"),
        fg3a.alias("FG3A"),
        F.col("sh_disc").alias("FG3_PCT"),
        (F.col("ln") * F.col("sh_q")).alias("FTM"),
        F.col("ln").alias("FTA"),
        F.col("sh_q").alias("FT_PCT"),
        period_label(F.col("yr")).alias("SEASON"),
    )
    return df


@_landed
def advanced_stats(spark: SparkSession, sf_dir: str, years: DataFrame | None = None) -> DataFrame:
    """Raw per-season advanced ratios in [0, 1] (PLAYER_ID, SEASON grain); ``years`` as above."""
    cy = customer_year(spark, sf_dir) if years is None else years
    cy = cy.select("o_custkey", "yr", *[F.round(F.col(c), PRECISION).alias(c) for c in cy.columns
                                        if c not in ("o_custkey", "yr", "n_orders")])
    return cy.select(
        F.col("o_custkey").alias("PLAYER_ID"),
        period_label(F.col("yr")).alias("SEASON"),
        (F.col("avg_qty") / 50).alias("USG_PCT"),
        (F.lit(1.0) - F.lit(5.0) * F.col("disc")).alias("TS_PCT"),
        (F.col("psize") / 50).alias("AST_PCT"),
        (F.lit(10.0) * F.col("tax")).alias("REB_PCT"),
        F.col("pie").alias("PIE"),
    )


@_landed
def player_bio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bio rows as an API would land them: text fields, API column names."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    undrafted = (k % 7) == 0
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select(
        k.alias("PERSON_ID"),
        F.col("c_name").alias("DISPLAY_FIRST_LAST"),
        F.when(k % 30 == 0, F.lit("unknown"))
        .otherwise(F.format_string("%04d-%02d-%02dT00:00:00", 1970 + k % 20, 1 + k % 12, 1 + k % 28))
        .alias("BIRTHDATE"),
        F.col("n_name").alias("COUNTRY"),
        F.when(k % 50 == 0, F.lit("6-")).otherwise(F.format_string("6-%d", k % 12)).alias("HEIGHT"),
        F.when(k % 40 == 0, F.lit("")).otherwise((180 + k % 100).cast("string")).alias("WEIGHT"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Guard")
        .when(F.col("c_mktsegment") == "BUILDING", "Forward")
        .when(F.col("c_mktsegment") == "FURNITURE", "Center")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Guard-Forward")
        .alias("POSITION"),
        F.when(undrafted, F.lit("Undrafted")).otherwise((1990 + k % 20).cast("string")).alias("DRAFT_YEAR"),
        F.when(undrafted, F.lit("Undrafted")).otherwise((1 + k % 2).cast("string")).alias("DRAFT_ROUND"),
        F.when(undrafted, F.lit("Undrafted")).otherwise((1 + k % 60).cast("string")).alias("DRAFT_NUMBER"),
    )


@_landed
def team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw per-season team table: nation-year aggregates rescaled to NBA-like ranges."""
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("yr"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    g = o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey", "yr").agg(
        F.count(F.lit(1)).alias("GP"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).cast("long").alias("W"),
        F.round(F.avg("o_totalprice"), PRECISION).alias("avg_price"),
        F.round(_share(F.col("o_orderstatus") == "F"), PRECISION).alias("sh_f"),
        F.round(_share(F.col("o_orderstatus") == "O"), PRECISION).alias("sh_o"),
    )
    off = F.lit(100.0) + F.lit(20.0) * F.col("sh_f")
    dfn = F.lit(100.0) + F.lit(20.0) * F.col("sh_o")
    return g.join(F.broadcast(n), g.c_nationkey == n.n_nationkey, "left").select(
        (F.lit(1610612700) + F.col("c_nationkey")).cast("long").alias("TEAM_ID"),
        F.col("n_name").alias("TEAM_NAME"),
        period_label(F.col("yr")).alias("SEASON"),
        F.col("GP"), F.col("W"), (F.col("GP") - F.col("W")).alias("L"),
        F.col("sh_f").alias("W_PCT"),
        (F.lit(90.0) + F.col("avg_price") / 15000).alias("PACE"),
        off.alias("OFF_RATING"), dfn.alias("DEF_RATING"), (off - dfn).alias("NET_RATING"),
    )


@_landed
def team_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box averages of a team-season, without the ratios that ``team_derived_stats`` adds."""
    g = player_stats(spark, sf_dir).groupBy("TEAM_ABBREVIATION", "SEASON").agg(
        *[F.round(F.avg(c), PRECISION).alias(c) for c in ("PTS", "AST", "TOV", "FGM", "FGA", "FG3A", "FTA")],
        F.round(F.avg("FG3_PCT"), PRECISION).alias("OREB_PCT"))
    return g.withColumn("TEAM_ID", F.lit(1610612700) + F.col("TEAM_ABBREVIATION").cast("long")).drop("TEAM_ABBREVIATION")


@_landed
def team_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, name) lookup for team abbreviations; two nation codes left unmapped."""
    n = table(spark, sf_dir, "nation")
    return n.filter(~F.col("n_nationkey").isin(*UNMAPPED_NATIONS)).select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"))


def season_ordinals(first: int = FIRST_YEAR, last: int = LAST_YEAR) -> dict[str, int]:
    """Configured label -> ordinal mapping for the driver's years (year - 1994)."""
    return {f"{y}-{(y + 1) % 100:02d}": y - (first - 1) for y in range(first, last + 1)}


def supplier_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second panel (supplier, ship year) with the same box-stat names."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy(F.col("l_suppkey").alias("PLAYER_ID"), F.year("l_shipdate").alias("yr")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("l_quantity").alias("q"),
        F.avg("l_discount").alias("d"),
        F.avg("l_tax").alias("t"),
    )
    return g.select(
        "PLAYER_ID", period_label(F.col("yr")).alias("SEASON"),
        F.col("n").alias("GP"), (F.col("q") / 2).alias("PTS"), (F.lit(100.0) * F.col("d")).alias("AST"),
        (F.lit(100.0) * F.col("t")).alias("REB"), F.col("q").alias("MIN"))


def user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day-grain panel from events: (user_id, day label ``yyyy-MM-dd``) with count and value sum."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id"), F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("GP"), F.sum("value").alias("PTS"))
