"""Projection, predicates and cleaning (family B)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec as S
from ..functions import cols_if_present, contains_ci, parse_height as _parse_height_expr
from ..functions import period_label as _period_label_expr
from ..functions import replace_inf
from .bounded import join_small
from .quantiles import exact_quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in ex]


def project_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    return df.select(*cols_if_present(df, cols))


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
    """Prefix every column not in ``keep`` (``TEAM_``, ``ADV_``)."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in set(keep)})


def filter_min_games(df: DataFrame, threshold: int = S.MIN_GAMES, col: str = "GP") -> DataFrame:
    return df.where(F.col(col) >= threshold)


def filter_active_entities(df: DataFrame, active: DataFrame, entity: str = "PLAYER_ID",
                           active_col: str = "is_active", active_entity: str = "id") -> DataFrame:
    """Keep rows whose entity is in the active set (semi join; AQE chooses broadcast by size)."""
    ids = active.where(F.col(active_col) == F.lit(True)).select(F.col(active_entity).alias(entity))
    return df.join(ids, entity, "left_semi")


def filter_id_prefix(df: DataFrame, col: str = "TEAM_ID", prefix: str = "161") -> DataFrame:
    return df.where(F.col(col).cast("string").startswith(prefix))


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first by the explicit tie-break ``order_by``.

    Written as ``min(struct(order, rest of the row))`` per key: an aggregate with
    map-side partial aggregation, so a hot key is reduced before the shuffle
    instead of being sorted whole in one window task.  Ties are broken by the
    remaining columns, so that the result does not depend on the rows' order.
    A row with columns that have no order goes beside the struct (``min_by``).
    """
    rest = [c for c in df.columns if c not in set(keys)]
    orderable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    by = [*dict.fromkeys(order_by), *[c for c in rest if c in orderable and c not in set(order_by)]]
    ordered = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(by)])
    if set(rest) <= set(by):            # the least struct is the row: it is held and shuffled once
        g = df.groupBy(*keys).agg(F.min(ordered).alias("_first"))
        return g.select(*keys, *[F.col(f"_first._{by.index(c)}").alias(c) for c in rest]).select(*df.columns)
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), ordered).alias("_first"))
    return g.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)


def fill_pct_zero(df: DataFrame) -> DataFrame:
    """Null -> 0 in every numeric column whose name contains ``PCT``."""
    cols = [c for c in numeric_columns(df) if "PCT" in c]
    return df.fillna(0, subset=cols) if cols else df


def fill_global_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null -> exact column median (distributed exact quantile, see :mod:`quantiles`)."""
    cols = cols_if_present(df, cols)
    med = exact_quantiles(df, [(c, 0.5) for c in cols])
    return df.select(*[
        F.coalesce(F.col(c), F.lit(med[(c, 0.5)]).cast("double")).alias(c) if c in cols else F.col(c)
        for c in df.columns])


def fill_period_mean(df: DataFrame, period: str = "SEASON",
                     skip: Sequence[str] = ("TEAM_ID", "GP", "W", "L")) -> DataFrame:
    """Null numeric -> mean of the same period; an all-null period stays null.

    The per-period means are a partial-aggregated ``groupBy`` joined back on
    the period (one row per period), not a window over the period: a window
    would put a whole period in one task.
    """
    cols = [c for c in numeric_columns(df, exclude=list(skip) + [period])]
    if not cols:
        return df
    means = df.groupBy(period).agg(*[F.avg(c).alias(f"__mean_{c}") for c in cols])
    j = join_small(df, means, [period], derived=True)
    return j.select(*[F.coalesce(F.col(c), F.col(f"__mean_{c}")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def fill_constant_default(df: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Experience -> 0, draft year -> ``Undrafted`` (only for columns present)."""
    defaults = defaults or {"YEARS_EXPERIENCE": 0, "DRAFT_YEAR": "Undrafted"}
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.fillna(present) if present else df


def coerce_numeric(df: DataFrame, cols: Sequence[str], fill: float | None = None) -> DataFrame:
    """Text -> double, bad text -> null (``try_cast``); then optionally null -> ``fill``."""
    cols = set(cols_if_present(df, cols))

    def conv(c):
        v = F.trim(F.col(c).cast("string")).try_cast("double")
        return (F.coalesce(v, F.lit(float(fill))) if fill is not None else v).alias(c)

    return df.select(*[conv(c) if c in cols else F.col(c) for c in df.columns])


def coerce_timestamp(df: DataFrame, col: str = "BIRTHDATE") -> DataFrame:
    """Text -> timezone-free timestamp (as pandas parses it); bad text -> null."""
    if col not in df.columns:
        return df
    return df.withColumn(col, F.col(col).cast("string").try_cast("timestamp_ntz"))


def age_from_birthdate(df: DataFrame, as_of: str, birth: str = "BIRTHDATE", out: str = "AGE") -> DataFrame:
    """``round(days(as_of - birth) / 365.25, 1)``; ``as_of`` is a parameter, not "now"."""
    if birth not in df.columns:
        return df
    days = F.datediff(F.to_date(F.lit(as_of)), F.to_date(F.col(birth)))
    return df.withColumn(out, F.bround(days / F.lit(365.25), 1))


def parse_height(df: DataFrame, col: str = "HEIGHT", out: str = "HEIGHT_INCHES") -> DataFrame:
    if col not in df.columns:
        return df
    return df.withColumn(out, _parse_height_expr(col))


def map_lookup(df: DataFrame, lookup: DataFrame | Mapping[str, str], code: str, out: str,
               lookup_code: str = "code", lookup_name: str = "name") -> DataFrame:
    """Map a code to a name; unmapped -> null.

    A Python mapping (a fixed small table) becomes an inline ``map`` literal;
    a DataFrame lookup is a left join, broadcast up to a measured size (:mod:`bounded`).
    """
    if isinstance(lookup, Mapping):
        m = F.create_map(*[x for k, v in lookup.items() for x in (F.lit(k), F.lit(v))])
        return df.withColumn(out, m[F.col(code)])
    lk = lookup.groupBy(F.col(lookup_code).alias(code)).agg(F.min(lookup_name).alias(out))
    base = df.drop(out) if out in df.columns else df
    return join_small(base, lk, [code]).select(*base.columns, out)


def period_label(df: DataFrame, year: str, out: str = "SEASON") -> DataFrame:
    return df.withColumn(out, _period_label_expr(year))


def period_ordinal(df: DataFrame, mapping: Mapping[str, int], period: str = "SEASON",
                   out: str = "SEASON_ORDER") -> DataFrame:
    """Configured label -> ordinal; unknown label -> null."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(int(v)))])
    return df.withColumn(out, m[F.col(period)])


def sort_rows(df: DataFrame, cols: Sequence[str], ascending: Sequence[bool] | bool = True) -> DataFrame:
    asc = [ascending] * len(cols) if isinstance(ascending, bool) else list(ascending)
    return df.orderBy(*[F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last() for c, a in zip(cols, asc)])


def text_contains_filter(df: DataFrame, col: str, needle: str) -> DataFrame:
    return df.where(contains_ci(col, needle))


def replace_infinite(df: DataFrame, cols: Sequence[str] | None = None, value: float = 0.0) -> DataFrame:
    dbl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = set(cols) & dbl if cols is not None else dbl
    return df.select(*[replace_inf(c, value).alias(c) if c in cols else F.col(c) for c in df.columns])


def drop_non_numeric_features(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop text/other non-numeric columns except ``keep`` (keys, targets); booleans kept."""
    keepset = set(keep)
    ok = [f.name for f in df.schema.fields
          if f.name in keepset or isinstance(f.dataType, NUMERIC + (T.BooleanType,))]
    return df.select(*ok)


def clean_bio(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    """Raw bio landing -> typed bio (reference cleaning order)."""
    keep = ("PERSON_ID", "DISPLAY_FIRST_LAST", "BIRTHDATE", "SCHOOL", "COUNTRY", "HEIGHT", "WEIGHT",
            "SEASON_EXP", "POSITION", "DRAFT_YEAR", "DRAFT_ROUND", "DRAFT_NUMBER", "TEAM_ID", "TEAM_NAME",
            "TEAM_ABBREVIATION", "TEAM_CITY")
    df = project_existing(raw, keep)
    df = rename_map(df, {"PERSON_ID": "PLAYER_ID", "DISPLAY_FIRST_LAST": "PLAYER_NAME",
                         "SEASON_EXP": "YEARS_EXPERIENCE"})
    df = coerce_timestamp(df, "BIRTHDATE")
    if as_of is not None:
        df = age_from_birthdate(df, as_of)
    df = parse_height(df)
    df = coerce_numeric(df, ["WEIGHT"])
    return fill_constant_default(df)
