"""Column-expression building blocks.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; nothing runs in Python per row.

Null rules (pandas semantics the operators reproduce):

* arithmetic propagates null;
* a comparison with null counts as False, so a flag is 0, never null
  (:func:`flag`);
* a guarded division by zero gives null (:func:`safe_div`); an unguarded
  one gives +/-inf or NaN (:func:`raw_div`).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


class ColumnSet:
    """Derived columns pending over a DataFrame, as Spark SQL text; ``to_df`` adds them in ONE ``selectExpr``.

    Feature families chain through a ColumnSet instead of a select each, so a
    wide panel is analyzed once and each column costs one expression parse on
    the JVM instead of a py4j call per operator node.  A pending column that a
    later feature references is inlined (codegen's subexpression elimination
    shares it).
    """

    def __init__(self, df: DataFrame):
        self.df = df
        self._base = list(df.columns)
        self._names = list(self._base)
        self.exprs: dict[str, str] = {}

    @property
    def columns(self) -> list[str]:
        return self._names

    def col(self, name: str) -> str:
        from .sqltext import q
        return f"({self.exprs[name]})" if name in self.exprs else q(name)

    def add(self, name: str, expr: str) -> None:
        if name not in self.exprs and name not in self._base:
            self._names.append(name)
        self.exprs[name] = expr

    def to_df(self) -> DataFrame:
        from .sqltext import q
        if not self.exprs:
            return self.df
        base = set(self._base)
        new = [f"{self.exprs[c]} AS {q(c)}" for c in self._names if c not in base]
        if any(c in base for c in self.exprs):
            kept = [f"{self.exprs[c]} AS {q(c)}" if c in self.exprs else q(c) for c in self._base]
            return self.df.selectExpr(*kept, *new)
        return self.df.selectExpr("*", *new)


def column_set(df):
    """(ColumnSet, finish): pass-through when chaining, one select when called on a DataFrame."""
    if isinstance(df, ColumnSet):
        return df, (lambda cs: cs)
    return ColumnSet(df), (lambda cs: cs.to_df())


def cols_if_present(df_or_cols, wanted: Iterable[str]) -> list[str]:
    """The wanted columns that exist, in the wanted order (plan-time guard)."""
    have = set(df_or_cols.columns if hasattr(df_or_cols, "columns") else df_or_cols)
    return [c for c in wanted if c in have]


def has(df_or_cols, *names: str) -> bool:
    have = set(df_or_cols.columns if hasattr(df_or_cols, "columns") else df_or_cols)
    return all(n in have for n in names)


def flag(cond: Column) -> Column:
    """0/1 integer flag; a null comparison counts as False (pandas rule)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def safe_div(num, den) -> Column:
    """``num / den`` with a zero denominator giving null (pandas ``replace(0, nan)``)."""
    return F.try_divide(col(num), F.nullif(col(den), F.lit(0)))


def raw_div(num, den) -> Column:
    """IEEE division: x/0 -> +/-inf, 0/0 -> NaN, null stays null (ANSI-safe)."""
    n, d = col(num).cast("double"), col(den).cast("double")
    return (
        F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
        .when(d != 0, n / d)
        .when(n > 0, F.lit(float("inf")))
        .when(n < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )


def cut_right_closed(x, edges: Sequence[float], labels: Sequence[float] | None = None) -> Column:
    """Bin ``x`` into right-closed intervals (e0, e1], (e1, e2], ...

    Values outside (e0, e_last] and nulls give null; labels default to
    1..n as doubles.  (MLlib ``Bucketizer`` is left-closed, so not used.)
    """
    x = col(x)
    labels = labels or list(range(1, len(edges)))
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(float(lab))) if expr is None else expr.when(cond, F.lit(float(lab)))
    return expr.otherwise(F.lit(None).cast("double"))


def clip(x, lower=None, upper=None) -> Column:
    """``Series.clip``: null stays null (Spark ``greatest`` would skip it)."""
    x = col(x)
    out = x
    if lower is not None:
        out = F.when(out < F.lit(lower), F.lit(lower)).otherwise(out)
    if upper is not None:
        out = F.when(out > F.lit(upper), F.lit(upper)).otherwise(out)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(out.cast("double"))


def _nn(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit(1)).otherwise(F.lit(0))


def row_count(cols: Sequence) -> Column:
    """Number of non-null values among ``cols`` in the row."""
    out = F.lit(0)
    for c in cols:
        out = out + _nn(col(c))
    return out


def row_mean(cols: Sequence) -> Column:
    """Null-skipping row mean (pandas ``mean(axis=1)``); all-null -> null."""
    s = F.lit(0.0)
    for c in cols:
        s = s + F.coalesce(col(c).cast("double"), F.lit(0.0))
    n = row_count(cols)
    return F.when(n > 0, s / n)


def row_std(cols: Sequence) -> Column:
    """Null-skipping sample std of a row (pandas ``std(axis=1)``, ddof=1).

    Needs at least two non-null values, else null.  Computed from squared
    deviations about the row mean (two-pass, numerically stable).
    """
    n = row_count(cols)
    m = row_mean(cols)
    ss = F.lit(0.0)
    for c in cols:
        ss = ss + F.coalesce(F.pow(col(c).cast("double") - m, F.lit(2.0)), F.lit(0.0))
    return F.when(n >= 2, F.sqrt(ss / (n - 1)))


def period_label(year) -> Column:
    """Year -> ``YYYY-YY`` label (2023 -> ``2023-24``)."""
    y = col(year)
    return F.format_string("%d-%02d", y, (y + 1) % 100)


def parse_height(text) -> Column:
    """``feet-inches`` text -> inches; null, empty, wrong part count or non-integer -> null."""
    t = col(text)
    parts = F.split(t, "-")
    feet = F.get(parts, 0).try_cast("int")
    inch = F.get(parts, 1).try_cast("int")
    return F.when(
        t.isNotNull() & (F.size(parts) == 2) & feet.isNotNull() & inch.isNotNull(),
        (feet * 12 + inch).cast("double"),
    )


def replace_inf(x, value: float = 0.0) -> Column:
    """+/-inf -> ``value`` (NaN and null untouched)."""
    x = col(x)
    return F.when(F.abs(x) == F.lit(float("inf")), F.lit(value)).otherwise(x)


def contains_ci(x, needle: str) -> Column:
    """Case-insensitive contains; null -> False."""
    return F.coalesce(F.lower(col(x)).contains(needle.lower()), F.lit(False))
