"""Spark SQL expression text for the wide feature families.

A feature family adds dozens of columns; building them as ``Column`` objects
costs one py4j round trip per operator node, which dominates query
construction on a wide panel.  These helpers return Spark SQL expression
*text* that a single ``selectExpr`` parses on the JVM side.  Semantics equal
the ``Column`` helpers in :mod:`exprs` (pandas null rules):

* ``flag``: a null comparison counts as False -> 0;
* ``safe_div``: zero denominator -> null;  ``raw_div``: IEEE +/-inf / NaN;
* ``cut``: right-closed bins, outside or null -> null;
* ``row_mean`` / ``row_std``: null-skipping across a row, std needs 2 values.

Numeric literals are written as doubles (``0.5D``) so no decimal arithmetic
sneaks in.
"""

from __future__ import annotations

from collections.abc import Sequence


def q(name: str) -> str:
    """Quoted column reference."""
    return "`" + name.replace("`", "``") + "`"


def d(x: float) -> str:
    """Double literal."""
    if x != x:
        return "CAST('NaN' AS DOUBLE)"
    if x in (float("inf"), float("-inf")):
        return "CAST('Infinity' AS DOUBLE)" if x > 0 else "CAST('-Infinity' AS DOUBLE)"
    return f"{float(x)!r}D"


def b(cond: str) -> str:
    """Boolean with null -> False."""
    return f"COALESCE({cond}, false)"


def flag(cond: str) -> str:
    return f"CAST(COALESCE({cond}, false) AS INT)"


def safe_div(num: str, den: str) -> str:
    return f"try_divide({num}, NULLIF({den}, 0))"


def raw_div(num: str, den: str) -> str:
    n, dd = f"CAST({num} AS DOUBLE)", f"CAST({den} AS DOUBLE)"
    return (f"CASE WHEN {n} IS NULL OR {dd} IS NULL THEN CAST(NULL AS DOUBLE) "
            f"WHEN {dd} != 0 THEN {n} / {dd} "
            f"WHEN {n} > 0 THEN {d(float('inf'))} WHEN {n} < 0 THEN {d(float('-inf'))} "
            f"ELSE {d(float('nan'))} END")


def cut(x: str, edges: Sequence[float], labels: Sequence[float] | None = None) -> str:
    labels = labels or list(range(1, len(edges)))
    whens = " ".join(f"WHEN {x} > {d(lo)} AND {x} <= {d(hi)} THEN {d(lab)}"
                     for lo, hi, lab in zip(edges[:-1], edges[1:], labels))
    return f"CASE {whens} ELSE CAST(NULL AS DOUBLE) END"


def clip(x: str, lower: float | None = None, upper: float | None = None) -> str:
    out = f"CAST({x} AS DOUBLE)"
    if lower is not None:
        out = f"CASE WHEN {out} < {d(lower)} THEN {d(lower)} ELSE {out} END"
    if upper is not None:
        out = f"CASE WHEN {out} > {d(upper)} THEN {d(upper)} ELSE {out} END"
    return f"CASE WHEN {x} IS NULL THEN CAST(NULL AS DOUBLE) ELSE {out} END"


def row_count(cols: Sequence[str]) -> str:
    return "(" + " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in cols) + ")"


def row_mean(cols: Sequence[str]) -> str:
    s = " + ".join(f"COALESCE(CAST({c} AS DOUBLE), 0.0D)" for c in cols)
    n = row_count(cols)
    return f"CASE WHEN {n} > 0 THEN ({s}) / {n} END"


def row_std(cols: Sequence[str]) -> str:
    n = row_count(cols)
    m = f"({row_mean(cols)})"
    ss = " + ".join(f"COALESCE(power(CAST({c} AS DOUBLE) - {m}, 2.0D), 0.0D)" for c in cols)
    return f"CASE WHEN {n} >= 2 THEN sqrt(({ss}) / ({n} - 1)) END"


def lit_double(x: float) -> str:
    """Exact double literal for any value (string parse round-trips ``repr``)."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def agg_row(df, exprs: Sequence[str]):
    """One global aggregate from SQL text (``selectExpr`` of aggregate expressions), first row."""
    return df.selectExpr(*exprs).first()
