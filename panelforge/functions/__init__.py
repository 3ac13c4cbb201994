"""Column-expression helpers (JVM-side, codegen-friendly)."""

from .exprs import (  # noqa: F401
    ColumnSet,
    column_set,
    clip,
    col,
    cols_if_present,
    contains_ci,
    cut_right_closed,
    flag,
    has,
    parse_height,
    period_label,
    raw_div,
    replace_inf,
    row_count,
    row_mean,
    row_std,
    safe_div,
)
