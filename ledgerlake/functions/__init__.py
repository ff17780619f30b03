"""Column expressions shared by the models (all built-in Spark functions)."""

from ledgerlake.functions.exprs import (  # noqa: F401
    asc_pg,
    banded,
    days_between,
    desc_pg,
    exact_mean,
    exact_ratio,
    flag01,
    pretty_size,
    recency_status,
    safe_corr,
    t_statistic,
    to_decimal_round,
)
