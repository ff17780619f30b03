"""Driver ranking (M-09): which client attributes move the transaction count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import flag01, safe_corr, t_statistic, to_decimal_round

# Driver names and the engagement columns they read, the target,
# the two-sided 5 % critical value and the direction labels.
DEFAULT_TARGET = "transaction_count"
DEFAULT_DRIVERS: tuple[tuple[str, str], ...] = (
    ("saldo_total", "total_balance"),
    ("tempo_relacionamento", "relationship_days"),
    ("quantidade_contas", "account_count"),
    ("posse_credito_aprovado", "has_approved_credit"),
)
CRITICAL_T = 1.96
POSITIVE, NEGATIVE, UNDEFINED = "positivo", "negativo", "indefinido"
DIRECTIONS = (POSITIVE, NEGATIVE, UNDEFINED)


def _driver_value(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    if dict(df.dtypes).get(column) == "boolean":
        return flag01(c)
    return c


def driver_ranking(engagement: DataFrame, target: str = DEFAULT_TARGET,
                   drivers: Sequence[tuple[str, str]] = DEFAULT_DRIVERS) -> DataFrame:
    """M-09: Pearson r of each driver against the target, with t-statistic and rank.

    One row per driver whose correlation is defined (a constant driver has no
    correlation and is dropped): r and |r| at 4 digits, r² in percent, sign,
    sample size (all rows, not only complete pairs), t at 2 digits, whether
    |t| > 1.96, and the rank by |r| (ties broken by driver name).

    Plan: a single global aggregate computes the sample size and every
    correlation in one scan with partial aggregation on each task; the
    per-driver rows are then produced by unpivoting that one row, so the
    ranking window only ever sees as many rows as there are drivers.
    """
    aggs = [F.count(F.lit(1)).alias("sample_size")]
    for name, column in drivers:
        aggs.append(safe_corr(F.col(target), _driver_value(engagement, column)).alias(name))
    wide = engagement.agg(*aggs)
    long = wide.unpivot(["sample_size"], [name for name, _ in drivers], "driver", "r")
    stats = (long.where(F.col("r").isNotNull())
             .withColumn("t", t_statistic("r", "sample_size")))
    rank_window = Window.orderBy(F.abs(F.col("r")).desc_nulls_last(), F.col("driver").asc())
    return stats.select(
        "driver",
        to_decimal_round("r", 4).alias("correlation"),
        to_decimal_round(F.abs(F.col("r")), 4).alias("abs_correlation"),
        to_decimal_round(F.pow(F.col("r"), 2) * F.lit(100), 2).alias("r_squared_pct"),
        F.when(F.col("r") > 0, F.lit(POSITIVE)).when(F.col("r") < 0, F.lit(NEGATIVE))
        .otherwise(F.lit(UNDEFINED)).alias("direction"),
        "sample_size",
        to_decimal_round("t", 2).alias("t_statistic"),
        (F.abs(F.col("t")) > F.lit(CRITICAL_T)).alias("significant_at_5pct"),
        F.row_number().over(rank_window).alias("impact_rank"),
    )
