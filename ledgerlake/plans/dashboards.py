"""Dashboard queries (D-01 … D-18) over the marts.

Each function takes the mart it reads and returns the card's DataFrame in
the card's order. Sorts follow the reference database's NULL placement
(NULLs first when descending, last when ascending) and add a key column as
tie-break so results are deterministic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import asc_pg, banded, desc_pg, exact_ratio
from ledgerlake.operators.activity import DORMANT, NEVER_USED
from ledgerlake.operators.credit import APPROVED
from ledgerlake.operators.engagement import AT_RISK

# Labels of the dashboards.
SENT = "Enviada"
ANOMALY, NORMAL = "ANOMALY", "NORMAL"
RELEVANT = "Relevante"
WEAK = "Significativo mas fraco"
NO_EVIDENCE = "Sem evidência"
YES, NO = "Sim", "Não"
RELEVANT_R2_PCT = 5
TOP_AT_RISK = 20
ANOMALY_SIGMAS = 3
ANOMALY_YEAR, ANOMALY_MONTH = 2022, 12

# Display headers of the driver table.
DRIVER_TABLE_HEADERS = {
    "impact_rank": "#",
    "driver": "Alavanca",
    "correlation": "r (Pearson)",
    "r_squared": "r² (variância explicada)",
    "significant": "Significativo (p<0,05)?",
    "verdict": "Veredito",
    "sample_size": "n (clientes)",
}


# --- commercial dashboard -------------------------------------------------

def dash_kpi_cards(kpis: DataFrame) -> DataFrame:
    """D-01: the five KPI cards."""
    return kpis.select("total_clientes", "clientes_ativos", "taxa_ativos_pct",
                       "taxa_inativos_pct", "media_transacoes_por_cliente")


def dash_status_distribution(engagement: DataFrame) -> DataFrame:
    """D-02: clients per engagement status, largest first."""
    return (engagement.groupBy("engagement_status")
            .agg(F.count(F.lit(1)).alias("clientes"))
            .orderBy(desc_pg("clientes"), asc_pg("engagement_status")))


def dash_top20_at_risk(engagement: DataFrame, limit: int = TOP_AT_RISK) -> DataFrame:
    """D-03: the at-risk clients with the highest balances (top-k, ties by client id)."""
    return (engagement.where(F.col("engagement_status") == F.lit(AT_RISK))
            .select("client_sk", "client_full_name", "total_balance", "transaction_count",
                    "days_since_last_transaction")
            .orderBy(desc_pg("total_balance"), asc_pg("client_sk"))
            .limit(limit))


def dash_driver_ranking(ranking: DataFrame) -> DataFrame:
    """D-04: drivers in rank order."""
    return (ranking.select("impact_rank", "driver", "correlation", "direction",
                           "significant_at_5pct")
            .orderBy(asc_pg("impact_rank")))


# --- credit dashboard -----------------------------------------------------

def _approved_count():
    return F.sum(F.when(F.col("proposal_status") == F.lit(APPROVED), F.col("proposal_count"))
                 .otherwise(F.lit(0)))


def dash_total_proposals(funnel: DataFrame) -> DataFrame:
    """D-05: total proposals."""
    return funnel.agg(F.sum("proposal_count").alias("total_proposals"))


def dash_approval_rate(funnel: DataFrame) -> DataFrame:
    """D-06: approved / total in percent (NULL instead of an error on an empty funnel)."""
    return funnel.agg(exact_ratio(_approved_count(), F.sum("proposal_count"), 2, factor=100)
                      .alias("approval_rate_pct"))


def dash_financed_amount(funnel: DataFrame) -> DataFrame:
    """D-07: amount of approved proposals."""
    approved_amount = F.sum(F.when(F.col("proposal_status") == F.lit(APPROVED),
                                   F.col("total_proposal_amount")).otherwise(F.lit(0)))
    return funnel.agg(F.round(approved_amount, 2).alias("total_financed_amount"))


def dash_funnel_monthly(funnel: DataFrame) -> DataFrame:
    """D-08: proposals per month and status."""
    return (funnel.select("month", "proposal_status", "proposal_count")
            .orderBy(asc_pg("month"), asc_pg("proposal_status")))


def dash_funnel_by_status(funnel: DataFrame) -> DataFrame:
    """D-09: proposals and amount per status, largest first."""
    return (funnel.groupBy("proposal_status")
            .agg(F.sum("proposal_count").alias("total"),
                 F.round(F.sum("total_proposal_amount"), 2).alias("total_amount"))
            .orderBy(desc_pg("total"), asc_pg("proposal_status")))


def dash_agency_conversion(performance: DataFrame) -> DataFrame:
    """D-10: agencies by conversion rate (agencies without proposals first)."""
    return (performance.select("agency_name", "agency_type", "total_proposals",
                               "approved_proposals", "conversion_rate_pct",
                               F.round("total_proposal_amount", 2).alias("total_proposal_amount"),
                               "agency_sk")
            .orderBy(desc_pg("conversion_rate_pct"), asc_pg("agency_sk"))
            .drop("agency_sk"))


def dash_funnel_detail(funnel: DataFrame) -> DataFrame:
    """D-11: funnel rows with rounded amount and mean rate in percent."""
    return (funnel.select("month", "proposal_status", "proposal_count",
                          F.round("total_proposal_amount", 2).alias("total_proposal_amount"),
                          F.round(F.col("avg_interest_rate") * F.lit(100), 4)
                          .alias("avg_interest_rate_pct"))
            .orderBy(asc_pg("month"), asc_pg("proposal_status")))


# --- insights dashboard ---------------------------------------------------

def dash_stuck_sent(funnel: DataFrame, status: str = SENT) -> DataFrame:
    """D-12: funnel rows still in the first status, by month."""
    return (funnel.where(F.col("proposal_status") == F.lit(status))
            .select("month", "proposal_status", "proposal_count", "total_proposal_amount")
            .orderBy(asc_pg("month")))


def dash_agency_ranking(performance: DataFrame) -> DataFrame:
    """D-13: every agency column, by conversion rate."""
    return (performance.select("agency_sk", "agency_name", "agency_type", "total_proposals",
                               "approved_proposals", "conversion_rate_pct",
                               "total_proposal_amount")
            .orderBy(desc_pg("conversion_rate_pct"), asc_pg("agency_sk")))


def dash_volume_anomaly(volume: DataFrame, year: int = ANOMALY_YEAR, month: int = ANOMALY_MONTH,
                        sigmas: float = ANOMALY_SIGMAS) -> DataFrame:
    """D-14: day/type rows of one month flagged above mean + k·stddev.

    The mean and sample standard deviation are taken over the whole history
    (one global aggregate used as a scalar subquery, evaluated once); only the
    output is limited to the month, written as a date range so a
    date-partitioned mart is pruned.
    """
    limit = volume.agg((F.avg("transaction_count")
                        + F.lit(sigmas) * F.stddev_samp("transaction_count")).alias("_limit")).scalar()
    start = dt.date(year, month, 1)
    end = dt.date(year + (month == 12), month % 12 + 1, 1)
    in_month = volume.where((F.col("transaction_date") >= F.lit(start))
                            & (F.col("transaction_date") < F.lit(end)))
    flagged = in_month.select(
        "transaction_date", "transaction_type", "transaction_count", "distinct_accounts",
        "avg_tx_per_account",
        F.when(F.col("transaction_count") > limit, F.lit(ANOMALY))
        .otherwise(F.lit(NORMAL)).alias("flag"))
    return flagged.orderBy(desc_pg("transaction_count"), asc_pg("transaction_date"),
                           asc_pg("transaction_type"))


def dash_idle_accounts(activity: DataFrame) -> DataFrame:
    """D-15: dormant and never-used accounts by balance."""
    return (activity.where(F.col("activity_status").isin(DORMANT, NEVER_USED))
            .select("account_sk", "client_fk", "agency_fk", "total_balance",
                    "last_transaction_date", "days_since_last_transaction", "activity_status")
            .orderBy(desc_pg("total_balance"), asc_pg("account_sk")))


def dash_cross_sell(opportunities: DataFrame) -> DataFrame:
    """D-16: cross-sell list by balance."""
    return (opportunities.select("client_fk", "client_full_name", "account_fk",
                                 "total_balance", "agency_fk")
            .orderBy(desc_pg("total_balance"), asc_pg("account_fk")))


def _verdict():
    """What a driver's explained variance (in %) amounts to, if it is significant at all."""
    evidence = F.when(F.col("significant_at_5pct"), F.col("r_squared_pct"))
    return banded(evidence, [(float("-inf"), WEAK), (RELEVANT_R2_PCT, RELEVANT)], NO_EVIDENCE)


def dash_driver_verdict(ranking: DataFrame) -> DataFrame:
    """D-17: ranking with a verdict (significant and r² ≥ 5 % / significant but weak / none)."""
    return (ranking.select("impact_rank", "driver", "correlation", "direction",
                           "significant_at_5pct", "r_squared_pct", "sample_size",
                           _verdict().alias("verdict"))
            .orderBy(asc_pg("impact_rank")))


def dash_driver_table(ranking: DataFrame) -> DataFrame:
    """D-18: the ranking as a display table with localized headers."""
    h = DRIVER_TABLE_HEADERS
    return (ranking.orderBy(asc_pg("impact_rank")).select(
        F.col("impact_rank").alias(h["impact_rank"]),
        F.col("driver").alias(h["driver"]),
        F.col("correlation").alias(h["correlation"]),
        F.concat(F.col("r_squared_pct").cast("string"), F.lit("%")).alias(h["r_squared"]),
        F.when(F.col("significant_at_5pct"), F.lit(YES)).otherwise(F.lit(NO)).alias(h["significant"]),
        _verdict().alias(h["verdict"]),
        F.col("sample_size").alias(h["sample_size"]),
    ))


# Dashboard -> (builder, mart it reads).
DASHBOARDS = {
    "dash_kpi_cards": (dash_kpi_cards, "commercial_kpis"),
    "dash_status_distribution": (dash_status_distribution, "client_engagement"),
    "dash_top20_at_risk": (dash_top20_at_risk, "client_engagement"),
    "dash_driver_ranking": (dash_driver_ranking, "driver_ranking"),
    "dash_total_proposals": (dash_total_proposals, "credit_funnel"),
    "dash_approval_rate": (dash_approval_rate, "credit_funnel"),
    "dash_financed_amount": (dash_financed_amount, "credit_funnel"),
    "dash_funnel_monthly": (dash_funnel_monthly, "credit_funnel"),
    "dash_funnel_by_status": (dash_funnel_by_status, "credit_funnel"),
    "dash_agency_conversion": (dash_agency_conversion, "agency_performance"),
    "dash_funnel_detail": (dash_funnel_detail, "credit_funnel"),
    "dash_stuck_sent": (dash_stuck_sent, "credit_funnel"),
    "dash_agency_ranking": (dash_agency_ranking, "agency_performance"),
    "dash_volume_anomaly": (dash_volume_anomaly, "daily_volume"),
    "dash_idle_accounts": (dash_idle_accounts, "account_activity"),
    "dash_cross_sell": (dash_cross_sell, "cross_sell"),
    "dash_driver_verdict": (dash_driver_verdict, "driver_ranking"),
    "dash_driver_table": (dash_driver_table, "driver_ranking"),
}


def dashboards_from_marts(spark: SparkSession, db: str = "marts") -> dict[str, DataFrame]:
    """Every dashboard query over the written marts, by name."""
    return {name: builder(spark.table(f"{db}.{mart}"))
            for name, (builder, mart) in DASHBOARDS.items()}
