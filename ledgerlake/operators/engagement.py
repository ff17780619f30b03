"""Client engagement (M-05) and commercial KPIs (M-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import days_between, exact_mean, exact_ratio, recency_status
from ledgerlake.operators.activity import reference_date
from ledgerlake.operators.credit import APPROVED, approved_clients

# Engagement labels and recency limits in days (inclusive).
NEVER_USED = "never_used"
ACTIVE = "active"
AT_RISK = "at_risk"
CHURNED = "churned"
ACTIVE_DAYS = 90
AT_RISK_DAYS = 360
ENGAGEMENT_STATUSES = (ACTIVE, AT_RISK, CHURNED, NEVER_USED)


def client_engagement(clients: DataFrame, accounts: DataFrame, usage: DataFrame,
                      proposals: DataFrame, active_days: int = ACTIVE_DAYS,
                      at_risk_days: int = AT_RISK_DAYS, approved: str = APPROVED) -> DataFrame:
    """M-05: one row per client that owns at least one account.

    Account count and balance, transaction count and amount (0 without
    transactions), mean transactions per account, last transaction date,
    recency and tenure in days from the data set's latest transaction date,
    whether the client has an approved proposal, and the engagement status.

    Plan: ``usage`` holds the transactions aggregated per account
    (:func:`~ledgerlake.operators.activity.transactions_by_account`; count, sum
    and max compose exactly), so the join to accounts and the per-client aggregate
    work on account-sized data. The per-client aggregate is hash-partitioned by client,
    and the joins to clients and approved clients reuse that partitioning.
    """
    ref = reference_date(usage)
    per_client = (accounts.select("account_id", "client_id", "total_balance")
                  .join(usage, "account_id", "left")
                  .groupBy("client_id")
                  .agg(F.count(F.lit(1)).alias("account_count"),
                       F.sum("total_balance").alias("total_balance"),
                       F.sum("tx_count").alias("tx_count"),
                       F.sum("tx_amount").alias("tx_amount"),
                       F.max("last_transaction_at").alias("last_transaction_at")))
    approved_flag = approved_clients(proposals, approved).withColumn("_approved", F.lit(True))
    joined = (clients.select("client_id", "client_full_name", "client_type", "onboarding_date")
              .join(per_client, "client_id", "inner")
              .join(approved_flag, "client_id", "left"))
    tx_count = F.coalesce(F.col("tx_count"), F.lit(0).cast("long"))
    last_date = F.to_date("last_transaction_at")
    onboarding_day = F.to_date("onboarding_date")
    recency = days_between(ref, last_date)
    return joined.select(
        F.col("client_id").alias("client_sk"),
        "client_full_name",
        "client_type",
        onboarding_day.alias("onboarding_date"),
        "account_count",
        "total_balance",
        tx_count.alias("transaction_count"),
        F.coalesce(F.col("tx_amount"), F.lit(0)).alias("transaction_total_amount"),
        exact_ratio(tx_count, "account_count", 2).alias("avg_tx_per_account"),
        last_date.alias("last_transaction_date"),
        recency.alias("days_since_last_transaction"),
        days_between(ref, onboarding_day).alias("relationship_days"),
        F.col("_approved").isNotNull().alias("has_approved_credit"),
        recency_status(recency, [(active_days, ACTIVE), (at_risk_days, AT_RISK)],
                       NEVER_USED, CHURNED).alias("engagement_status"),
    )


def commercial_kpis(engagement: DataFrame) -> DataFrame:
    """M-06: one row: clients by engagement status, active and inactive %, mean transactions.

    Inactive means at risk or churned; credit ownership is the share of clients
    with an approved proposal.
    """
    status = F.col("engagement_status")
    total = F.count(F.lit(1))
    active = F.count_if(status == F.lit(ACTIVE))
    inactive = F.count_if(status.isin(AT_RISK, CHURNED))
    with_credit = F.count_if(F.col("has_approved_credit"))
    return engagement.agg(
        total.alias("total_clientes"),
        active.alias("clientes_ativos"),
        F.count_if(status == F.lit(AT_RISK)).alias("clientes_em_risco"),
        F.count_if(status == F.lit(CHURNED)).alias("clientes_churned"),
        F.count_if(status == F.lit(NEVER_USED)).alias("clientes_sem_uso"),
        exact_ratio(active, total, 2, factor=100).alias("taxa_ativos_pct"),
        exact_ratio(inactive, total, 2, factor=100).alias("taxa_inativos_pct"),
        exact_mean("transaction_count", 2).alias("media_transacoes_por_cliente"),
        exact_ratio(with_credit, total, 2, factor=100).alias("taxa_posse_credito_pct"),
    )
