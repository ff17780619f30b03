"""Credit models: funnel (M-02), agency performance (M-03), credit KPIs (M-07)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import exact_ratio

# Proposal status domain of the credit funnel.
APPROVED = "Aprovada"
PROPOSAL_STATUSES = ("Aprovada", "Em análise", "Enviada", "Validação documentos")


def approved_clients(proposals: DataFrame, approved: str = APPROVED) -> DataFrame:
    """Distinct ids of clients with at least one approved proposal."""
    return (proposals.where(F.col("proposal_status") == F.lit(approved))
            .select("client_id").distinct())


def credit_funnel(proposals: DataFrame) -> DataFrame:
    """M-02: proposals by calendar month and status: count, amount, mean monthly rate."""
    return (proposals
            .groupBy(F.date_trunc("month", F.col("proposal_date")).alias("month"),
                     F.col("proposal_status"))
            .agg(F.count(F.lit(1)).alias("proposal_count"),
                 F.sum("proposal_amount").alias("total_proposal_amount"),
                 F.avg("monthly_interest_rate").alias("avg_interest_rate")))


def agency_performance(agencies: DataFrame, bridge: DataFrame, proposals: DataFrame,
                       approved: str = APPROVED) -> DataFrame:
    """M-03: per agency, proposals of its employees, approvals, conversion % and amount.

    A proposal carries no agency; it reaches one through its employee and the
    N:N employee-agency bridge, so a proposal counts once for *each* agency of
    its employee, and proposals of employees without an agency drop out.
    Agencies without proposals are kept with zero counts and NULL rate and
    amount.

    Plan: the proposals (the large side) are aggregated per employee before
    anything is joined, so the bridge join and the agency aggregate only see
    one row per employee. Sums distribute over the fan-out, so this equals
    joining every proposal row first.
    """
    per_employee = proposals.groupBy("employee_id").agg(
        F.count("proposal_id").alias("n"),
        F.count_if(F.col("proposal_status") == F.lit(approved)).alias("n_approved"),
        F.sum("proposal_amount").alias("amount"),
    )
    per_agency = (bridge.select("employee_id", "agency_id")
                  .join(per_employee, "employee_id", "inner")
                  .groupBy("agency_id")
                  .agg(F.sum("n").alias("n"), F.sum("n_approved").alias("n_approved"),
                       F.sum("amount").alias("amount")))
    grouped = (agencies.select("agency_id", "agency_name", "agency_type")
               .join(per_agency, "agency_id", "left")
               .groupBy("agency_id", "agency_name", "agency_type")
               .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_proposals"),
                    F.coalesce(F.sum("n_approved"), F.lit(0)).alias("approved_proposals"),
                    F.sum("amount").alias("total_proposal_amount")))
    return grouped.select(
        F.col("agency_id").alias("agency_sk"),
        "agency_name",
        "agency_type",
        "total_proposals",
        "approved_proposals",
        exact_ratio("approved_proposals", "total_proposals", 2, factor=100).alias("conversion_rate_pct"),
        "total_proposal_amount",
    )


def credit_kpis(funnel: DataFrame, approved: str = APPROVED) -> DataFrame:
    """M-07: one row of credit KPIs over the funnel.

    "Rejected" is every status other than the approved one (also proposals
    still in progress); the mean rate is the unweighted mean of the monthly
    group means, expressed in percent.
    """
    is_approved = F.col("proposal_status") == F.lit(approved)
    approved_n = F.sum(F.when(is_approved, F.col("proposal_count")).otherwise(F.lit(0)))
    total_n = F.sum("proposal_count")
    return funnel.agg(
        total_n.alias("total_proposals"),
        approved_n.alias("approved_proposals"),
        F.sum(F.when(F.col("proposal_status") != F.lit(approved), F.col("proposal_count"))
              .otherwise(F.lit(0))).alias("rejected_proposals"),
        exact_ratio(approved_n, total_n, 2, factor=100).alias("approval_rate_pct"),
        F.round(F.sum("total_proposal_amount"), 2).alias("total_proposal_amount"),
        F.round(F.sum(F.when(is_approved, F.col("total_proposal_amount")).otherwise(F.lit(0))), 2)
        .alias("total_financed_amount"),
        F.round(F.avg("avg_interest_rate") * F.lit(100), 4).alias("avg_interest_rate_pct"),
    )
