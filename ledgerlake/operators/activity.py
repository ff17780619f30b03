"""Account activity (M-01) and the shared recency building blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import days_between, recency_status

# Activity labels and the recency limit in days (inclusive).
NEVER_USED = "never_used"
ACTIVE = "active"
DORMANT = "dormant"
ACTIVE_DAYS = 90
ACTIVITY_STATUSES = (ACTIVE, DORMANT, NEVER_USED)


#: Key of the transactions without an account id (no account has it).
NO_ACCOUNT = -(2**63)
MEASURES = ("last_transaction_at", "tx_count", "tx_amount")


def transactions_by_account(tx: DataFrame) -> DataFrame:
    """One row per account id: count, amount and latest time of its transactions.

    This is the only pass over the transactions for the recency models; the
    partial aggregate runs on every task before the shuffle, so the shuffle
    carries at most one row per account per task, however skewed the accounts.
    Transactions without an account id share the key ``NO_ACCOUNT``, which
    joins to no account but counts for the data set's latest date.
    """
    return tx.groupBy(F.coalesce("account_id", F.lit(NO_ACCOUNT)).alias("account_id")).agg(
        F.count("transaction_id").alias("tx_count"),
        F.sum("transaction_amount").alias("tx_amount"),
        F.max("transaction_at").alias("last_transaction_at"),
    )


def reference_date(usage: DataFrame, measures: tuple[str, ...] = MEASURES) -> Column:
    """The date of the latest transaction in the data set (not today), as a scalar.

    An uncorrelated scalar subquery over the per-account aggregate. It names
    all ``measures`` that the query itself reads, so both see the same
    aggregate and Spark reuses its exchange: the transactions are scanned once.
    """
    if len(measures) == 1:
        latest = F.max("last_transaction_at")
    else:
        latest = F.max(F.struct(*measures))["last_transaction_at"]
    return usage.agg(F.to_date(latest).alias("reference_date")).scalar()


def account_activity(accounts: DataFrame, usage: DataFrame,
                     active_days: int = ACTIVE_DAYS) -> DataFrame:
    """M-01: one row per account with its last transaction date and activity status.

    ``usage`` is :func:`transactions_by_account`. Days are counted from the
    latest transaction date in the data set. ``never_used`` if the account has
    no transaction, ``active`` if the last one is at most ``active_days`` days
    old, else ``dormant``.
    """
    last = usage.select("account_id", "last_transaction_at")
    ref = reference_date(last, ("last_transaction_at",))
    acc = accounts.select("account_id", "client_id", "agency_id", "total_balance")
    joined = acc.join(last, "account_id", "left")
    last_date = F.to_date("last_transaction_at")
    days = days_between(ref, last_date)
    return joined.select(
        F.col("account_id").alias("account_sk"),
        F.col("client_id").alias("client_fk"),
        F.col("agency_id").alias("agency_fk"),
        F.col("total_balance"),
        last_date.alias("last_transaction_date"),
        days.alias("days_since_last_transaction"),
        recency_status(days, [(active_days, ACTIVE)], NEVER_USED, DORMANT).alias("activity_status"),
    )
