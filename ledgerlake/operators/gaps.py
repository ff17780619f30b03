"""Transactions that follow each other suspiciously fast (planned mart F4-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.sequences import previous_rows

# Flags and the limits in seconds of the gap to the transaction before.
HIGH = "suspeita_alta"
MEDIUM = "suspeita_media"
NORMAL = "normal"
FRAUD_FLAGS = (HIGH, MEDIUM, NORMAL)
HIGH_BELOW = 60
MEDIUM_UP_TO = 300

_SECONDS = "decimal(20,6)"


def transaction_gaps(transactions: DataFrame, high_below: int = HIGH_BELOW,
                     medium_up_to: int = MEDIUM_UP_TO, ranges: int | None = None) -> DataFrame:
    """One row per transaction with the time since its account's transaction before.

    Transactions of an account follow each other by time, then id (rows with the
    same id: by amount and type); the first
    has no predecessor and is ``normal``, like one without a time. A gap under
    ``high_below`` seconds is ``suspeita_alta``, up to ``medium_up_to``
    ``suspeita_media``. Transactions without an account form one sequence.

    Plan: :func:`~ledgerlake.operators.sequences.previous_rows`, so an account of
    any size is spread over ranges of (account, time, id).
    """
    tx = transactions.select("transaction_id", "account_id", "transaction_at", "transaction_type",
                             "transaction_amount")
    chained = previous_rows(tx, ["account_id"], ["transaction_at", "transaction_id", "transaction_amount",
                                                   "transaction_type"],
                            {"transaction_at": "prev_transaction_at"}, ranges)
    micros = F.unix_micros("transaction_at") - F.unix_micros("prev_transaction_at")
    gap = micros.cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(6,6)")
    seconds = F.col("seconds_since_prev")
    flag = (F.when(seconds < high_below, HIGH).when(seconds <= medium_up_to, MEDIUM)
            .otherwise(NORMAL))
    return chained.withColumn("seconds_since_prev", gap.cast(_SECONDS)).select(
        "transaction_id", "account_id", "transaction_at", "prev_transaction_at",
        "seconds_since_prev", flag.alias("fraud_flag"), "transaction_type", "transaction_amount")


def account_alerts(gaps: DataFrame) -> DataFrame:
    """One row per account with transactions: alerts by level, the amount of the transactions
    they fell on (0 without alerts) and the date of the last one."""
    alert = F.col("fraud_flag") != NORMAL
    return gaps.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_if(F.col("fraud_flag") == HIGH).alias("high_alerts"),
        F.count_if(F.col("fraud_flag") == MEDIUM).alias("medium_alerts"),
        F.coalesce(F.sum(F.when(alert, F.col("transaction_amount"))), F.lit(0))
        .alias("alert_amount"),
        F.max(F.when(alert, F.to_date("transaction_at"))).alias("last_alert_date"))
