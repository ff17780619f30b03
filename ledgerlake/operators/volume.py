"""Daily transaction volume (M-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import exact_ratio


def daily_volume(tx: DataFrame) -> DataFrame:
    """M-04: by calendar day and transaction type: count, distinct accounts, mean per account.

    The distinct count is exact. Spark plans it as two aggregation levels
    (day, type, account) then (day, type), each combined on the map side, so
    a hot day or type never gathers its raw rows in one task.
    """
    grouped = (tx.groupBy(F.to_date("transaction_at").alias("transaction_date"),
                          F.col("transaction_type"))
               .agg(F.count(F.lit(1)).alias("transaction_count"),
                    F.count_distinct("account_id").alias("distinct_accounts")))
    return grouped.withColumn(
        "avg_tx_per_account", exact_ratio("transaction_count", "distinct_accounts", 2))
