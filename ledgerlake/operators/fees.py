"""Fee revenue by client and by agency (planned marts F4-03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.joins import BROADCAST_ROWS, lookup_join

FEE_SCHEMA = ("transaction_type string, fixed_fee decimal(10,2), amount_share decimal(6,3), "
              "fee_note string")
# Fee per transaction and share of its amount, by transaction type.
FEES = [
    ("PIX", "0.00", "0.000", "Isento por regulação Bacen"),
    ("TED", "12.00", "0.000", "Tarifa fixa DOC/TED"),
    ("DOC", "8.00", "0.000", "Tarifa fixa DOC"),
    ("Transferência", "5.00", "0.000", "Transferência interna"),
    ("Depósito", "0.00", "0.000", "Depósito isento"),
    ("Saque", "2.50", "0.000", "Saque em caixa"),
]


def fee_table(spark: SparkSession, fees: list[tuple[str, str, str, str]] | None = None) -> DataFrame:
    """The fees as a table, exact decimals."""
    rows = spark.createDataFrame(fees or FEES, "t string, f string, s string, d string")
    return rows.select(F.col("t").alias("transaction_type"),
                       F.col("f").cast("decimal(10,2)").alias("fixed_fee"),
                       F.col("s").cast("decimal(6,3)").alias("amount_share"),
                       F.col("d").alias("fee_note"))


def fees_by_account(transactions: DataFrame, fees: DataFrame,
                    broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per account and transaction type: transactions and the fees they brought.

    A fee is linear in the amount (a fixed part and a share), so transactions
    are first counted and summed per account and type on every task, and the
    fee table, measured first, meets those sums. Transactions of a type without
    a fee count with fee 0.
    """
    used = transactions.groupBy("account_id", "transaction_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("transaction_amount").alias("amount"))
    priced = lookup_join(used, fees.select("transaction_type", "fixed_fee", "amount_share"),
                         ["transaction_type"], ["account_id"], "left", most=broadcast_rows)
    fee = F.coalesce(F.col("fixed_fee"), F.lit(0)) * F.col("n") \
        + F.coalesce(F.col("amount_share"), F.lit(0)) * F.coalesce(F.col("amount"), F.lit(0))
    return priced.select("account_id", "transaction_type", "n", fee.cast("decimal(38,5)").alias("fee"))


def client_fee_revenue(transactions: DataFrame, accounts: DataFrame, fees: DataFrame,
                       broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per client with transactions: their number, the fees they brought, the mean fee
    per transaction (4 digits) and the type used most (of equals the first by name).

    Two levels: the sums per client and type are themselves reduced per client, so
    a client with a third of the transactions is summed on every task.
    """
    per_account = fees_by_account(transactions, fees, broadcast_rows)
    per_type = (per_account.join(accounts.select("account_id", "client_id"), "account_id")
                .groupBy("client_id", "transaction_type")
                .agg(F.sum("n").alias("n"), F.sum("fee").alias("fee")))
    most = F.min(F.struct((-F.col("n")).alias("less"), F.col("transaction_type").alias("t")))
    return per_type.groupBy(F.col("client_id").alias("client_fk")).agg(
        F.sum("n").alias("transaction_count"), F.sum("fee").cast("decimal(38,5)").alias("fee_revenue"),
        most.alias("_most")).select(
        "client_fk", "transaction_count", "fee_revenue",
        _per("fee_revenue", "transaction_count", 4).alias("mean_fee"),
        F.col("_most.t").alias("most_used_type"))


def agency_fee_revenue(transactions: DataFrame, accounts: DataFrame, fees: DataFrame,
                       broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per agency whose accounts have transactions: fees, clients, transactions and fees
    per client (2 digits)."""
    per_account = fees_by_account(transactions, fees, broadcast_rows).groupBy("account_id").agg(
        F.sum("n").alias("n"), F.sum("fee").alias("fee"))
    per_client = (per_account.join(accounts.select("account_id", "client_id", "agency_id"),
                                   "account_id")
                  .groupBy("agency_id", "client_id")
                  .agg(F.sum("n").alias("n"), F.sum("fee").alias("fee")))
    return per_client.groupBy(F.col("agency_id").alias("agency_fk")).agg(
        F.sum("fee").cast("decimal(38,5)").alias("fee_revenue"),
        F.count("client_id").alias("client_count"), F.sum("n").alias("transaction_count")) \
        .withColumn("fee_per_client", _per("fee_revenue", "client_count", 2))


def _per(fee: str, n: str, digits: int) -> Column:
    """Fees divided by a count, rounded half away from zero; NULL for none."""
    count = F.nullif(F.col(n), F.lit(0)).cast("decimal(18,0)")
    return F.round(F.col(fee).cast("decimal(28,5)") / count, digits)
