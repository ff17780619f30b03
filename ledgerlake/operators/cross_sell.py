"""Cross-sell opportunities (M-08)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.credit import APPROVED, approved_clients
from ledgerlake.operators.joins import join_salting_frequent_keys

# Fixed value: balance above which an account is a cross-sell candidate (strict).
MIN_BALANCE = 20000


def cross_sell(accounts: DataFrame, clients: DataFrame, proposals: DataFrame,
               min_balance: int | float = MIN_BALANCE, approved: str = APPROVED,
               hot_share: float | None = None, salted_clients: int | None = None) -> DataFrame:
    """M-08: one row per account with balance above ``min_balance`` whose client
    exists and has no approved proposal.

    The grain is the account: a client with two such accounts gives two rows.

    Plan: "no approved proposal" is a left anti join (not an outer join plus a
    NULL filter) between two client-sized relations, clients and distinct
    approved clients. The accounts, filtered on balance in the scan, then meet
    the eligible clients in one join on client and salt: the accounts of
    clients that hold at least ``hot_share`` of them (by default a quarter of a
    partition's even share) are dealt over all partitions, so a client holding a
    third of the accounts does not end up in one task (``salted_clients`` limits
    their number). Building the plan runs
    two narrow jobs, which find those clients (a bounded summary, then a count
    of the few it names).
    """
    acc = (accounts.where(F.col("total_balance") > F.lit(min_balance))
           .select("account_id", "client_id", "total_balance", "agency_id"))
    eligible = (clients.select("client_id", "client_full_name")
                .join(approved_clients(proposals, approved), "client_id", "left_anti"))
    joined = join_salting_frequent_keys(acc, eligible, "client_id", "account_id", hot_share,
                                        most=salted_clients)
    return joined.select(
        F.col("client_id").alias("client_fk"),
        "client_full_name",
        F.col("account_id").alias("account_fk"),
        "total_balance",
        F.col("agency_id").alias("agency_fk"),
    )
