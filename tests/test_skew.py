"""A key holding a third of all rows: results stay whole and exact, plans split the hot key."""

from __future__ import annotations

import datetime as dt
import os
from collections import defaultdict
from decimal import Decimal

import pytest
from fixtures import ACCOUNTS, CLIENTS, PROPOSALS, TX, account, client, proposal, tx

from pyspark.sql import functions as F

from ledgerlake.operators.activity import transactions_by_account
from ledgerlake.operators.cross_sell import cross_sell
from ledgerlake.operators.engagement import client_engagement
from ledgerlake.operators.volume import daily_volume
from ledgerlake.plans.models import Models
from ledgerlake.sources.crosswalk import RawLayer

N = 3000
HOT = 1


@pytest.fixture
def skew_conf(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _data(spark):
    # client 1 owns a third of the accounts; every account has two transactions,
    # and a third of all transactions fall on one day
    accounts, txs = [], []
    for a in range(1, N + 1):
        owner = HOT if a % 3 == 0 else 1000 + a
        accounts.append(account(a, owner, 20000 + a))
        day = dt.datetime(2023, 6, 1) if a % 3 == 0 else dt.datetime(2023, 1, 1) + dt.timedelta(days=a % 90)
        txs += [tx(2 * a, a, day, 1), tx(2 * a + 1, a, day, 2)]
    clients = [client(HOT)] + [client(1000 + a) for a in range(1, N + 1) if a % 3 != 0]
    props = [proposal(1, 1000 + 1, "Aprovada")]
    return (spark.createDataFrame(accounts, ACCOUNTS), spark.createDataFrame(clients, CLIENTS),
            spark.createDataFrame(txs, TX), spark.createDataFrame(props, PROPOSALS), accounts, txs)


@pytest.mark.parametrize("most", [0, 1, 32])
def test_cross_sell_hot_client(spark, skew_conf, most):
    accounts, clients, txs, props, acc_rows, _ = _data(spark)
    rows = cross_sell(accounts, clients, props, salted_clients=most).collect()
    expected = sorted(a[0] for a in acc_rows if a[1] != 1001)
    assert sorted(r["account_fk"] for r in rows) == expected
    assert sum(1 for r in rows if r["client_fk"] == HOT) == N // 3


def test_cross_sell_deals_a_hot_client_through_the_crosswalk(spark, skew_conf, scratch):
    """A third of ``orders`` on one client: no task of the result holds much more than its share."""
    src, folder = "/root/testdata/sf0.01", os.path.join(scratch, "skewed")
    for t in ("customer", "lineitem"):
        spark.read.parquet(f"{src}/{t}.parquet").write.mode("overwrite").parquet(f"{folder}/{t}.parquet")
    orders = spark.read.parquet(f"{src}/orders.parquet")
    third = F.col("o_orderkey") % 3 == 0
    orders.withColumn("o_custkey", F.when(third, F.lit(1)).otherwise(F.col("o_custkey"))) \
        .write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    models = Models(RawLayer(spark, folder))
    # no client has an approved proposal here, so all large accounts are candidates
    out = cross_sell(models["stg_accounts"], models["stg_clients"], models["stg_proposals"],
                     approved="none")
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    hot = out.where("client_fk = 1").count()
    assert sum(sizes) == models["stg_accounts"].where("total_balance > 20000").count()
    assert hot > 0.3 * sum(sizes)
    assert max(sizes) < 0.3 * sum(sizes)  # 8 partitions; without salting one holds over a third
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_engagement_hot_client_matches_brute_force(spark, skew_conf):
    accounts, clients, txs, props, acc_rows, tx_rows = _data(spark)
    eng = {r["client_sk"]: r for r in client_engagement(
        clients, accounts.repartition(8), transactions_by_account(txs.repartition(8)),
        props).collect()}
    owner = {a[0]: a[1] for a in acc_rows}
    count, amount = defaultdict(int), defaultdict(Decimal)
    for t in tx_rows:
        count[owner[t[1]]] += 1
        amount[owner[t[1]]] += t[4]
    assert len(eng) == 1 + N - N // 3
    assert eng[HOT]["account_count"] == N // 3
    assert eng[HOT]["transaction_count"] == count[HOT] == 2 * (N // 3)
    assert eng[HOT]["transaction_total_amount"] == amount[HOT]
    assert all(eng[c]["transaction_count"] == count[c] for c in eng)


def test_daily_volume_hot_day(spark, skew_conf):
    _, _, txs, _, acc_rows, tx_rows = _data(spark)
    vol = {r["transaction_date"]: r for r in daily_volume(txs.repartition(8)).collect()}
    hot = vol[dt.date(2023, 6, 1)]
    assert hot["transaction_count"] == 2 * (N // 3)
    assert hot["distinct_accounts"] == N // 3
    assert hot["avg_tx_per_account"] == Decimal("2.00")
    assert sum(r["transaction_count"] for r in vol.values()) == len(tx_rows)
