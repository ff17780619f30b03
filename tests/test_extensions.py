"""Planned marts: gaps between transactions, distribution statistics, fee revenue; the joins
and sequences they rest on. Brute force, and a third of all rows on one key."""

from __future__ import annotations

import datetime as dt
import random
import statistics
from collections import Counter, defaultdict
from decimal import Decimal
from fractions import Fraction

import pytest
from fixtures import ACCOUNTS, TX, account, tx
from pyspark.sql import functions as F

from ledgerlake.operators import joins
from ledgerlake.operators.distribution import transaction_statistics, values_at_ranks
from ledgerlake.operators.fees import FEES, agency_fee_revenue, client_fee_revenue, fee_table
from ledgerlake.operators.gaps import account_alerts, transaction_gaps
from ledgerlake.operators.joins import frequent_keys, lookup_join
from ledgerlake.operators.sequences import previous_rows
from ledgerlake.plans.models import EXTENSIONS, Models

START = dt.datetime(2024, 1, 1)


def _transactions(spark, n=3000, seed=1):
    """A third of the transactions on account 1; odd rows: no account, no time, equal times."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        account_id = 1 if i % 3 == 0 else rnd.randrange(2, 60)
        at = START + dt.timedelta(seconds=rnd.randrange(40_000), microseconds=rnd.choice([0, 1, 500_000]))
        rows.append((i, account_id, at, rnd.choice(["PIX", "TED", "Saque"]),
                     Decimal(rnd.randrange(1, 10_000_000)) / 100))
    rows += [(n + i, None, START + dt.timedelta(seconds=30 * i), "DOC", Decimal("1.00")) for i in range(5)]
    rows += [(n + 10 + i, 7, None, "TED", None) for i in range(3)]
    rows += [(n + 20 + i, 8, START, "PIX", Decimal("2.00")) for i in range(4)]
    rows += [(n + 30, 9, START, None, Decimal("3.00"))]
    return rows, spark.createDataFrame(rows, TX).repartition(5)


def _brute_gaps(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    out = {}
    late = dt.datetime.max
    for own in by.values():
        before = None
        for k, r in enumerate(sorted(own, key=lambda r: (r[2] or late, r[0]))):
            prev = before if k else None
            gap = None if r[2] is None or prev is None else (r[2] - prev).total_seconds()
            flag = "normal" if gap is None or gap > 300 else "suspeita_alta" if gap < 60 else "suspeita_media"
            out[r[0]] = (prev, gap, flag)
            before = r[2]
    return out


@pytest.mark.parametrize("ranges", [1, 8, 40])
def test_gaps_equal_brute_force(spark, ranges):
    rows, df = _transactions(spark)
    got = transaction_gaps(df, ranges=ranges).collect()
    want = _brute_gaps(rows)
    assert len(got) == len(want)
    for r in got:
        gap = None if r["seconds_since_prev"] is None else float(r["seconds_since_prev"])
        assert (r["prev_transaction_at"], gap, r["fraud_flag"]) == want[r["transaction_id"]]
    assert transaction_gaps(df.where("false")).count() == 0


def test_no_task_holds_a_hot_account(spark):
    rows, df = _transactions(spark, n=6000)
    gaps = transaction_gaps(df, ranges=24)
    files = gaps.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()
    hot = sum(r[1] == 1 for r in rows)
    assert hot >= len(rows) / 3.1
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    assert "Window [lag(transaction_at" not in plan  # no window over an account
    # the ranges themselves: of the hot account's rows, none holds more than a small part
    dealt = df.repartitionByRange(24, "account_id", "transaction_at", "transaction_id")
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(
        F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 0.3 * hot and len(files) >= 1


def test_previous_rows_across_empty_and_tiny_ranges(spark):
    rows = [(1, i, f"v{i}") for i in range(7)] + [(None, 1, "a"), (None, None, "b"), (2, 1, "c")]
    df = spark.createDataFrame(rows, "k long, o long, v string")
    got = {(r["k"], r["o"]): r["p"] for r in
           previous_rows(df, ["k"], ["o"], {"v": "p"}, ranges=30).collect()}
    assert got == {**{(1, i): f"v{i - 1}" if i else None for i in range(7)},
                   (None, 1): None, (None, None): "a", (2, 1): None}


def test_alerts_per_account(spark):
    rows, df = _transactions(spark)
    want = _brute_gaps(rows)
    got = {r["account_id"]: r for r in account_alerts(transaction_gaps(df)).collect()}
    for account_id in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == account_id]
        flags = Counter(want[r[0]][2] for r in own)
        alerts = [r for r in own if want[r[0]][2] != "normal"]
        r = got[account_id]
        assert (r["transaction_count"], r["high_alerts"], r["medium_alerts"]) == (
            len(own), flags["suspeita_alta"], flags["suspeita_media"])
        assert r["alert_amount"] == sum((a[4] or 0 for a in alerts), Decimal(0))
        assert r["last_alert_date"] == max((a[2].date() for a in alerts), default=None)


# --- distribution ---------------------------------------------------------------


def _percentile(values, p):
    values = sorted(values)
    at = Fraction(p * (len(values) - 1), 100)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return Fraction(values[low]) + (Fraction(values[high]) - Fraction(values[low])) * (at - low)


@pytest.mark.parametrize("steps", [50, 1024])
def test_statistics_equal_brute_force(spark, steps):
    rows, df = _transactions(spark, n=900)
    extra = [(9000 + i, 1, START, "one", Decimal("5.55")) for i in range(1)]
    extra += [(9100 + i, 1, START, "equal", Decimal("-7.10")) for i in range(50)]
    extra += [(9200 + i, 1, START, "skewed", Decimal("0.01") if i else Decimal("900000000000.00"))
              for i in range(40)]
    extra += [(9300, 1, START, "none", None)]
    rows += extra
    df = df.union(spark.createDataFrame(extra, TX))
    got = {(r["scope"], r["transaction_type"]): r for r in
           transaction_statistics(df, steps=steps).collect()}
    groups = {("all", None): rows, **{("type", t): [r for r in rows if r[3] == t]
                                      for t in {r[3] for r in rows}}}
    assert set(got) == set(groups)
    for key, own in groups.items():
        values, r = [x[4] for x in own if x[4] is not None], got[key]
        assert r["transaction_count"] == len(values)
        if not values:
            assert r["median_amount"] is None and r["mean_amount"] is None and r["is_skewed"] is None
            continue
        assert Fraction(r["median_amount"]) == _percentile(values, 50)
        assert Fraction(r["p95_amount"]) == _percentile(values, 95)
        assert (r["min_amount"], r["max_amount"]) == (min(values), max(values))
        mean = Fraction(sum(values)) / len(values)
        assert abs(Fraction(r["mean_amount"]) - mean) <= Fraction(1, 20000)
        if len(values) == 1:
            assert r["variance_amount"] is None
            continue
        spread = statistics.variance([Fraction(v) for v in values])
        assert r["variance_amount"] == pytest.approx(float(spread), rel=1e-12, abs=0.005)
        assert r["is_skewed"] == (spread > 4 * mean ** 2 if mean >= 0 else True)
    assert transaction_statistics(df.where("false")).collect() == []
    assert [r["transaction_count"] for r in
            transaction_statistics(df.where("transaction_type = 'none'")).collect()] == [0, 0]


def test_ranks_of_a_scope_with_nearly_all_rows(spark):
    rows = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 100 == 0, "b").otherwise("a").alias("scope"), (F.col("id") % 997).alias("v"))
    wanted = spark.createDataFrame([("a", 0), ("a", 9_900), ("b", 100)], "scope string, rank long")
    found = values_at_ranks(rows, wanted, 0, 996, 2, steps=32)
    a = sorted(i % 997 for i in range(20_000) if i % 100)
    b = sorted(i % 997 for i in range(20_000) if not i % 100)
    assert {(r["scope"], r["rank"]): r["v"] for r in found.collect()} == {
        ("a", 0): a[0], ("a", 9_900): a[9_900], ("b", 100): b[100]}


# --- look-ups and frequent keys ---------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("most", [0, 100])
def test_lookup_join_is_the_same_either_way(spark, how, most):
    big = spark.range(0, 3000, 1, 4).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(
        F.col("id") % 50).alias("k"))
    side = spark.createDataFrame([(k, f"n{k}") for k in range(0, 40)], "k long, name string")
    got = lookup_join(big, side, ["k"], ["id"], how, most=most)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (most > 0)
    names = {k: f"n{k}" for k in range(40)}
    keys = {i: 1 if i % 3 == 0 else i % 50 for i in range(3000)}
    want = {(i, k, names.get(k)) for i, k in keys.items() if how == "left" or k in names}
    rows = [(r["id"], r["k"], r["name"]) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want
    with pytest.raises(ValueError, match="outer"):
        lookup_join(big, side, ["k"], ["id"], "outer")


def test_a_large_side_deals_a_hot_key(spark):
    big = spark.range(0, 4000, 1, 4).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(
        F.col("id")).alias("k"))
    side = spark.range(0, 4000).select(F.col("id").alias("k"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["n"] for r in lookup_join(big, side, ["k"], ["id"], most=10).groupBy(
            F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sum(sizes) == 4000 and max(sizes) < 0.3 * 4000


def test_forty_frequent_keys_are_found_in_one_pass(spark):
    # 40 keys with 1 % of the rows each, the rest all different, and many NULLs
    rows = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 10 < 4, F.col("id") % 100).when(F.col("id") % 10 == 9, None)
        .otherwise(F.col("id") + 1_000_000).alias("k"))
    counts = Counter(i % 100 for i in range(40_000) if i % 10 < 4)
    known = 40_000 - 4_000
    want = {k for k, n in counts.items() if n >= 0.01 * known}
    assert len(want) == 40
    assert set(frequent_keys(rows, "k", 0.01)) == want
    assert frequent_keys(rows, "k", 0.02) == []
    assert frequent_keys(rows, "k", 0.01, most=3) == sorted(want)[:3]
    assert frequent_keys(rows.where("false"), "k", 0.01) == []


def test_frequent_keys_need_no_shuffle_of_all_keys(spark):
    """The summary is one global aggregate: its exchange carries a row per task."""
    rows = spark.range(0, 1000, 1, 8).withColumnRenamed("id", "k")
    plan = rows.agg(F.expr("approx_top_k(k, 4, 64)"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan and "SinglePartition" in plan
    assert joins.FREQUENT_PART < 1


# --- fees ------------------------------------------------------------------------


@pytest.mark.parametrize("most", [0, 100])
def test_fee_revenue_equals_brute_force(spark, most):
    rows, df = _transactions(spark)
    fees = fee_table(spark, [*FEES[:2], ("Saque", "2.50", "0.015", "")])
    accounts = [account(a, 100 if a == 1 else 100 + a % 9, a) for a in range(1, 60)]
    acc = spark.createDataFrame(accounts, ACCOUNTS)
    price = {"PIX": (0, 0), "TED": (12, 0), "Saque": (Decimal("2.50"), Decimal("0.015"))}
    owner = {a[0]: (a[1], a[2]) for a in accounts}
    revenue, n, types = defaultdict(Decimal), Counter(), defaultdict(Counter)
    agency, clients = defaultdict(Decimal), defaultdict(set)
    for _, a, _, kind, amount in rows:
        if a in owner:
            fixed, share = price.get(kind, (0, 0))
            fee = Decimal(fixed) + Decimal(share) * (amount or 0)
            client = owner[a][0]
            revenue[client] += fee
            n[client] += 1
            types[client][kind] += 1
    got = {r["client_fk"]: r for r in client_fee_revenue(df, acc, fees, most).collect()}
    assert {c: r["fee_revenue"] for c, r in got.items()} == revenue
    assert {c: r["transaction_count"] for c, r in got.items()} == dict(n)
    for c, r in got.items():
        top = max(types[c].values())
        assert r["most_used_type"] == min(t for t, k in types[c].items() if k == top)
        assert abs(r["mean_fee"] - revenue[c] / n[c]) <= Decimal("0.00005")
    by_agency = {r["agency_fk"]: r for r in agency_fee_revenue(df, acc, fees, most).collect()}
    agency_of = {a["account_id"]: (a["agency_id"], a["client_id"]) for a in acc.collect()}
    for _, a, _, kind, amount in rows:
        if a in agency_of:
            fixed, share = price.get(kind, (0, 0))
            agency[agency_of[a][0]] += Decimal(fixed) + Decimal(share) * (amount or 0)
            clients[agency_of[a][0]].add(agency_of[a][1])
    assert {k: r["fee_revenue"] for k, r in by_agency.items()} == agency
    assert {k: r["client_count"] for k, r in by_agency.items()} == {k: len(v) for k, v in clients.items()}


def test_pix_is_free_by_default(spark):
    free = fee_table(spark).where("fixed_fee = 0 AND amount_share = 0").collect()
    assert {r["transaction_type"] for r in free} == {"PIX", "Depósito"}
    raw = {"transacoes": spark.createDataFrame(
        [tx(1, 1, START, 10)], TX).selectExpr(
            "transaction_id AS cod_transacao", "account_id AS num_conta",
            "transaction_at AS data_transacao", "'PIX' AS nome_transacao",
            "transaction_amount AS valor_transacao")}
    assert Models(raw)["tarifas_transacao"].count() == len(FEES)


def test_every_planned_mart_is_described():
    for name, (builder, _) in EXTENSIONS.items():
        assert builder.__doc__ and len(builder.__doc__.strip()) > 20, name
