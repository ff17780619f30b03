"""Unit fixtures with hand-computed answers for the gold models."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from fixtures import (
    ACCOUNTS,
    AGENCIES,
    BRIDGE,
    CLIENTS,
    PROPOSALS,
    TX,
    D,
    account,
    client,
    proposal,
    recency_fixture,
    tx,
)

from ledgerlake.operators.activity import account_activity, transactions_by_account
from ledgerlake.operators.credit import agency_performance, credit_funnel, credit_kpis
from ledgerlake.operators.cross_sell import cross_sell
from ledgerlake.operators.drivers import driver_ranking
from ledgerlake.operators.engagement import client_engagement, commercial_kpis
from ledgerlake.operators.volume import daily_volume
from ledgerlake.plans import dashboards as dash


def test_account_activity_recency_edges(spark):
    accounts, _, txs, _ = recency_fixture(spark)
    rows = {r["account_sk"]: r for r in account_activity(accounts, transactions_by_account(txs)).collect()}
    assert [rows[i]["days_since_last_transaction"] for i in range(1, 6)] == [0, 90, 91, 360, 361]
    assert [rows[i]["activity_status"] for i in range(1, 7)] == [
        "active", "active", "dormant", "dormant", "dormant", "never_used"]
    assert rows[6]["days_since_last_transaction"] is None
    assert rows[6]["last_transaction_date"] is None


def test_engagement_recency_edges(spark):
    accounts, clients, txs, proposals = recency_fixture(spark)
    rows = {r["client_sk"]: r for r in
            client_engagement(clients, accounts, transactions_by_account(txs), proposals).collect()}
    assert [rows[i]["engagement_status"] for i in range(1, 7)] == [
        "active", "active", "at_risk", "at_risk", "churned", "never_used"]
    assert rows[6]["transaction_count"] == 0
    assert rows[6]["transaction_total_amount"] == 0
    assert rows[1]["avg_tx_per_account"] == Decimal("1.00")


def test_empty_transactions_all_never_used(spark):
    accounts = spark.createDataFrame([account(1, 1), account(2, 2)], ACCOUNTS)
    clients = spark.createDataFrame([client(1), client(2)], CLIENTS)
    txs = spark.createDataFrame([], TX)
    props = spark.createDataFrame([], PROPOSALS)
    act = account_activity(accounts, transactions_by_account(txs)).collect()
    assert {r["activity_status"] for r in act} == {"never_used"}
    assert all(r["days_since_last_transaction"] is None for r in act)
    eng = client_engagement(clients, accounts, transactions_by_account(txs), props).collect()
    assert {r["engagement_status"] for r in eng} == {"never_used"}
    assert all(r["relationship_days"] is None for r in eng)


def test_reference_date_counts_unknown_accounts(spark):
    # the newest transaction belongs to no known account; it still sets the reference date
    accounts = spark.createDataFrame([account(1, 1)], ACCOUNTS)
    txs = spark.createDataFrame([tx(1, 1, dt.datetime(2023, 1, 1)),
                                 tx(2, 99, dt.datetime(2023, 4, 11))], TX)
    row = account_activity(accounts, transactions_by_account(txs)).collect()[0]
    assert row["days_since_last_transaction"] == 100
    assert row["activity_status"] == "dormant"


def test_engagement_multi_account_totals_and_credit_flag(spark):
    accounts = spark.createDataFrame([account(1, 1, 100), account(2, 1, 50), account(3, 2, 70)],
                                     ACCOUNTS)
    clients = spark.createDataFrame([client(1), client(2), client(3)], CLIENTS)
    t0 = dt.datetime(2023, 1, 10)
    txs = spark.createDataFrame([tx(1, 1, t0, 5), tx(2, 1, t0, 5), tx(3, 2, t0, 1),
                                 tx(4, 3, t0 - dt.timedelta(days=10), 2)], TX)
    props = spark.createDataFrame([proposal(1, 2, "Aprovada"), proposal(2, 1, "Enviada"),
                                   proposal(3, 2, "Aprovada")], PROPOSALS)
    rows = {r["client_sk"]: r for r in client_engagement(clients, accounts, transactions_by_account(txs), props).collect()}
    assert set(rows) == {1, 2}  # client 3 has no account
    assert rows[1]["account_count"] == 2 and rows[1]["total_balance"] == D(150)
    assert rows[1]["transaction_count"] == 3 and rows[1]["transaction_total_amount"] == D(11)
    assert rows[1]["avg_tx_per_account"] == Decimal("1.50")
    assert rows[1]["has_approved_credit"] is False and rows[2]["has_approved_credit"] is True
    assert rows[2]["days_since_last_transaction"] == 10


def test_orphan_client_absent_from_engagement_and_cross_sell(spark):
    accounts = spark.createDataFrame([account(1, 1, 30000), account(2, 528, 50000)], ACCOUNTS)
    clients = spark.createDataFrame([client(1)], CLIENTS)
    txs = spark.createDataFrame([tx(1, 2, dt.datetime(2023, 1, 1))], TX)
    props = spark.createDataFrame([proposal(1, 528, "Em análise", amount=74000)], PROPOSALS)
    eng = client_engagement(clients, accounts, transactions_by_account(txs), props).collect()
    assert [r["client_sk"] for r in eng] == [1]
    cs = cross_sell(accounts, clients, props).collect()
    assert [r["account_fk"] for r in cs] == [1]


def test_cross_sell_balance_edge_and_two_accounts(spark):
    accounts = spark.createDataFrame([
        account(1, 1, "20000.00"), account(2, 2, "20000.01"),
        account(3, 3, 25000), account(4, 3, 30000),   # two accounts of one client
        account(5, 4, 90000),                          # client with approved credit
    ], ACCOUNTS)
    clients = spark.createDataFrame([client(i) for i in range(1, 5)], CLIENTS)
    props = spark.createDataFrame([proposal(1, 4, "Aprovada"), proposal(2, 3, "Enviada")],
                                  PROPOSALS)
    opportunities = cross_sell(accounts, clients, props)
    rows = sorted(r["account_fk"] for r in opportunities.collect())
    assert rows == [2, 3, 4]
    # the declared uniqueness of client_fk fails when a client has two such accounts
    from ledgerlake.operators.quality import Check, run_checks
    res = run_checks([Check("unique", "cross_sell", "client_fk")], {"cross_sell": opportunities})
    assert [(r["status"], r["failures"]) for r in res.collect()] == [("fail", 1)]


def test_credit_funnel_and_unweighted_mean(spark):
    jan, feb = dt.datetime(2023, 1, 31, 23, 59, 59), dt.datetime(2023, 2, 1, 0, 0, 0)
    props = ([proposal(1, 1, "Aprovada", rate="0.02", at=jan, amount=100)]
             + [proposal(10 + i, 1, "Enviada", rate="0.01", at=feb, amount=10) for i in range(9)])
    funnel = credit_funnel(spark.createDataFrame(props, PROPOSALS))
    rows = {(r["month"], r["proposal_status"]): r for r in funnel.collect()}
    assert set(rows) == {(dt.datetime(2023, 1, 1), "Aprovada"), (dt.datetime(2023, 2, 1), "Enviada")}
    assert rows[(dt.datetime(2023, 2, 1), "Enviada")]["proposal_count"] == 9
    kpi = credit_kpis(funnel).collect()[0]
    assert kpi["total_proposals"] == 10 and kpi["approved_proposals"] == 1
    assert kpi["rejected_proposals"] == 9
    assert kpi["approval_rate_pct"] == Decimal("10.00")
    assert kpi["total_financed_amount"] == Decimal("100.00")
    # mean of the group means (2 % and 1 %), not the weighted 1.1 %
    assert kpi["avg_interest_rate_pct"] == Decimal("1.5000")


def test_null_status_in_neither_bucket(spark):
    props = spark.createDataFrame([proposal(1, 1, None), proposal(2, 1, "Aprovada")], PROPOSALS)
    kpis = credit_kpis(credit_funnel(props))
    kpi = kpis.collect()[0]
    assert kpi["total_proposals"] == 2
    assert kpi["approved_proposals"] == 1 and kpi["rejected_proposals"] == 0
    # so the declared expression test of the KPI table fails
    from ledgerlake.operators.quality import Check, run_checks
    check = Check("expression", "credit_kpis",
                  expression="total_proposals = approved_proposals + rejected_proposals")
    res = run_checks([check], {"credit_kpis": kpis}).collect()[0]
    assert (res["status"], res["failures"]) == ("fail", 1)


def test_agency_bridge_fan_out(spark):
    agencies = spark.createDataFrame(
        [(a, f"Agency {a}", None, None, None, None, "Digital") for a in (1, 2, 3)], AGENCIES)
    # employee 10 works in agencies 1 and 2; employee 20 has no agency; agency 3 has nobody
    bridge = spark.createDataFrame([(10, 1), (10, 2)], BRIDGE)
    props = spark.createDataFrame([
        proposal(1, 1, "Aprovada", employee_id=10, amount=100),
        proposal(2, 1, "Enviada", employee_id=10, amount=50),
        proposal(3, 1, "Aprovada", employee_id=20, amount=999),
    ], PROPOSALS)
    rows = {r["agency_sk"]: r for r in agency_performance(agencies, bridge, props).collect()}
    for a in (1, 2):
        assert rows[a]["total_proposals"] == 2 and rows[a]["approved_proposals"] == 1
        assert rows[a]["conversion_rate_pct"] == Decimal("50.00")
        assert rows[a]["total_proposal_amount"] == D(150)
    assert rows[3]["total_proposals"] == 0 and rows[3]["approved_proposals"] == 0
    assert rows[3]["conversion_rate_pct"] is None and rows[3]["total_proposal_amount"] is None
    # NULL conversion sorts first when descending
    order = [r["agency_sk"] for r in dash.dash_agency_ranking(
        agency_performance(agencies, bridge, props)).collect()]
    assert order == [3, 1, 2]


def test_daily_volume_utc_day_edges(spark):
    t = [tx(1, 1, dt.datetime(2022, 12, 31, 23, 59, 59)), tx(2, 2, dt.datetime(2022, 12, 31, 0, 0)),
         tx(3, 1, dt.datetime(2023, 1, 1, 0, 0)), tx(4, 1, dt.datetime(2022, 12, 31, 12, 0))]
    rows = {(r["transaction_date"], r["transaction_type"]): r
            for r in daily_volume(spark.createDataFrame(t, TX)).collect()}
    d31 = rows[(dt.date(2022, 12, 31), "PIX")]
    assert d31["transaction_count"] == 3 and d31["distinct_accounts"] == 2
    assert d31["avg_tx_per_account"] == Decimal("1.50")
    assert rows[(dt.date(2023, 1, 1), "PIX")]["transaction_count"] == 1


def _engagement_rows(spark, rows):
    schema = ("client_sk long, transaction_count long, total_balance decimal(18,2), "
              "relationship_days int, account_count long, has_approved_credit boolean")
    return spark.createDataFrame(rows, schema)


def test_driver_ranking_zero_variance_dropped_and_dense(spark):
    eng = _engagement_rows(spark, [
        (1, 10, D(100), 30, 1, True), (2, 20, D(300), 10, 1, False), (3, 35, D(200), 50, 1, True)])
    rows = driver_ranking(eng).collect()
    drivers = {r["driver"] for r in rows}
    assert "quantidade_contas" not in drivers and len(drivers) == 3
    assert sorted(r["impact_rank"] for r in rows) == [1, 2, 3]
    assert all(r["sample_size"] == 3 for r in rows)


def test_driver_ranking_perfect_correlation(spark):
    eng = _engagement_rows(spark, [(i, 2 * i, D(i), i, 1 + i % 2, i % 2 == 0) for i in range(1, 8)])
    rows = {r["driver"]: r for r in driver_ranking(eng).collect()}
    r = rows["saldo_total"]
    assert r["correlation"] == Decimal("1.0000") and r["direction"] == "positivo"
    assert r["t_statistic"] is None and r["significant_at_5pct"] is None
    assert r["r_squared_pct"] == Decimal("100.00") and r["impact_rank"] == 1


def test_driver_ranking_nullable_pair(spark):
    eng = _engagement_rows(spark, [
        (1, 1, D(10), 1, 1, True), (2, 2, None, 5, 1, False), (3, 3, D(30), 2, 1, True),
        (4, 5, D(20), 9, 1, False)])
    rows = {r["driver"]: r for r in driver_ranking(eng).collect()}
    # pairwise: client 2 is ignored for the balance correlation but counts in n
    xs, ys = [10, 30, 20], [1, 3, 5]
    mx, my = sum(xs) / 3, sum(ys) / 3
    cov = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
    r = cov / (sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys)) ** 0.5
    assert rows["saldo_total"]["correlation"] == Decimal(str(round(r, 4)))
    assert rows["saldo_total"]["sample_size"] == 4


def test_commercial_kpis_partition(spark):
    accounts, clients, txs, props = recency_fixture(spark)
    kpi = commercial_kpis(client_engagement(clients, accounts, transactions_by_account(txs), props)).collect()[0]
    assert kpi["total_clientes"] == 6
    assert (kpi["clientes_ativos"], kpi["clientes_em_risco"], kpi["clientes_churned"],
            kpi["clientes_sem_uso"]) == (2, 2, 1, 1)
    assert kpi["taxa_ativos_pct"] == Decimal("33.33")
    assert kpi["taxa_inativos_pct"] == Decimal("50.00")
    assert kpi["media_transacoes_por_cliente"] == Decimal("0.83")
    assert kpi["taxa_posse_credito_pct"] == Decimal("0.00")


def test_top20_tie_break_is_deterministic(spark):
    schema = ("client_sk long, client_full_name string, total_balance decimal(18,2), "
              "transaction_count long, days_since_last_transaction int, engagement_status string")
    rows = [(i, f"c{i}", D(5000), 1, 100, "at_risk") for i in range(21, 0, -1)]
    eng = spark.createDataFrame(rows, schema)
    got = [r["client_sk"] for r in dash.dash_top20_at_risk(eng).collect()]
    assert got == list(range(1, 21))


def test_volume_anomaly_uses_all_history(spark):
    schema = ("transaction_date date, transaction_type string, transaction_count long, "
              "distinct_accounts long, avg_tx_per_account decimal(10,2)")
    rows = [(dt.date(2022, 11, d), "PIX", 10, 5, D("2.00")) for d in range(1, 29)]
    rows.append((dt.date(2022, 12, 1), "PIX", 100, 5, D("20.00")))
    rows.append((dt.date(2022, 12, 2), "PIX", 10, 5, D("2.00")))
    out = dash.dash_volume_anomaly(spark.createDataFrame(rows, schema)).collect()
    assert [(r["transaction_date"].day, r["flag"]) for r in out] == [(1, "ANOMALY"), (2, "NORMAL")]


def test_driver_table_display_headers(spark):
    eng = _engagement_rows(spark, [(i, i % 3 + i, D(i * 7 % 5), i, 1 + i % 2, i % 2 == 0)
                                   for i in range(1, 30)])
    table = dash.dash_driver_table(driver_ranking(eng))
    assert table.columns == ["#", "Alavanca", "r (Pearson)", "r² (variância explicada)",
                             "Significativo (p<0,05)?", "Veredito", "n (clientes)"]
    first = table.collect()[0]
    assert first["r² (variância explicada)"].endswith("%")
    assert first["Significativo (p<0,05)?"] in ("Sim", "Não")
