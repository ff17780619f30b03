"""Physical-plan properties the models rely on for scale."""

from __future__ import annotations

from ledgerlake.plans.models import Models
from ledgerlake.plans.registry import models_for
from ledgerlake.sources.crosswalk import RawLayer

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cross_sell_is_anti_join_with_pushed_balance_filter(spark):
    m = models_for(spark, SF)
    opt = _optimized(m["cross_sell"])
    assert "LeftAnti" in opt
    assert opt.count("LeftOuter") == 1  # the crosswalk's agency look-up


def test_driver_ranking_single_scan_of_engagement(spark):
    m = models_for(spark, SF)
    plan = _plan(m["driver_ranking"])
    # engagement is aggregated once for every driver (no union of four aggregates)
    assert "Union" not in plan
    assert plan.count("Expand") == 1  # the unpivot


def test_engagement_pre_aggregates_transactions_per_account(spark):
    m = models_for(spark, SF)
    opt = _optimized(m["client_engagement"])
    # transactions reach the join already grouped by account id
    join = opt.rindex("LeftOuter, (account_id")
    assert "Aggregate [" in opt[join:] and "sum(" in opt[join:]  # below the join


def test_transactions_are_scanned_once(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        m = Models(RawLayer(spark, SF, "events"))
        for name in ("account_activity", "client_engagement"):
            plan = _plan(m[name])
            scans = [x for x in plan.splitlines() if "FileScan" in x and "events.parquet" in x]
            assert len(scans) == 1, plan
            assert "ReusedExchange" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_scans_are_pruned(spark):
    m = models_for(spark, SF)
    plan = _plan(m["credit_funnel"])
    # only the columns the funnel needs are read from lineitem
    lineitem_scan = [line for line in plan.splitlines() if "lineitem" in line and "FileScan" in line]
    assert lineitem_scan, plan
    assert "l_partkey" not in lineitem_scan[0] and "l_tax" not in lineitem_scan[0]


def test_no_cross_joins_reference_date_is_a_scalar_subquery(spark):
    m = models_for(spark, SF)
    for name in ("account_activity", "client_engagement"):
        plan = _plan(m[name])
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "Subquery" in plan


def test_unread_joins_are_dropped(spark):
    """No proposal query that reads no client shuffles the lines to fetch one."""
    m = models_for(spark, SF)
    for name in ("credit_funnel", "credit_kpis"):
        opt = _optimized(m[name])
        assert "Join" not in opt and "orders" not in opt, name
    assert "customer" not in _optimized(m["stg_accounts"].select("account_id", "client_id"))
    # where the client is read, its join is one on the order
    assert "Join" in _optimized(m["stg_proposals"].select("client_id"))
