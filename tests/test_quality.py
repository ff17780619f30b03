"""Generic checks V-01 … V-07, the live dashboard checks and the load checks."""

from __future__ import annotations

from fixtures import ACCOUNTS, CLIENTS, PROPOSALS, account, client, proposal

from ledgerlake.operators.quality import (
    Check,
    audit_rows,
    check_expected_counts,
    check_pk_duplicates,
    check_pk_not_null,
    check_rank_dense,
    check_row_parity,
    check_single_row,
    declared_checks,
    quality_dashboard,
    run_checks,
)


def _statuses(spark, checks, tables):
    return {r["test_name"]: (r["status"], r["failures"]) for r in run_checks(checks, tables).collect()}


def test_declared_suite_has_69_tests():
    checks = declared_checks()
    assert len(checks) == 69
    assert sum(c.severity == "warn" for c in checks) == 2


def test_each_generic_check_pass_fail_and_nulls(spark):
    good = spark.createDataFrame([(1, "a", 5), (2, "b", 7)], "k long, v string, n int")
    bad = spark.createDataFrame([(1, "a", 5), (1, "z", 700), (None, None, None)],
                                "k long, v string, n int")
    nulls = spark.createDataFrame([(None, None, None), (3, "a", 1)], "k long, v string, n int")
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    tables = {"good": good, "bad": bad, "nulls": nulls, "parent": parent}

    def suite(model):
        return [
            Check("unique", model, "k"),
            Check("not_null", model, "k"),
            Check("relationships", model, "k", to="parent", to_column="k"),
            Check("accepted_values", model, "v", values=("a", "b")),
            Check("unique_combination", model, columns=("k", "v")),
            Check("expression", model, expression="n < 100"),
            Check("range", model, "n", min_value=0, max_value=10),
        ]

    got = _statuses(spark, suite("good") + suite("bad") + suite("nulls"), tables)
    assert all(s == ("pass", 0) for name, s in got.items() if "_good_" in name)
    bad = {n.split("_bad_")[0]: s for n, s in got.items() if "_bad_" in n}
    assert bad == {"unique": ("fail", 1), "not_null": ("fail", 1), "relationships": ("pass", 0),
                   "accepted_values": ("fail", 1), "unique_combination": ("pass", 0),
                   "expression": ("fail", 1), "range": ("fail", 1)}
    nul = {n.split("_nulls_")[0]: s for n, s in got.items() if "_nulls_" in n}
    # NULLs pass every test but not_null; the relationship test fails on key 3 only
    assert nul == {"unique": ("pass", 0), "not_null": ("fail", 1), "relationships": ("fail", 1),
                   "accepted_values": ("pass", 0), "unique_combination": ("pass", 0),
                   "expression": ("pass", 0), "range": ("pass", 0)}


def test_relationship_warn_severity_and_audit_rows(spark):
    accounts = spark.createDataFrame([account(1, 1), account(2, 528)], ACCOUNTS)
    clients = spark.createDataFrame([client(1)], CLIENTS)
    check = Check("relationships", "stg_accounts", "client_id", to="stg_clients",
                  to_column="client_id", severity="warn")
    res = run_checks([check], {"stg_accounts": accounts, "stg_clients": clients})
    row = res.collect()[0]
    assert (row["status"], row["failures"]) == ("warn", 1)
    assert row["message"] == "Got 1 result, configured to warn if != 0"
    audit = audit_rows(res).collect()[0]
    assert audit["column_name"] == "client_id" and audit["executed_at"] is not None


def test_quality_dashboard_orphans_and_strict_parity(spark):
    clients = spark.createDataFrame([client(1), client(2), client(2)], CLIENTS)
    agencies = spark.createDataFrame([(1, "A", None, None, None, None, "x")],
                                     "agency_id long, agency_name string, address string, "
                                     "city string, state string, opening_date date, agency_type string")
    accounts = spark.createDataFrame([account(1, 1), account(2, 528), account(3, None)], ACCOUNTS)
    props = spark.createDataFrame([proposal(1, 528), proposal(None, 1), proposal(None, 1)],
                                  PROPOSALS)
    rows = {(r["model_name"], r["column_name"], r["test_type"]): r
            for r in quality_dashboard(clients, agencies, accounts, props).collect()}
    orphan = rows[("stg_accounts", "client_id", "relationships")]
    assert orphan["failure_count"] == 2  # unknown 528 and the NULL client id
    assert orphan["message"] == "Found 2 account(s) referencing non-existent client(s)"
    assert rows[("stg_clients", "client_id", "unique")]["failure_count"] == 1
    assert rows[("stg_proposals", "proposal_id", "not_null")]["failure_count"] == 2
    assert rows[("stg_proposals", "proposal_id", "unique")]["failure_count"] == 1  # NULLs group
    c1 = spark.createDataFrame([client(1)], CLIENTS)
    a1 = spark.createDataFrame([account(1, 1)], ACCOUNTS)
    p1 = spark.createDataFrame([proposal(1, 1)], PROPOSALS)
    clean = quality_dashboard(c1, agencies, a1, p1, strict_parity=True)
    strict = {r["test_type"]: r["status"] for r in clean.collect() if r["test_type"] == "relationships"}
    assert strict == {"relationships": "FAIL"}
    lenient = quality_dashboard(c1, agencies, a1, p1)
    assert {r["status"] for r in lenient.collect() if r["test_type"] == "relationships"} == {"PASS"}
    order = [r["status"] for r in quality_dashboard(clients, agencies, accounts, props).collect()]
    assert order == sorted(order, reverse=True)


def test_load_checks(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (2, None)], "k long, j long")
    b = spark.createDataFrame([(1, 1)], "k long, j long")
    parity = {r["table_name"]: r["status"] for r in
              check_row_parity({"a": a, "b": b}, {"a": a, "b": a}).collect()}
    assert parity == {"a": "pass", "b": "fail"}
    nn = {r["table_name"]: r["null_keys"] for r in
          check_pk_not_null({"a": a}, {"a": ("k", "j")}).collect()}
    assert nn == {"a": 1}
    dup = {r["table_name"]: r["duplicate_keys"] for r in
           check_pk_duplicates({"a": a}, {"a": ("k",)}).collect()}
    assert dup == {"a": 1}
    exp = {r["table_name"]: r["status"] for r in check_expected_counts({"a": a}, {"a": 3}).collect()}
    assert exp == {"a": "pass"}
    ranks = spark.createDataFrame([(1,), (2,), (3,)], "r int")
    assert check_rank_dense(ranks, "r").collect()[0]["is_dense"] is True
    gap = spark.createDataFrame([(1,), (3,)], "r int")
    assert check_rank_dense(gap, "r").collect()[0]["is_dense"] is False
    assert check_single_row(b).collect()[0]["is_single_row"] is True
    assert check_single_row(a).collect()[0]["is_single_row"] is False


def test_assert_checks_pass_names_failures(spark):
    import pytest

    from ledgerlake.operators.quality import assert_checks_pass
    df = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    ok = run_checks([Check("not_null", "t", "k")], {"t": df})
    assert_checks_pass(ok)
    bad = run_checks([Check("unique", "t", "k")], {"t": df})
    with pytest.raises(AssertionError, match="unique_t_k=1"):
        assert_checks_pass(bad)


def test_kpis_of_an_empty_bank_are_one_row(spark):
    """The single-row check can fail: on no data each KPI mart still has its one row of zeros."""
    from ledgerlake.plans.models import Models
    from ledgerlake.schemas import RAW_SCHEMAS

    models = Models({t: spark.createDataFrame([], s) for t, s in RAW_SCHEMAS.items()})
    for mart in ("commercial_kpis", "credit_kpis"):
        rows = models[mart].collect()
        assert len(rows) == 1, mart
        assert check_single_row(models[mart]).collect()[0]["is_single_row"] is True
        assert not any(rows[0].asDict().values()), rows  # zero or null, nothing made up
    assert check_single_row(models["stg_clients"]).collect()[0]["is_single_row"] is False
