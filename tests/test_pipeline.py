"""End-to-end pipeline run on the smallest driver data set."""

from __future__ import annotations

import pytest

from ledgerlake.plans.dashboards import DASHBOARDS, dashboards_from_marts
from ledgerlake.plans.pipeline import run_pipeline
from ledgerlake.sources.crosswalk import RawLayer


def test_pipeline_end_to_end(spark):
    raw = RawLayer(spark, "/root/testdata/sf0.001").as_dict()
    result = run_pipeline(spark, raw)
    assert result.raw_counts["transacoes"] == 6000
    assert result.raw_counts["propostas_credito"] == 6000
    assert result.mart_counts["client_engagement"] == 150
    assert result.mart_counts["cross_sell"] == 398
    assert result.mart_counts["credit_funnel"] == 326
    # the crosswalk makes these keys non-unique on purpose (several lines per order,
    # several orders per customer)
    assert result.failed_checks == sorted([
        "unique_stg_proposals_proposal_id", "unique_stg_transactions_transaction_id",
        "unique_cross_sell_client_fk"])
    layers = {r["schema_name"]: r["medallion_layer"]
              for r in spark.table("marts.model_catalog").collect()}
    assert layers == {"raw": "bronze", "staging": "silver", "marts": "gold"}
    views = {r["model_name"] for r in spark.table("marts.model_catalog").collect()
             if r["materialization"] == "view"}
    assert len(views) == 8 and "quality_dashboard" in views
    catalog = spark.table("marts.model_catalog")
    assert catalog.columns == ["model_name", "schema_name", "materialization", "row_count",
                               "total_size", "table_size", "description", "medallion_layer",
                               "captured_at"]
    listed = [(r["schema_name"], r["model_name"]) for r in catalog.collect()]
    assert listed == sorted(listed)
    engagement = [r for r in catalog.collect() if r["model_name"] == "client_engagement"][0]
    assert engagement["row_count"] == 150 and engagement["description"]
    cards = dashboards_from_marts(spark)
    assert set(cards) == set(DASHBOARDS)
    assert cards["dash_kpi_cards"].first()["total_clientes"] == 150
    assert cards["dash_cross_sell"].count() == 398
    audit = spark.table("metadata.test_results")
    assert audit.count() == 69
    assert spark.table("metadata.model_runs").count() == 11
    # a second run appends a second batch of test results and replaces every table
    result2 = run_pipeline(spark, raw)
    # (the catalog of the second run also lists the catalog table written by the first)
    assert result2.mart_counts["model_catalog"] == result.mart_counts["model_catalog"] + 1
    del result2.mart_counts["model_catalog"], result.mart_counts["model_catalog"]
    assert result2.mart_counts == result.mart_counts
    assert spark.table("metadata.test_results").count() == 138


def test_failed_runs_leave_a_record(spark, monkeypatch):
    from pyspark.sql import functions as F

    from ledgerlake.plans import models

    def broken(*_):
        return spark.range(1).select(F.raise_error(F.lit("broken on purpose")).alias("x"))

    monkeypatch.setitem(models.MARTS, "credit_funnel", (broken, ("stg_proposals",)))
    before = spark.table("metadata.model_runs").count()
    with pytest.raises(Exception, match="broken on purpose"):
        run_pipeline(spark, RawLayer(spark, "/root/testdata/sf0.001").as_dict())
    runs = spark.table("metadata.model_runs")
    failed = runs.where("status = 'error'").collect()
    assert [r["model_name"] for r in failed] == ["credit_funnel"] and failed[0]["message"]
    assert runs.count() > before + 1  # marts of the same level are recorded as well


def test_quality_dashboard_is_live(spark):
    """The view equals the model, and follows the staging layer."""
    from ledgerlake.plans.models import Models

    raw = RawLayer(spark, "/root/testdata/sf0.001").as_dict()
    run_pipeline(spark, raw)
    view = spark.table("marts.quality_dashboard")
    model = Models(raw)["quality_dashboard"].select(view.columns)
    assert sorted(map(tuple, view.collect())) == sorted(map(tuple, model.collect()))
    clients = raw["clientes"].where("cod_cliente > 10")
    clients.write.mode("overwrite").saveAsTable("raw.clientes")
    orphans = spark.table("marts.quality_dashboard").where("test_type = 'relationships'").collect()
    assert all(r["status"] == "FAIL" and r["failure_count"] > 0 for r in orphans)
