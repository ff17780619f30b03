"""The full pipeline run: load raw -> gate -> staging views -> marts -> checks -> catalog.

One Spark application replaces the scheduler, the loaders and the model
runner: every step is a Spark job, and each written table is the input of
the next layer, which also cuts the lineage between layers (a lost executor
recomputes from the last written table, never from the raw sources).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.catalog import model_catalog
from ledgerlake.operators.quality import (
    audit_rows,
    declared_checks,
    quality_dashboard_view,
    run_checks,
)
from ledgerlake.operators.staging import STAGING_SPECS, view_sql
from ledgerlake.plans.models import MARTS, SHARED, Models, build_levels
from ledgerlake.session import configure
from ledgerlake.sources.gate import validate_load
from ledgerlake.sources.sinks import (
    RUN,
    create_layers,
    create_view,
    ensure_audit_tables,
    full_refresh,
    model_run_rows,
    overwrite_table,
    set_comment,
    write_batch,
)

# Marts written at the same time.
PARALLEL_MODELS = 4
#: Database of intermediates that several marts read (not listed by the catalog).
SHARED_DB = "work"

#: Marts that are views: read live, never written (model -> text of the view).
VIEWS = {"quality_dashboard": quality_dashboard_view}


MODEL_DOCS = {
    "account_activity": "When each account was last used, and whether that makes it active, "
                        "dormant or never used",
    "credit_funnel": "How many proposals of which amount stood in each status, month by month",
    "agency_performance": "Proposals that an agency's employees brought in, and the share approved",
    "daily_volume": "Transactions and accounts in use per calendar day and kind of transaction",
    "client_engagement": "What each account holder owns and does, and how engaged that makes them",
    "commercial_kpis": "Headline numbers of the client base in one row",
    "credit_kpis": "Headline numbers of the credit business in one row",
    "cross_sell": "Well-filled accounts whose owners have no approved credit yet",
    "driver_ranking": "Client properties by how strongly they go along with transaction counts",
    "quality_dashboard": "Orphans, missing keys and repeated keys of the staging layer, as of now",
    "model_catalog": "Every table and view of the layers, with size, rows and description",
}


@dataclass
class PipelineResult:
    raw_counts: dict[str, int]
    mart_counts: dict[str, int]
    check_results: DataFrame
    failed_checks: list[str] = field(default_factory=list)


class _Catalog(Mapping):
    """Models read back from the written layers (staging views, mart tables)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __getitem__(self, name: str) -> DataFrame:
        db = "staging" if name in STAGING_SPECS else "marts"
        return self.spark.table(f"{db}.{name}")

    def __iter__(self):
        return iter(list(STAGING_SPECS) + list(MARTS) + ["model_catalog"])

    def __len__(self) -> int:
        return len(list(iter(self)))


def run_pipeline(spark: SparkSession, raw_tables: Mapping[str, DataFrame],
                 parallel_models: int = PARALLEL_MODELS, run_id: str | None = None,
                 extensions: Sequence[str] = ()) -> PipelineResult:
    """Build every layer from ``raw_tables`` (the seven raw relations, e.g. from
    :func:`ledgerlake.sources.readers.read_raw_csv` or the crosswalk).

    ``parallel_models`` marts of one dependency level are written at a time, then
    those of the planned marts (``EXTENSIONS``) that ``extensions`` names. ``run_id``
    names the run in the audit tables (by default a new one): a run that is
    repeated under its old name replaces what it left there.
    """
    run_id = run_id or uuid.uuid4().hex
    configure(spark)
    create_layers(spark)
    ensure_audit_tables(spark)

    # 1. raw layer: full refresh, then the gate on what was written
    raw_counts = full_refresh(spark, raw_tables, "raw")
    validate_load({t: spark.table(f"raw.{t}") for t in raw_tables})

    # 2. staging: permanent views over the raw tables
    for name in STAGING_SPECS:
        create_view(spark, view_sql(name))

    # 3. marts level by level; each reads the written upstream tables. Marts
    #    of one level are independent, so their jobs are submitted together
    #    and share the cluster (a small mart does not wait for a large one).
    models = Models({t: spark.table(f"raw.{t}") for t in raw_tables})
    for name in STAGING_SPECS:
        models.replace(name, spark.table(f"staging.{name}"))
    mart_counts: dict[str, int] = {}
    runs: list[tuple[str, str, str, int, str, str]] = []
    try:
        # what several marts read, made once
        create_layers(spark, (SHARED_DB,))
        for name in SHARED:
            overwrite_table(models[name], f"{SHARED_DB}.{name}")
            models.replace(name, spark.table(f"{SHARED_DB}.{name}"))
        with ThreadPoolExecutor(max_workers=parallel_models) as pool:
            for level in build_levels():
                _build_level(spark, models, level, pool, runs, mart_counts)
        for name in extensions:
            mart_counts[name] = _recorded(
                runs, name, lambda n=name: overwrite_table(models[n], f"marts.{n}"))
            models.replace(name, spark.table(f"marts.{name}"))
        known = {f"raw.{t}": n for t, n in raw_counts.items()}
        known.update({f"marts.{t}": n for t, n in mart_counts.items()})
        rows = _recorded(runs, "model_catalog", lambda: overwrite_table(
            model_catalog(spark, known_rows=known), "marts.model_catalog"))
        mart_counts["model_catalog"] = rows
        set_comment(spark, "marts.model_catalog", MODEL_DOCS["model_catalog"])
    finally:  # a failed run leaves its record too
        if runs:
            write_batch(model_run_rows(spark, runs), "metadata.model_runs", run_id)

    # 4. declared tests over the written layers: this run's batch in the audit
    #    table, read back from it
    stamp = F.lit(dt.datetime.now(dt.timezone.utc))
    write_batch(audit_rows(run_checks(declared_checks(), _Catalog(spark)), stamp),
                "metadata.test_results", run_id)
    results = spark.table("metadata.test_results").where(F.col(RUN) == run_id).drop(RUN)
    failed = sorted(r["test_name"] for r in
                    results.where("status = 'fail'").select("test_name").collect())
    return PipelineResult(raw_counts, mart_counts, results, failed)


def _recorded(runs: list, name: str, write, kind: str = "table") -> int:
    """Rows written by ``write()``; the outcome, success or failure, is added to ``runs``."""
    try:
        rows = write()
    except Exception as e:
        runs.append((name, kind, "marts", 0, "error", str(e).splitlines()[0][:500]))
        raise
    runs.append((name, kind, "marts", rows, "success", ""))
    return rows


def _build_level(spark: SparkSession, models: Models, level: list[str],
                 pool: ThreadPoolExecutor, runs: list, counts: dict[str, int]) -> None:
    """Build the marts of a level together; the first failure is raised when all have ended."""
    plans = {name: models[name] for name in level if name not in VIEWS}  # built on this thread
    futures = {name: pool.submit(overwrite_table, df, f"marts.{name}")
               for name, df in plans.items()}
    failure = None
    for name in level:
        try:
            if name in VIEWS:
                _recorded(runs, name, lambda n=name: create_view(spark, VIEWS[n](f"marts.{n}")) or 0,
                          "view")
            else:
                counts[name] = _recorded(runs, name, futures[name].result)
                set_comment(spark, f"marts.{name}", MODEL_DOCS.get(name))
            models.replace(name, spark.table(f"marts.{name}"))
        except Exception as e:  # the others of the level still get their records
            failure = failure or e
    if failure is not None:
        raise failure
