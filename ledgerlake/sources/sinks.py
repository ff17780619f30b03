"""Sinks: layered databases, full-refresh tables, staging views, audit batches.

A table is replaced by publication: its rows are written to a fresh folder,
counted there, and only then does the catalog's entry point to that folder. A
write that fails half-way leaves the old table as it was, and readers see
either the old rows or the new ones. A written table is also the lineage cut
between layers (downstream models read the table, not the plan that produced it).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.schemas import MODEL_RUNS_SCHEMA, TEST_RESULTS_SCHEMA

# One database per layer, named literally (no prefix).
LAYERS = ("raw", "staging", "marts", "metadata")


def create_layers(spark: SparkSession, layers: tuple[str, ...] = LAYERS) -> None:
    """K-05: ``CREATE DATABASE IF NOT EXISTS`` for each layer."""
    for db in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


#: Tables of a layer that are reloaded at the same time.
PARALLEL_LOADS = 4
#: Versions of a table's rows that stay: the published one, and the one before for its readers.
KEPT_VERSIONS = 2


class PublicationError(RuntimeError):
    """What was written is not what should be published; the old table stays."""


def _folder(spark: SparkSession, name: str) -> str:
    """Where the versions of a table lie, apart from the folders the catalog manages."""
    db, table = name.split(".")
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/published/{table}"


def _delete(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def _drop_old_versions(spark: SparkSession, folder: str, kept: int) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    for f in sorted(files, key=lambda f: f.getModificationTime(), reverse=True)[kept:]:
        _delete(spark, f.getPath().toString())


def _nullable(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(f.name, f.dataType) for f in schema.fields]


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet",
                    validate: Callable[[DataFrame], None] | None = None) -> int:
    """K-01 / K-03: publish ``df`` as table ``name``; returns the rows written.

    The rows go to a folder of their own. They are counted by an observation on
    the write and again from the files (``validate`` may look at the written
    rows, too, and raise), and then the catalog's entry is moved to that folder: one
    change of metadata. Only a table whose columns or kind have changed is
    dropped and made anew, between which it is missing for a moment; its
    rows are never at risk, as a published table owns no files.
    """
    spark, folder = df.sparkSession, _folder(df.sparkSession, name)
    version = f"{folder}/{uuid.uuid4().hex}"
    try:
        obs = Observation(f"rows_{name.replace('.', '_')}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).save(version)
        rows = int(obs.get["rows"])
        written = spark.read.schema(df.schema).format(fmt).load(version)
        if (found := written.count()) != rows:
            raise PublicationError(f"{name}: {rows} rows were written, {found} are there")
        if validate:
            validate(written)
    except Exception:
        _delete(spark, version)
        raise
    _point_to(spark, name, version, df.schema, fmt)
    _drop_old_versions(spark, folder, KEPT_VERSIONS)
    return rows


def _point_to(spark: SparkSession, name: str, version: str, schema: T.StructType,
              fmt: str) -> None:
    """The catalog's entry of ``name`` moved to the rows in ``version``."""
    if spark.catalog.tableExists(name):
        table = spark.catalog.getTable(name)
        if table.tableType == "EXTERNAL" and _nullable(spark.table(name).schema) == _nullable(schema):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
            return
        spark.sql(f"DROP {'VIEW' if table.tableType == 'VIEW' else 'TABLE'} {name}")
    spark.catalog.createTable(name, path=version, source=fmt, schema=schema)


def set_comment(spark: SparkSession, name: str, comment: str | None) -> None:
    """Attach a description to a table (listed by the catalog model)."""
    if comment:
        escaped = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {name} IS '{escaped}'")


def full_refresh(spark: SparkSession, tables: Mapping[str, DataFrame], db: str = "raw",
                 parallel: int = PARALLEL_LOADS) -> dict[str, int]:
    """K-01: reload every table of a layer, ``parallel`` at a time; no metadata columns, no history.

    Each table is published by itself; if some fail, the first failure is raised
    once the others have ended, and the failed ones keep their old rows.
    """
    create_layers(spark, (db,))
    plans = {name: tables[name] for name in tables}  # lazy mappings are built on this thread
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = {name: pool.submit(overwrite_table, df, f"{db}.{name}")
                   for name, df in plans.items()}
    return {name: f.result() for name, f in futures.items()}


def create_view(spark: SparkSession, sql: str) -> None:
    """K-02 / K-04: a permanent view from its ``CREATE OR REPLACE VIEW`` text."""
    spark.sql(sql)


#: Partition of the audit tables: the run that a batch of rows belongs to.
RUN = "run_id"


def write_batch(df: DataFrame, name: str, run: str) -> None:
    """K-06 / K-07: the batch of one run in an audit table, in one write.

    The table is partitioned by run and only this run's partition is written:
    a step that is retried replaces its own batch, others stay as they are.
    """
    conf, mode = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    columns = [c for c in df.sparkSession.table(name).columns if c != RUN]
    before = conf.get(mode)
    conf.set(mode, "dynamic")  # an insert into a table takes it from the session only
    try:
        df.select(*columns, F.lit(run).alias(RUN)).write.mode("overwrite").insertInto(name)
    finally:
        conf.set(mode, before)


def ensure_audit_tables(spark: SparkSession, db: str = "metadata") -> None:
    """The two audit tables, created empty if missing."""
    create_layers(spark, (db,))
    for name, schema in (("test_results", TEST_RESULTS_SCHEMA), ("model_runs", MODEL_RUNS_SCHEMA)):
        if not spark.catalog.tableExists(f"{db}.{name}"):
            spark.createDataFrame([], schema).withColumn(RUN, F.lit("")).write \
                .format("parquet").partitionBy(RUN).saveAsTable(f"{db}.{name}")


def model_run_rows(spark: SparkSession, runs: list[tuple[str, str, str, int, str, str]]) -> DataFrame:
    """K-07: rows of the model-run audit table, stamped with the current time."""
    base = spark.createDataFrame(
        runs, "model_name string, materialization string, schema_name string, "
              "row_count long, status string, message string")
    return base.withColumn("executed_at", F.current_timestamp())
