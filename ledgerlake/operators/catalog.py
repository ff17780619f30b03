"""M-11: catalog of the tables and views the pipeline builds.

The catalog is metadata, not data: one row per relation, read from Spark's
catalog and the table statistics (``ANALYZE TABLE … COMPUTE STATISTICS``
runs the count as a distributed job; only the resulting numbers reach the
driver).
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import pretty_size

# Layer of each database and name patterns that are never listed.
MEDALLION = {"raw": "bronze", "staging": "silver", "marts": "gold"}
EXCLUDED_PATTERNS = ("pg_%", "dbt_%")

#: Relations whose statistics are gathered at the same time.
PARALLEL_RELATIONS = 8

_STATS = re.compile(r"(\d+) bytes(?:, (\d+) rows)?")


def _statistics(spark: SparkSession, qualified: str) -> tuple[int, int]:
    """(bytes, rows) from the table's statistics; (0, 0) when there are none."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified}").collect()
    for r in rows:
        if r["col_name"] == "Statistics":
            m = _STATS.search(r["data_type"])
            if m:
                return int(m.group(1)), int(m.group(2) or 0)
    return 0, 0


def _listed(spark: SparkSession, db: str) -> list:
    """Tables and views of a database, without those whose name is LIKE an excluded pattern."""
    tables = {t.name: t for t in spark.catalog.listTables(db) if not t.isTemporary}
    names = spark.createDataFrame([(n,) for n in tables], "name string")
    for pattern in EXCLUDED_PATTERNS:
        names = names.where(~F.col("name").like(pattern))
    return [tables[r["name"]] for r in names.collect()]


def model_catalog(spark: SparkSession, databases: tuple[str, ...] = ("raw", "staging", "marts"),
                  analyze: bool = True, known_rows: dict[str, int] | None = None) -> DataFrame:
    """One row per table or view of the layered databases.

    ``(model_name, schema_name, materialization, row_count, total_size,
    table_size, description, medallion_layer, captured_at)``, sorted by schema
    and name. Views report 0 rows and 0 bytes.

    ``known_rows`` (``"db.table" -> rows``, e.g. counted while writing) lets the
    statistics be refreshed with ``NOSCAN`` (file sizes only), so a large
    table is never scanned again just to count it.
    """
    known_rows = known_rows or {}

    def entry(relation: tuple) -> tuple:
        db, t = relation
        qualified = f"{db}.{t.name}"
        if t.tableType == "VIEW":
            return t.name, db, "view", 0, 0, t.description
        if analyze:
            noscan = " NOSCAN" if qualified in known_rows else ""
            spark.sql(f"ANALYZE TABLE {qualified} COMPUTE STATISTICS{noscan}")
        nbytes, nrows = _statistics(spark, qualified)
        return t.name, db, "table", known_rows.get(qualified, nrows), nbytes, t.description

    relations = [(db, t) for db in databases if spark.catalog.databaseExists(db)
                 for t in _listed(spark, db)]
    with ThreadPoolExecutor(max_workers=PARALLEL_RELATIONS) as pool:
        entries = list(pool.map(entry, relations))
    base = spark.createDataFrame(
        entries, "model_name string, schema_name string, materialization string, "
                 "row_count long, size_bytes long, description string")
    layer = None
    for db, name in MEDALLION.items():
        cond = F.col("schema_name") == F.lit(db)
        layer = F.when(cond, F.lit(name)) if layer is None else layer.when(cond, F.lit(name))
    return (base.select(
        "model_name", "schema_name", "materialization",
        F.greatest(F.col("row_count"), F.lit(0)).alias("row_count"),
        pretty_size("size_bytes").alias("total_size"),
        pretty_size("size_bytes").alias("table_size"),
        "description",
        layer.alias("medallion_layer"),
        F.current_timestamp().alias("captured_at"))
        .orderBy("schema_name", "model_name"))
