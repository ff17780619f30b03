"""Publishing tables: a failed write or check leaves the old rows; retried audit batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources.sinks import (
    KEPT_VERSIONS,
    PublicationError,
    RUN,
    create_layers,
    ensure_audit_tables,
    full_refresh,
    model_run_rows,
    overwrite_table,
    write_batch,
)

DB = "published_test"


@pytest.fixture(scope="module")
def db(spark):
    create_layers(spark, (DB,))
    yield DB
    spark.sql(f"DROP DATABASE {DB} CASCADE")


def _ids(spark, name):
    return sorted(r["id"] for r in spark.table(name).collect())


def _fails_half_way(spark, n=100):
    """Some tasks write their rows, one fails."""
    return spark.range(0, n, 1, 4).select(
        F.when(F.col("id") == n - 1, F.raise_error(F.lit("broken half-way")).cast("long"))
        .otherwise(F.col("id") + 1000).alias("id"))


def test_a_failed_write_leaves_the_old_table(spark, db):
    name = f"{db}.numbers"
    assert overwrite_table(spark.range(5), name) == 5
    with pytest.raises(Exception, match="broken half-way"):
        overwrite_table(_fails_half_way(spark), name)
    assert _ids(spark, name) == [0, 1, 2, 3, 4]
    assert overwrite_table(spark.range(10, 12), name) == 2
    assert _ids(spark, name) == [10, 11]


def test_a_failed_check_leaves_the_old_table(spark, db):
    name = f"{db}.checked"
    overwrite_table(spark.range(3), name)

    def at_least_three(written):
        if written.count() < 3:
            raise PublicationError("too few rows")
    with pytest.raises(PublicationError, match="too few"):
        overwrite_table(spark.range(2), name, validate=at_least_three)
    assert _ids(spark, name) == [0, 1, 2]
    overwrite_table(spark.range(4), name, validate=at_least_three)
    assert _ids(spark, name) == [0, 1, 2, 3]


def test_a_table_can_be_made_from_itself(spark, db):
    name = f"{db}.grows"
    overwrite_table(spark.range(3), name)
    for n in (6, 12, 24):
        old = spark.table(name)
        assert overwrite_table(old.union(old), name) == n
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()[1]
    parent = spark._jvm.org.apache.hadoop.fs.Path(location).getParent()
    versions = parent.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(parent)
    assert len(versions) == KEPT_VERSIONS


def test_changed_columns_and_other_kinds_are_replaced(spark, db):
    name = f"{db}.changes"
    overwrite_table(spark.range(3), name)
    overwrite_table(spark.range(2).withColumn("more", F.lit("x")), name)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 2
    spark.range(7).write.saveAsTable(f"{db}.managed")
    assert overwrite_table(spark.range(4), f"{db}.managed") == 4
    assert _ids(spark, f"{db}.managed") == [0, 1, 2, 3]
    spark.sql(f"CREATE VIEW {db}.seen AS SELECT * FROM {name}")
    overwrite_table(spark.range(5).withColumn("more", F.lit("y")), name)
    assert spark.table(f"{db}.seen").count() == 5  # a view follows the published rows


def test_tables_of_a_layer_fail_by_themselves(spark, db):
    full_refresh(spark, {"a": spark.range(2), "b": spark.range(3), "c": spark.range(4)}, db)
    with pytest.raises(Exception, match="broken half-way"):
        full_refresh(spark, {"a": spark.range(5), "b": _fails_half_way(spark), "c": spark.range(6)}, db)
    assert [spark.table(f"{db}.{t}").count() for t in "abc"] == [5, 3, 6]


def test_a_retried_batch_replaces_itself(spark, db):
    ensure_audit_tables(spark, db)
    name = f"{db}.model_runs"

    def runs(*models):
        return model_run_rows(spark, [(m, "table", "marts", 1, "success", "") for m in models])
    write_batch(runs("x", "y"), name, "first")
    write_batch(runs("x"), name, "second")
    write_batch(runs("x", "y", "z"), name, "first")  # the first run, repeated
    got = sorted((r[RUN], r["model_name"]) for r in spark.table(name).collect())
    assert got == [("first", "x"), ("first", "y"), ("first", "z"), ("second", "x")]
    with pytest.raises(Exception, match="broken half-way"):
        write_batch(_fails_half_way(spark).select(
            F.col("id").cast("string").alias("model_name"), F.lit("t").alias("materialization"),
            F.lit("s").alias("schema_name"), F.lit(1).cast("long").alias("row_count"),
            F.lit("x").alias("status"), F.lit("").alias("message"),
            F.current_timestamp().alias("executed_at")), name, "first")
    assert spark.table(name).where("run_id = 'second'").count() == 1
    write_batch(runs("x"), name, "first")
    assert spark.table(name).count() == 2
