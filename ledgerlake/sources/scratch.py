"""Intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: str | None = None


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names.

    Only a local master without that setting (a laptop) gets a folder of its
    own; a cluster without it is an error, as its machines share no local one.
    """
    global _LOCAL
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; name a shared folder for it")
        if _LOCAL is None:
            _LOCAL = tempfile.mkdtemp(prefix="ledgerlake-")
        base = _LOCAL
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: made once, whoever reads it, and
    recomputed from these files if an executor is lost."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
