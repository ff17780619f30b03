"""SparkSession construction.

The library never overrides settings the cluster already provides: the
plan-shaping defaults below are applied only where the cluster configuration
has no value, so a cluster's shuffle sizing or warehouse wins. Only the settings results depend on (time zone, ANSI casts) are pinned.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every model relies on for correct results.
REQUIRED_CONF = {
    # Date casts, month truncation and day differences depend on the zone.
    "spark.sql.session.timeZone": "UTC",
    # Malformed casts must fail instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
}

# Defaults that only shape the physical plan.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.ui.enabled": "false",
    # Call-site capture costs several driver<->JVM round trips per column
    # function; the models build hundreds of expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "ledgerlake",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session.

    ``extra`` is applied as given (callers such as tests and the benchmark
    size their local runs with it). ``DEFAULT_CONF`` only fills keys that
    neither the cluster configuration (``spark-defaults``, submit options)
    nor an already running session sets. ``REQUIRED_CONF`` is always applied.
    """
    from pyspark import SparkConf

    active = SparkSession.getActiveSession()
    cluster = SparkConf()  # spark-defaults and submit-time settings
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        if not cluster.contains(key) and (active is None or active.conf.get(key, None) is None):
            builder = builder.config(key, value)
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; leave the rest to the cluster."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark
