"""Column helpers: readable sizes, exact ratios, correlation guard, NULL ordering."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import exact_ratio, pretty_size, safe_corr


@pytest.mark.parametrize("nbytes,text", [
    (0, "0 bytes"),
    (10239, "10239 bytes"),
    (10240, "10 kB"),
    (1_000_000, "977 kB"),
    (20 * 2**50, "20 PB"),
    (10 * 1024 * 1024 - 1024, "10239 kB"),
    (10 * 1024 * 1024 - 1, "10 MB"),
    (10 * 1024 * 1024, "10 MB"),
    (20 * 1024 * 1024 - 1, "20 MB"),
    (5 * 1024 ** 3, "5120 MB"),
    (25 * 1024 ** 3, "25 GB"),
    (30 * 1024 ** 4, "30 TB"),
])
def test_pretty_size_boundaries(spark, nbytes, text):
    got = spark.range(1).select(pretty_size(F.lit(nbytes)).alias("s")).collect()[0]["s"]
    assert got == text


def test_exact_ratio_rounds_half_away_from_zero(spark):
    # 203 / 200 = 1.015 exactly: a float division would round it down to 1.01
    row = spark.range(1).select(
        exact_ratio(F.lit(203), F.lit(200), 2).alias("a"),
        exact_ratio(F.lit(1), F.lit(3), 2, factor=100).alias("b"),
        exact_ratio(F.lit(5), F.lit(0), 2).alias("c"),
        exact_ratio(F.lit(5), F.lit(None).cast("long"), 2).alias("d"),
    ).collect()[0]
    assert row["a"] == Decimal("1.02")
    assert row["b"] == Decimal("33.33")
    assert row["c"] is None and row["d"] is None


def test_safe_corr_matches_builtin_and_guards_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 3.9, 5.0), (3.0, 6.2, 5.0), (4.0, None, 5.0)],
                               "x double, y double, c double")
    row = df.agg(safe_corr("y", "x").alias("r"), safe_corr("c", "x").alias("z")).collect()[0]
    builtin = df.where("y IS NOT NULL").agg(F.corr("y", "x")).collect()[0][0]
    assert row["r"] == pytest.approx(builtin, abs=1e-12)
    assert row["z"] is None
