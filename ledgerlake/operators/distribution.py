"""Exact distribution statistics of amounts (planned mart F4-04).

Medians and other percentiles are found by selection, not by sorting a group:
values are counted in equal steps between the least and the largest, the step
that holds a wanted rank becomes the next interval, and its values are counted
again in finer steps until a step is one value. Each pass counts on every task
before anything is shuffled, so a type that holds a third of the rows costs its
tasks a few counters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import exact_ratio
from ledgerlake.operators.joins import lookup_join
from ledgerlake.sources.scratch import written_once

#: Steps per interval and pass.
STEPS = 4096
#: Percentiles that are interpolated between their two neighbouring ranks.
PERCENTILES = (50, 95)

_ALL = "all"
_WIDE = "decimal(38,0)"


def _scope(of: str) -> Column:
    """Key of a type's rows; a missing type is a type of its own."""
    return F.when(F.col(of).isNull(), F.lit("missing")).otherwise(F.concat(F.lit("type:"), of))


def _counted(inside: DataFrame, step: int) -> DataFrame:
    """Rows per scope, interval (its ``low``) and step within it."""
    return inside.groupBy("scope", "low", F.expr(f"(v - low) div {step}").alias("at")).agg(
        F.count(F.lit(1)).alias("n"))


def values_at_ranks(rows: DataFrame, wanted: DataFrame, low: int, high: int, scopes: int,
                    steps: int = STEPS, overall: str = _ALL) -> DataFrame:
    """``scope``, ``rank`` and the value ``v`` that stands there in the scope's sorted values.

    ``rows`` has ``scope`` and ``v`` (a whole number from ``low`` to ``high``); a scope
    named ``overall`` holds all rows. ``wanted`` has ``scope`` and ``rank`` from 0, a few
    per scope. The number of passes is
    the logarithm of the range of values to the base ``steps``, at least one.
    """
    targets = wanted.select("scope", "rank", F.lit(low).cast("long").alias("low"),
                            F.col("rank").alias("left"))
    width = high - low + 1
    first = True
    while True:
        step = max(1, -(-width // steps))
        if first:  # one interval for all: what all scopes count is the sum over them
            own = _counted(rows.withColumn("low", F.lit(low).cast("long")), step)
            counts = own.unionByName(own.groupBy("low", "at").agg(F.sum("n").alias("n"))
                                     .withColumn("scope", F.lit(overall)))
            first = False
        else:
            spots = targets.select("scope", "low").distinct()  # at most one per wanted rank
            both = rows.select(F.explode(F.array("scope", F.lit(overall))).alias("scope"), "v")
            counts = _counted(lookup_join(
                both, spots, ["scope"], ["v"], side_rows=scopes * 2 * len(PERCENTILES))
                .where((F.col("v") >= F.col("low")) & (F.col("v") - F.col("low") < width)), step)
        upto = F.sum("n").over(Window.partitionBy("scope", "rank").orderBy("at"))
        picked = targets.join(counts, ["scope", "low"]).withColumn("upto", upto).where(
            (F.col("left") < F.col("upto")) & (F.col("left") >= F.col("upto") - F.col("n")))
        # a few rows, read twice by the next pass
        targets = written_once(picked.select(
            "scope", "rank", (F.col("low") + F.col("at") * step).alias("low"),
            (F.col("left") - F.col("upto") + F.col("n")).alias("left")), "ranks")
        if step == 1:
            return targets.select("scope", "rank", F.col("low").alias("v"))
        width = step


def transaction_statistics(transactions: DataFrame, steps: int = STEPS) -> DataFrame:
    """One row per transaction type and one for all (``scope`` type or all).

    Number of amounts, mean (rounded to 4 digits), sample variance and
    standard deviation (to 2), least and largest amount, exact interpolated median
    and 95th percentile, and whether the distribution is skewed (the
    standard deviation is more than twice the mean). Missing amounts don't
    count; a type without amounts has NULL statistics. A missing type is a
    type of its own; an empty table has no rows.

    Sums are exact: the squared deviations come from whole cents around the
    whole part of the mean, so nothing cancels.
    """
    cents = (F.col("transaction_amount") * 100).cast("long")
    rows = transactions.select("transaction_type", cents.alias("v"))
    square = F.col("v").cast("decimal(19,0)") * F.col("v").cast("decimal(19,0)")
    by_type = written_once(rows.groupBy("transaction_type").agg(
        F.count("v").alias("n"), F.sum(F.col("v").cast("decimal(28,0)")).cast(_WIDE).alias("s"),
        F.sum(square).cast(_WIDE).alias("q"), F.min("v").alias("least"),
        F.max("v").alias("largest")), "statistics")
    low, high, types = by_type.agg(F.min("least"), F.max("largest"), F.count(F.lit(1))).first()
    overall = by_type.groupBy().agg(
        *[F.sum(c).cast(_WIDE if c != "n" else "long").alias(c) for c in ("n", "s", "q")],
        F.min("least").alias("least"), F.max("largest").alias("largest"),
        F.count(F.lit(1)).alias("types")).where("types > 0")
    sums = by_type.select(_scope("transaction_type").alias("key"), F.lit("type").alias("scope"),
                          "transaction_type", "n", "s", "q", "least", "largest").unionByName(
        overall.select(F.lit(_ALL).alias("key"), F.lit(_ALL).alias("scope"),
                       F.lit(None).cast("string").alias("transaction_type"), "n", "s", "q",
                       "least", "largest"))
    if low is None:  # no amounts at all
        ranked = sums.select("key", F.expr("cast(map() as map<bigint, bigint>)").alias("at"))
    else:
        places = [f(p) for p in PERCENTILES for f in (_below, _above)]
        wanted = sums.where("n > 0").select(
            F.col("key").alias("scope"),
            F.explode(F.array_distinct(F.array(*places))).alias("rank"))
        scoped = rows.where(F.col("v").isNotNull()).select(
            _scope("transaction_type").alias("scope"), "v")
        found = values_at_ranks(scoped, wanted, low, high, types + 1, steps)
        ranked = found.groupBy(F.col("scope").alias("key")).agg(F.map_from_entries(
            F.collect_list(F.struct("rank", "v"))).alias("at"))  # four ranks a scope at most
    return _summary(sums.join(ranked, "key", "left"))


def _below(p: int) -> Column:
    """Rank below the ``p``-th percentile of ``n`` values."""
    return F.expr(f"({p} * (n - 1)) div 100")


def _above(p: int) -> Column:
    return F.least(_below(p) + 1, F.col("n") - 1)


def _percentile(p: int) -> Column:
    part = (F.lit(p) * (F.col("n") - 1)) % 100
    lower, upper = (F.try_element_at("at", rank) for rank in (_below(p), _above(p)))
    hundredths = lower.cast("decimal(24,0)") * (100 - part) + upper.cast("decimal(24,0)") * part
    return (hundredths * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(22,4)")


def _summary(sums: DataFrame) -> DataFrame:
    n = F.col("n")
    some = F.nullif(n, F.lit(0))
    whole = F.expr("cast(s div nullif(n, 0) as decimal(38,0))")  # whole cents of the mean
    rest = F.col("s") - whole * n
    around = (F.col("q") - whole * (F.col("s") + rest)).cast("double") \
        - rest.cast("double") * (rest.cast("double") / some)
    variance = F.when(n > 1, around / (n - 1) / 10_000)
    mean = F.col("s").cast("double") / some / 100
    cents = lambda c: (F.col(c).cast("decimal(18,0)")
                       * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,2)")
    return sums.withColumn("_variance", variance).select(
        "scope", "transaction_type", n.alias("transaction_count"),
        (exact_ratio(F.col("s"), some, 2) * F.lit("0.01").cast("decimal(2,2)")).alias("mean_amount"),
        F.round("_variance", 2).alias("variance_amount"),
        F.round(F.sqrt("_variance"), 2).alias("stddev_amount"),
        cents("least").alias("min_amount"), cents("largest").alias("max_amount"),
        *[F.when(n > 0, _percentile(p)).alias(name)
          for p, name in zip(PERCENTILES, ("median_amount", "p95_amount"))],
        (F.sqrt("_variance") > 2 * mean).alias("is_skewed"))
