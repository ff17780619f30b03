"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a look-up side up to which it is broadcast.
BROADCAST_ROWS = 100_000
#: A key is frequent if it holds more than this part of a partition's even share of the rows.
FREQUENT_PART = 0.25
#: Most keys that the summary of frequent keys follows at a time.
TRACKED_KEYS = 1 << 19


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def frequent_keys(rows: DataFrame, key: str, share: float, most: int | None = None) -> list:
    """The values of ``key`` that hold at least ``share`` of all rows, NULL apart, the most
    frequent first (of these the first ``most``, if given).

    One pass with a bounded summary per task (a mergeable sketch of frequent
    items) finds candidates, then those alone are counted exactly; no task
    sees a row per key. The sketch follows enough keys that none with ``share`` of
    the rows is missed; at most ``1 / share`` values reach the driver.
    """
    known = rows.where(F.col(key).isNotNull())
    # an item that holds more than 3.5 times 1/tracked of the rows is never missed, and its
    # count is known within that; twice as many keep it apart from the error
    tracked = 16
    while tracked < min(TRACKED_KEYS, 8 / share):
        tracked *= 2
    wanted = min(tracked, max(1, int(1 / share) * 4))
    found = known.agg(
        F.expr(f"approx_top_k(`{key}`, {wanted}, {tracked})").alias("top"),
        F.count(F.lit(1)).alias("n")).first()
    if not found["n"]:
        return []
    candidates = [x["item"] for x in found["top"] or []]
    if not candidates:
        return []
    counted = known.where(F.col(key).isin(candidates)).groupBy(key).agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= share * found["n"])
    return [r[key] for r in counted.orderBy(F.desc("n"), key).collect()][:most]


def join_salting_frequent_keys(big: DataFrame, per_key: DataFrame, key: str, spread: str,
                               share: float | None = None, salts: int | None = None,
                               most: int | None = None) -> DataFrame:
    """Inner join of ``big`` with ``per_key`` (at most one row per key) on ``key``.

    The rows of the frequent keys, those with at least ``share`` of all rows,
    are dealt over ``salts`` partitions (by default the session's shuffle
    partitions) by a hash of ``spread``, and those keys' rows of ``per_key`` are
    repeated once per salt: at most ``salts / share`` rows more, at any size. All
    other rows have salt 0. One join on key and salt, whatever its physical
    kind, gives exactly the inner join.
    """
    salts = salts or partitions_of(big)
    hot = frequent_keys(big, key, share or min(0.5, FREQUENT_PART / salts), most)
    frequent = F.col(key).isin(hot) if hot else F.lit(False)
    left = big.withColumn("_salt", F.when(
        frequent, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(F.lit(0)))
    right = per_key.withColumn("_salt", F.explode(F.when(
        frequent, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "_salt"], "inner").drop("_salt")


def lookup_join(big: DataFrame, side: DataFrame, keys: Sequence[str], spread: Sequence[str],
                how: str = "inner", side_rows: int | None = None,
                most: int = BROADCAST_ROWS, salts: int | None = None) -> DataFrame:
    """``big`` joined with a look-up table that is meant to be small, however large it is.

    The side is measured first (``side_rows`` if the caller knows, else a count
    that stops beyond ``most``). Up to ``most`` rows it is broadcast, and ``big``
    isn't moved. Beyond, both are shuffled, each key's rows of ``big`` dealt over
    ``salts`` partitions by a hash of ``spread`` and the side repeated as often, so
    a key that holds a third of ``big`` is still split.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a look-up join is inner or left, not {how!r}")
    if side_rows is None:
        side_rows = side.limit(most + 1).count()
    if side_rows <= most:
        return big.join(F.broadcast(side), list(keys), how)
    salts = salts or partitions_of(big)
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    repeated = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("_salt", salt).join(repeated.hint("merge"), [*keys, "_salt"], how) \
        .drop("_salt")
