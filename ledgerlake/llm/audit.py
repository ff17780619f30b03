"""Filter interaction audit (operator 13): what each filter removes in every order of filters.

A document's failures are a mask, a bit per filter. The step at which an order
of filters removes it is a min-plus product: the mask matrix holds 0 where a
mask fails a filter and a step that never comes where it does not; the
position matrix holds each order's inverse permutation, the step at which a
filter stands; the minimum over the filters of their sums is the step at which
the mask's first failing filter stands. Documents are counted by part and mask
(a handful of rows a part, whatever the table's size) and these counts are
scattered with that step over (order, step); a failing filter that stands
later than the step gets them as redundant.

The texts are read once, into narrow rows. Copies are counted before they meet:
rows of a document, then of an equal text, so a text or an id that holds a
third of all rows crosses a shuffle as a few rows per task.

Defined results: a null text is empty (fails A alone, and E if an empty text
has a smaller id); a null language is the part '' and shares it with empty
ones; rows with the same doc_id are counted one by one and aren't copies of
each other; a null doc_id has no label, is no copy and makes none. Several
label rows of a document count once, a good or toxic one decides. Very long
texts are one row like others; ties (equal texts, equal ids) count in full. An
empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LETTERS = "ABCDE"
#: Bounds and characters of the five filters.
FEWEST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"
#: Bytes that continue a code point in UTF-8.
_CONTINUED = bytes(range(0x80, 0xC0))
_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


# --- min-plus removal steps -------------------------------------------------


def mask_matrix(n: int) -> np.ndarray:
    """For each of the 2**n masks and each filter 0 if the mask has the filter's bit, else ``n``."""
    has = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    return np.where(has == 1, 0, n)


def position_matrix(n: int) -> np.ndarray:
    """Inverse permutations: the step (from 0) of each filter in each order, orders as listed."""
    orders = np.array(list(itertools.permutations(range(n))))
    return np.argsort(orders, axis=1)


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Step at which each order removes each mask, the number of filters if it never does."""
    steps = (masks[:, None, :] + positions[None, :, :]).min(axis=2)
    return np.minimum(steps, positions.shape[1])


def scatter(masks: np.ndarray, weights: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """Counts by order and step of documents with these masks.

    ``weights`` has a row per mask: documents, good ones, toxic ones.
    """
    cost, positions = mask_matrix(n)[masks], position_matrix(n)
    steps = removal_steps(cost, positions)
    orders = np.arange(len(positions))
    removed = np.zeros((len(positions), n + 1, weights.shape[1]), np.int64)
    np.add.at(removed, (orders[None, :], steps), weights[:, None, :])
    redundant = np.zeros((len(positions), n), np.int64)
    alone = np.zeros(n, np.int64)
    shapley = np.zeros(n, np.int64)
    for f in range(n):
        later = (cost[:, f] == 0)[:, None] & (steps < positions[:, f])
        redundant[orders, positions[:, f]] = (later * weights[:, :1]).sum(axis=0)
        alone[f] = weights[masks == 1 << f, 0].sum()
        shapley[f] = removed[orders, positions[:, f], 0].sum()
    at = np.argsort(positions, axis=1)  # the filter that stands at each step
    lost = removed[:, :n]
    return {"kept": weights[:, 0].sum() - lost[:, :, 0].cumsum(axis=1), "removed": lost[:, :, 0],
            "redundant": redundant, "unique_fails": alone[at], "good_lost": lost[:, :, 1],
            "toxic_lost": lost[:, :, 2], "shapley": shapley[at]}


def interactions(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """All orders and steps of each part, from ``counts`` (part, mask, n, good, toxic)."""
    orders = ["".join(o) for o in itertools.permutations(letters)]
    n = len(letters)

    def run(table: pa.Table) -> pa.Table:
        weights = np.stack([table.column(c).to_numpy() for c in ("n", "good", "toxic")], axis=1)
        found = scatter(table.column("mask").to_numpy(), weights, n)
        rows = len(orders) * n
        return pa.table({
            "part": pa.array([table.column("part")[0].as_py()] * rows, pa.string()),
            "filter_order": np.repeat(orders, n),
            "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)),
            **{c: np.ascontiguousarray(found[c]).reshape(-1).astype(np.int64) for c in _COUNTS}})

    return counts.groupBy("part").applyInArrow(
        run, "part string, filter_order string, step int, "
        + ", ".join(f"{c} long" for c in _COUNTS))


# --- the five filters -------------------------------------------------------


def failures(data: bytes) -> int:
    """Bits of the filters A to D that a text, as UTF-8, fails."""
    words = data.split()  # of bytes: at space and tab to carriage return
    points = len(data.translate(None, _CONTINUED))
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return ((len(words) < FEWEST_WORDS)
            | (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > MOST_CAPITALS_PERCENT * points) << 2
            | (len(data.translate(None, SYMBOLS)) < len(data)) << 3)


def facts(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (of A to D) and digest of the text of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for text in batch.column(2):
                data = text.as_py() or b""
                masks.append(failures(data))
                digests.append(hashlib.sha256(data).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(masks, pa.int32()),
                 pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])

    return docs.select(F.col("doc_id").cast("long"),
                       F.coalesce(F.col("lang"), F.lit("")).alias("part"),
                       F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, part string, mask int, digest binary")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good ones and toxic ones by part and mask of all five filters."""
    rows = facts(docs).groupBy("doc_id", "part", "mask", "digest").agg(
        F.count(F.lit(1)).alias("n"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = rows.join(marks, "doc_id", "left") \
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    # rows of one text: those of the smallest id, and those without one, are no copies
    texts = marked.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first_id"),
        F.min_by("n", "doc_id").alias("n_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    least = F.min("first_id").over(Window.partitionBy("digest"))
    both = texts.withColumn("least", least).withColumn(
        "own", F.col("n_null") + F.when(F.col("first_id") == F.col("least"), F.col("n_first"))
        .otherwise(0))
    return both.select("part", "good", "toxic", F.expr(
        f"stack(2, mask, own, mask | {1 << LETTERS.index('E')}, n - own) AS (mask, n)")) \
        .groupBy("part", "mask").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
            F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over whole documents."""
    return interactions(mask_counts(docs, labels))
