"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the characters that separate words (space, and tab to carriage return).
SEPARATORS = " \t\n\x0b\x0c\r"
#: A word, as a pattern for Spark and for Python.
WORD = r"[^\x20\x09-\x0D]+"

_LOCAL_SCRATCH: str | None = None


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local master without that setting (tests, a laptop) gets a folder
    of its own; a cluster without it is an error.
    """
    global _LOCAL_SCRATCH
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; name a shared folder for it")
        if _LOCAL_SCRATCH is None:
            _LOCAL_SCRATCH = tempfile.mkdtemp(prefix="ledgerlake-")
        base = _LOCAL_SCRATCH
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: what follows recomputes from these files if an executor
    is lost, and a table that is used twice is made once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], spread: str,
                how: str = "inner", salts: int = 16) -> DataFrame:
    """``big`` joined with ``small`` (at most one row a key) with each key's rows of ``big``
    dealt over ``salts`` partitions by a hash of its column ``spread``.

    ``small`` is repeated once per salt, so it should hold only keys that
    have partners (keys with several rows), not every key.
    """
    salt = F.pmod(F.xxhash64(F.col(spread)), F.lit(salts)).cast("int")
    left = big.withColumn("_salt", salt)
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def smallest_hashes(rows: DataFrame, most: int, *key: str) -> DataFrame:
    """The ``most`` rows with the smallest hashes of ``key`` (all, if there are no more).

    The rows are counted first, and only those with hashes in the share of the
    range that holds about 1.2 times ``most`` of them are sorted, so what meets
    in the last task doesn't grow with the number of partitions.
    """
    share = min(1.0, 1.2 * most / max(1, rows.count()))
    if share < 1:
        rows = rows.where(F.xxhash64(*key) <= F.lit(int(-2**63 + share * 2**64)))
    return rows.orderBy(F.xxhash64(*key), key[0]).limit(most)


def text_groups(texts: list[str], most_chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most_chars`` characters (one text at least)."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most_chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def text_parts(column: pa.Array, most_bytes: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts (null: empty) of about ``most_bytes`` (one text at least), each part
    with the row of its first. Only one part's texts are Python strings at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64))
    start = 0
    while start < len(column):
        past = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, past + most_bytes, "right")))
        yield start, [t or "" for t in column.slice(start, stop - start).to_pylist()]
        start = stop


class WordTable:
    """Words numbered in order of arrival, with numpy columns computed once per word.

    ``compute(words)`` gets the new words and returns one array per column,
    each with a row per word. Beyond ``limit`` words the table starts anew, so
    memory stays bounded by ``limit`` plus the distinct words of one call.
    """

    def __init__(self, compute: Callable[[list[str]], tuple[np.ndarray, ...]],
                 limit: int = 200_000):
        self.compute, self.limit = compute, limit
        self.index: dict[str, int] = {}
        self.columns: list[np.ndarray] = []
        self.restarts = 0

    def lookup(self, words: list[str]) -> np.ndarray:
        """Row numbers of ``words``; ``columns`` hold the rows."""
        got = list(map(self.index.get, words))
        if None not in got:
            return np.array(got, np.int64)
        new = list(dict.fromkeys([w for w, g in zip(words, got) if g is None]))
        if self.index and len(self.index) + len(new) > self.limit:
            self.index.clear()
            self.restarts += 1
            new = list(dict.fromkeys(words))
        n = len(self.index)
        made = self.compute(new)
        if not n:
            self.columns = [np.empty((max(1024, 2 * len(c)), *c.shape[1:]), c.dtype)
                            for c in made]
        for i, c in enumerate(made):
            if n + len(c) > len(self.columns[i]):
                grown = np.empty((2 * (n + len(c)), *c.shape[1:]), c.dtype)
                grown[:n] = self.columns[i][:n]
                self.columns[i] = grown
            self.columns[i][n:n + len(c)] = c
        self.index.update(zip(new, range(n, n + len(new))))
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))


def codepoints(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters of ``words`` in one array, and where each word starts (and the last ends)."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)), out=starts[1:])
    return flat, starts


def by_length(starts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Word numbers grouped by their length."""
    lens = np.diff(starts)
    order = np.argsort(lens, kind="stable")
    cuts = np.flatnonzero(np.diff(lens[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(lens[rows[0]]), rows


def sums_of(values: np.ndarray, counts: Iterable[int]) -> np.ndarray:
    """Sums of consecutive runs of ``values`` with the given lengths (0 for an empty run)."""
    ends = np.cumsum(np.asarray(counts, np.int64))
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]]).astype(np.int64)] \
        if len(ends) else np.zeros((0, *values.shape[1:]))
