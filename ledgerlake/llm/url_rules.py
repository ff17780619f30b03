"""URL filters (operator 3): a sort-merge range join of URLs with host and path rules.

A host becomes a canonical key: its labels reversed, each followed by ``/``
(which no host contains), so ``a.example.org`` is ``org/example/a/``. A rule's
host and all its subdomains are then the keys with one prefix: an interval of
the sorted keys, and intervals of different rules nest or are disjoint.

Keys are cut into ranges at bounds taken from a bounded sample of the URLs (by
key, path and id, so one host, or one repeated URL, spreads over several
ranges). Each URL goes to its range, each rule to all ranges its interval
meets; what a range holds beyond its own share are the rules that nest around
it, at most one host per label. Ranges are sorted and swept: rules whose
interval has begun and not ended form a stack, and a URL looks for its path's
longest prefix among the rules of the stack.

The longest fitting rule wins (host and path together, then the longer host);
of equal rules with different verdicts ``block`` wins.

Defined results: a null URL, or one without ``://``, has an empty host and
path; URLs that no rule fits get the default verdict and a null rule; rules
without a host or path are ignored; repeated URLs and ids are judged row by
row.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import smallest_hashes

_LAST = "\U0010ffff"
_LEAST = -(2**63)
#: Sampled URLs per range, from which the bounds are taken.
SAMPLE_PER_RANGE = 64


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels reversed, each followed by ``/``: subdomains share a prefix with their domain."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "/"), F.lit("/"))


def _bounds(rows: DataFrame, ranges: int) -> list[tuple[str, str, int]]:
    """At most ``ranges`` - 1 places that cut a bounded sample into equal parts."""
    sample = sorted(tuple(r) for r in
                    smallest_hashes(rows.select("_key", "_path", "_id"),
                                    ranges * SAMPLE_PER_RANGE, "_id", "_path").collect())
    step = len(sample) / ranges
    return sorted({sample[int(k * step)] for k in range(1, ranges)}) if sample else []


class Sweep:
    """The stack of rules whose interval holds the current key."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def _close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, path: str, rule: str, verdict: str) -> None:
        self._close(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, []))
        _, rules, lengths = self.stack[-1]
        if rules.get(path, ("", ""))[1] != "block":
            rules[path] = (rule, verdict)
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def judge(self, key: str, path: str) -> tuple[str, str] | None:
        self._close(key)
        best = None
        for _, rules, lengths in reversed(self.stack):  # the longest host first
            for n in lengths:
                found = rules.get(path[:n]) if n <= len(path) else None
                if found:
                    if best is None or len(found[0]) > len(best[0]):
                        best = found
                    break
        return best


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow",
          ranges: int | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (``page_id``, ``url``).

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block).
    """
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    url = F.col("url")
    urls = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"),
        path_of(url).alias("path"))
    urls = urls.select(
        host_key(F.col("host")).alias("_key"), F.col("path").alias("_path"),
        F.coalesce("page_id", F.lit(_LEAST)).alias("_id"), "page_id", "host", "path")
    bounds = _bounds(urls, ranges)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(bounds, row) for row in zip(
                *(batch.column(c).to_pylist() for c in ("_key", "_path", "_id")))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), batch.column("_key"),
                 pa.array([1] * len(at), pa.int32()), batch.column("path"),
                 pa.nulls(len(at), pa.string()), pa.nulls(len(at), pa.string()),
                 batch.column("page_id"), batch.column("host")], names)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, path, rule, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                first = bisect_right(bounds, (key, "", _LEAST))
                last = bisect_right(bounds, (key + _LAST, "", _LEAST))
                rows += [(at, key, 0, path, rule, verdict, None, None)
                         for at in range(first, last + 1)]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], names)

    names = ["_range", "_key", "_kind", "path", "rule", "verdict", "page_id", "host"]
    types = [pa.int32(), pa.string(), pa.int32(), *[pa.string()] * 3, pa.int64(), pa.string()]
    schema = ("_range int, _key string, _kind int, path string, rule string, verdict string, "
              "page_id long, host string")
    rule_host = lower_ascii(F.col("host"))
    opened = rules.where("host <> '' and path is not null and verdict is not null").select(
        host_key(rule_host).alias("_key"), "path",
        F.concat(rule_host, F.col("path")).alias("rule"), "verdict")
    merged = urls.select("_key", "_path", "_id", "page_id", "host", "path").mapInArrow(
        place, schema).unionByName(opened.mapInArrow(spread, schema))
    merged = merged.repartition(ranges, "_range").sortWithinPartitions(
        "_range", "_key", "_kind", "path")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, Sweep()
        for batch in batches:
            kept, found = [], []
            columns = [batch.column(c).to_pylist() for c in names[:6]]
            for k, (at, key, kind, path, rule, verdict) in enumerate(zip(*columns)):
                if at != current:
                    current, state = at, Sweep()
                if kind == 0:
                    state.open(key, path, rule, verdict)
                else:
                    kept.append(k)
                    found.append(state.judge(key, path) or (None, default))
            own = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [own.column("page_id"), own.column("host"), own.column("path"),
                 pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])

    return merged.mapInArrow(
        sweep, "page_id long, host string, path string, rule string, verdict string")
