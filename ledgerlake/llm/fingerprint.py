"""Document fingerprints (operator 4): improbable byte windows in chained Bloom filters.

Every window of ``WINDOW`` bytes has an entropy; how rare each (quantised)
entropy is in the corpus ranks the windows, the rarest first. Entropies of no
use (nearly constant windows) never count. Among ``NEAR`` neighbouring windows
the rarest, leftmost first, gets a point; windows with at least ``POINTS``
points are the text's features. In repetitive text the points may be spread
over so many windows that none gets there: in a stretch of ``BARE`` windows or
more without a feature, every window with a point is one. A text that still
has none (all its windows are of no use) has all its windows as features. Each
feature's hash sets ``BITS_PER_FEATURE`` bits of a Bloom filter of
``FILTER_BYTES`` bytes; after ``PER_FILTER`` features the next filter of the
chain starts. Two fingerprints are compared by the best match of each filter of
the shorter chain in the longer one: common bits beyond what chance explains,
over what they could be.

Texts shorter than ``SHORT`` code points have few long windows. They have two
chains: all their windows of ``SHORT_WINDOW`` bytes (or the text, if shorter)
are features of the first, the second has the features of a long text. Two
short texts are compared by their first chains, a short and a long one by the
features that both have; a text of fewer than ``WINDOW`` bytes has none of
these, and shares nothing with a long text (one of fewer than ``WINDOW`` +
``NEAR`` - 1 bytes rarely does, even if the long text contains it). An empty text has no feature; two
fingerprints without features are alike (1), one with and one without are not
(0).

The rank table is learned from the corpus itself: a histogram of quantised
window entropies over all texts, summed in Spark (``LEVELS`` + 1 counts).

The neighbour of a text in the order of ids comes from a range partitioning:
ranges of ids are sorted in tasks, and the first text of each range is also
sent to the range before it (the very first one to the last range).

Defined results: null texts are empty; null ids come first; rows with equal
ids are ordered by text; a single row is its own next.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import text_groups

WINDOW = 32
NEAR = 32
POINTS = 8
#: Windows in a row without a feature from which one point is enough.
BARE = 2 * NEAR
LEVELS = 200
FILTER_BYTES = 256
BITS_PER_FEATURE = 5
PER_FILTER = 160
SHORT = 128
SHORT_WINDOW = 3
#: Overlap that two unrelated filters may reach above chance.
SLACK = 0.3
#: Entropies at or below this share of the largest are never features.
DULL = 0.1
#: Bytes handled at a time.
_CHUNK = 1 << 17

_C = np.arange(WINDOW + 1, dtype=np.float64)
_CLOG = np.where(_C > 0, _C * np.log2(np.maximum(_C, 1)), 0.0)
#: What a byte adds to the sum of c log c when c equal bytes are there already.
_ADDS = np.round((_CLOG[1:] - _CLOG[:-1]) * 65536).astype(np.int64)


def window_levels(data: np.ndarray) -> np.ndarray:
    """Quantised entropy (0 to ``LEVELS``) of every window of ``data`` (uint8).

    The sum of c log c over a window's byte counts changes by what the new
    byte adds and the old one took; both depend on the equal bytes within a
    window's length, counted with one comparison per distance. All numbers are
    integers, so a window's level depends on its bytes only.
    """
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.uint8)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        before[d:] += same
        after[:-d] += same
    counts = np.bincount(data[:WINDOW], minlength=256)
    first = int(sum(_ADDS[:c].sum() for c in counts))
    change = _ADDS[before[WINDOW:]] - _ADDS[after[:n - WINDOW]]
    total = np.empty(n - WINDOW + 1, np.int64)
    total[0] = first
    np.cumsum(change, out=total[1:])
    total[1:] += first
    top = int(_ADDS.sum())
    return ((top - total) * LEVELS // top).clip(0, LEVELS).astype(np.uint8)


def level_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all texts have each level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                data = np.frombuffer((text or "").encode(), np.uint8)
                for a in range(0, max(1, len(data) - WINDOW + 1), _CHUNK):
                    part = window_levels(data[a:a + _CHUNK + WINDOW - 1])
                    total += np.bincount(part, minlength=LEVELS + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(LEVELS + 1)), pa.array(total)], ["level", "n"])

    rows = docs.select("text").mapInArrow(run, "level long, n long").groupBy("level").agg(
        F.sum("n").alias("n")).collect()
    out = np.zeros(LEVELS + 1, np.int64)
    for r in rows:
        out[r["level"]] = r["n"]
    return out


def rank_table(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, the rarest 1, ties by level; 0xFFFF for levels that never count."""
    order = np.lexsort((np.arange(len(counts)), counts))
    ranks = np.empty(len(counts), np.uint16)
    ranks[order] = np.arange(1, len(counts) + 1)
    ranks[:int(DULL * LEVELS) + 1] = 0xFFFF
    return ranks


def window_points(data: np.ndarray, bounds: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Points of the window at each byte of the texts that ``bounds`` cut ``data`` into.

    Windows that cross a bound never count, and neither do neighbourhoods.
    """
    n = len(data)
    points = np.zeros(n + 1, np.uint8)
    if n >= WINDOW:
        # windows and neighbourhoods inside a text
        room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
        width = WINDOW + NEAR - 1
        for a in range(0, n - WINDOW + 1, _CHUNK):
            part = data[a:a + _CHUNK + width - 1]
            rank = ranks[window_levels(part)].astype(np.uint32)
            m = len(rank)
            rank[room[a:a + m] < WINDOW] = 0xFFFF
            key = (rank.astype(np.uint64) << np.uint64(32)) | np.arange(m, dtype=np.uint64)
            least, span = key, 1
            while span < NEAR:  # minima over 2, 4, ... neighbouring windows
                least = np.minimum(least[:-span], least[span:]) if len(least) > span \
                    else least[:0]
                span *= 2
            starts = min(len(least), _CHUNK)
            least = least[:starts][room[a:a + starts] >= width]
            least = least[(least >> np.uint64(32)) < 0xFFFF]
            at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
            got = np.bincount(at, minlength=m)
            points[a:a + m] += got[:m].astype(np.uint8)
    return points


def feature_starts(data: np.ndarray, bounds: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Start of each window with ``POINTS`` points or more, in order."""
    return np.flatnonzero(window_points(data, bounds, ranks) >= POINTS)


def with_bare_stretches(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of the windows with ``POINTS`` points, and in bare stretches of those with any."""
    picked = points >= POINTS
    # a stretch ends at a feature and at the ends of its text
    stops = np.sort(np.concatenate(
        [np.flatnonzero(picked), bounds[:-1] - 1, bounds[1:] - WINDOW + 1]))
    weak = np.flatnonzero((points > 0) & ~picked)
    after = np.searchsorted(stops, weak)
    picked[weak[stops[after] - stops[after - 1] > BARE]] = True
    return np.flatnonzero(picked)


_rng = np.random.default_rng(20240301)
_TIMES = _rng.integers(0, 2**64, WINDOW, np.uint64) | np.uint64(1)


def _hashes(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes at each start."""
    h = np.full(len(starts), np.uint64(width))
    for k in range(width):
        h += (data[starts + k].astype(np.uint64) + np.uint64(1)) * _TIMES[k]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _all_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the windows of ``width`` bytes, each once, in order of appearance."""
    found = []
    for a in range(0, len(data) - width + 1, _CHUNK):
        found.append(_once(_hashes(
            data, np.arange(a, min(a + _CHUNK, len(data) - width + 1)), width)))
    return _once(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _once(hashes: np.ndarray) -> np.ndarray:
    _, first = np.unique(hashes, return_index=True)
    return hashes[np.sort(first)]


class Fingerprint:
    """A chain of Bloom filters and how many features each holds.

    ``as_long``: a short text's second chain, to compare it with long texts.
    """

    __slots__ = ("filters", "features", "as_long")

    def __init__(self, filters: np.ndarray, features: np.ndarray,
                 as_long: Fingerprint | None = None):
        self.filters, self.features, self.as_long = filters, features, as_long

    def __str__(self) -> str:
        """Feature counts and the filters, base 64, a second chain after ``;``; empty without
        features."""
        if not len(self.features):
            return ""
        own = f"{int(self.features.sum())}:" + base64.b64encode(self.filters.tobytes()).decode()
        return own if self.as_long is None else f"{own};{self.as_long}"

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        if not text:
            return cls(np.zeros((0, FILTER_BYTES), np.uint8), np.zeros(0, np.int64))
        text, short, second = text.partition(";")
        if short:
            out = cls.parse(text)
            out.as_long = cls.parse(second)
            return out
        total, _, body = text.partition(":")
        filters = np.frombuffer(base64.b64decode(body), np.uint8).reshape(-1, FILTER_BYTES)
        counts = np.full(len(filters), PER_FILTER, np.int64)
        counts[-1] = int(total) - PER_FILTER * (len(filters) - 1)
        return cls(filters, counts)


def chain(hashes: np.ndarray) -> Fingerprint:
    """The fingerprint of features in order, equal hashes only once."""
    hashes = _once(hashes)
    n = -(-len(hashes) // PER_FILTER)
    bits = np.zeros((n, FILTER_BYTES * 8), bool)
    row = np.arange(len(hashes)) // PER_FILTER
    for k in range(BITS_PER_FEATURE):
        bits[row, ((hashes >> np.uint64(11 * k)) & np.uint64(2047)).astype(np.int64)] = True
    return Fingerprint(np.packbits(bits, axis=1) if n else np.zeros((0, FILTER_BYTES), np.uint8),
                       np.bincount(row, minlength=n))


def fingerprints(texts: list[str], ranks: np.ndarray) -> list[Fingerprint]:
    data = [t.encode() for t in texts]
    out: list[Fingerprint | None] = [None] * len(texts)
    flat = np.frombuffer(b"".join(data), np.uint8)
    bounds = np.cumsum([0, *map(len, data)])
    starts = with_bare_stretches(window_points(flat, bounds, ranks), bounds)
    cut = np.searchsorted(starts, bounds)
    hashes = _hashes(flat, starts, WINDOW)
    for i, t in enumerate(texts):
        own = hashes[cut[i]:cut[i + 1]]
        made = chain(own if len(own) else _all_hashes(flat[bounds[i]:bounds[i + 1]], WINDOW))
        if len(t) < SHORT:
            width = min(SHORT_WINDOW, len(data[i]))
            own = np.arange(bounds[i], bounds[i + 1] - width + 1) if width else np.zeros(0, int)
            as_long, made = made, chain(_hashes(flat, own, width))
            made.as_long = as_long
        out[i] = made
    return out


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """From 0 to 1: mean over the shorter chain of the best match in the longer one."""
    if not len(a.features) or not len(b.features):
        return float(len(a.features) == len(b.features))
    if (a.as_long is None) != (b.as_long is None):  # a short and a long text
        a, b = a.as_long or a, b.as_long or b
        if not len(a.features) or not len(b.features):
            return 0.0
    if a.filters.shape == b.filters.shape and (a.filters == b.filters).all():
        return 1.0
    if len(a.features) > len(b.features) or (
            len(a.features) == len(b.features) and a.features.sum() > b.features.sum()):
        a, b = b, a
    m = FILTER_BYTES * 8
    x, y = a.filters.view(np.uint64), b.filters.view(np.uint64)
    ones_x, ones_y = np.bitwise_count(x).sum(axis=1), np.bitwise_count(y).sum(axis=1)
    stay = 1 - 1 / m  # share of bits that one insertion leaves alone
    total = 0.0
    for i in range(len(x)):
        both = np.bitwise_count(x[i][None, :] & y).sum(axis=1).astype(np.float64)
        most = np.minimum(ones_x[i], ones_y)
        s, t = BITS_PER_FEATURE * a.features[i], BITS_PER_FEATURE * b.features
        chance = m * (1 - stay ** s - stay ** t + stay ** (s + t))
        cutoff = SLACK * (most - chance) + chance
        total += np.clip((both - cutoff) / np.maximum(most - cutoff, 1e-9), 0, 1).max()
    return float(total / len(x))


def next_texts(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows (_range, doc_id, text, _last) dealt and sorted so that each text's next follows it.

    Rows with ``_last`` only end a range: they are the next of the row before.
    Ranges hold about equally many rows; four per partition, dealt by a hash,
    spread a stretch of ids with long texts over several partitions.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * partitions
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    cuts = rows.select("doc_id").where("doc_id is not null").approxQuantile(
        "doc_id", [k / ranges for k in range(1, ranges)], 0.1 / ranges) if ranges > 1 else []
    cuts = sorted({int(c) for c in cuts})

    def range_of(c):
        if not cuts:
            return F.lit(0)
        return F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda b: b <= c)), F.lit(0))

    placed = rows.withColumn("_range", range_of(F.col("doc_id")))
    # the first row of each range, found from ids alone; one row per range
    least = F.lit(-(2**63))
    key = F.coalesce("doc_id", least)
    firsts = sorted((r["_range"], r["k"]) for r in
                    placed.groupBy("_range").agg(F.min(key).alias("k")).collect())
    before = {k: firsts[i - 1][0] for i, (_, k) in enumerate(firsts)}
    again = F.lit(None).cast("int")
    if before:
        again = F.try_element_at(
            F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), key)
    twice = placed.select("doc_id", "text", F.explode(F.when(
        again.isNull(), F.array(F.struct(F.col("_range").alias("_range"),
                                         F.lit(False).alias("_last")))).otherwise(
        F.array(F.struct(F.col("_range").alias("_range"), F.lit(False).alias("_last")),
                F.struct(again.alias("_range"), F.lit(True).alias("_last"))))).alias("x"))
    return twice.select("x._range", "doc_id", "text", "x._last").repartition(partitions, "_range") \
        .sortWithinPartitions("_range", "_last", F.asc_nulls_first("doc_id"), "text")


def compare_with_edits(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Fingerprint of each text and of its edited text, and their likeness; see the contract.

    The edited text has its last quarter replaced by the first code points of
    the next text.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]

    def judge(rows: list[tuple], follow: str) -> pa.RecordBatch:
        """``rows``: id and text; ``follow``: the text after the last of them."""
        texts = [t for _, t in rows]
        edited = []
        for t, f in zip(texts, [*texts[1:], follow]):
            k = len(t) // 4
            edited.append(t[:len(t) - k] + f[:k])
        made = fingerprints([*texts, follow], ranks)
        changed = fingerprints(edited, ranks)
        return pa.RecordBatch.from_arrays([
            pa.array([i for i, _ in rows], pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
            pa.array([str(f) for f in made[:-1]]), pa.array([str(f) for f in changed]),
            pa.array([likeness(a, b) for a, b in zip(made, changed)]),
            pa.array([likeness(a, b) for a, b in zip(made, made[1:])])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []  # the last row waits for its next
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            marks = zip(batch.column("_range").to_pylist(), batch.column("_last").to_pylist())
            ends = list(marks)
            for a, b in text_groups(texts, 1_000_000):
                for k in range(a, b):
                    at, last = ends[k]
                    if at != current:
                        current, held = at, []
                    if last:
                        if held:  # equal ids may send several rows: the first is the next
                            yield judge(held, texts[k])
                        held = []
                    else:
                        held.append((ids[k], texts[k]))
                if len(held) > 1:
                    yield judge(held[:-1], held[-1][1])
                    held = held[-1:]

    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    return next_texts(docs).mapInArrow(run, schema)
