"""N-gram Jaccard join (operator 8): MinHash banding, then exact comparison of n-gram sets.

1. One pass over the texts makes a key of each text's words (equal keys:
   copies) and its MinHash bands. Rows and bands per hash are chosen for a
   target recall at the threshold (:func:`choose_bands`).
2. Copies collapse to one representative, so copies never meet in a bucket.
3. Representatives shuffle on their band hashes. Each bucket contributes one
   edge per member, to its smallest member; connected components of these
   edges hold every candidate pair.
4. Within a component all pairs of representatives are compared by their
   whole n-gram sets, in blocks of bounded size: a large component is cut into
   blocks, each pair of blocks is one group of rows, and a group emits only
   its link counts and a spanning forest, never its pairs. Rare n-grams are
   merged, so texts that a chain of others has brought into one component cost
   only what they share.
5. Counts are summed, the forests' components are the classes.

Nothing is capped: a group of near copies of any size is compared in full. The
work in a component grows with the square of its different texts, the rows
with blocks times texts.

Words are runs without blanks (space, tab to carriage return), as they stand.
Defined results: an empty table gives an empty result; texts are read whole, a
very long one is a block of its own; only doc_id and text are read, so other
columns' names can't clash; a text of one to ``n`` - 1 words has one n-gram, all its
words; null and empty texts have none and link to nothing (their class is
their own id). For :func:`join_classes` rows that share a doc_id count as one
document (the smallest key, one with words before none), a null doc_id as an id
of its own; for :func:`one_of_each` rows with one doc_id and different texts are
different documents, and rows without an id all stay.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import WORD, WordTable, salted_join, text_parts, written
from ledgerlake.llm.components import components

N = 5
THRESHOLD = 0.8
RECALL = 0.99
MAX_HASHES = 100
#: N-grams and texts in a block at most, on average.
BLOCK_NGRAMS, BLOCK_TEXTS = 1_000_000, 512
#: A visit to a pair that shares an n-gram costs as much as this many counts of a bit.
MERGE_COST = 320
#: Such visits at a time.
MOST_VISITS = 4_000_000

_WORDS = re.compile(WORD)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL,
                 max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most rows (fewest false candidates) for which the bands
    that reach ``recall`` at ``threshold`` take no more than ``max_hashes`` hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no bands reach this recall; allow more hashes")
    return best


class NgramReader:
    """Hashed n-grams of texts."""

    def __init__(self, n: int = N):
        self.n = n
        self.table = WordTable(lambda words: (np.fromiter(
            (xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words)),))

    def read(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Word hashes of each text; n-gram hashes of all, and the text that each belongs to."""
        words: list[str] = []
        counts = []
        for t in texts:
            own = _WORDS.findall(t)
            counts.append(len(own))
            words += own
        ends = np.cumsum(counts)
        at = self.table.lookup(words)
        h = self.table.columns[0][at] if words else np.zeros(0, np.uint64)
        doc = np.repeat(np.arange(len(texts)), counts)
        # words beyond a text's end count as 0, so a short text still has one n-gram
        start = np.flatnonzero((np.arange(len(h)) + self.n <= np.repeat(ends, counts))
                               | (np.arange(len(h)) == np.repeat(ends - counts, counts)))
        gram = np.zeros(len(start), np.uint64)
        for k in range(self.n):
            at = start + k
            inside = at < ends[doc[start]]
            gram = gram * _MIX + np.where(inside, h[np.minimum(at, len(h) - 1)], np.uint64(0))
            gram ^= gram >> np.uint64(29)
        per_text = [h[e - c:e] for e, c in zip(ends, counts)]
        return per_text, gram * _MIX, doc[start]


def sketches(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """Per row: doc_id, the key of its words (k1, k2; null without words), n_words, bands."""
    rng = np.random.default_rng(20240229)
    times = rng.integers(0, 2**64, bands * rows, np.uint64) | np.uint64(1)
    masks = rng.integers(0, 2**64, bands * rows, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = NgramReader(n)
        for batch in batches:
            ids, keys, sizes = batch.column(0), [], []
            band = np.zeros((batch.num_rows, bands), np.uint64)
            for a, texts in text_parts(batch.column(1)):
                words, grams, owner = reader.read(texts)
                for w in words:
                    d = xxhash.xxh3_128_digest(w.tobytes()) if len(w) else None
                    keys.append(d)
                    sizes.append(len(w))
                if not len(grams):
                    continue
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                at = a + owner[first]
                for i in range(bands):
                    value = np.full(len(first), i, np.uint64)
                    for j in range(i * rows, (i + 1) * rows):
                        least = np.minimum.reduceat((grams ^ masks[j]) * times[j], first)
                        value = (value ^ least) * _MIX
                        value ^= value >> np.uint64(32)
                    band[at, i] = value
            low = [None if k is None else int.from_bytes(k[:8], "little", signed=True)
                   for k in keys]
            high = [None if k is None else int.from_bytes(k[8:], "little", signed=True)
                    for k in keys]
            lists = pa.ListArray.from_arrays(
                np.arange(0, band.size + 1, bands, dtype=np.int32),
                pa.array(band.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                 pa.array(sizes, pa.int64()), lists], ["doc_id", "k1", "k2", "n_words", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, k1 long, k2 long, n_words long, bands array<long>")


def ngram_sets(rows: DataFrame, n: int) -> DataFrame:
    """From (comp, tasks, rep, copies, k1, k2, text): the first four and the n-gram set.

    Rows whose text has another key (a repeated doc_id) are left out.
    """
    names = ["comp", "tasks", "rep", "copies"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = NgramReader(n)
        for batch in batches:
            k1, k2 = (batch.column(k).to_pylist() for k in ("k1", "k2"))
            for a, texts in text_parts(batch.column("text")):
                words, grams, owner = reader.read(texts)
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                kept, sets = [], []
                for i, w in enumerate(words):
                    d = xxhash.xxh3_128_digest(w.tobytes())
                    if (int.from_bytes(d[:8], "little", signed=True) == k1[a + i]
                            and int.from_bytes(d[8:], "little", signed=True) == k2[a + i]):
                        kept.append(a + i)
                        sets.append(np.unique(grams[cuts[i]:cuts[i + 1]]).view(np.int64))
                if kept:
                    own = batch.take(pa.array(kept))
                    ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*(own.column(c) for c in names),
                         pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets)))],
                        [*names, "grams"])

    return rows.mapInArrow(run, "comp long, tasks array<struct<i:int,j:int,side:int>>, "
                                "rep long, copies long, grams array<long>")


def common_ngrams(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each set of ``left`` has in common with each of ``right``.

    An n-gram of many sets is one bit of each, counted for all pairs at once;
    the sets of a rarer one are merged by n-gram, so their pairs alone are
    visited. The border is where a merge would cost more than a bit, so pairs
    without a common n-gram cost next to nothing.
    """
    shape = len(left), len(right)
    both = np.zeros(shape, np.int64)
    size_l, size_r = ([len(s) for s in side] for side in (left, right))
    term = np.unique(np.concatenate([*left, *right]), return_inverse=True)[1]
    term_l, term_r = term[:sum(size_l)], term[sum(size_l):]
    owner_l, owner_r = (np.repeat(np.arange(len(s)), s) for s in (size_l, size_r))
    n = int(term.max()) + 1 if len(term) else 0
    in_l, in_r = np.bincount(term_l, minlength=n), np.bincount(term_r, minlength=n)
    dense = in_l * in_r * MERGE_COST > both.size

    number = np.cumsum(dense) - 1
    width = -(-int(dense.sum()) // 64)

    def as_bits(term: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        bits, use = np.zeros((width, texts), np.uint64), dense[term]
        bit = number[term[use]]
        np.bitwise_or.at(bits, (bit // 64, owner[use]), np.uint64(1) << (bit % 64).astype(np.uint64))
        return bits

    for x, y in zip(as_bits(term_l, owner_l, shape[0]), as_bits(term_r, owner_r, shape[1])):
        both += np.bitwise_count(x[:, None] & y[None, :])  # 64 n-grams at a time

    order = np.argsort(term_r, kind="stable")
    begin = np.cumsum(in_r) - in_r
    use = np.flatnonzero(~dense[term_l] & (in_r[term_l] > 0))
    ends = np.cumsum(in_r[term_l[use]])
    at = 0
    while at < len(use):  # a bounded number of visits at a time
        past = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, past + MOST_VISITS, "right")))
        some = use[at:upto]
        count = in_r[term_l[some]]
        shift = np.repeat(begin[term_l[some]] - (np.cumsum(count) - count), count)
        hit = owner_r[order[np.arange(len(shift)) + shift]]
        both += np.bincount(np.repeat(owner_l[some], count) * shape[1] + hit,
                            minlength=both.size).reshape(shape)
        at = upto
    return both


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, copies: np.ndarray,
           threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked copies of each text, and a label per text: the first text it is connected to.

    ``left`` and ``right`` are the texts of the two sides (the same for a
    block with itself).
    """
    size = np.array([len(s) for s in sets])
    both = common_ngrams([sets[i] for i in left], [sets[i] for i in right])
    union = size[left][:, None] + size[right][None, :] - both
    linked = (both >= threshold * union - 1e-9) & (left[:, None] != right[None, :])
    step = max(1, 4_000_000 // max(1, len(right) * 8))
    total = np.zeros(len(sets), np.int64)
    total[left] += linked @ copies[right]
    if left is not right:
        total[right] += linked.T @ copies[left]
    label = np.arange(len(sets))
    while True:
        before = label.copy()
        for a in range(0, len(left), step):
            rows = left[a:a + step]
            near = np.where(linked[a:a + step], label[right][None, :], len(sets)).min(axis=1)
            label[rows] = np.minimum(label[rows], near)
        far = np.full(len(right), len(sets))
        for a in range(0, len(left), step):
            far = np.minimum(far, np.where(linked[a:a + step], label[left[a:a + step]][:, None],
                                           len(sets)).min(axis=0))
        label[right] = np.minimum(label[right], far)
        label = label[label]
        if (label == before).all():
            return total, label


def compare(sets: DataFrame, threshold: float) -> DataFrame:
    """Link counts (``rep``, ``links``) and forest edges (``rep``, ``root``) of each block pair.

    A group of rows has the same comp, i and j; ``side`` tells the two blocks
    apart. Rows arrive sorted by group, so one group is held at a time.
    """
    def finish(key, rows) -> pa.RecordBatch:
        unique = {r[0]: r for r in rows}  # a repeated row of the table counts once
        rows = [unique[k] for k in sorted(unique)]
        reps = np.array([r[0] for r in rows], np.int64)
        side = np.array([r[2] for r in rows])
        if key[1] == key[2]:
            left = right = np.arange(len(rows))
        else:
            left, right = np.flatnonzero(side == key[1]), np.flatnonzero(side == key[2])
        if len(left) and len(right) and len(rows) > 1:
            links, label = _links([r[3] for r in rows], left, right,
                                  np.array([r[1] for r in rows], np.int64), threshold)
        else:
            links, label = np.zeros(len(rows), np.int64), np.arange(len(rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(reps), pa.array(links), pa.array(reps[label])], ["rep", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, done = None, [], []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("comp", "i", "j"))))
            reps, copies, side = (batch.column(c).to_pylist() for c in ("rep", "copies", "side"))
            grams = batch.column("grams")
            ends, flat = grams.offsets.to_numpy(), grams.values.to_numpy()
            for k, own in enumerate(keys):
                if own != key:
                    if rows:
                        done.append(finish(key, rows))
                    key, rows = own, []
                rows.append((reps[k], copies[k], side[k], flat[ends[k]:ends[k + 1]]))
            if len(done) > 500:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
                done = []
            # the rows that stay must not keep the whole batch alive
            rows = [(r, c, s, np.array(g)) for r, c, s, g in rows]
        if rows:
            done.append(finish(key, rows))
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()

    return sets.mapInArrow(run, "rep long, links long, root long")


def join_classes(docs: DataFrame, n: int = N, threshold: float = THRESHOLD,
                 recall: float = RECALL, max_hashes: int = MAX_HASHES) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_copies.

    ``class_id`` is the smallest doc_id of the documents that are connected by
    links (Jaccard similarity of the n-gram sets at or above ``threshold``),
    ``n_links`` the number of documents linked to this one, copies included,
    ``n_copies`` the number of documents with its words (itself included).
    """
    bands, rows = choose_bands(threshold, recall, max_hashes)
    sketch = sketches(docs, n, bands, rows).groupBy("doc_id").agg(
        F.min(F.struct(F.col("k1").isNull().alias("wordless"), "k1", "k2", "n_words",
                       "bands")).alias("s"))
    sketch = written(sketch.select("doc_id", "s.*").drop("wordless"), "sketches")
    reps = written(sketch.where("k1 is not null and doc_id is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
        F.first("n_words").alias("n_words"), F.first("bands").alias("bands")), "texts")

    member = reps.select("rep", F.explode("bands").alias("bucket"))
    full = member.groupBy("bucket").agg(F.min("rep").alias("first"),
                                        F.count(F.lit(1)).alias("n")).where("n > 1")
    edges = salted_join(member, full.select("bucket", "first"), ["bucket"], "rep")
    tree = components(edges.select(F.col("rep").alias("a"), F.col("first").alias("b")))

    # texts with candidates: their component and its blocks
    inside = tree.select(F.col("node").alias("rep"), F.col("root").alias("comp")).unionByName(
        tree.select(F.col("root").alias("rep"), F.col("root").alias("comp")).distinct())
    sized = written(inside.join(reps.drop("bands"), "rep"), "candidates")
    total = sized.groupBy("comp").agg(F.ceil(F.greatest(
        F.sum("n_words") / BLOCK_NGRAMS, F.count(F.lit(1)) / BLOCK_TEXTS)).cast("int").alias("nb"))
    dealt = salted_join(sized, total, ["comp"], "rep", salts=8).withColumn(
        "blk", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
    tasks = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda x: F.struct(
        F.least("blk", x).alias("i"), F.greatest("blk", x).alias("j"), F.col("blk").alias("side")))
    wanted = dealt.select("comp", tasks.alias("tasks"), "rep", "copies", "k1", "k2")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    sets = ngram_sets(wanted.join(texts, "rep"), n)
    groups = sets.select("comp", F.explode("tasks").alias("t"), "rep", "copies", "grams").select(
        "comp", "t.i", "t.j", "t.side", "rep", "copies", "grams")
    groups = groups.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    found = written(compare(groups, threshold), "links")

    links = found.groupBy("rep").agg(F.sum("links").alias("links")).where("links > 0")
    classes = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = (reps.select("k1", "k2", "rep", "copies")
             .join(links, "rep", "left")
             .join(classes.select(F.col("node").alias("rep"), "root"), "rep", "left")
             .where("copies > 1 or links is not null or root is not null")
             .select("k1", "k2", F.coalesce("root", "rep").alias("class"), "copies",
                     F.coalesce("links", F.lit(0)).alias("links")))
    out = salted_join(sketch.select("doc_id", "k1", "k2"), known, ["k1", "k2"], "doc_id", "left")
    own = F.col("doc_id").isNotNull()  # a null id has no class
    copies = F.when(own, F.coalesce("copies", F.lit(1))).otherwise(F.lit(1))
    return out.select(
        "doc_id", F.when(own, F.coalesce("class", "doc_id")).alias("class_id"),
        F.when(own, F.coalesce("links", F.lit(0)) + copies - 1).otherwise(F.lit(0))
        .cast("long").alias("n_links"),
        copies.cast("long").alias("n_copies"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The first document of each class, and the rows without an id; columns as they were.

    Rows with the same doc_id and text are one document, rows with the same
    doc_id and different texts are several. The first has the smallest doc_id,
    and of several texts of that the smallest key.
    """
    row = F.struct("*").alias("_row")
    packed = docs.select(F.col("doc_id").cast("long").alias("_id"),
                         F.xxhash64("text").alias("_key"), row)
    named = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_key"), "text")
    several = named.groupBy("_id").agg(F.min("_key").alias("a"), F.max("_key").alias("b")) \
        .where("a <> b")
    if several.isEmpty():
        kept = join_classes(docs, **options).where("class_id = doc_id").select(
            F.col("doc_id").alias("_id"))
        first = packed.join(kept, "_id").groupBy("_id").agg(F.min_by("_row", "_key").alias("_row"))
    else:  # each text of an id gets a number of its own to be joined by
        numbers = written(named.select("_id", "_key").distinct().withColumn(
            "_number", F.monotonically_increasing_id()), "numbers")
        classes = join_classes(named.join(numbers, ["_id", "_key"]).select(
            F.col("_number").alias("doc_id"), "text"), **options)
        kept = numbers.join(classes, F.col("_number") == F.col("doc_id")).groupBy("class_id").agg(
            F.min(F.struct("_id", "_key")).alias("x")).select("x.*")
        first = packed.join(kept, ["_id", "_key"]).groupBy("_id", "_key").agg(
            F.first("_row").alias("_row"))
    nameless = packed.where("_id is null")
    return first.select("_row.*").unionByName(nameless.select("_row.*"))
