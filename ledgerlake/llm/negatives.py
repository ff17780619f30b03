"""Hard-negative mining (operator 11) by Fagin's threshold algorithm.

For each anchor its best rows of the same label are positives; for each
positive the best rows of other labels, with scores in a window below the
positive's, are negatives. Scores are integer inner products.

Both searches run the threshold algorithm over blocks of candidates. A block
keeps one list of rows per dimension, sorted by component. An anchor reads the
lists of its non-zero components, from the top where its own component is
positive and from the bottom where it is negative, some places deeper in each
round. Rows seen for the first time are scored by random access. The threshold
is the score that a row with the last component read in every list would have:
no unseen row scores more. Reading stops once it is strictly below the kth
score of each of the anchor's windows (so that ties with smaller ids are still
seen), or below the window's lower end where it holds fewer than k rows.

Candidates and anchors are dealt into blocks of bounded size by a hash of
their row number in a written table, so equal vectors, ids or labels never
meet in one block more than others do. Each pair of an anchor block and a candidate
block is a group, each anchor takes its k best of each block along, and a
limited window picks among those. Block sizes decide balance, not results.

Defined results: rows with a null label or vector or a null or non-finite
component take no part; a null id is no anchor and comes last among equal
scores. Rows with the same id are rows of their own ("other rows" are other
rows of the table), so a repeated anchor row gives its rows again. A shorter
vector is as if filled up with zeros; an empty one scores 0 with every row.
Quantised components beyond 2**26 in size are held at that, which keeps the
scores of up to 2048 dimensions in 64 bits. An empty table gives no rows.
Other columns, whatever their names, are not read; there is no text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import written

POSITIVES = 5
NEGATIVES = 3
#: A negative scores between these percentages of its positive's score.
LEAST_PERCENT = 50
MOST_PERCENT = 95
SCALE = 256
#: Most rows of a block of candidates, least rows, and blocks wanted of small tables.
CANDIDATE_BLOCK = 16_384
LEAST_BLOCK = 2_048
BLOCKS = 32
ANCHOR_BLOCK = 8_192
#: Places read in each list in the first round; each later round reads as many as all before.
FIRST_DEPTH = 64
_MOST = 1 << 26
_NO_ID = np.iinfo(np.int64).max
_LEAST_SCORE = -_NO_ID


class SortedLists:
    """A block of candidates with, per dimension, its rows sorted by component both ways."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        rising = np.argsort(vectors, axis=0, kind="stable").astype(np.int32).T
        components = np.take_along_axis(vectors.T, rising, axis=1)
        #: List j falls by component j, list d + j rises.
        self.rows = np.ascontiguousarray(np.concatenate([rising[:, ::-1], rising]))
        self.components = np.concatenate([components[:, ::-1], components])

    def access(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Rounds: rows seen for the first time, their scores, and the most that an unseen
        row can score (minus infinity once all were seen)."""
        n, d = self.vectors.shape
        lists = np.concatenate([np.flatnonzero(anchor > 0), d + np.flatnonzero(anchor < 0)])
        if not len(lists):  # no list says anything: all scores are 0
            yield np.arange(n), np.zeros(n, np.int64), -np.inf
            return
        weights = anchor[lists % d].astype(np.float64)
        seen = np.zeros(n, bool)
        low, high, left = 0, min(n, FIRST_DEPTH), n
        while left:
            fresh = np.zeros(n, bool)
            fresh[self.rows[lists, low:high]] = True
            rows = np.flatnonzero(fresh > seen)
            seen[rows] = True
            left -= len(rows)
            bound = weights @ self.components[lists, high - 1] if left else -np.inf
            yield rows, (self.vectors[rows] @ anchor).astype(np.int64), bound
            low, high = high, min(n, 2 * high)


class Windows:
    """The best ``k`` rows of each of some windows of scores: highest score, then smallest id."""

    def __init__(self, k: int, least: list[int], most: list[int]):
        self.k = k
        self.least, self.most = np.array(least, np.int64), np.array(most, np.int64)
        self.score = self.id = self.row = np.empty(0, np.int64)  # best first
        self.first = np.zeros(len(least), np.int64)
        #: No row below these can come into the windows any more.
        self.kth = self.least

    def add(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        score = np.concatenate([self.score, scores])
        id_, row = np.concatenate([self.id, ids]), np.concatenate([self.row, rows])
        best = np.lexsort((row, id_, -score))
        self.score, self.id, self.row = score[best], id_[best], row[best]
        self.first = np.searchsorted(-self.score, -self.most)
        last = self.first + self.k - 1
        full = last < len(best)
        kth = self.score[np.where(full, last, 0)] if len(best) else self.least
        self.kth = np.where(full & (kth > self.least), kth, self.least)
        fewest = np.searchsorted(-self.score, -self.kth.min(), "right")
        self.score, self.id, self.row = self.score[:fewest], self.id[:fewest], self.row[:fewest]

    def found(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores, ids and row numbers of window ``i``."""
        a, b = self.first[i], self.first[i] + self.k
        own = self.score[a:b] >= self.least[i]
        return self.score[a:b][own], self.id[a:b][own], self.row[a:b][own]


def search(lists: SortedLists, ids: np.ndarray, rows: np.ndarray, usable: np.ndarray,
           anchor: np.ndarray, windows: Windows) -> None:
    """Fills ``windows`` with the usable candidates of a block by the threshold algorithm."""
    most = windows.most.max()
    for new, scores, bound in lists.access(anchor):
        new_at = np.flatnonzero(usable[new] & (scores >= windows.kth.min()) & (scores <= most))
        if len(new_at):
            new, scores = new[new_at], scores[new_at]
            windows.add(scores, ids[new], rows[new])
        if bound < windows.kth.min():
            return


# --- blocks -----------------------------------------------------------------


def prepared(vectors: DataFrame, label: Column, anchors: Column, row_id: str = "vec_id",
             vector: str = "embedding") -> DataFrame:
    """Rows that take part: row (a number of its own), id, label, anchor and the quantised
    components; a written table."""
    x = F.col(vector)

    def component(c: Column) -> Column:
        held = F.least(F.lit(SCALE) * c.cast("double"), F.lit(float(_MOST)))
        return F.floor(F.greatest(held, F.lit(-float(_MOST)))).cast("int")

    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return written(vectors.where(label.isNotNull() & x.isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("row"), F.col(row_id).cast("long").alias("id"),
        label.cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.transform(x, component).alias("q")), "vectors")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of a matrix, filled up with zeros."""
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lens = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lens == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lens), width), np.int32)
    out[np.arange(width) < lens[:, None]] = flat
    return out


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy()


def _exact(anchors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as the narrowest floats that hold every score exactly (products run fastest), or
    else as longs."""
    most = max(1, rows.shape[1])
    for part in (anchors, rows):
        most *= max(1, int(np.abs(part).max(initial=0)))
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return anchors.astype(kind), rows.astype(kind)


def _blocks(rows: DataFrame) -> tuple[int, int, int]:
    """Numbers of anchor blocks and of candidate blocks, and of dimensions."""
    n, anchors, width = rows.agg(
        F.count(F.lit(1)), F.count_if("anchor"), F.max(F.size("q"))).first()
    size = min(CANDIDATE_BLOCK, max(LEAST_BLOCK, n // BLOCKS))
    return max(1, -(-anchors // ANCHOR_BLOCK)), max(1, -(-n // size)), width or 0


def _over_blocks(anchors: DataFrame, rows: DataFrame, sizes: tuple[int, int, int],
                 find: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``find`` over each anchor block and each candidate block."""
    a_blocks, c_blocks, _ = sizes

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        columns = [F.col(c).alias(c) for c in df.columns]  # both sides come from one table
        return df.select(*columns, F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias(own)) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))) \
            .groupBy("a_block", "c_block")

    return dealt(anchors, "a_block", a_blocks, "c_block", c_blocks).cogroup(
        dealt(rows, "c_block", c_blocks, "a_block", a_blocks)).applyInArrow(find, schema)


def _table(columns: dict[str, list[np.ndarray]]) -> pa.Table:
    """Columns put together from parts; ids that stand for none become null."""
    out = {}
    for name, parts in columns.items():
        values = np.concatenate(parts) if parts else np.empty(0, np.int64)
        out[name] = pa.array(values, pa.int64(),
                             mask=values == _NO_ID if name.endswith("id") else None)
    return pa.table(out)


def positives(rows: DataFrame, sizes: tuple[int, int, int], k: int = POSITIVES) -> DataFrame:
    """row of each anchor, and place, positive_id and positive_score of its best other rows of
    the same label; a written table."""
    width = sizes[2]

    def find(anchors: pa.Table, block: pa.Table) -> pa.Table:
        a, x = _exact(_matrix(anchors.column("q"), width), _matrix(block.column("q"), width))
        a_row, a_label = anchors.column("row").to_numpy(), anchors.column("label").to_numpy()
        row, label, ids = block.column("row").to_numpy(), block.column("label").to_numpy(), \
            _ids(block.column("id"))
        own, found = [], []
        for value in np.unique(a_label):
            here = np.flatnonzero(label == value)
            if not len(here):
                continue
            lists = SortedLists(x[here])
            for i in np.flatnonzero(a_label == value):
                best = Windows(k, [_LEAST_SCORE], [-_LEAST_SCORE])
                search(lists, ids[here], row[here], row[here] != a_row[i], a[i], best)
                found.append(best.found(0))
                own.append(np.full(len(found[-1][0]), a_row[i]))
        return _table({"row": own, "positive_id": [f[1] for f in found],
                       "positive_row": [f[2] for f in found],
                       "positive_score": [f[0] for f in found]})

    found = _over_blocks(rows.where("anchor"), rows, sizes, find,
                         "row long, positive_id long, positive_row long, positive_score long")
    place = F.row_number().over(Window.partitionBy("row").orderBy(
        F.desc("positive_score"), F.asc_nulls_last("positive_id"), "positive_row"))
    return written(found.withColumn("place", place).where(F.col("place") <= k)
                   .drop("positive_row"), "positives")


def negatives(rows: DataFrame, chosen: DataFrame, sizes: tuple[int, int, int],
              k: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores, from the anchors' positives."""
    width = sizes[2]
    windows = chosen.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("place", "positive_id", "positive_score"))).alias("p"))
    anchors = rows.where("anchor").join(windows, "row").select(
        "row", "id", "label", "q", F.col("p.place").alias("place"),
        F.col("p.positive_id").alias("positive_id"),
        F.col("p.positive_score").alias("positive_score"))

    def find(anchors: pa.Table, block: pa.Table) -> pa.Table:
        a, x = _exact(_matrix(anchors.column("q"), width), _matrix(block.column("q"), width))
        a_row, a_label = anchors.column("row").to_numpy(), anchors.column("label").to_numpy()
        a_id = _ids(anchors.column("id"))
        places = anchors.column("place").to_pylist()
        p_ids = anchors.column("positive_id").to_pylist()
        p_scores = anchors.column("positive_score").to_pylist()
        row, label, ids = block.column("row").to_numpy(), block.column("label").to_numpy(), \
            _ids(block.column("id"))
        lists = SortedLists(x) if len(x) else None
        out: dict[str, list[np.ndarray]] = {c: [] for c in _NEGATIVE}
        for i in range(len(a) if lists else 0):
            # 50 p <= 100 s <= 95 p over integers
            # of a negative positive's window the ends have changed places: it is empty
            of = [j for j, p in enumerate(p_scores[i]) if p >= 0]
            if not of:
                continue
            best = Windows(k, [-(-LEAST_PERCENT * p_scores[i][j] // 100) for j in of],
                           [MOST_PERCENT * p_scores[i][j] // 100 for j in of])
            search(lists, ids, row, label != a_label[i], a[i], best)
            for w, j in enumerate(of):
                found = best.found(w)
                values = {"row": a_row[i], "place": places[i][j], "anchor_id": a_id[i],
                          "positive_id": _NO_ID if p_ids[i][j] is None else p_ids[i][j],
                          "positive_score": p_scores[i][j]}
                for c, value in values.items():
                    out[c].append(np.full(len(found[0]), value, np.int64))
                for c, part in zip(("negative_score", "negative_id", "negative_row"), found):
                    out[c].append(part)
        return _table(out)

    found = _over_blocks(anchors, rows, sizes, find, ", ".join(f"{c} long" for c in _NEGATIVE))
    rank = F.row_number().over(Window.partitionBy("row", "place").orderBy(
        F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative_row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


_NEGATIVE = ["row", "place", "anchor_id", "positive_id", "positive_score", "negative_id",
             "negative_row", "negative_score"]


def mine(vectors: DataFrame, label: Column, anchors: Column) -> DataFrame:
    """Hard negatives of every anchor row; ``label`` and ``anchors`` are over ``vectors``."""
    rows = prepared(vectors, label, anchors)
    sizes = _blocks(rows)
    return negatives(rows, positives(rows, sizes), sizes)
