"""Best-fit packing (operator 1): documents' tokens into sequences of fixed length.

Each document's ids get an end mark and are cut into pieces of at most
``length`` tokens; only longer documents are cut. Pieces are packed online in
bounded space: a fixed number of open sequences, and a bitset with one bit per
free space that some open sequence has. The next piece goes to the open
sequence with the least free space that fits it (the lowest set bit at or
above its length); if none fits, a new sequence opens, and when all are in use
the fullest (the lowest set bit) closes. A piece's place is known when it is
placed, so rows stream through with memory for the open sequences only.

Pieces are dealt over groups by a hash of (document, piece); each group is
packed by itself. The number of groups follows the total number of tokens
(``GROUP_TOKENS`` each), so a group costs at most a few half-filled sequences
among tens of thousands. Within a group pieces come in the order of another
hash, so that large and small ones mix and a rerun gives the same result. Each
group is one task.

Defined results: a null text is empty (its piece holds only the end mark);
rows with the same doc_id are packed row by row; a null doc_id stays null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import PACKING_WORDS, text_encoder
from ledgerlake.llm.common import text_parts, written

LENGTH = 2048
OPEN_SEQUENCES = 1024
GROUP_TOKENS = 40_000_000
END = 0


class BestFit:
    """Bounded-space online best fit: ``place`` gives the sequence and the offset of a piece."""

    def __init__(self, length: int = LENGTH, open_sequences: int = OPEN_SEQUENCES):
        self.length, self.most = length, open_sequences
        self.with_space: list[list[int]] = [[] for _ in range(length + 1)]
        self.bits = self.open = self.opened = 0

    def _take(self, free: int) -> int:
        """An open sequence with this free space."""
        stack = self.with_space[free]
        out = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        return out

    def place(self, size: int) -> tuple[int, int]:
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.open -= 1
            free, sequence = self.length, self.opened
            self.opened += 1
            self.open += 1
        if free == size:
            self.open -= 1  # full
        else:
            self.with_space[free - size].append(sequence)
            self.bits |= 1 << (free - size)
        return sequence, self.length - free


def cut(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``sizes`` in pieces of at most ``length``: row, number and size of each piece."""
    many = -(-sizes // length)
    row = np.repeat(np.arange(len(sizes)), many)
    number = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    return row, number, np.minimum(length, sizes[row] - number * length)


def pieces(docs: DataFrame, vocabulary_path: str, length: int = LENGTH,
           end: int = END, remembered: int = PACKING_WORDS) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document.

    ``remembered``: words that the encoder of a Python worker holds.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(vocabulary_path, remembered)
        for batch in batches:
            for a, texts in text_parts(batch.column(1)):
                ids, counts = encoder.encode(texts)
                marked = np.insert(ids, np.cumsum(counts), end).astype("<u4")
                row, number, sizes = cut(counts + 1, length)
                at = 4 * (np.cumsum(sizes) - sizes)  # pieces follow each other
                data = memoryview(marked.tobytes())
                sums = [zlib.crc32(data[x:x + 4 * n]) for x, n in zip(at.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(a + row)), pa.array(number.astype(np.int32)),
                     pa.array(number * length), pa.array(sizes), pa.array(sums, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(rows: DataFrame, length: int = LENGTH, open_sequences: int = OPEN_SEQUENCES,
         group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """``rows`` (any columns, with ``length``; a written table) and sequence_id, offset.

    ``doc_id`` and ``piece`` deal the rows and fix their order.
    """
    total = rows.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups))) \
        .repartitionById(groups, F.col("_group").cast("int")) \
        .sortWithinPartitions("_group", F.xxhash64(F.lit(7), F.col("doc_id"), F.col("piece")),
                              "doc_id", "piece", "length", "ids_crc32")
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, packer = None, None
        for batch in batches:
            sequences, offsets = [], []
            for g, size in zip(batch.column("_group").to_pylist(),
                               batch.column("length").to_pylist()):
                if g != group:
                    group, packer = g, BestFit(length, open_sequences)
                sequence, offset = packer.place(size)
                sequences.append((g << 40) + sequence)
                offsets.append(offset)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequences, pa.int64()),
                 pa.array(offsets, pa.int64())], [*names, "sequence_id", "offset"])

    return dealt.mapInArrow(run, rows.schema.add("sequence_id", "long").add("offset", "long"))


def packed(docs: DataFrame, vocabulary_path: str, length: int = LENGTH,
           remembered: int = PACKING_WORDS) -> DataFrame:
    """Every piece of every document and its place."""
    made = pieces(docs, vocabulary_path, length, remembered=remembered)
    return pack(written(made, "pieces"), length)
