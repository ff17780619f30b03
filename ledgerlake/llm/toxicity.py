"""Toxicity (operator 10): a subsequence string-kernel SVM with Nystroem landmarks.

Words are compared by the string subsequence kernel: the common subsequences
of ``ORDER`` characters, gaps allowed, each weighted by ``DECAY`` to the power
of the two spans it covers, normalised to 1 for equal words. A word with
characters inserted, dropped or spread out still shares most subsequences with
the insult it hides. A sentence is compared by the sum over its words
(a convolution kernel), so its Nystroem features are sums of word features
against a fixed set of landmark words, and the linear SVM's decision for a
sentence is a sum of one number per distinct word. A document's decision is
that of its worst sentence; a logistic curve maps it to a score from 0 to 1.

Words are runs of non-blank characters, lower-cased, with everything but
letters and digits removed; runs of at least ``ORDER`` single characters
("i d i o t") also count joined. Sentences end at a word that ends in ``.``,
``!`` or ``?``, or after ``SENTENCE`` words.

Training takes a bounded sample of labelled documents (``MAX_TOXIC``,
``MAX_CLEAN``). Only documents carry labels, so the sentences are labelled in
turns: the sentence of a toxic document that has the most associated words (in
the next turn: the highest decision) is a positive, the worst sentence of a
clean document a negative. The second turn also gets the landmarks that the
first one rejects with a character inserted, so that the margin covers them.

Defined results: null and empty texts get the score of no sentence; labels of
null or of missing documents are left out; of several labels the largest
counts; without both classes every document scores 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import (
    WordTable,
    by_length,
    codepoints,
    smallest_hashes,
    text_groups,
    text_parts,
    written,
)

ORDER, DECAY, POWER = 4, 0.6, 2
SENTENCE = 64
LANDMARKS = 96
#: Labelled documents that the classifier is fitted on at most.
MAX_TOXIC, MAX_CLEAN = 3000, 5000
#: Longer words are compared in overlapping windows of this length.
WINDOW = 24
#: Words, and pairs of a word and a landmark, that are compared at a time (about 10 MB each).
ROWS, PAIRS = 5_000, 10_000


# --- the kernel ---------------------------------------------------------------


def _matrix(words: list[str], pad: int, width: int | None = None) -> np.ndarray:
    """Characters of ``words`` as rows, padded with a character that no word has."""
    flat, starts = codepoints(words)
    lens = np.diff(starts)
    out = np.full((len(words), width or int(lens.max(initial=1))), pad, np.uint32)
    rows = np.repeat(np.arange(len(words)), lens)
    out[rows, np.arange(len(flat)) - np.repeat(starts[:-1], lens)] = flat
    return out


def kernel_of_pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The subsequence kernel of each row of ``left`` with the same row of ``right``.

    Rows are padded characters; the pads of the two sides differ, so they never match.
    """
    n, width = right.shape
    decay = np.tril(DECAY ** np.subtract.outer(np.arange(width), np.arange(width)).clip(0)).T
    decay = decay.astype(np.float32)
    prefix = [np.ones((n, width + 1), np.float32)]
    prefix += [np.zeros((n, width + 1), np.float32) for _ in range(ORDER - 1)]
    total = np.zeros(n, np.float32)
    for k in range(left.shape[1]):
        match = (left[:, k, None] == right).astype(np.float32) * np.float32(DECAY ** 2)
        total += np.einsum("ij,ij->i", match, prefix[-1][:, :-1])
        for i in range(ORDER - 1, 0, -1):
            new = (match * prefix[i - 1][:, :-1]) @ decay
            prefix[i] *= np.float32(DECAY)
            prefix[i][:, 1:] += new
    return total


def common_length(words: np.ndarray, landmarks: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each word (row) with each landmark.

    Bit-parallel: a set of at most 32 bits per pair, one step per character.
    """
    letters = sorted(set("".join(landmarks)))
    masks = np.zeros((len(letters) + 1, len(landmarks)), np.uint32)
    for j, mark in enumerate(landmarks):
        for k, c in enumerate(mark):
            masks[letters.index(c) + 1, j] |= np.uint32(1 << k)
    codes = np.array([ord(c) for c in letters], np.uint32)
    at = np.searchsorted(codes, words).clip(max=len(codes) - 1)
    at = np.where(codes[at] == words, at + 1, 0)
    state = np.full((len(words), len(landmarks)), 0xFFFFFFFF, np.uint32)
    for k in range(words.shape[1]):
        hit = state & masks[at[:, k]]
        state = (state + hit) | (state - hit)
    full = np.array([(1 << len(x)) - 1 for x in landmarks], np.uint32)
    return np.bitwise_count(~state & full)


class Landmarks:
    """Landmark words, and the normalised kernel of any words with them."""

    def __init__(self, words: list[str]):
        self.words = words
        self.rows = _matrix(words, 0)
        self.norms = np.sqrt(kernel_of_pairs(_matrix(words, 1), self.rows))

    def features(self, words: list[str]) -> np.ndarray:
        """Kernel values to the power ``POWER``, a row per word, a column per landmark.

        Pairs whose longest common subsequence is shorter than ``ORDER`` have
        kernel 0 and are skipped.
        """
        out = np.zeros((len(words), len(self.words)), np.float32)
        parts, owner = [], []
        for i, w in enumerate(words):
            for a in range(0, max(1, len(w) - WINDOW // 2), WINDOW // 2) if len(w) > WINDOW \
                    else (0,):
                parts.append(w[a:a + WINDOW])
                owner.append(i)
        owner = np.array(owner, np.int64)
        flat, starts = codepoints(parts)
        for length, rows in by_length(starts):
            if length < ORDER:
                continue
            for rows_ in np.array_split(rows, max(1, len(rows) // ROWS)):
                chars = flat[starts[rows_][:, None] + np.arange(length)]
                i, j = np.nonzero(common_length(chars, self.words) >= ORDER)
                if not len(i):
                    continue
                used, back = np.unique(i, return_inverse=True)
                norms = np.sqrt(kernel_of_pairs(chars[used], chars[used]))
                for a in range(0, len(i), PAIRS):
                    s = slice(a, a + PAIRS)
                    k = kernel_of_pairs(chars[i[s]], self.rows[j[s]])
                    k /= norms[back[s]] * self.norms[j[s]]
                    np.add.at(out, (owner[rows_[i[s]]], j[s]), k ** POWER)
        return out


# --- texts to sentences ---------------------------------------------------------


def normal(word: str) -> str:
    """Letters and digits only."""
    return word if word.isalnum() else "".join(filter(str.isalnum, word))


class SentenceReader:
    """Splits texts into words and sentences, with columns computed once per distinct word."""

    def __init__(self, columns, limit: int = 200_000):
        """``columns(words)``: an array with a row per normalised word; ``limit``: words held."""
        def compute(raw: list[str]):
            return (columns([normal(w) for w in raw]),
                    np.fromiter((w[-1] in ".!?" for w in raw), bool, len(raw)),
                    np.fromiter((len(w) == 1 and w.isalnum() for w in raw), bool, len(raw)))
        self.table = WordTable(compute, limit)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Column sums per sentence, the document of each sentence, and each word's sentence.

        The words are those of all texts in order; joined runs of single
        characters follow at the end.
        """
        words: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            own = t.lower().split()
            counts[i] = len(own)
            words += own
        self.words = words
        if not words:
            return np.zeros((0, 1)), np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = self.table.lookup(words)
        values, ends, single = (c[at] for c in self.table.columns)
        docs = np.repeat(np.arange(len(texts)), counts)
        start = np.ones(len(words), bool)
        start[1:] = ends[:-1] | (docs[1:] != docs[:-1])
        begin = np.maximum.accumulate(np.where(start, np.arange(len(words)), 0))
        start |= (np.arange(len(words)) - begin) % SENTENCE == 0
        sentence = np.cumsum(start) - 1
        joined = self._joined(words, single, docs)
        if joined:
            extra = self.table.lookup([w for w, _ in joined])  # may start the table anew
            place = np.array([sentence[k] for _, k in joined])
            order = np.argsort(np.concatenate([sentence, place]), kind="stable")
            values = np.concatenate([values, self.table.columns[0][extra]])[order]
            sentence = np.concatenate([sentence, place])[order]
            self.words = [*words, *(w for w, _ in joined)]
            self.words = [self.words[k] for k in order]
        first = np.flatnonzero(np.diff(sentence, prepend=-1))
        sums = np.add.reduceat(values.astype(np.float64), first, axis=0)
        return sums, docs[start], sentence

    @staticmethod
    def _joined(words: list[str], single: np.ndarray, docs: np.ndarray) -> list[tuple[str, int]]:
        """Runs of at least ``ORDER`` single characters of a text, joined, and their first word."""
        out = []
        edges = np.flatnonzero(np.diff(np.concatenate([[0], single.view(np.int8), [0]])))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= ORDER:
                for k in (a, *(a + 1 + np.flatnonzero(np.diff(docs[a:b])))):
                    e = min(b, int(np.searchsorted(docs, docs[k], "right")))
                    if e - k >= ORDER:
                        out.append(("".join(words[k:e]), int(k)))
        return out


# --- the model -------------------------------------------------------------------


@dataclass
class ToxicityModel:
    """Landmarks, one weight per landmark, bias, and the logistic curve of the decision."""

    landmarks: list[str]
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def decide(self, texts: list[str | None], reader: SentenceReader) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        texts = [t or "" for t in texts]
        for a, b in text_groups(texts):
            sums, docs, _ = reader.read(texts[a:b])
            if len(docs):
                first = np.flatnonzero(np.diff(docs, prepend=-1))
                out[a + docs[first]] = np.maximum(
                    self.bias, np.maximum.reduceat(sums[:, 0], first) + self.bias)
        return out

    def scores(self, texts: pa.Array, reader: SentenceReader) -> np.ndarray:
        """The score of each text of a column."""
        return self.score(np.concatenate([np.zeros(0), *(
            self.decide(part, reader) for _, part in text_parts(texts))]))

    def score(self, decision: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decision + self.offset, -500, 500)))

    def reader(self) -> SentenceReader:
        if not self.landmarks:
            return SentenceReader(lambda words: np.zeros((len(words), 1), np.float32))
        marks = Landmarks(self.landmarks)
        return SentenceReader(lambda words: marks.features(words) @ self.weights[:, None])


def never() -> ToxicityModel:
    return ToxicityModel([], np.zeros(0), 0.0, 0.0, -500.0)


def sample_of(docs: DataFrame, labels: DataFrame, allowed: Column | None = None) -> DataFrame:
    """``text`` and ``toxic`` of the documents to learn from, written to the shared folder.

    Those of each class with the smallest hashes of their ids, ``MAX_TOXIC``
    and ``MAX_CLEAN`` at most; ``allowed`` is a condition on ``doc_id``. The
    ids are broadcast, so only the sample's texts are written.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    if allowed is not None:
        known = known.where(allowed)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    chosen = smallest_hashes(known.where("_toxic = 1"), MAX_TOXIC, "doc_id").unionAll(
        smallest_hashes(known.where("_toxic = 0"), MAX_CLEAN, "doc_id"))
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("_id"), "_toxic"))
    own = docs.select("doc_id", "text").where(F.col("text").isNotNull())  # other names can clash
    return written(own.join(chosen, own["doc_id"] == F.col("_id"))
                   .select("text", F.col("_toxic").alias("toxic")), "toxicity-sample")


def associated(sample: DataFrame, most: int = 400) -> dict[str, float]:
    """Normalised words that mark toxic documents, with their weight, from document counts."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, toxic = [], []
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {w for w in map(normal, set(t.lower().split())) if len(w) >= ORDER}
                found += own
                toxic += [y] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()),
                                              pa.array(toxic, pa.int64())], ["w", "y"])

    n = {r["toxic"]: r["n"] for r in
         sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return {}
    counts = (sample.select("text", F.col("toxic").cast("long"))
              .mapInArrow(words, "w string, y long").groupBy("w")
              .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q")).where("p >= 2"))
    odds = F.log((F.col("p") / n[1]) / ((F.col("q") + 0.5) / n[0]))
    top = counts.select("w", odds.alias("odds"), (F.sqrt("p") * odds).alias("rank")) \
        .where("odds > 1").orderBy(F.desc("rank"), "w").limit(most).collect()
    return {r["w"][:32]: r["odds"] for r in top}


def choose_landmarks(words: dict[str, float], most: int = LANDMARKS) -> list[str]:
    """The strongest words, leaving out those close to one already chosen."""
    if not words:
        return []
    names, out = list(words), []
    kernel = Landmarks(names).features(names)
    for i in range(len(names)):
        if len(out) < most and (kernel[i, out] < 0.7 ** POWER).all():
            out.append(i)
    return [names[i] for i in out]


def _sentences(sample: DataFrame, marks: list[str], words: dict[str, float],
               model: ToxicityModel | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of one sentence per document, and the documents' labels.

    The sentence with the highest decision; without a model: the one with the
    largest sum of word weights in toxic documents, of kernel values in clean ones.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Landmarks(marks)

        def columns(new: list[str]) -> np.ndarray:
            weight = np.array([words.get(w, 0.0) for w in new], np.float32)
            return np.column_stack([kernel.features(new), weight])

        reader = SentenceReader(columns, limit=50_000)  # a row is as wide as the landmarks
        for batch in batches:
            texts, toxic = (c.to_pylist() for c in batch.columns)
            rows, ys = [], []
            for a, b in text_groups(texts, 100_000):
                sums, docs, _ = reader.read(texts[a:b])
                if not len(docs):
                    continue
                y = np.array(toxic[a:b])[docs]
                if model is None:
                    rank = np.where(y == 1, sums[:, -1], sums[:, :-1].sum(axis=1))
                else:
                    rank = sums[:, :-1] @ model.weights
                order = np.lexsort((-rank, docs))
                best = order[np.flatnonzero(np.diff(docs[order], prepend=-1))]
                if model is None:
                    best = best[(y[best] == 0) | (rank[best] > 0)]
                rows += list(sums[best, :-1])
                ys += y[best].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), pa.array(ys, pa.int64())], ["f", "y"])

    got = sample.select("text", F.col("toxic").cast("long")) \
        .mapInArrow(run, "f array<double>, y long").collect()
    return (np.array([r["f"] for r in got]).reshape(len(got), len(marks)),
            np.array([r["y"] for r in got]))


def _svm(x: np.ndarray, y: np.ndarray, c: float = 10.0) -> np.ndarray:
    """Weights and bias of a linear SVM (squared hinge, classes balanced), by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    sign = np.where(y == 1, 1.0, -1.0)
    cost = np.where(y == 1, c / max(1, (y == 1).sum()), c / max(1, (y == 0).sum())) * len(y)
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        inside = sign * (x @ w) < 1
        xi, ci = x[inside], cost[inside]
        new = np.linalg.solve(ridge + (xi * ci[:, None]).T @ xi, xi.T @ (ci * sign[inside]))
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def _logistic(d: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of label on decision (lightly ridged Newton)."""
    x = np.column_stack([d, np.ones(len(d))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-6), float(w[1])


def _disguised(model: ToxicityModel) -> np.ndarray:
    """Features of the landmarks that the model rejects, each with a character inserted."""
    marks = Landmarks(model.landmarks)
    own = marks.features(model.landmarks)
    bad = [w for w, d in zip(model.landmarks, own @ model.weights + model.bias) if d > 0]
    out = [w[:k] + "\u2022" + w[k:] for w in bad for k in range(2, len(w) - 1, 2)]
    return marks.features(out) if out else np.zeros((0, len(model.landmarks)))


def learn(docs: DataFrame, labels: DataFrame, allowed: Column | None = None) -> ToxicityModel:
    """A model from documents (``doc_id``, ``text``) and labels (``doc_id``, ``toxic``)."""
    sample = sample_of(docs, labels, allowed)
    words = associated(sample)
    marks = choose_landmarks(words)
    if not marks:
        return never()
    kernel = Landmarks(marks).features(marks).astype(np.float64)
    value, vector = np.linalg.eigh((kernel + kernel.T) / 2)
    keep = value > 1e-4
    root = vector[:, keep] / np.sqrt(value[keep])  # Nystroem map: features @ root
    x, y = _sentences(sample, marks, words, None)
    model = None
    for _ in range(2):
        if len(set(y.tolist())) < 2:
            return never()
        w = _svm(x @ root, y)
        model = ToxicityModel(marks, root @ w[:-1], float(w[-1]), 1.0, 0.0)
        worst, labels_ = _sentences(sample, marks, words, model)
        decision = np.maximum(worst @ model.weights, 0) + model.bias
        # from now on: sentences of toxic documents that the model finds, all of clean ones
        found = (labels_ == 0) | (decision > 0)
        hidden = _disguised(model)
        x = np.concatenate([x, worst[found], hidden])
        y = np.concatenate([y, labels_[found], np.ones(len(hidden), np.int64)])
    model.slope, model.offset = _logistic(decision, labels_)
    return model


def scored(docs: DataFrame, model: ToxicityModel, carry: list[str]) -> DataFrame:
    """``carry`` columns and the ``score`` of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in batches:
            score = model.scores(batch.column(batch.num_columns - 1), reader)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)],
                                             [*carry, "score"])

    rows = docs.select(*carry, F.col("text").alias("_text"))
    schema = docs.select(*carry).schema.add("score", "double")
    return rows.mapInArrow(run, schema)


def clean_only(docs: DataFrame, model: ToxicityModel, at_least: float = 0.5) -> DataFrame:
    """The documents that score under ``at_least``, all columns as they were."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in batches:
            score = model.scores(batch.column(place), reader)
            yield batch.filter(pa.array(score < at_least))

    return docs.mapInArrow(run, docs.schema)
