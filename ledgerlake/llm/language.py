"""Language ID (operator 5): unigram pieces, marginalised over all segmentations.

A word's probability in a language is the sum over all ways to cut it into
pieces of a fixed public vocabulary, each cut weighted by the product of its
pieces' probabilities in that language: one forward pass over the characters.
A text's prediction is the language with the largest sum of its words'
log-probabilities, the score that language's share of the total (softmax).

Piece probabilities are learned by expectation maximisation on the words of a
bounded sample of labelled documents (``SAMPLE`` per language): each round
counts every piece's expected uses, again over all segmentations, in Spark
tasks, and sums them by language and piece. What reaches the driver is bounded
by languages times vocabulary.

Words are runs of non-blank characters, lower-cased, stripped of characters
that aren't letters at both ends, with a mark in front; a character outside the
vocabulary counts as an unknown piece. Words without a letter say nothing.
The forward pass runs over many words of equal length at a time.

Defined results: ``und`` with score 0 for null texts and texts without a
letter, and when nothing could be learned; ties go to the first language by
name.
"""

from __future__ import annotations

import functools
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
    sums_of,
    text_groups,
    written,
)

#: Documents of a language that the model is fitted on, about.
SAMPLE = 1000
ROUNDS = 2
MARK = "▁"
UNKNOWN = 1e-7
_P = np.uint64(0x100000001B3)


@functools.lru_cache(maxsize=4)
def read_pieces(path: str) -> tuple[str, ...]:
    """The pieces of a sentencepiece vocabulary that are plain text, lower case."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    return tuple(sorted({p.lower() for p in found if p}))


class PieceFinder:
    """Piece numbers of substrings of whole arrays of words, by hashing."""

    def __init__(self, pieces: tuple[str, ...]):
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        bits = 20
        self.shift = np.uint64(64 - bits)
        self.slots: list[tuple[np.ndarray, np.ndarray]] = []
        hashes = np.zeros(len(pieces), np.uint64)
        for i, p in enumerate(pieces):
            h = np.zeros(1, np.uint64)
            for c in p:
                h = self._step(h, np.array([ord(c)], np.uint64))
            hashes[i] = h[0]
        number = np.arange(len(pieces))
        while len(number):  # pieces that share a slot go to the next level
            keys = np.zeros(1 << bits, np.uint64)
            value = np.full(1 << bits, -1, np.int32)
            at = self._slot(hashes[number])
            keys[at], value[at] = hashes[number], number
            number = number[value[at] != number]
            self.slots.append((keys, value))

    @staticmethod
    def _step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        h = (h ^ (c + np.uint64(0x9E3779B97F4A7C15))) * _P
        return h ^ (h >> np.uint64(32))

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return ((h * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, chars: np.ndarray) -> np.ndarray:
        """Numbers [word, start, length - 1] of the pieces in words of equal length; -1: none."""
        n, length = chars.shape
        out = np.full((n, length, self.longest), -1, np.int32)
        wide = chars.astype(np.uint64)
        h = np.zeros((n, length), np.uint64)
        for k in range(min(self.longest, length)):
            h = self._step(h[:, :length - k], wide[:, k:])
            at = self._slot(h)
            got = np.full(h.shape, -1, np.int32)
            for keys, value in self.slots:
                got = np.where(keys[at] == h, value[at], got)
            out[:, :length - k, k] = got
        return out


def _forward(found: np.ndarray, probs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each prefix [word, end, language], scaled, and the log of the scale.

    ``probs`` has a row per piece and one more for unknown characters.
    """
    n, length, most = found.shape
    langs = probs.shape[1]
    alpha = np.zeros((n, length + 1, langs))
    alpha[:, 0] = 1
    scale = np.zeros((n, langs))
    unknown = len(probs) - 1
    present = (found >= 0).any(axis=0).tolist()
    for end in range(1, length + 1):
        total = np.zeros((n, langs))
        for k in range(min(most, end)):
            if k and not present[end - 1 - k][k]:
                continue
            piece = found[:, end - 1 - k, k]
            if k == 0:
                piece = np.where(piece < 0, unknown, piece)
                total += alpha[:, end - 1] * probs[piece]
            else:
                has = np.flatnonzero(piece >= 0)
                if len(has):
                    total[has] += alpha[has, end - 1 - k] * probs[piece[has]]
        alpha[:, end] = total
        if end % 16 == 0:  # keep long words within range
            top = total.copy()
            top[top == 0] = 1
            alpha[:, max(0, end - most):end + 1] /= top[:, None]
            scale += np.log(top)
    return alpha, scale


def log_probabilities(words: list[str], finder: PieceFinder, probs: np.ndarray) -> np.ndarray:
    """Log-probability of each (marked) word in each language."""
    out = np.zeros((len(words), probs.shape[1]), np.float32)
    flat, starts = codepoints(words)
    for length, rows in by_length(starts):
        step = max(1, 200_000 // max(1, length))
        for a in range(0, len(rows), step):
            some = rows[a:a + step]
            chars = flat[starts[some][:, None] + np.arange(length)]
            alpha, scale = _forward(finder.find(chars), probs)
            out[some] = np.log(np.maximum(alpha[:, -1], 1e-300)) + scale
    return out


def _log_sums(logs: np.ndarray, at: int, weight: np.ndarray) -> np.ndarray:
    """Log of the sums of exp(``logs``) times ``weight`` [word, k]; ``logs`` [word, k] may hold
    -inf, but not in column ``at``."""
    top = logs[:, at]
    return top + np.log((np.exp(logs - top[:, None]) * weight).sum(axis=1))


def expected_uses(words: list[str], counts: np.ndarray, finder: PieceFinder,
                  probs: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in words of one language (``probs``: one column).

    The passes keep logarithms of the sums over prefixes and suffixes, so words
    of any length count.
    """
    uses = np.zeros(len(probs))
    flat, starts = codepoints(words)
    unknown = len(probs) - 1
    for length, rows in by_length(starts):
        step = max(1, 100_000 // max(1, length))
        for a in range(0, len(rows), step):
            some = rows[a:a + step]
            found = finder.find(flat[starts[some][:, None] + np.arange(length)])
            n, _, most = found.shape
            found[:, :, 0] = np.where(found[:, :, 0] < 0, unknown, found[:, :, 0])
            weight = np.where(found >= 0, probs[found.clip(0), 0], 0.0)
            # prefixes [end + most] and suffixes [start], nothing beyond the word's ends
            alpha = np.full((n, length + 1 + most), -np.inf)
            beta = np.full((n, length + 1 + most), -np.inf)
            alpha[:, most] = beta[:, length] = 0
            back = np.arange(most)[::-1]  # length - 1 of the piece from each of the last starts
            for end in range(1, length + 1):
                from_ = end - 1 - back
                own = np.where(from_ >= 0, weight[:, from_.clip(0), back], 0.0)
                alpha[:, end + most] = _log_sums(alpha[:, end:end + most], most - 1, own)
            for start in range(length - 1, -1, -1):
                beta[:, start] = _log_sums(beta[:, start + 1:start + 1 + most], 0, weight[:, start])
            alpha = alpha[:, most:]
            total = alpha[:, length]
            for k in range(min(most, length)):
                word, start = np.nonzero(weight[:, :length - k, k])
                part = np.exp(alpha[word, start] + beta[word, start + k + 1] - total[word]) \
                    * weight[word, start, k] * counts[some][word]
                uses += np.bincount(found[word, start, k], part, len(uses))
    return uses


def marked(raw: str) -> str | None:
    """A lower-case word stripped of what isn't a letter at both ends, with the mark; None if empty."""
    if not raw.isalpha():
        a, b = 0, len(raw)
        while a < b and not raw[a].isalpha():
            a += 1
        while b > a and not raw[b - 1].isalpha():
            b -= 1
        raw = raw[a:b]
    return MARK + raw if raw else None


@dataclass
class LanguageModel:
    """Languages in order of name, and piece probabilities (a column per language)."""

    languages: list[str]
    probs: np.ndarray


def training_sample(docs: DataFrame, allowed: Column, per_language: int = SAMPLE) -> DataFrame:
    """``text`` and ``lang`` of about ``per_language`` documents of each language, written.

    Each language's documents are counted, then taken by a hash of their ids
    below that share of the hash's range.
    """
    known = docs.where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], F.lit(per_language / r["n"])).otherwise(share)
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000_007)) / 1_000_000_007.0
    return written(known.where(dealt < share).select("text", "lang"), "language-sample")


def learn(docs: DataFrame, pieces_path: str, allowed: Column,
          per_language: int = SAMPLE, rounds: int = ROUNDS) -> LanguageModel:
    """A model of the languages in ``lang`` from the documents that ``allowed`` admits."""
    pieces = read_pieces(pieces_path)
    sample = training_sample(docs, allowed, per_language)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, found = [], []
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                own = [w for w in map(marked, text.lower().split()) if w]
                found += own
                langs += [lang] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(found, pa.string())], ["lang", "w"])

    counted = written(sample.mapInArrow(words, "lang string, w string").groupBy("lang", "w")
                      .agg(F.count(F.lit(1)).alias("n")), "language-words")
    total = {r["lang"]: r["n"] for r in
             sample.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(total)
    probs = np.full((len(pieces) + 1, max(1, len(languages))), 1.0 / len(pieces))
    probs[-1] = UNKNOWN
    for _ in range(rounds if languages else 0):
        now = probs

        def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = PieceFinder(pieces)
            total = np.zeros_like(now)
            for batch in batches:
                lang = np.array([languages.index(x) for x in batch.column(0).to_pylist()],
                                np.int64)
                own, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
                for j in np.unique(lang):
                    at = np.flatnonzero(lang == j)
                    total[:, j] += expected_uses([own[k] for k in at], n[at], finder,
                                                 now[:, j:j + 1])
            piece, j = np.nonzero(total)
            for a in range(0, len(piece), 10_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(piece[a:a + 10_000]), pa.array(j[a:a + 10_000]),
                     pa.array(total[piece[a:a + 10_000], j[a:a + 10_000]])], ["p", "j", "x"])

        rows = counted.mapInArrow(uses, "p long, j long, x double").groupBy("p", "j").agg(
            F.sum("x").alias("x")).collect()
        new = np.full_like(probs, 0.05)  # unseen pieces keep a little weight
        for r in rows:
            new[r["p"], r["j"]] += r["x"]
        new[-1] = 0
        probs = new / new.sum(axis=0)
        probs[-1] = UNKNOWN
    return LanguageModel(languages, probs)


def predict(docs: DataFrame, model: LanguageModel, pieces_path: str,
            carry: list[str]) -> DataFrame:
    """``carry``, ``lang_pred`` and ``score`` of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = PieceFinder(read_pieces(pieces_path))
        langs = len(model.languages)

        def compute(raw: list[str]) -> tuple[np.ndarray, np.ndarray]:
            words = [marked(w) for w in raw]
            said = np.array([w is not None for w in words])
            out = np.zeros((len(raw), langs), np.float32)
            if said.any():
                out[said] = log_probabilities([w for w in words if w], finder, model.probs)
            return out, said

        table = WordTable(compute)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            names, scores = [], []
            for a, b in text_groups(texts):
                words: list[str] = []
                counts = []
                for t in texts[a:b]:
                    own = t.lower().split()
                    counts.append(len(own))
                    words += own
                total = np.zeros((b - a, langs))
                letters = np.zeros(b - a)
                if words and langs:
                    at = table.lookup(words)
                    total = sums_of(table.columns[0][at].astype(np.float64), counts)
                    letters = sums_of(table.columns[1][at].astype(np.float64), counts)
                for row, n in zip(total, letters):
                    if n < 0.5 or not langs:
                        names.append("und")
                        scores.append(0.0)
                        continue
                    best = int(row.argmax())
                    names.append(model.languages[best])
                    scores.append(float(1 / np.exp(np.clip(row - row[best], -700, 0)).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())], [*carry, "lang_pred", "score"])

    schema = docs.select(*carry).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*carry, F.col("text").alias("_text")).mapInArrow(run, schema)
