"""BPE encoding and decoding (operator 7): a bounded-lookahead streaming transducer.

The merge list bounds how far a later character can reach back: two merge
orders that differ beyond a window's end differ at most :attr:`Vocabulary.
lookahead` bytes before it (see :func:`sufficient_lookahead`). A word's stream
(:class:`WordStream`) holds a window of bytes, merges it by rank, emits the
tokens that end at least that far before the window's end, and goes on with the
rest; what was emitted never changes, so memory stays constant on words of any
length.

Texts pass through a :class:`Transducer` in chunks of characters. It carries
the characters after the last blank into the next chunk, and emits the ids of
whatever no later character can change: of all ended words, looked up in a
memo of words (new words of a chunk are merged together, windows of equal
length as rows of one matrix), and of the settled part of a run without blanks
that outgrows :data:`RUN` characters. A chunk border changes no id.

Decoding is a state machine over the ids in order: each id adds the bytes of
its vocabulary entry, the UTF-8 state carries incomplete characters from id to
id and from chunk to chunk.

A vocabulary file is the tokenizers library's JSON of a BPE with word ends:
NFC, white space collapsed, lower case; words cut by the file's pattern.
Defined results: a null text is empty and has no ids, an empty table gives an
empty result; a very long text takes many chunks, a very long run many windows
(only a run of combining characters without any other is held whole); rows that
are repeated, or share an id, are each encoded; of other columns only those
named by ``carry`` are read, so their names can't clash.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import WordTable, by_length, text_parts

#: Bytes of a window at least; longer words take several.
WINDOW = 64
#: Characters of a text that are read at a time.
CHUNK = 1 << 16
#: A run without blanks that is longer than this (in characters) is encoded while it goes on.
RUN = 4096
#: Characters held back at the end of such a run: more than any special token or fixed
#: alternative of a pattern has.
HOLD = 32
_NONE = np.int32(2**31 - 1)
#: Fixed value: white space for the normaliser (Unicode White_Space).
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_NOT_SPACE = re.compile(f"[^{SPACES}]+")
_FIRST_BLANK = re.compile(f"[{SPACES}]")
#: Python's str.split() also splits at these.
_ODD = "\x1c\x1d\x1e\x1f"


def _unassigned(c: str) -> bool:
    return unicodedata.category(c) == "Cn"


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once per Python worker."""
    return Vocabulary(path)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes
    stand for themselves, the others are numbered from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [], 256
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def sufficient_lookahead(merges: list[tuple[str, str]], size=len) -> int:
    """How many units before a cut the merges can depend on what follows it.

    What follows the cut changes a token first by merging (or not) with the
    token ``c1`` that ends at the cut; then the token before ``c1`` may merge,
    at a later rank, with one that begins with ``c1``; and so on. So a chain
    of rules with rising ranks, in which the right part of each rule begins
    (down its left parts) with the left part of the rule before. The bound is
    the largest sum of left parts over all chains, found in one pass from the
    last rule to the first.
    """
    left_of = {a + b: a for a, b in merges}
    reach: dict[str, int] = {}
    most = 0
    for a, b in reversed(merges):
        here = size(a) + reach.get(a, 0)
        most = max(most, here)
        t: str | None = b
        while t is not None:
            reach[t] = max(reach.get(t, 0), here)
            t = left_of.get(t)
    return most


class _PairTable:
    """Rank and result of pairs of ids, looked up for whole arrays (open addressing by levels)."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray):
        self.levels = []
        bits = 18
        salt = 0x9E3779B97F4A7C15
        while len(pairs):
            keys = np.full(1 << bits, -1, np.int64)
            value = np.full(1 << bits, _NONE, np.int32)
            at = self._slot(pairs, salt, bits)
            keys[at], value[at] = pairs, ranks
            self.levels.append((salt, bits, keys, value))
            left = keys[at] != pairs
            pairs, ranks = pairs[left], ranks[left]
            salt = (salt * 6364136223846793005 + 1442695040888963407) % 2**64 | 1
            bits = max(10, bits - 2)

    @staticmethod
    def _slot(pairs: np.ndarray, salt: int, bits: int) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(salt)) >> np.uint64(64 - bits)).view(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = (left.astype(np.int64) << 32) | right
        out = np.full(pairs.shape, _NONE, np.int32)
        for salt, bits, keys, value in self.levels:
            at = self._slot(pairs, salt, bits)
            hit = keys[at] == pairs
            out = np.where(hit, value[at], out)
        return out


class Vocabulary:
    """A word-end BPE vocabulary read from the tokenizers library's JSON."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
                  for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        #: Whether the pattern leaves a run of letters in one part.
        self.letters_whole = self.pattern.findall("aé漢я") == ["aé漢я"]
        self._library_normal = tokenizers.normalizers.Sequence(
            [tokenizers.normalizers.NFC(), tokenizers.normalizers.Lowercase()])
        self._library_split = tokenizers.pre_tokenizers.Split(
            tokenizers.Regex(split), "removed", invert=True)
        #: Whether a special token is made of letters only, so that it can be part of a word.
        self.special_letters = any(map(str.isalpha, self.special))
        self._special = re.compile("|".join(map(re.escape, self.special)) or "(?!)")

        letters = byte_letters()
        self.inner = np.array([self.vocab[c] for c in letters], np.int32)
        self.final = np.array([self.vocab[c + self.suffix] for c in letters], np.int32)
        ids = self.vocab
        pairs = np.array([(ids[a] << 32) | ids[b] for a, b in merges], np.int64)
        self.results = np.array([ids[a + b] for a, b in merges], np.int32)
        # a pair listed twice keeps its first rank
        unique, first = np.unique(pairs, return_index=True)
        self.table = _PairTable(unique, first.astype(np.int32))
        self.rank_of = dict(zip(unique.tolist(), first.tolist()))
        self.result_of = self.results.tolist()
        self.strings = {i: t for t, i in {**self.vocab, **self.special}.items()}
        end = len(self.suffix)

        def width(t: str) -> int:
            return len(t) - end if t.endswith(self.suffix) else len(t)

        self.lookahead = sufficient_lookahead(merges, width)
        self.widths = np.zeros(max(self.strings) + 1, np.int32)
        for t, i in self.vocab.items():
            self.widths[i] = width(t)

    # --- encoding -----------------------------------------------------------

    def _merge(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Merged ids of windows given as rows of ids: (row numbers, ids) by number of ids."""
        done, number = [], np.arange(len(rows))
        rank = self.table.ranks(rows[:, :-1], rows[:, 1:])
        while len(rows):
            if rows.shape[1] == 1:
                done.append((number, rows))
                break
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            over = best == _NONE
            if over.any():
                done.append((number[over], rows[over]))
                go = ~over
                rows, rank, number, at, best = rows[go], rank[go], number[go], at[go], best[go]
                if not len(rows):
                    break
            column = np.arange(rows.shape[1] - 1)
            after = column > at[:, None]
            each = np.arange(len(rows))
            rows = np.where(after, rows[:, 1:], rows[:, :-1])
            rows[each, at] = self.results[best]
            rank = np.where(after[:, :-1], rank[:, 1:], rank[:, :-1])
            has = at > 0
            rank[each[has], at[has] - 1] = self.table.ranks(rows[each[has], at[has] - 1],
                                                            rows[each[has], at[has]])
            has = at < rows.shape[1] - 1
            rank[each[has], at[has]] = self.table.ranks(rows[each[has], at[has]],
                                                        rows[each[has], at[has] + 1])
        return done

    def _merge_one(self, ids: list[int]) -> list[int]:
        """Merged ids of one long window: a heap of pairs by rank and place, over a linked list."""
        ranks, results = self.rank_of, self.result_of
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k) for k in range(n - 1)
                if (r := ranks.get((ids[k] << 32) | ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            e = after[k]
            if e >= n or ids[k] < 0 or ranks.get((ids[k] << 32) | ids[e]) != r:
                continue  # one of the two was merged meanwhile
            ids[k], ids[e] = results[r], -1
            after[k] = f = after[e]
            if f < n:
                before[f] = k
                if (x := ranks.get((ids[k] << 32) | ids[f])) is not None:
                    heapq.heappush(heap, (x, k))
            d = before[k]
            if d >= 0 and (x := ranks.get((ids[d] << 32) | ids[k])) is not None:
                heapq.heappush(heap, (x, d))
        return [i for i in ids if i >= 0]

    def encode_word(self, data: bytes, window: int | None = None) -> Iterator[np.ndarray]:
        """Stable ids of one word, in order, from a window that slides over its bytes."""
        stream = WordStream(self, window)
        yield stream.feed(data)
        yield stream.finish()

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words as the pattern cuts them: all in one array, and how many each has."""
        data = [p.encode() for p in parts]
        flat = np.frombuffer(b"".join(data), np.uint8)
        starts = np.zeros(len(data) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, data), np.int64, len(data)), out=starts[1:])
        counts = np.zeros(len(data), np.int64)
        made: list[tuple[np.ndarray, np.ndarray]] = []
        for length, rows in by_length(starts):
            if length > WINDOW:
                for r in rows:
                    ids = np.concatenate(list(self.encode_word(data[r])))
                    made.append((np.array([r]), ids[None, :]))
                continue
            for some in np.array_split(rows, -(-len(rows) // 20_000)):
                chars = flat[starts[some][:, None] + np.arange(length)]
                ids = self.inner[chars]
                ids[:, -1] = self.final[chars[:, -1]]
                made += [(some[n], x) for n, x in self._merge(ids)]
        for numbers, ids in made:
            counts[numbers] = ids.shape[1]
        begin = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int32)
        for numbers, ids in made:
            out[begin[numbers][:, None] + np.arange(ids.shape[1])] = ids
        return out, counts

    def _cut(self, word: str) -> list[str]:
        """Parts of a run without white space, normalised; special tokens stay whole."""
        letters = word.isalpha() and not self.special_letters
        if not letters and self._special.search(word):
            out, at = [], 0
            for m in self._special.finditer(word):
                out += self._cut(word[at:m.start()]) + [m.group()]
                at = m.end()
            return out + self._cut(word[at:])
        word = self.normal(word, letters)
        if word.isalpha() and self.letters_whole:
            return [word]
        return [word[a:b] for a, b in self.spans(word)]

    def normal(self, word: str, letters: bool = False) -> str:
        """Characters as the vocabulary has them (``letters``: known to be letters only)."""
        if word.isascii():
            return word.lower()
        if not letters and any(map(_unassigned, word)):
            # newer characters: as the library's Unicode has them
            return self._library_normal.normalize_str(word)
        return unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()

    def spans(self, word: str) -> list[tuple[int, int]]:
        """Where the parts of a normalised run begin and end."""
        if not word.isascii() and any(map(_unassigned, word)):
            return [at for _, at in self._library_split.pre_tokenize_str(word)]
        return [m.span() for m in self.pattern.finditer(word)]

    @functools.cached_property
    def entries(self) -> dict[int, bytes]:
        """Each id's entry as the vocabulary writes it, after a separating space."""
        return {i: b" " + t.encode() for i, t in self.strings.items()}

    @functools.cached_property
    def word_bytes(self) -> dict[int, bytes]:
        """The bytes of text that each id stands for, a space at a word's end."""
        byte_of, end = {c: b for b, c in enumerate(byte_letters())}, self.suffix
        return {i: t.encode() if t in self.special else
                bytes(byte_of[c] for c in t.removesuffix(end)) + b" " * t.endswith(end)
                for i, t in self.strings.items()}

    @functools.cached_property
    def numbers(self) -> dict[int, bytes]:
        """Each id in decimal, after a separating space."""
        return {i: b" %d" % i for i in self.strings}

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs without white space: all in one array, and how many each has."""
        parts, owner = [], []
        for i, w in enumerate(words):
            own = self._cut(w)
            parts += own
            owner += [i] * len(own)
        index = {p: i for i, p in enumerate(dict.fromkeys(parts))}
        unique = list(index)
        flat, counts = self.encode_parts([p if p not in self.special else "x" for p in unique])
        begin = np.cumsum(counts) - counts
        for p, i in self.special.items():
            if p in index:
                flat[begin[index[p]]] = i
                counts[index[p]] = 1
        at = np.fromiter(map(index.__getitem__, parts), np.int64, len(parts))
        ids = runs(flat, begin[at], counts[at])
        each = np.bincount(np.array(owner, np.int64), weights=counts[at], minlength=len(words)) \
            if len(owner) else np.zeros(len(words))
        return ids, each.astype(np.int64)


class WordStream:
    """Bytes of one word to ids: ``feed`` returns those that no later byte can change."""

    def __init__(self, vocabulary: Vocabulary, window: int | None = None):
        self.vocabulary = vocabulary
        self.window = max(window or 0, WINDOW,
                          2 * vocabulary.lookahead + int(vocabulary.widths.max()))
        self.held = bytearray()

    def feed(self, data: bytes) -> np.ndarray:
        v, out, at = self.vocabulary, [np.zeros(0, np.int32)], 0
        self.held += data
        while len(self.held) - at > self.window:
            part = np.frombuffer(bytes(self.held[at:at + self.window]), np.uint8)
            ids = np.array(v._merge_one(v.inner[part].tolist()), np.int32)
            ends = np.cumsum(v.widths[ids])
            stable = int(np.searchsorted(ends, self.window - v.lookahead, "right"))
            out.append(ids[:stable])
            at += int(ends[stable - 1])
        del self.held[:at]
        return np.concatenate(out)

    def finish(self) -> np.ndarray:
        part = np.frombuffer(bytes(self.held), np.uint8)
        row = self.vocabulary.inner[part]
        row[-1] = self.vocabulary.final[part[-1]]
        return np.array(self.vocabulary._merge_one(row.tolist()), np.int32)


class RunStream:
    """Characters of one long run without blanks to ids, while the run goes on.

    Held are the last characters of the run as they came (a special token or a
    combining character may follow), the last normalised ones (the pattern may
    cut them otherwise), and the window of the part that is open. Of an open
    part that is in the window already, :data:`HOLD` characters stay before the
    new ones, so the pattern goes on with the same kind of part.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.raw = self.normal = ""
        self.seen = 0  # characters of ``normal`` that the window has
        self.part: WordStream | None = None

    def feed(self, chars: str, last: bool = False) -> list[np.ndarray]:
        v, out, at = self.vocabulary, [], 0
        raw = self.raw + chars
        end = len(raw)
        if not last:
            end = max(0, end - HOLD)
            while end and _joins_before(raw[end]):
                end -= 1
        for m in v._special.finditer(raw) if v.special else ():
            if m.start() >= end:
                break
            out += self._plain(raw[at:m.start()], True)
            out.append(np.array([v.special[m.group()]], np.int32))
            at, end = m.end(), max(end, m.end())
        out += self._plain(raw[at:end], last)
        self.raw = raw[end:]
        return out

    def _plain(self, chars: str, closed: bool) -> list[np.ndarray]:
        """Ids that characters without special tokens settle; all of them, if the run is closed."""
        v, out = self.vocabulary, []
        text = self.normal + v.normal(chars)
        for a, b in v.spans(text):
            seen = self.seen if a == 0 else 0
            if not closed and b > len(text) - HOLD:
                if b - max(a, seen) > 4 * HOLD:
                    self.part = self.part or WordStream(v)
                    out.append(self.part.feed(text[max(a, seen):b - HOLD].encode()))
                    a, seen = b - 2 * HOLD, HOLD
                self.normal, self.seen = text[a:], seen
                return out
            if seen:
                out += [self.part.feed(text[seen:b].encode()), self.part.finish()]
                self.part = None
            else:
                out.append(v.encode_parts([text[a:b]])[0])
        self.normal, self.seen = "", 0
        return out


def _joins_before(c: str) -> bool:
    """Whether a character may change the one before it when text is composed."""
    return unicodedata.category(c) in ("Mn", "Mc", "Me", "Cn") or "\u1160" <= c <= "\u11ff"


class Transducer:
    """Texts in chunks to ids, several texts side by side (for the memo's sake)."""

    def __init__(self, encoder: TextEncoder, streams: int):
        self.encoder = encoder
        self.open = [""] * streams  # the characters after the last blank
        self.long: dict[int, RunStream] = {}  # streams within a long run

    def feed(self, chunks: list[tuple[int, str, bool]]) -> list[np.ndarray]:
        """Settled ids for each (stream, next characters, whether they are its last)."""
        words: list[str] = []
        spans, before, after = [], [], []
        for stream, chunk, last in chunks:
            head, text = [], self.open[stream] + chunk
            if stream in self.long:
                blank = _FIRST_BLANK.search(text)
                upto = blank.start() if blank else len(text)
                ended = last or blank is not None
                head = self.long[stream].feed(text[:upto], ended)
                if ended:
                    del self.long[stream]
                text = text[upto:]
            cut = len(text) if last else _after_last_blank(text)
            own, rest, tail = split_words(text[:cut]), text[cut:], []
            if len(rest) > RUN and stream not in self.long:
                self.long[stream] = RunStream(self.encoder.vocabulary)
                tail, rest = self.long[stream].feed(rest), ""
            self.open[stream] = rest
            spans.append(len(own))
            words += own
            before.append(head)
            after.append(tail)
        flat, counts = self.encoder.encode_words(words)
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *spans])]
        return [np.concatenate([*head, flat[a:b], *tail]) if head or tail else flat[a:b]
                for head, tail, a, b in zip(before, after, ends, ends[1:])]


def _after_last_blank(text: str) -> int:
    last = _NOT_SPACE.match(text[::-1])
    return len(text) - (last.end() if last else 0)


def runs(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Runs of ``flat`` one after the other."""
    total = int(counts.sum())
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return flat[np.arange(total) + shift]


def split_words(text: str) -> list[str]:
    """Runs without the normaliser's white space."""
    if any(c in text for c in _ODD):
        return _NOT_SPACE.findall(text)
    return text.split()


class TextEncoder:
    """Encodes texts; each distinct word is encoded once while its table lasts."""

    def __init__(self, vocabulary: Vocabulary, limit: int = 300_000):
        self.vocabulary = vocabulary
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.words = WordTable(self._compute, limit)

    def _compute(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self.words.index:
            self.used = 0
        ids, counts = self.vocabulary.encode_words(words)
        if self.used + len(ids) > len(self.flat):
            grown = np.zeros(2 * (self.used + len(ids)), np.int32)
            grown[:self.used] = self.flat[:self.used]
            self.flat = grown
        self.flat[self.used:self.used + len(ids)] = ids
        starts = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        return starts, counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has."""
        words: list[str] = []
        per_text = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            own = split_words(t)
            per_text[i] = len(own)
            words += own
        flat, counts = self.encode_words(words)
        ends = np.concatenate([[0], np.cumsum(counts)])
        last = np.cumsum(per_text)
        return flat, ends[last] - ends[last - per_text]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each word has."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        at = self.words.lookup(words)
        starts, counts = (c[at] for c in self.words.columns)
        return runs(self.flat, starts, counts), counts


#: Words that the encoder of a worker remembers (about 250 bytes each). Each worker of an
#: executor has its own table and keeps it while it serves other stages; a job with other
#: stages names a smaller number.
PACKING_WORDS = 1_000_000


@functools.lru_cache(maxsize=1)
def text_encoder(path: str, limit: int = PACKING_WORDS) -> TextEncoder:
    """The encoder of a file's vocabulary, one per Python worker: what a task has put into its
    word table (bounded) serves the next tasks of that worker."""
    return TextEncoder(vocabulary(path), limit)


# --- decoding ------------------------------------------------------------------


class Decoder:
    """Ids to text in order: ``feed`` returns the characters that the next ids complete.

    With ``words``, ids give their bytes and a word end gives a space (the text
    itself, normalised). Without, entries appear as the vocabulary writes them,
    separated by spaces (the library's decode() of a file without a decoder).
    The state is whether an id came before, and the bytes of an unfinished character.
    """

    def __init__(self, vocabulary: Vocabulary, words: bool = False):
        self.table = vocabulary.word_bytes if words else vocabulary.entries
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.first = not words

    def feed(self, ids: Iterable[int]) -> str:
        data = b"".join(map(self.table.__getitem__, ids))
        if self.first and data:
            self.first, data = False, data[1:]
        return self.state.decode(data)

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


def decode(ids: Iterable[int], vocabulary: Vocabulary, words: bool = False) -> str:
    machine = Decoder(vocabulary, words)
    return machine.feed(map(int, ids)) + machine.finish()


# --- over a table -----------------------------------------------------------------


class _TextDigest:
    """What the ids of one text, as they come, add up to."""

    def __init__(self, vocabulary: Vocabulary):
        self.numbers, self.decoder = vocabulary.numbers, Decoder(vocabulary)
        self.n, self.ids, self.decoded = 0, hashlib.sha256(), hashlib.sha256()

    def feed(self, ids: np.ndarray) -> None:
        if not len(ids):
            return
        some = ids.tolist()
        shown = b"".join(map(self.numbers.__getitem__, some))
        self.ids.update(shown if self.n else shown[1:])
        self.decoded.update(self.decoder.feed(some).encode())
        self.n += len(some)

    def finish(self) -> tuple[int, str, str]:
        self.decoded.update(self.decoder.finish().encode())
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


def digest(texts: list[str], encoder: TextEncoder, chunk: int = CHUNK) -> list[tuple[int, str, str]]:
    """Number of ids, digest of the ids and of the decoded text, of each text: chunks go
    through the transducer, its ids through the decoder."""
    transducer = Transducer(encoder, len(texts))
    found = [_TextDigest(encoder.vocabulary) for _ in texts]
    for at in range(0, max(map(len, texts), default=0), chunk):
        some = [(i, t[at:at + chunk], at + chunk >= len(t))
                for i, t in enumerate(texts) if at < len(t)]
        for (i, _, _), ids in zip(some, transducer.feed(some)):
            found[i].feed(ids)
    return [f.finish() for f in found]


def digests(docs: DataFrame, vocabulary_path: str, carry: list[str]) -> DataFrame:
    """``carry`` and n_tokens, ids_sha256, decoded_sha256 of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(vocabulary_path)
        for batch in batches:
            rows = [r for _, texts in text_parts(batch.column(batch.num_columns - 1))
                    for r in digest(texts, encoder)]
            made = [pa.array([r[k] for r in rows], kind)
                    for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made],
                                             [*carry, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = docs.select(*carry).schema
    for name, kind in (("n_tokens", "long"), ("ids_sha256", "string"),
                       ("decoded_sha256", "string")):
        schema = schema.add(name, kind)
    return docs.select(*carry, F.col("text").alias("_text")).mapInArrow(run, schema)
