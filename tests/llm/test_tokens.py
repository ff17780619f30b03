"""BPE, packing and language ID against the library, brute force and held-out accuracy."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from llm_fixtures import SF, odd_rows

from ledgerlake.llm import bpe, language, packing, registry
from ledgerlake.llm.bpe import TextEncoder, decode, sufficient_lookahead, vocabulary

PATH = registry.word_vocabulary()


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def _check(texts, library):
    flat, counts = TextEncoder(vocabulary(PATH)).encode(texts)
    at = 0
    for t, n in zip(texts, counts):
        want = library.encode(t, add_special_tokens=False).ids
        assert flat[at:at + n].tolist() == want, t[:60]
        at += n


def test_ids_equal_the_library(library):
    rnd = random.Random(5)
    texts = [t or "" for _, t, *_ in odd_rows()]
    texts += ["".join(rnd.choice("thein") for _ in range(rnd.randint(1, 3000))) for _ in range(40)]
    texts += ["".join(rnd.choice("é漢ß🎉naç!?#.ΣİK") for _ in range(300)) for _ in range(40)]
    texts += [f"x{chr(c)}y {chr(c)}" for c in range(1, 0x3000)]
    _check(texts, library)


def test_small_tables_start_anew(library):
    texts = [" ".join(f"w{i}{j}" for j in range(50)) for i in range(20)]
    encoder = TextEncoder(vocabulary(PATH), limit=100)
    for t in texts:
        flat, _ = encoder.encode([t])
        assert flat.tolist() == library.encode(t, add_special_tokens=False).ids
    encoder = TextEncoder(vocabulary(PATH), limit=60)
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        assert bpe.digest([t], encoder)[0][:2] == (len(want), hashlib.sha256(
            " ".join(map(str, want)).encode()).hexdigest())


def test_lookahead_bounds_a_small_merge_list():
    """Tokens that end the lookahead before a cut are the same whatever follows the cut."""
    merges = [("a", "b"), ("b", "c"), ("ab", "a"), ("c", "a"), ("bc", "ca"), ("aba", "bc")]
    reach = sufficient_lookahead(merges)
    rank = {p: i for i, p in enumerate(merges)}

    def merged(s):
        parts = list(s)
        while True:
            best = min((rank.get((parts[k], parts[k + 1]), 99), k) for k in range(len(parts) - 1)) \
                if len(parts) > 1 else (99, 0)
            if best[0] == 99:
                return parts
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    rnd = random.Random(3)
    for _ in range(3000):
        s = "".join(rnd.choice("abc") for _ in range(rnd.randint(reach + 1, 24)))
        cut = rnd.randint(reach, len(s))
        alone, whole, end = merged(s[:cut]), merged(s), 0
        for i, t in enumerate(alone):
            end += len(t)
            if end > cut - reach:
                break
            assert whole[i] == t


def test_streaming_windows_and_decoding(library):
    v = vocabulary(PATH)
    word = "thinginghaedable" * 900
    ids = np.concatenate(list(v.encode_word(word.encode()))).tolist()
    assert ids == library.encode(word, add_special_tokens=False).ids
    assert decode(ids, v) == library.decode(ids, skip_special_tokens=False)
    text = "naïve 漢字 🎉 café"
    ids = TextEncoder(v).encode([text])[0].tolist()
    assert decode(ids, v, words=True) == text + " "


def _streamed(text, chunks, encoder):
    transducer, out = bpe.Transducer(encoder, 1), []
    for k, c in enumerate(chunks):
        out += transducer.feed([(0, c, k == len(chunks) - 1)])[0].tolist()
    return out


def test_chunk_borders_change_no_id(library):
    """A border at every position, and chunks of every small size, with runs longer than RUN."""
    encoder = TextEncoder(vocabulary(PATH))
    text = ("naïve cafe\u0301 漢字 🎉 we'll <|endoftext|>don't x<|startoftext|>y 1234 "
            "ΣΑΣ \u1112\u1161\u11ab \U0001fae8x !!!'s  \u3000end")
    want = library.encode(text, add_special_tokens=False).ids
    for at in range(len(text) + 1):
        assert _streamed(text, [text[:at], text[at:]], encoder) == want
    for n in range(1, 9):
        cuts = [text[k:k + n] for k in range(0, len(text), n)]
        assert _streamed(text, cuts, encoder) == want


def test_long_runs_stream_in_constant_memory(library, monkeypatch):
    monkeypatch.setattr(bpe, "RUN", 50)
    encoder, rnd = TextEncoder(vocabulary(PATH)), random.Random(8)
    bits = ["thing", "'s", "'ll", "!!!", "é", "e\u0301", "漢字", "7", "<|endoftext|>", "<|end",
            "a" * 300, "?!'" * 90, "\u1112\u1161\u11ab", "ΣΑΣ", "🎉", "\U0001fae8", "'"]
    for _ in range(120):
        text = "".join(rnd.choice(bits) * rnd.randint(1, 3) for _ in range(rnd.randint(5, 60)))
        text += rnd.choice(["", " end", " "])
        want = library.encode(text, add_special_tokens=False).ids
        n = rnd.choice([1, 7, 40, 333])
        assert _streamed(text, [text[k:k + n] for k in range(0, len(text), n)], encoder) == want
    assert max(map(len, encoder.words.index)) <= 50 + 333
    run, out = bpe.RunStream(vocabulary(PATH)), []
    for _ in range(2000):  # one word of 2 M characters
        out += run.feed("thinginghaedable" * 64)
        assert len(run.raw) + len(run.normal) < 2000 and len(run.part.held) < 4000
    out = np.concatenate(out + run.feed("", True))
    assert int(vocabulary(PATH).widths[out].sum()) == 2000 * 64 * 16


def test_decoder_carries_bytes_between_ids(library):
    v = vocabulary(PATH)
    text = "naïve 漢字 🎉 café ﷽"
    ids = TextEncoder(v).encode([text])[0].tolist()
    machine, plain = bpe.Decoder(v, words=True), bpe.Decoder(v)
    assert "".join(machine.feed([i]) for i in ids) + machine.finish() == text + " "
    assert "".join(plain.feed([i]) for i in ids) == library.decode(ids, skip_special_tokens=False)
    cut = bpe.Decoder(v, words=True)
    assert (cut.feed([int(v.inner[0xE6])]), cut.finish()) == ("", "\ufffd")


def test_codec_query_on_odd_rows(odd, empty, library):
    rows = bpe.digests(odd, PATH, ["doc_id"]).collect()
    want = Counter()
    for i, t, *_ in odd_rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(map(tuple, rows)) == want
    assert bpe.digests(empty, PATH, ["doc_id"]).count() == 0


def test_packing_is_whole_and_gapless(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = registry.op1_best_fit_packing(spark, SF).toPandas()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for doc, own in rows.groupby("doc_id"):
        ids = library.encode(texts[doc], add_special_tokens=False).ids + [0]
        own = own.sort_values("piece")
        assert own.piece.tolist() == list(range(-(-len(ids) // 2048)))
        for r in own.itertuples():
            part = np.array(ids[r.start:r.start + 2048], "<u4")
            assert (r.start, r.length) == (2048 * r.piece, len(part))
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
    assert set(rows.doc_id) == set(texts)
    for _, own in rows.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert own.length.sum() <= 2048
    assert rows.sequence_id.nunique() <= 1.06 * -(-rows.length.sum() // 2048) + 1


def test_packing_odd_rows_and_groups(odd, empty):
    rows = packing.packed(odd, PATH, 16).toPandas()
    assert len(odd_rows()) == (rows.piece == 0).sum()
    assert packing.packed(empty, PATH).count() == 0
    many = packing.pack(packing.written(packing.pieces(odd, PATH, 16), "p"), 16, 4, 500).toPandas()
    assert many.length.sum() == rows.length.sum()
    assert many.groupby("sequence_id").length.sum().max() <= 16


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    packer = packing.BestFit(10, 2)
    assert [packer.place(n) for n in (6, 7, 3, 4, 5)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0)]
    packer = packing.BestFit(10, 2)
    assert [packer.place(n)[0] for n in (6, 8, 5, 4, 2)] == [0, 1, 2, 0, 2]


def test_language_held_out_accuracy(spark):
    got = registry.op5_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    row = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")),
                                    F.min("score"), F.max("score")).first()
    assert row[0] > 0.97 and 0 <= row[1] <= row[2] <= 1


def test_language_forward_sums_all_segmentations():
    pieces = ("▁", "a", "ab", "b", "▁a")
    finder = language.PieceFinder(pieces)
    probs = np.array([[0.2], [0.3], [0.1], [0.25], [0.15], [1e-7]])
    found = np.exp(language.log_probabilities(["▁ab", "▁a"], finder, probs))[:, 0]
    # ▁|a|b, ▁|ab, ▁a|b and ▁|a, ▁a
    assert found[0] == pytest.approx(.2 * .3 * .25 + .2 * .1 + .15 * .25, rel=1e-5)
    assert found[1] == pytest.approx(.2 * .3 + .15, rel=1e-5)
    long = language.log_probabilities(["▁" + "ab" * 3000], finder, probs)
    assert np.isfinite(long).all() and long[0, 0] < -1000


def test_language_pieces_are_the_whole_vocabulary():
    import sentencepiece

    path = registry.vocabulary_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    pieces = language.read_pieces(path)
    assert set(pieces) == plain
    finder = language.PieceFinder(pieces)
    for word in ("▁something", "▁information"):
        found = finder.find(np.array([[ord(c) for c in word]], np.uint32))
        assert pieces[found[0, 0, len(word) - 1]] == word


def test_language_learns_from_long_words():
    pieces = ("▁", "a", "ab", "b", "▁a")
    finder = language.PieceFinder(pieces)
    probs = np.array([[0.2], [0.3], [0.1], [0.25], [0.15], [1e-7]])

    def cuts(word):  # probability and pieces of every segmentation
        if not word:
            yield 1.0, []
        for i, p in enumerate(pieces):
            if word.startswith(p):
                for rest, used in cuts(word[len(p):]):
                    yield rest * probs[i, 0], [i, *used]

    for word in ("▁ab", "▁abbab"):
        total = sum(p for p, _ in cuts(word))
        want = np.zeros(6)
        for p, used in cuts(word):
            np.add.at(want, used, 3 * p / total)
        got = language.expected_uses([word], np.array([3]), finder, probs)
        assert got == pytest.approx(want, rel=1e-9)
    for n in (33, 1000):
        long = language.expected_uses(["▁" + "ab" * n], np.array([1]), finder, probs)
        cut = .3 * .25 / (.3 * .25 + .1)  # share of each ab that is cut in two
        assert long[3] == pytest.approx(n - long[2], rel=1e-9)
        assert long[2] == pytest.approx((n - 1) * (1 - cut) + .2 * .1 / (
            .2 * (.3 * .25 + .1) + .15 * .25), rel=1e-9)


def test_language_tells_texts_without_blanks_apart(spark):
    rnd = random.Random(6)
    rows = [(i, "".join(rnd.choice(("abcde", "cdefg")[i % 2]) for _ in range(100)), "xy"[i % 2])
            for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    path = registry.vocabulary_path("piece_bpe_32k.model")
    model = language.learn(df, path, F.col("doc_id") < 20)
    got = language.predict(df.where("doc_id >= 20"), model, path, ["doc_id", "lang"]).collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)


def test_language_odd_rows(odd, empty):
    pieces = registry.vocabulary_path("piece_bpe_32k.model")
    model = language.learn(odd, pieces, F.lit(True))
    rows = language.predict(odd, model, pieces, ["doc_id", "text"]).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        silent = not r["text"] or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == silent
    none = language.learn(empty, pieces, F.lit(True))
    assert language.predict(empty, none, pieces, ["doc_id"]).count() == 0
    assert {r["lang_pred"] for r in language.predict(odd, none, pieces, ["doc_id"]).collect()} == {"und"}
