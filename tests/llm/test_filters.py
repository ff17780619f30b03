"""Quality rules, toxicity, fingerprints and the n-gram join against brute force."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import PROSE, SF, odd_rows

from ledgerlake.llm import components, fingerprint, ngram_join, quality, registry, toxicity
from ledgerlake.llm.common import WORD


# --- quality rules -------------------------------------------------------------


def _counts(text):
    words = re.findall(WORD, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(inside))


def _check_counts(rows, texts):
    for r in rows:
        want = _counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality.BASE) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_counts_equal_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = registry.op6_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    _check_counts(rows, texts)


def test_counts_of_odd_rows(odd, empty, labels, no_labels):
    rules = quality.learn_from(odd, labels)
    rows = quality.judge(odd, rules).collect()
    texts = {i: t for i, t, *_ in odd_rows() if i is not None}
    assert len(rows) == len(odd_rows())
    _check_counts([r for r in rows if r["doc_id"] is not None], texts)
    none = quality.learn_from(odd, no_labels)
    assert none.rules == []
    assert quality.judge(empty, quality.learn_from(empty, labels)).count() == 0
    kept = quality.keep_good(odd, none)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {7, 8, 9, 12, None}


def test_repeated_windows_overlap(spark):
    text = " ".join(["a b c d e f g h"] * 3 + ["i"] + ["a b c d e f g h"])
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality.with_counts(df, "text", ["doc_id"]).first()["n_repeat_words"] == _counts(text)[4]


def test_decision_list_finds_planted_rules(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(600):
        words = [rnd.choice(PROSE.split()) for _ in range(60)]
        bad = i % 5 == 0
        if bad:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), 0 if bad else 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    rules = quality.learn_from(df, df.select("doc_id", "quality"))
    assert 1 <= len(rules.rules) <= 3 and "reject if" in str(rules)
    kept = {r["doc_id"] for r in quality.judge(df, rules).where("kept").collect()}
    assert kept == {i for i, _, q in rows if q == 1}


def test_a_stray_symbol_stays(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        words = [rnd.choice(PROSE.split()) for _ in range(60)]
        if i % 5 == 0:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), int(i % 5 != 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    rules = quality.learn_from(df, df.select("doc_id", "quality"))
    new = spark.createDataFrame(
        [(1, rows[1][1] + " &"), (2, rows[2][1] + " costs $5"), (3, rows[0][1])],
        "doc_id long, text string")
    assert {r["doc_id"] for r in quality.judge(new, rules).where("kept").collect()} == {1, 2}
    assert [r["doc_id"] for r in quality.keep_good(new, rules).orderBy("doc_id").collect()] == [1, 2]


def test_quality_has_no_python_in_its_plan(spark):
    plan = registry.op6_quality_rules(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- toxicity --------------------------------------------------------------------


def _kernel(s, t):
    """The subsequence kernel by listing all subsequences."""
    def weights(x):
        out = Counter()
        for at in itertools.combinations(range(len(x)), toxicity.ORDER):
            out["".join(x[i] for i in at)] += toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out
    a, b = weights(s), weights(t)
    return sum(a[k] * b[k] for k in a)


def test_kernel_equals_listing_subsequences():
    words = ["idiot", "idxiot", "worthless", "scum", "banana", "abc", "moron", "oooooo"]
    marks = toxicity.Landmarks(["idiot", "worthless", "banana"])
    got = marks.features(words)
    for i, w in enumerate(words):
        for j, m in enumerate(marks.words):
            own = _kernel(w, w)
            want = (_kernel(w, m) / (own * _kernel(m, m)) ** 0.5) ** toxicity.POWER if own else 0
            assert got[i, j] == pytest.approx(want, rel=1e-4, abs=1e-6)


def test_held_out_toxicity(spark):
    got = registry.op10_toxicity(spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out")
    y = np.array([(r["toxic"], r["score"], r["predicted"]) for r in got.collect()])
    pos, neg = y[y[:, 0] == 1], y[y[:, 0] == 0]
    assert ((pos[:, 1][:, None] > neg[:, 1]).mean()
            + (pos[:, 1][:, None] == neg[:, 1]).mean() / 2) > 0.85  # area under the curve
    assert pos[:, 2].mean() > 0.6 and neg[:, 2].mean() < 0.03
    assert ((y[:, 1] >= 0.5) == (y[:, 2] == 1)).all()


def test_gaps_and_inserted_characters(spark):
    rnd = random.Random(4)
    vocabulary = PROSE.split()
    rows = []
    for i in range(300):
        words = [rnd.choice(vocabulary) for _ in range(40)]
        if i % 4 == 0:
            words[rnd.randrange(40)] = rnd.choice(["blockhead", "numbskull"])
        rows.append((i, " ".join(words) + ".", int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(df, df.select("doc_id", "toxic"))
    texts = ["you b l o c k h e a d there", "you num.bsk.ull there", "you bloxckhead there",
             "the quick brown fox", "", None]
    score = model.score(model.decide(texts, model.reader()))
    assert (score[:3] > 0.5).all() and (score[3:] < 0.5).all()


def test_toxicity_odd_rows(odd, empty, labels, no_labels):
    model = toxicity.learn(odd, labels)
    assert toxicity.scored(odd, model, ["doc_id"]).count() == len(odd_rows())
    never = toxicity.learn(odd, no_labels)
    assert {r["score"] < 1e-9 for r in toxicity.scored(odd, never, ["doc_id"]).collect()} == {True}
    kept = toxicity.clean_only(odd, never)
    assert kept.schema == odd.schema and kept.count() == len(odd_rows())
    assert toxicity.clean_only(empty, never).count() == 0


# --- fingerprints ------------------------------------------------------------------


def test_levels_and_features_equal_brute_force():
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 97 + k, n).astype(np.uint8) for k, n in
             ((4, 500), (20, 3000), (2, 64), (26, 31), (26, 200))]
    data = np.concatenate(texts)
    bounds = np.cumsum([0, *map(len, texts)])
    adds = fingerprint._ADDS
    for t in texts:
        got = fingerprint.window_levels(t)
        top = int(adds.sum())
        for i in range(len(t) - fingerprint.WINDOW + 1):
            c = np.bincount(t[i:i + fingerprint.WINDOW])
            total = sum(int(adds[:n].sum()) for n in c)
            assert got[i] == (top - total) * fingerprint.LEVELS // top
    ranks = fingerprint.rank_table(np.bincount(fingerprint.window_levels(data),
                                               minlength=fingerprint.LEVELS + 1))
    want = []
    for t, start in zip(texts, bounds):
        rank = ranks[fingerprint.window_levels(t)].astype(int)
        points = Counter()
        for i in range(len(rank) - fingerprint.NEAR + 1):
            near = rank[i:i + fingerprint.NEAR]
            if near.min() < 0xFFFF:
                points[i + int(near.argmin())] += 1
        want += [start + p for p in sorted(points) if points[p] >= fingerprint.POINTS]
    chunk = fingerprint._CHUNK
    try:
        for fingerprint._CHUNK in (chunk, 257):  # chunks make no difference
            assert fingerprint.feature_starts(data, bounds, ranks).tolist() == want
    finally:
        fingerprint._CHUNK = chunk


def test_edits_and_neighbours(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(registry.op4_document_fingerprints(spark, SF).collect(), key=lambda r: r["doc_id"])
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    assert len(rows) == len(texts)
    for r, t, f in zip(rows, texts, texts[1:] + texts[:1]):
        k = len(t) // 4
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256((t[:len(t) - k] + f[:k]).encode()).hexdigest()
    long = [r for r in rows if r["n_chars"] > 300]
    assert np.mean([r["near_edited"] for r in long]) > 0.5
    assert np.mean([r["near_next"] for r in long]) < 0.05
    a = [fingerprint.Fingerprint.parse(r["fingerprint"]) for r in rows[:20]]
    for x, y, r in zip(a, a[1:], rows):
        assert fingerprint.likeness(x, y) == pytest.approx(r["near_next"])


def test_fingerprints_of_odd_rows(odd, empty, spark):
    ranks = fingerprint.rank_table(fingerprint.level_counts(odd))
    rows = fingerprint.compare_with_edits(odd, ranks).collect()
    assert len(rows) == len(odd_rows())
    by_size = {}
    for r in rows:
        by_size.setdefault((r["n_chars"], r["doc_id"] in (7, 8, 12)), set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert len(by_size[len(PROSE), True]) == 1
    assert fingerprint.compare_with_edits(
        empty, fingerprint.rank_table(fingerprint.level_counts(empty))).count() == 0
    one = spark.createDataFrame([(5, PROSE)], "doc_id long, text string")
    r = fingerprint.compare_with_edits(one, ranks).first()
    assert r["near_next"] == 1.0


def test_repetitive_texts_have_features():
    rng = np.random.default_rng(3)
    other = "".join(map(chr, rng.integers(97, 123, 4000)))
    ranks = fingerprint.rank_table(np.bincount(fingerprint.window_levels(np.frombuffer(
        other.encode(), np.uint8)), minlength=fingerprint.LEVELS + 1))
    phrases = ["Shti ", "thly ", "ha ", "lorem ipsum ", *(
        "".join(map(chr, rng.choice(np.arange(97, 97 + max(26, k)), k, replace=False)))
        for k in range(2, 33))]
    for n in (130, 400, 2000):
        texts = [(p * n)[:n] for p in phrases]
        edited = [t[:n - n // 4] + other[:n // 4] for t in texts]
        made = fingerprint.fingerprints(texts, ranks)
        changed = fingerprint.fingerprints(edited, ranks)
        assert all(map(str, made))
        assert all(fingerprint.likeness(a, b) > 0.5 for a, b in zip(made, changed))
        assert max(fingerprint.likeness(a, b) for a, b in itertools.combinations(made, 2)) < 0.5
    dull, blank = fingerprint.fingerprints(["x" * 500, ""], ranks)
    assert str(dull) and not str(blank) and fingerprint.likeness(dull, blank) == 0


def test_near_copies_across_the_short_border():
    rng = np.random.default_rng(4)
    texts = ["".join(map(chr, rng.integers(97, 123, 140))) for _ in range(40)]
    ranks = fingerprint.rank_table(np.bincount(fingerprint.window_levels(np.frombuffer(
        "".join(texts).encode(), np.uint8)), minlength=fingerprint.LEVELS + 1))
    whole = fingerprint.fingerprints(texts, ranks)
    for cut in (slice(120), slice(20, 140), slice(90)):
        parts = fingerprint.fingerprints([t[cut] for t in texts], ranks)
        got = [fingerprint.likeness(a, b) for a, b in zip(whole, parts)]
        assert np.mean(got) > 0.9
        unlike = [fingerprint.likeness(a, b) for a, b in zip(whole, parts[1:])]
        assert np.mean(unlike) < 0.05
        for p in parts:
            again = fingerprint.Fingerprint.parse(str(p))
            assert str(again) == str(p) and fingerprint.likeness(p, again) == 1
    assert fingerprint.likeness(*fingerprint.fingerprints([texts[0], texts[0][:20]], ranks)) == 0


# --- n-gram join ---------------------------------------------------------------------


def _brute(rows, threshold=0.8):
    sets = {}
    for i, t in rows:
        w = re.findall(WORD, t or "")
        if i is not None:
            sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    links, root = Counter(), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in sets}


def _near_copies(n, seed=1):
    rnd = random.Random(seed)
    base = [f"w{k}" for k in range(120)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(120)] = f"x{rnd.randrange(1000)}"
        out.append(" ".join(words))
    return out


def test_join_equals_brute_force(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(120).collect()]
    texts += _near_copies(60) + [texts[3]] * 20 + ["one two", "one two", "two one", None, "", " "]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"])
           for r in ngram_join.join_classes(df).collect()}
    assert got == _brute(rows)


def test_blocks_make_no_difference(spark, monkeypatch):
    rows = list(enumerate(_near_copies(70, 5)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 16)
    got = {r["doc_id"]: (r["class_id"], r["n_links"])
           for r in ngram_join.join_classes(df).collect()}
    assert got == _brute(rows)


def test_common_ngrams_equal_brute_force(monkeypatch):
    rng = np.random.default_rng(4)
    sets = [np.unique(np.concatenate([rng.choice(40, rng.integers(0, 30)),  # frequent
                                      rng.integers(1000, 4000, rng.integers(0, 60))]))
            for _ in range(90)]
    for visits in (4_000_000, 50):
        monkeypatch.setattr(ngram_join, "MOST_VISITS", visits)
        for left, right in ((sets, sets), (sets[:30], sets[30:]), (sets[:1], sets[1:3])):
            want = [[len(np.intersect1d(x, y)) for y in right] for x in left]
            assert (ngram_join.common_ngrams(left, right) == want).all()
    assert (ngram_join.common_ngrams([sets[0][:0]], [sets[0][:0]]) == 0).all()


def test_a_block_of_texts_that_share_little_is_fast():
    """4,096 texts, each like one other: the cost follows the shared n-grams, not all n-grams."""
    rng = np.random.default_rng(9)
    half = rng.integers(0, 2**62, (2048, 244))
    sets = [np.sort(x) for x in np.concatenate([half, half])]
    begun = time.process_time()
    every = np.arange(4096)
    links, label = ngram_join._links(sets, every, every, np.ones(4096, np.int64), 0.8)
    assert (links == 1).all() and (label == np.tile(np.arange(2048), 2)).all()
    assert time.process_time() - begun < 30


def test_recall_of_near_copies(spark):
    """Of the pairs of a document and its edited copy whose similarity is at the threshold or
    above, at least 0.97 are in one class (0.99 at the threshold itself, by the bands' formula)."""
    rnd = random.Random(12)
    texts = dict(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
                 .select("doc_id", "text").collect())

    def grams(words):
        return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))}

    rows, pairs = [], []
    for i, t in texts.items():
        words = re.findall(WORD, t or "")
        if len(words) < 40:
            continue
        copy = list(words)
        for _ in range(rnd.randint(1, max(1, len(words) // 40))):
            copy[rnd.randrange(len(copy))] = f"changed{rnd.randrange(10**6)}"
        x, y = grams(words), grams(copy)
        rows += [(2 * i, t), (2 * i + 1, " ".join(copy))]
        if len(x & y) >= 0.8 * len(x | y):
            pairs.append((2 * i, 2 * i + 1))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes = {r["doc_id"]: r["class_id"] for r in ngram_join.join_classes(df).collect()}
    assert len(pairs) > 100
    assert sum(classes[a] == classes[b] for a, b in pairs) >= 0.97 * len(pairs)


def test_join_odd_rows(odd, empty):
    rows = ngram_join.join_classes(odd).collect()
    ids = [i for i, *_ in odd_rows()]
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == \
        sorted({i for i in ids if i is not None})
    want = _brute({(i, t) for i, t, *_ in odd_rows()})
    assert {r["doc_id"]: (r["class_id"], r["n_links"])
            for r in rows if r["doc_id"] is not None} == want
    kept = ngram_join.one_of_each(odd)
    assert kept.columns == odd.columns
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == [0, 1, 2, 3, 4, 5, 6, 7, 10, 11]
    assert got.count(None) == 2
    assert ngram_join.join_classes(empty).count() == 0
    assert ngram_join.one_of_each(empty).count() == 0


def test_texts_that_share_an_id(spark):
    near = PROSE + " again"
    own = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcde"]
    rows = [(1, None), (1, PROSE), (2, own[4]), (2, own[0]), (2, own[1]), (3, near),
            (4, own[1] + " more"), (4, own[2]), (5, own[2]), (5, own[3]), (5, own[3]), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r["doc_id"], r["text"]) for r in ngram_join.one_of_each(df).collect())
    # near, own[1] + " more" and the second own[2] go, as does the repeated row
    assert got == Counter([(1, None), (1, PROSE), (2, own[4]), (2, own[0]), (2, own[1]),
                           (4, own[2]), (5, own[3]), (6, "")])
    links = {r["doc_id"]: (r["class_id"], r["n_links"])
             for r in ngram_join.join_classes(df.where("doc_id in (1, 3)")).collect()}
    assert links == {1: (1, 1), 3: (1, 1)}  # a text with words comes before one without


def test_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands()
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.99 and bands * rows <= ngram_join.MAX_HASHES


def test_components(spark):
    rnd = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rnd.randrange(60), rnd.randrange(60))
                                                      for _ in range(40)] + [(7, 7), (None, 3)]
    root = {n: n for e in edges for n in e if n is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(df).collect()}
    assert got == {n: find(n) for n in root if find(n) != n}
