"""Hard negatives, HTML extraction and the filter audit against brute force."""

import html
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import PROSE, SF
from pyspark.sql import functions as F

from ledgerlake.llm import audit, boosting, dom, extraction, negatives, registry

VEC_SCHEMA = "vec_id long, embedding array<float>, label int, row string, q string, anchor string"


# --- hard negatives ----------------------------------------------------------


def _mined(rows):
    """Brute force over (vec_id, vector, label) rows, ids null last."""
    use = []
    for k, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i is not None and i % 7 == 0 else label
        use.append((k, i, [math.floor(256 * float(x)) for x in v], label))
    out = []
    key = lambda s: (-s[1], s[0][1] is None, s[0][1] or 0)
    for a in use:
        if a[1] is None or a[1] % 50:
            continue
        scored = sorted(((b, sum(x * y for x, y in zip(a[2], b[2]))) for b in use if b[0] != a[0]),
                        key=key)
        for p, ps in [s for s in scored if s[0][3] == a[3]][:5]:
            fits = [s for s in scored if s[0][3] != a[3] and 50 * ps <= 100 * s[1] <= 95 * ps]
            out += [(a[1], p[1], r + 1, n[1], ps, ns) for r, (n, ns) in enumerate(fits[:3])]
    return sorted(out, key=repr)


def _mine(spark, rows):
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], VEC_SCHEMA).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mine(df, label, F.col("vec_id") % 50 == 0)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr)


def _vectors(n, d=8, seed=1, labels=4):
    rnd = np.random.default_rng(seed)
    return [(i, [float(x) for x in rnd.normal(0.3, 0.4, d).astype(np.float32)],
             int(rnd.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("block", [16, 1000])
def test_negatives_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(negatives, "LEAST_BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 3)
    monkeypatch.setattr(negatives, "FIRST_DEPTH", 2)
    rows = _vectors(330)
    want = _mined(rows)
    assert len(want) > 30
    assert _mine(spark, rows) == want


def test_negatives_of_odd_rows(spark):
    rows = _vectors(120, labels=2)
    rows += [(50, None, 1), (100, [0.5, None] + [0.1] * 6, 1), (150, [float("nan")] * 8, 1),
             (200, [float("inf")] + [0.1] * 7, 1), (250, [0.5] * 8, None), (None, [0.4] * 8, 1),
             (None, [0.4] * 8, 0), rows[0], rows[0], rows[50],  # repeated anchors
             (300, [], 1), (350, [0.5, 0.5], 1), (400, [0.0] * 8, 1)]
    rows += [(1000 + 7 * (i % 3), [0.25] * 8, i % 2) for i in range(60)]  # ties, repeated ids
    want = _mined(rows)
    assert any(r[0] == 0 for r in want) and any(r[4] == 0 for r in want)
    assert _mine(spark, rows) == want
    assert _mine(spark, []) == []
    assert _mine(spark, [(0, [0.1], 1)]) == []


def test_threshold_algorithm_stops_early_and_misses_nothing():
    rnd = np.random.default_rng(3)
    vectors = rnd.integers(-100, 100, (4000, 2)).astype(np.float64)
    ids = np.arange(4000)
    for a in rnd.integers(-100, 100, (20, 2)).astype(np.float64):
        lists = negatives.SortedLists(vectors)
        best = negatives.Windows(5, [-10**9], [10**9])
        read = 0
        access = lists.access

        def counted(anchor):
            nonlocal read
            for new, scores, bound in access(anchor):
                read += len(new)
                yield new, scores, bound
        lists.access = counted
        negatives.search(lists, ids, ids, np.ones(4000, bool), a, best)
        scores = (vectors @ a).astype(int)
        want = sorted(range(4000), key=lambda i: (-scores[i], i))[:5]
        assert best.found(0)[1].tolist() == want
        if a.any():
            assert read < 4000


def test_large_components_stay_exact():
    big = np.array([[1 << 26, -(1 << 26), 3]], np.int32)
    a, b = negatives._exact(big, big)
    assert int((a @ b.T)[0, 0]) == 2 * (1 << 52) + 9


# --- HTML extraction ----------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return extraction.learn(pages)


def _template_text(page):
    """Article text of the given pages' own template."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    lines = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def test_extraction_of_given_pages(spark, pages):
    rows = registry.op12_html_extraction(spark, SF).collect()
    source = {r["page_id"]: r for r in pages.collect()}
    assert len(rows) == len(source)
    for r in rows:
        page = source[r["page_id"]]
        assert r["url"] == page["url"] and r["n_chars"] == len(r["text"])
        assert r["text"] == _template_text(page["html"])


def test_extraction_of_odd_rows(spark, model):
    deep = "<div>" * 3000 + "deep text" + "</div>" * 3000
    odd = [(0, None), (1, ""), (2, " \n "), (3, "<"), (4, "<p"), (5, "<!-- never closed <p>x"),
           (6, "<script>var x='</p>'"), (7, deep), (8, "<article>" + "<p>word</p>" * 20_000),
           (9, "<a title='unclosed>text</a><p>more"), (None, "<p>a</p>"), (1, ""),
           (10, "</p></div></b><table><tr><td>a<td>b<tr><td>c</table>")]
    df = spark.createDataFrame([(i, f"u{i}", h, "t", 1, "x") for i, h in odd],
                               "page_id long, url string, html string, text string, n_chars int, x string")
    rows = extraction.extracted(df, model).collect()
    assert len(rows) == len(odd)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    by_id = {r["page_id"]: r["text"] for r in rows}
    assert by_id[0] == by_id[1] == by_id[2] == by_id[4] == by_id[5] == by_id[6] == ""
    assert by_id[8] == "\n".join(["word"] * 20_000)
    assert extraction.extracted(df.where("false"), model).count() == 0
    untrained = extraction.learn(df.where("false"))
    assert untrained.leaves == []
    kept = {r["page_id"]: r["text"] for r in extraction.extracted(df, untrained).collect()}
    assert kept[10] == "a\nb\nc" and kept[7] == "deep text" and kept[None] == "a"


LAYOUTS = {
    "classes": '<body><div class="menu">{link}</div><div class="content">{art}</div>'
               '<div class="footer">{j}</div></body>',
    "semantic": "<body><header><h1>{j}</h1></header><nav>{link}</nav><main><article>{art}</article>"
                "<aside><p>{j}</p></aside></main><footer><p>{j}</p></footer></body>",
    "comments": '<body><div id="main"><div class="post">{art}</div><div id="comments">'
                '<div class="comment"><p>{j}</p></div><div class="comment"><p>{j}</p></div></div>'
                "</div></body>",
    "within": '<body><article>{art}<div class="ad">{j}</div><section class="comments"><p>{j}</p>'
              "</section></article></body>",
    "notice": '<body><div class="cookie-notice"><p>{j}</p></div><main>{art}</main><form><p>{j}</p>'
              "<input></form></body>",
    "sidebar": '<body><div class="sidebar"><h3>{j}</h3><p>{j}</p></div><div class="main-content">'
               "{art}</div></body>",
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_other_layouts(model, pages, layout):
    texts = [x for r in pages.orderBy("page_id").limit(40).collect()
             for x in _template_text(r["html"]).split("\n") if 80 < len(x) < 900]
    article, junk = texts[:6], iter(texts[6:])
    page = re.sub(r"{(\w+)}", lambda m: {
        "art": "".join(f"<p>{html.escape(t)}</p>" for t in article), "link": "<a href=x>one</a> " * 6,
        "j": "junk " + html.escape(next(junk)[:120])}[m[1]], LAYOUTS[layout])
    tree = dom.parse(page)
    got = extraction.main_text(tree, model.scores(extraction.features([tree])))
    assert got == "\n".join(article)


def test_blocks_of_a_page():
    tree = dom.parse("<title>no</title><p>a &amp; b &am<b>c<br>d<p>e\n f<div>g<span>h</span></div>i"
                     "<ul><li>j<li>k</ul><style>x</style><!-- y --><textarea>z</textarea>l")
    assert tree.text == ["a & b &amc d", "e f", "gh", "i", "j", "k", "l"]


def test_decoding_has_no_contradiction_and_is_the_likeliest():
    rnd = random.Random(4)
    for _ in range(60):
        n = rnd.randint(1, 9)
        parent = [-1] + [rnd.randrange(i) for i in range(1, n)]
        # page order: descendants follow their element
        order, stack = [], [0]
        while stack:
            x = stack.pop()
            order.append(x)
            stack += [c for c in range(n) if parent[c] == x]
        number = {x: i for i, x in enumerate(order)}
        tree = dom.Tree(tag=[0] * n, parent=[number.get(parent[x], -1) for x in order])
        odds = np.array([rnd.uniform(-4, 4) for _ in range(n)])
        got = extraction.decode(tree, odds)

        def worth(keep):
            return sum(-math.log1p(math.exp(-o if k else o)) for k, o in zip(keep, odds))
        fits = [k for k in itertools.product([False, True], repeat=n)
                if all(not k[i] or i == 0 or k[tree.parent[i]] for i in range(n))]
        assert tuple(got) in fits
        assert worth(got) == pytest.approx(max(map(worth, fits)))


def test_boosting_learns_an_interaction():
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    forest = boosting.fit(x[:2000], y[:2000])
    assert ((forest.scores(x[2000:]) > 0) == y[2000:]).mean() > 0.95
    assert boosting.fit(x[:10], np.ones(10)).scores(x).tolist() == [0.0] * 3000


# --- filter audit --------------------------------------------------------------


def _audited(docs, labels):
    """Brute force: each order applied to each document of each part."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    facts = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and text in first and first[text] < i}
        facts.append((lang or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    out = {}
    for part in {f[0] for f in facts}:
        own = [f for f in facts if f[0] == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                before = [d for d in own if d not in left]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[1] for d in own) - len(gone),
                    sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def _check_audit(got, want):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in names] for r in got}
    assert len(rows) == len(got) == 600 * len({p for p, _, _ in want})
    assert rows == want


def test_audit_equals_brute_force(spark):
    rnd = random.Random(6)
    words = PROSE.split()
    docs = []
    for i in range(150):
        text = " ".join(rnd.choice(words) + rnd.choice(["", "", "a", "b", "%"] if i % 4 == 0 else [""])
                        for _ in range(rnd.choice([20, 220])))
        if i % 5 == 0:
            text = " ".join(f"{w}{k}" for k, w in enumerate(text.split()))
        docs.append((i, text.upper() if i % 9 == 0 else text, rnd.choice(["en", "fr", None, ""])))
    docs += [(200 + i, docs[i % 7][1], "en") for i in range(40)]  # copies
    docs += [(200, docs[0][1], "en"), (3, docs[3][1], "fr"), (None, docs[1][1], "en"),
             (None, None, None), (500, None, "en"), (501, "", "en"), (502, "a\x0b\x1cb É", "é")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 240, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    df = spark.createDataFrame([(*d, "a", "b", 1, b"x") for d in docs],
                               "doc_id long, text string, lang string, part string, mask string, "
                               "n int, digest binary").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    _check_audit(audit.audit(df, marks).collect(), _audited(docs, labels))
    assert audit.audit(df.where("false"), marks).count() == 0
    unlabelled = audit.audit(df, marks.where("false")).collect()
    assert all(r["good_lost"] == r["toxic_lost"] == 0 for r in unlabelled)


def test_removal_steps_are_the_first_failing_filter():
    n = 4
    steps = audit.removal_steps(audit.mask_matrix(n), audit.position_matrix(n))
    for k, order in enumerate(itertools.permutations(range(n))):
        for mask in range(1 << n):
            fails = [s for s, f in enumerate(order) if mask >> f & 1]
            assert steps[mask, k] == (fails[0] if fails else n)
