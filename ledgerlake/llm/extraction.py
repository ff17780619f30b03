"""HTML main-text extraction (operator 12): boosted trees over DOM nodes, decoded over the tree.

A page is read into the tree of its block-level elements (``dom``). Each
element gets features: its tag, families of words in its class, id, role and
label, the same of its ancestors, text and link density of its subtree, depth,
and how it compares with its siblings. Gradient-boosted trees give the log-odds
that the element is part of the article or holds some of it. Elements are then
kept or left out all at once: an element can be kept only if its parent is, and
the choice over the whole tree with the greatest likelihood is found from the
leaves up, so no element is kept inside one that is left out. The text is that
of kept elements, block by block.

The model learns from pages whose markup says where the article is: those with
one ``article`` element (or, without any, one ``main``) and text around it. So that
it doesn't learn one site's template, each sampled page is also dressed anew
several times: its article in other wrappers, its own texts and those of
other sampled pages as menus, headers, sidebars, notices, adverts, forms and
reader comments, under names from the families below. The sample is bounded
(``SAMPLE_PAGES`` pages by a hash of the id, ``SAMPLE_NODES`` elements of
pages and ``SAMPLE_CHARS`` characters of a page's article); every page is
extracted whole.

Defined results: a null or empty page, and one without text, gives an empty
text; rows with the same page_id are extracted row by row; a null page_id or
url stays null. Pages of any length and depth are read whole. If no page says
where its article is (an empty table, too), nothing is learned and all text of
blocks is kept. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import boosting
from ledgerlake.llm.common import smallest_hashes, text_groups, written
from ledgerlake.llm.dom import TAG, Tree, by_depth, name_tokens, parse

SAMPLE_PAGES = 400
SAMPLE_NODES = 40_000
SAMPLE_CHARS = 20_000
#: New dresses of each sampled page.
DRESSES = 5

#: Words of names that tell what an element is for.
FAMILIES = {
    "content": "article articles body content copy entry main post story text prose read "
               "hentry richtext markdown page",
    "navigation": "nav navigation navbar menu menus breadcrumb breadcrumbs tabs toc pager "
                  "pagination links skip sitemap navi",
    "header": "header head masthead topbar top logo branding hero",
    "footer": "footer foot bottom copyright legal imprint colophon contentinfo",
    "side": "side sidebar aside rail widget widgets secondary complementary",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo "
              "promotion promoted banner banners teaser",
    "comment": "comment comments respond reply replies discussion thread reviews review "
               "commentlist reader readers",
    "notice": "notice notices cookie cookies consent gdpr alert alerts popup modal overlay "
              "warning message messages paywall toast announcement",
    "form": "form forms search login signup signin subscribe newsletter input register contact",
    "social": "share sharing social follow like likes tweet tools toolbar buttons",
    "related": "related recommended recommendations more popular trending next previous also "
               "latest recent",
    "meta": "byline author meta tag tags category categories credit credits timestamp",
    "hidden": "hidden invisible none",
}
_FAMILY = {w: i for i, (_, words) in enumerate(FAMILIES.items()) for w in words.split()}
#: Elements whose descendants know that they are inside.
_INSIDE = ["article", "main", "nav", "aside", "header", "footer", "form", "ul", "table",
           "blockquote", "figure", "section"]
_HEADINGS = [TAG[f"h{i}"] for i in range(1, 7)]


# --- features ---------------------------------------------------------------


def _name_families(names: list[str], cache: dict[str, np.ndarray]) -> np.ndarray:
    """How many words of each family name each element."""
    out = np.zeros((len(names), len(FAMILIES)), np.float32)
    for i, raw in enumerate(names):
        if raw:
            row = cache.get(raw)
            if row is None:
                row = np.zeros(len(FAMILIES), np.float32)
                for t in name_tokens(raw):
                    if t in _FAMILY:
                        row[_FAMILY[t]] += 1
                if len(cache) < 50_000:
                    cache[raw] = row
            out[i] = row
    return out


def features(trees: list[Tree], cache: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """A row for each element of the trees, one tree after the other."""
    sizes = np.array([len(t) for t in trees])
    start = np.cumsum(sizes) - sizes
    join = lambda name: np.concatenate([np.asarray(getattr(t, name)) for t in trees])
    shift = np.repeat(start, sizes)
    tag, depth = join("tag"), join("depth")
    root = np.repeat(start, sizes)
    parent = join("parent") + shift
    top = np.arange(len(tag)) == root
    parent[top] = np.flatnonzero(top)
    end = join("end") + shift
    each = np.arange(len(tag))

    own = np.zeros((len(tag), 6))  # chars, words, stops, blocks, linked chars, inline elements
    for s, t in zip(start.tolist(), trees):
        if t.owner:
            at = np.array(t.owner) + s
            for k, values in enumerate((
                    [len(x) for x in t.text], [x.count(" ") + 1 for x in t.text],
                    [x.count(".") + x.count(",") + x.count("?") + x.count("!") for x in t.text],
                    [1] * len(t.text))):
                np.add.at(own[:, k], at, values)
    own[:, 4], own[:, 5] = join("linked"), join("inline")
    kinds = np.stack([tag == TAG["p"], np.isin(tag, _HEADINGS), tag == TAG["li"],
                      np.ones(len(tag))], axis=1)
    total = np.concatenate([np.zeros((1, 10)), np.cumsum(np.hstack([own, kinds]), axis=0)])
    below = total[end] - total[each]  # of the subtree
    page = below[root]
    chars, words, stops, blocks, linked, inline, p, heads, items, nodes = below.T
    some = np.maximum(chars, 1)

    # siblings: under the same parent
    children = np.bincount(parent, ~top, len(tag))
    sum_of = lambda x: np.bincount(parent, np.where(top, 0, x), len(tag))
    same = np.unique(parent * len(TAG) + tag, return_inverse=True)[1]
    alike = np.bincount(same)[same]
    # children of a parent are numbered in page order
    by_parent = np.argsort(np.where(top, -1, parent), kind="stable")
    place = np.empty(len(tag))
    runs = np.concatenate([[0], np.flatnonzero(np.diff(np.where(top, -1, parent)[by_parent])) + 1])
    place[by_parent] = each - np.repeat(runs, np.diff(np.append(runs, len(tag))))
    of = children[parent]
    mean = sum_of(chars)[parent] / np.maximum(of, 1)
    links_among = sum_of(linked)[parent] / np.maximum(sum_of(chars)[parent], 1)

    names = _name_families(
        [n for t in trees for n in t.names], {} if cache is None else cache)
    inside = np.stack([tag == TAG[t] for t in _INSIDE], axis=1).astype(np.float32)
    mine = np.hstack([names, inside])
    above = np.zeros_like(mine)
    for rows in by_depth(depth)[1:]:
        above[rows] = above[parent[rows]] + mine[parent[rows]]
    has_article = np.maximum.reduceat(inside[:, :2], start, axis=0) if len(trees) else inside[:, :2]

    numbers = np.stack([
        tag, np.minimum(depth, 30), np.log1p(chars), np.log1p(own[:, 0]), words / np.maximum(blocks, 1),
        chars / np.maximum(blocks, 1), linked / some, stops / np.maximum(words, 1),
        chars / np.maximum(nodes + inline, 1), np.log1p(p), heads, np.log1p(items), np.log1p(nodes),
        chars / np.maximum(page[:, 0], 1), (each - root) / np.maximum(end[root] - root, 1),
        np.where(top, 0, place / np.maximum(of, 1)), of, alike,
        np.log1p(mean), np.where(mean > 0, chars / np.maximum(mean, 1), 0), links_among,
        chars / np.maximum(chars[parent], 1), np.log1p(own[parent, 0]), children,
        linked[parent] / some[parent], np.log1p(p[parent]), tag[parent]], axis=1)
    return np.hstack([numbers, names, np.minimum(above, 3), has_article[
        np.repeat(np.arange(len(trees)), sizes)]]).astype(np.float32)


# --- hierarchical decoding --------------------------------------------------


def decode(tree: Tree, log_odds: np.ndarray) -> list[bool]:
    """Which elements are kept: the likeliest choice that keeps no element without its parent."""
    bounded = np.clip(log_odds, -6, 6)
    yes = (-np.log1p(np.exp(-bounded))).tolist()
    no = (-np.log1p(np.exp(bounded))).tolist()
    parent = tree.parent
    left_out = no[:]  # of the whole subtree
    kept = yes[:]
    for i in range(len(tree) - 1, 0, -1):
        p = parent[i]
        left_out[p] += left_out[i]
        kept[p] += max(kept[i], left_out[i])
    out = [kept[0] >= left_out[0]]
    for i in range(1, len(tree)):
        out.append(out[parent[i]] and kept[i] >= left_out[i])
    return out


def main_text(tree: Tree, log_odds: np.ndarray) -> str:
    """Text of the kept elements, a line for each block."""
    if not tree.text:
        return ""
    keep = decode(tree, log_odds)
    return "\n".join(t for o, t in zip(tree.owner, tree.text) if keep[o])


# --- learning ---------------------------------------------------------------


def marked_article(tree: Tree) -> int | None:
    """The element that the page's markup calls the article, if it leaves other text out."""
    for name in ("article", "main"):
        found = [i for i, t in enumerate(tree.tag) if t == TAG[name]]
        if len(found) == 1:
            at, inside = found[0], [found[0] <= o < tree.end[found[0]] for o in tree.owner]
            return at if any(inside) and not all(inside) else None
        if found:
            return None
    return None


def labels_of(tree: Tree, articles: list[int], junk: list[int] = ()) -> np.ndarray:
    """1 for elements in or around an article's text, 0 for those without any of it."""
    text = np.zeros(len(tree), bool)
    for a in articles:
        text[a:tree.end[a]] = True
    for j in junk:
        text[j:tree.end[j]] = False
    parent = tree.parent
    out = text.copy()
    for i in range(len(tree) - 1, 0, -1):
        if out[i]:
            out[parent[i]] = True
    return out


class Dresser:
    """New pages from the texts of sampled ones: an article and what stands around it."""

    #: Names of wrappers that say nothing.
    PLAIN = ["container", "wrapper", "row", "inner", "box", "block", "col", "grid", "layout", ""]

    def __init__(self, seed: int, prose: list[str]):
        self.rnd = random.Random(seed)
        self.prose = [p.split() for p in prose if p] or [["text"]]

    def words(self, few: int, many: int) -> str:
        """Some words of the sampled texts, as they follow each other."""
        n, out = self.rnd.randint(few, many), []
        while len(out) < n:
            text = self.rnd.choice(self.prose)
            at = self.rnd.randrange(len(text))
            out += text[at:at + n - len(out)]
        return entities.escape(" ".join(out))

    def name(self, *families: str) -> str:
        """A class or id out of words of a family (or none)."""
        word = self.rnd.choice(" ".join(FAMILIES[f] for f in families).split())
        shape = self.rnd.choice(["{}", "{}", "site-{}", "{}-box", "page_{}", "js-{} {}", "{}Area"])
        return f' {self.rnd.choice(["class", "class", "id"])}="{shape.format(word, word)}"'

    def plain(self) -> str:
        word = self.rnd.choice(self.PLAIN)
        return f' class="{word}"' if word else ""

    def some(self, few: int, many: int, make) -> str:  # noqa: ANN001
        return "".join(make() for _ in range(self.rnd.randint(few, many)))

    def link(self) -> str:
        return f'<a href="#">{self.words(1, 4)}</a>'

    def links(self) -> str:
        if self.rnd.random() < 0.3:
            return self.some(3, 9, lambda: self.link() + " ")
        return "<ul>" + self.some(3, 10, lambda: f"<li>{self.link()}</li>") + "</ul>"

    def paragraph(self, few: int, many: int) -> str:
        return f"<p>{self.words(few, many)}</p>"

    def wrapped(self, tags: list[str], families: list[str], inner: str, mark: bool = True) -> str:
        """``inner`` in an element that either its tag or its name gives away."""
        tag = self.rnd.choice([*tags, "div", "div", "section"])
        named = tag in ("div", "section", "ul") or self.rnd.random() < 0.5
        return f'<{tag}{self.name(*families) if named else ""}{" data-j" if mark else ""}>' \
               f"{inner}</{tag}>"

    def junk(self, kind: str) -> str:
        """A part of a page that is no article."""
        w, p = self.words, self.paragraph
        if kind == "navigation":
            return self.wrapped(["nav", "nav", "menu"], ["navigation"], self.links())
        if kind == "header":
            return self.wrapped(["header", "header"], ["header"], self.rnd.choice([
                f"<h1>{w(1, 6)}</h1>", f"<p>{w(2, 12)}</p>", w(1, 8), ""]) + self.rnd.choice(
                    ["", self.links(), self.junk("form")]))
        if kind == "footer":
            return self.wrapped(["footer", "footer"], ["footer"], self.rnd.choice([
                f"&copy; {w(2, 20)}", p(3, 40), self.links() + p(3, 15)]))
        if kind == "side":
            return self.wrapped(["aside", "aside"], ["side"], self.some(1, 3, lambda: self.rnd.choice([
                f"<h3>{w(1, 5)}</h3>{self.links()}", p(5, 60), f"<h4>{w(1, 4)}</h4>{p(4, 40)}",
                f"<div>{w(4, 30)}</div>"])))
        if kind == "advert":
            return self.wrapped(["aside"], ["advert"], self.rnd.choice(
                [w(3, 30), p(3, 50), f"<h3>{w(2, 6)}</h3>{p(4, 30)}", self.link()]))
        if kind == "comment":
            one = self.rnd.choice(["<li{}>{}</li>", "<div{}>{}</div>", "<article{}>{}</article>"])
            name = self.name("comment") if self.rnd.random() < 0.6 else self.plain()
            return self.wrapped(["section", "aside"], ["comment"], self.rnd.choice(
                ["", f"<h2>{w(1, 4)}</h2>"]) + self.some(1, 6, lambda: one.format(name, self.rnd.choice(
                    [p(3, 80), f"<b>{w(1, 2)}</b> {w(4, 60)}", p(1, 3) + self.some(
                        1, 3, lambda: p(4, 50))]))) + self.rnd.choice(["", self.junk("form")]))
        if kind == "notice":
            return self.wrapped(["dialog", "aside"], ["notice"], self.rnd.choice(
                [w(4, 40), p(4, 60), p(4, 30) + "<button>OK</button>"]))
        if kind == "form":
            return self.wrapped(["form", "form", "form"], ["form"], self.rnd.choice([
                f"<label>{w(1, 5)}</label><input>", f"<p>{w(3, 20)}</p><input><button>x</button>",
                f"<h3>{w(1, 5)}</h3><p>{w(4, 30)}</p><textarea></textarea>",
                f"<fieldset><legend>{w(1, 3)}</legend><label>{w(1, 4)}<input></label></fieldset>"]))
        if kind == "social":
            return self.wrapped(["ul"], ["social"], self.some(2, 5, lambda: f"<li>{self.link()}</li>"))
        if kind == "related":
            return self.wrapped(["aside", "nav"], ["related"], f"<h3>{w(1, 5)}</h3>"
                                + self.rnd.choice([self.links(), self.some(2, 5, lambda: p(3, 25))]))
        return f'<div{self.name("hidden")} data-j>{w(3, 30)}</div>'

    KINDS = ["navigation", "header", "footer", "side", "advert", "comment", "notice", "form",
             "social", "related", "hidden"]

    def page(self, article: list[str]) -> str:
        """A page around an article's blocks, given as elements; ``data-y`` and ``data-j`` mark
        the article and what isn't one."""
        rnd = self.rnd
        blocks = list(article)
        bare = rnd.random()
        if bare < 0.06:  # text right in the wrapper, or in elements without a meaning
            blocks = [re.sub(r"</?(?:p|h\d)>", "", b) + "<br>" for b in blocks]
        elif bare < 0.14:
            blocks = [re.sub(r"<(/?)p>", r"<\1div>", b) for b in blocks]
        for i in range(len(blocks)):  # other elements that an article may have
            if rnd.random() < 0.1:
                tag = rnd.choice(["blockquote", "pre", "li", "h2", "h2", "h3", "figcaption", "td"])
                text = self.words(1, 8) if tag[0] == "h" else self.words(2, 60)
                blocks[i] += {"li": f"<ul><li>{text}</li><li>{self.words(1, 60)}</li></ul>",
                              "figcaption": f"<figure><figcaption>{text}</figcaption></figure>",
                              "td": f"<table><tr><td>{text}</td><td>{self.words(1, 60)}</td></tr>"
                                    "</table>"}.get(tag, f"<{tag}>{text}</{tag}>")
            elif rnd.random() < 0.05:
                blocks[i] += self.junk(rnd.choice(
                    ["advert", "social", "notice", "side", "related", "form"]))
        if rnd.random() < 0.15:
            blocks.append(self.junk(rnd.choice(["comment", "social", "related"])))
        body = "".join(blocks)
        shape = rnd.random()
        if shape < 0.25:
            body = f"<article{self.name('content') if rnd.random() < 0.3 else ''} data-y>{body}</article>"
        elif shape < 0.4:
            body = f"<main data-y>{body}</main>"
        elif shape < 0.8:
            body = f"<{(t := rnd.choice(['div', 'div', 'section']))}{self.name('content')} data-y>" \
                   f"{body}</{t}>"
        else:
            body = f"<div{self.plain()} data-y>{body}</div>"
        if rnd.random() < 0.3:
            body = f"<main{self.plain()}>{body}</main>"
        much = rnd.choice([0, 0.3, 0.45, 0.45, 0.6])
        kinds = [k for k in self.KINDS if rnd.random() < much]
        rnd.shuffle(kinds)
        cut = [k for k in kinds if k in ("navigation", "header", "notice", "advert", "hidden", "form")
               or rnd.random() < 0.25 and k != "footer"]
        after = [k for k in kinds if k not in cut]
        if "header" in cut and rnd.random() < 0.7:
            cut.insert(0, cut.pop(cut.index("header")))
        if "footer" in after:
            after.append(after.pop(after.index("footer")))
        parts = [self.junk(k) for k in cut] + [body] + [self.junk(k) for k in after]
        if rnd.random() < 0.5:  # a wrapper around the article and its neighbours
            a = rnd.randint(0, len(cut))
            b = rnd.randint(len(cut) + 1, len(parts))
            parts[a:b] = [f"<div{self.plain()}>{''.join(parts[a:b])}</div>"]
        if not kinds and rnd.random() < 0.3:
            return f"<html data-y>{''.join(blocks)}</html>"
        return f"<html><body>{''.join(parts)}</body></html>"


def _marked(tree: Tree, mark: str) -> list[int]:
    return [i for i, n in enumerate(tree.names) if n.endswith(f" {mark}")]


def examples(pages: list[str], seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of the elements of pages that say where their article is, and of
    pages made of their texts."""
    found: list[tuple[Tree, int]] = []
    for page in pages:
        tree = parse(page)
        if (at := marked_article(tree)) is not None:
            found.append((tree, at))
    cut = [[t[:2000] for o, t in zip(tree.owner, tree.text) if at <= o < tree.end[at]]
           for tree, at in found]
    dresser = Dresser(seed, [t for texts in cut for t in texts[1:4]])
    tags = list(TAG)
    for (tree, at), texts in zip(found, cut):
        yield features([tree]), labels_of(tree, [at])
        kinds = [tags[tree.tag[o]] for o in tree.owner if at <= o < tree.end[at]]
        for _ in range(DRESSES):
            blocks, size = [], 0
            for kind, text in zip(kinds, texts):
                if size <= SAMPLE_CHARS:
                    kind = kind if kind[0] in "hp" and kind != "html" else "p"
                    blocks.append(f"<{kind}>{entities.escape(text)}</{kind}>")
                    size += len(text)
            if dresser.rnd.random() < 0.3:  # short articles, too
                blocks = blocks[:dresser.rnd.randint(1, 3)]
            made = parse(dresser.page(blocks))
            articles, junk = _marked(made, "data-y"), _marked(made, "data-j")
            yield features([made]), labels_of(made, articles, junk)


def learn(pages: DataFrame) -> boosting.Forest:
    """Trees fitted on a bounded sample of pages that say where their article is."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("html").alias("html"))
    marked = rows.where(F.lower("html").rlike("<(article|main)[\\s>]"))
    chosen = smallest_hashes(written(marked.select("page_id"), "marked"), SAMPLE_PAGES, "page_id")
    ids = chosen.distinct()  # at most SAMPLE_PAGES of them
    sample = marked.join(F.broadcast(ids), "page_id").dropDuplicates(["page_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for a, b in text_groups(texts, 2_000_000):
                for x, y in examples(texts[a:b], sum(ids[a:b])):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r.tobytes() for r in x], pa.binary()),
                         pa.array(y.astype(np.int32))], ["x", "y"])

    nodes = written(sample.sortWithinPartitions("page_id").mapInArrow(run, "x binary, y int"),
                    "nodes")
    fit = smallest_hashes(nodes, SAMPLE_NODES, "x", "y").collect()
    if not fit:
        return boosting.Forest([], 0)
    values = np.stack([np.frombuffer(r["x"], np.float32) for r in fit])
    return boosting.fit(values, np.array([r["y"] for r in fit], np.float64))


# --- extraction -------------------------------------------------------------


def extracted(pages: DataFrame, model: boosting.Forest) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, np.ndarray] = {}
        for batch in batches:
            htmls = [h or "" for h in batch.column(2).to_pylist()]
            for a, b in text_groups(htmls, 2_000_000):
                trees = [parse(h) for h in htmls[a:b]]
                log_odds = model.scores(features(trees, cache))
                texts, at = [], 0
                for tree in trees:
                    texts.append(main_text(tree, log_odds[at:at + len(tree)]))
                    at += len(tree)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").alias("url"), F.col("html").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
