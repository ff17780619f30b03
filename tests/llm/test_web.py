"""WARC archives, URL rules, quotation links and the pipeline against brute force."""

import gzip
import hashlib
import random
from collections import Counter

import pytest
from llm_fixtures import SF, odd_rows

import corpus_pipeline
from ledgerlake.llm import quotation, registry, url_rules, warc
from ledgerlake.llm.common import scratch_path

PAGES = "page_id long, url string, html string, kind string, digest string"


# --- WARC ------------------------------------------------------------------------


def _archive(spark, rows, **options):
    df = spark.createDataFrame(rows, PAGES)
    path = scratch_path(spark, "warc")
    warc.write_archives(df, path, **options)
    return path


def _want(rows):
    first = {}
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        if len(body) >= 100 and i is not None:
            first[body] = min(first.get(body, i), i)
    out = Counter()
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        origin = first.get(body)
        origin = origin if i is not None and origin != i else None
        out[i, len(body), hashlib.sha256(body).hexdigest(),
            "response" if origin is None else "revisit", origin] += 1
    return out


WEB = [
    (1, "http://a.example.org/x?y=1#z", "<p>" + "é" * 100 + "\r\n\r\nWARC/1.1\r\n</p>", "k", "d"),
    (2, "http://b.example.org/", "<p>" + "é" * 100 + "\r\n\r\nWARC/1.1\r\n</p>", "k", "d"),
    (3, None, "short", "k", "d"), (4, "no scheme\r\nX: 1", "short", "k", "d"), (5, "", None, "k", "d"),
    (6, "http://c/", "", "k", "d"), (7, "http://c/", "z" * 300_000, "k", "d"),
    (8, "http://c/", "z" * 300_000, "k", "d"), (8, "http://c/", "z" * 300_000, "k", "d"),
    (7, "http://c/", "z" * 300_000, "k", "d"), (None, "http://n/", "n" * 200, "k", "d"),
    (9, "http://c/", "page-id: 77\r\n" * 20, None, None),
]


def test_round_trip(spark):
    path = _archive(spark, WEB, records_per_file=7)
    got = warc.digest_rows(warc.transactions(warc.read_records(spark, path, payloads=False)))
    assert Counter(map(tuple, got.collect())) == _want(WEB)
    full = warc.transactions(warc.read_records(spark, path)).collect()
    texts = {i: h for i, _, h, *_ in WEB}
    for r in full:
        if r["response"]["kind"] == "response":
            assert r["response"]["payload"] == (texts[r["metadata"]["page_id"]] or "")
        assert r["request"]["block"].startswith("GET ")


def test_records_are_linked_and_gzip_readable(spark):
    path = _archive(spark, WEB[:3]).removeprefix("file:")
    import glob
    data = b"".join(gzip.open(f).read() for f in sorted(glob.glob(f"{path}/part*")))
    records = list(warc.parse(data))
    assert Counter(h["warc-type"] for h, _ in records) == {
        "request": 3, "response": 2, "revisit": 1, "metadata": 3}
    main = {h["warc-record-id"] for h, _ in records if h["warc-type"] in ("response", "revisit")}
    assert {h["warc-concurrent-to"] for h, _ in records if "warc-concurrent-to" in h} == main
    # members of their own, or none at all, read the same
    assert warc.unpack(gzip.compress(b"a") + gzip.compress(b"b")) == b"ab"
    assert warc.unpack(b"plain") == b"plain"
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1 broken"))


def test_no_pages(spark):
    path = _archive(spark, [])
    assert warc.transactions(warc.read_records(spark, path)).count() == 0


# --- URL rules ----------------------------------------------------------------------


def _judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:n], rest[n:]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        path = path[:min([path.index(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[3:] if fits else (None, default))


RULES = [*registry.URL_RULES, ("example.org", "/en/12", "allow"), ("b.example.org", "/", "block"),
         ("a.b.example.org", "/x", "allow"), ("com", "/fr/", "block"), ("net", "/", "block")]


def test_rules_equal_brute_force(spark):
    rnd = random.Random(6)
    urls = [None, "", "nothing", "://", "http://", "http://org", "http://org/", "http://xorg/",
            "HTTP://A.EXAMPLE.ORG/es/1?q", "http://ÀB.org/en", "ftp://a,b.com/fr/", "http://com/",
            "http://.org/", "http://org./", "http://a.org?x/y", "x://y://z.org/", "http://a.b\n.org/q",
            "http://example.org/" + "long/" * 5000]
    for _ in range(1500):
        host = ".".join(rnd.choice(["a", "b", "example", "org", "com", "net", "xorg"])
                        for _ in range(rnd.randint(1, 4)))
        urls.append(f"http://{host}" + rnd.choice(["", "/", "/es/", "/en/1", "/en/123", "/fr/", "/de/x",
                                                    "/x", "/es?", "#/es/"]))
    urls += ["http://hot.example.org/es/"] * 600
    pages = spark.createDataFrame([(i % 1900, u, "h") for i, u in enumerate(urls)]
                                  + [(None, urls[20], "h")], "page_id long, url string, verdict string")
    rules = spark.createDataFrame(RULES + [(None, "/", "block"), ("", "/", "block"), ("q", None, "allow")],
                                  "host string, path string, verdict string")
    want = Counter((i % 1900, *_judge(u, RULES)) for i, u in enumerate(urls))
    want[(None, *_judge(urls[20], RULES))] += 1
    for ranges in (1, 8, 40):
        got = url_rules.judge(pages, rules, ranges=ranges).collect()
        assert Counter(map(tuple, got)) == want
    assert url_rules.judge(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_rules.judge(pages, rules.limit(0), "block").collect()} == {"block"}


# --- quotations -------------------------------------------------------------------------


def _threads(messages):
    """Links and places by comparing every quote with every earlier message."""
    parsed = {(c, t): quotation.parse(x or "") for c, t, _, x in messages}
    reply = {}
    for (c, t), (_, _, quotes, _, _) in parsed.items():
        votes = Counter()
        for level, h, size in quotes:
            holders = [u for (d, u), p in parsed.items() if d == c and h in p[1]]
            if holders and min(holders) < t:
                votes[level, min(holders)] += size
        if votes:
            low = min(level for level, _ in votes)
            reply[c, t] = max((n, u) for (level, u), n in votes.items() if level == low)[1]
    place = {}
    for c, t in parsed:
        depth, at = 0, t
        while (c, at) in reply:
            at, depth = reply[c, at], depth + 1
        place[c, t] = (reply.get((c, t)), at, depth)
    return place


def test_threads_equal_brute_force(spark):
    rnd = random.Random(8)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = []
    for c in range(12):
        said = []
        for t in range(rnd.randint(1, 14)):
            lines = []
            if said and rnd.random() < 0.8:
                level, pick = 1, said[:]
                while pick and level < 4:
                    quoted = rnd.choice(pick)
                    lines += ["> " * level + q.upper() for q in quoted[:rnd.randint(1, len(quoted))]]
                    level += 1
                    if rnd.random() < 0.6:
                        break
            own = [" ".join(rnd.choice(words) for _ in range(rnd.randint(2, 5))) for _ in range(2)]
            said.append(own)
            rows.append((c, t, "user", "\n".join(lines + own)))
    # a passage that very many messages quote, and a reply chain of some depth
    rows += [(50, 0, "user", "a common line"), *[(50, t, "user", f"> a common line\nme {t}")
                                                 for t in range(1, 200)]]
    rows += [(51, 0, "user", "step 0"), *[(51, t, "user", f"> step {t - 1}\nstep {t}")
                                          for t in range(1, 30)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quotation.link_quotations(df).collect()
    assert len(got) == len(rows)
    want = _threads(rows)
    for r in got:
        assert (r["reply_to"], r["root_turn"], r["reply_depth"]) == want[r["conv_id"], r["turn"]]
        assert not any(x.startswith(">") for x in r["text"].split("\n"))
    order = [(r["conv_id"], r["turn"]) for r in quotation.ordered(quotation.link_quotations(df)).collect()]
    for i, at in enumerate(order):  # answers come after what they answer
        if want[at][0] is not None:
            assert order.index((at[0], want[at][0])) < i


def _reply_order(rows):
    """Position of each (conversation, turn) by walking every thread from its first message."""
    want, reply = {}, {at: up for at, (up, _, _) in _threads(rows).items()}
    for c in {c for c, *_ in rows}:
        answers = {}
        for (d, t), up in sorted(reply.items()):
            if d == c:
                answers.setdefault(up, []).append(t)
        todo = answers[None][::-1]
        while todo:
            t = todo.pop()
            want[c, t] = sum(d == c for d, _ in want) + 1
            todo += answers.get(t, [])[::-1]
    return want


def test_positions_equal_a_walk(spark):
    rnd = random.Random(3)
    rows = [(1, 1, "u", "m1"), (1, 2, "u", "> m1\nm2"), (1, 3, "u", "> m1\nm3"),
            (1, 4, "u", "> m2\nm4"), (1, 5, "u", "> m3\nm5")]
    for c in range(2, 8):  # trees of any shape, some messages begin threads of their own
        for t in range(rnd.randint(1, 60)):
            up = rnd.randrange(t) if t and rnd.random() < 0.85 else None
            rows.append((c, t, "u", (f"> line {up}\n" if up is not None else "") + f"line {t}"))
    rows += [(9, 0, "u", "line 0"), *[(9, t, "u", f"> line {t - 1}\nline {t}") for t in range(1, 40)]]
    rows += [(10, 0, "u", "line 0"), *[  # a third of all rows answer one message
        (10, t, "u", f"> line 0\nline {t}") for t in range(1, len(rows) // 2)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): r["position"] for r in quotation.link_quotations(df).collect()}
    assert got == _reply_order(rows)
    assert [got[1, t] for t in (1, 2, 4, 3, 5)] == [1, 2, 3, 4, 5]


def test_odd_messages(spark):
    rows = [(1, 0, "u", None), (1, 1, None, ""), (None, 1, "u", "> x"), (1, None, "u", "> x"),
            (1, 2, "u", "> > >"), (1, 3, "u", "same"), (1, 3, "u", "same"), (1, 4, "u", "> same\nyes"),
            (1, 4, "u", "other row"), (1, 5, "u", "> yes\n" + "long " * 50_000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, "
                               "text string, root_turn int, own string")
    got = quotation.link_quotations(df).collect()
    assert len(got) == len(rows)
    at = {(r["conv_id"], r["turn"]): (r["reply_to"], r["root_turn"], r["reply_depth"]) for r in got}
    places = {(r["conv_id"], r["turn"]): r["position"] for r in got}
    assert places == {(1, 0): 1, (1, 1): 2, (1, 2): 3, (1, 3): 4, (1, 4): 5, (1, 5): 6,
                      (None, 1): None, (1, None): None}
    assert at[1, 4] == (3, 3, 1) and at[1, 5] == (4, 3, 2) and at[1, 0] == (None, 0, 0)
    assert quotation.link_quotations(df.limit(0)).count() == 0


def test_attribution_lines_go_with_the_quote():
    clean, own, quotes, level, n = quotation.parse("On Monday Ann wrote:\n> hi there\n>> deeper\nfine")
    assert (clean, len(own), level, n) == ("fine", 1, 2, 2)
    assert [q[0] for q in quotes] == [1, 2]


# --- oracle SQL ------------------------------------------------------------------------------


@pytest.mark.parametrize("key", sorted(registry.ORACLE_SQL))
def test_queries_equal_their_sql(spark, key):
    import duckdb

    con = duckdb.connect()
    for table in ("pages", "documents", "conversations", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(registry.ORACLE_SQL[key])
    names = [c[0] for c in want.description]
    got = registry.QUERIES[key](spark, SF).select(names)
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())


# --- the pipeline --------------------------------------------------------------------------


def test_stages_keep_their_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "toxicity", "n-gram Jaccard join", "best-fit packing"]
    kept = {r["doc_id"] for r in docs.collect()}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs_next = stage(spark, docs, SF)
        assert docs_next.schema == docs.schema
        path = scratch_path(spark, "stage")
        docs_next.write.parquet(path)
        docs = spark.read.parquet(path)
        ids = {r["doc_id"] for r in docs.collect()}
        assert ids < kept if i != 1 else ids <= kept
        kept = ids
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in rows} == kept
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()} == kept


def test_stages_take_odd_rows(spark, odd, empty):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns
        assert stage(spark, empty, SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, odd, SF).where("piece = 0").count() == len(odd_rows())
