"""The whole pipeline against a version that works text by text."""

import re
import zlib

import numpy as np
import tokenizers
from llm_fixtures import SF
from test_filters import _brute, _counts

import corpus_pipeline
from ledgerlake.llm import quality, registry, toxicity
from ledgerlake.llm.common import WORD


def _statistics(text):
    """All counts that rules may use, by name."""
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = _counts(text)
    words = re.findall(WORD, text)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words,
        "n_lines": len([x for x in text.split("\n") if re.search(WORD, x)]),
        "n_short_words": sum(len(w) <= 3 for w in words),
        "n_distinct_words": len(set(words)), "n_digits": len(re.findall("[0-9]", text)),
    }


def _rejected(text, rules):
    counts = _statistics(text)
    if counts["n_words"] < 20 or 100 * counts["n_repeat_words"] > 30 * counts["n_words"]:
        return True
    for rule in rules.rules:
        if all((eval(quality.RATIOS[c.statistic], {}, counts) > c.threshold) == c.above
               for c in rule):
            return True
    return False


def test_run_equals_text_by_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    rules = quality.learn_from(docs, labels)
    texts = {i: t for i, t in texts.items() if not _rejected(t, rules)}
    left = docs.where(docs["doc_id"].isin(list(texts)))
    model = toxicity.learn(left, labels)
    ids = sorted(texts)
    score = model.score(model.decide([texts[i] for i in ids], model.reader()))
    texts = {i: texts[i] for i, s in zip(ids, score) if s < 0.5}
    classes = _brute(list(texts.items()))
    texts = {i: t for i, t in texts.items() if classes[i][0] == i}

    library = tokenizers.Tokenizer.from_file(registry.word_vocabulary())
    want = set()
    for i, t in texts.items():
        tokens = np.array(library.encode(t, add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(tokens), 2048):
            part = tokens[k:k + 2048]
            want.add((i, k // 2048, k, len(part), zlib.crc32(part.tobytes())))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {tuple(r)[:5] for r in rows} == want and len(rows) == len(want)
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048
