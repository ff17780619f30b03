"""What the tasks of a text operator hold, whatever the number of texts in an Arrow batch."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from ledgerlake.llm import bpe, ngram_join, packing, registry, toxicity
from ledgerlake.llm.common import text_parts

PATH = registry.word_vocabulary()
TEXTS, WORDS = 40, 10_000  # 60 characters a word: 24 MB in all


class Task:
    """Stands for a table; keeps the function that an operator maps over its batches."""

    columns = ["doc_id", "text"]
    schema = property(lambda self: self)

    def select(self, *_):
        return self

    def add(self, *_):
        return self

    def mapInArrow(self, run, _):
        self.run = run
        return self


OPERATORS = {
    "pieces": lambda t: packing.pieces(t, PATH),
    "digests": lambda t: bpe.digests(t, PATH, ["doc_id"]),
    "sketches": lambda t: ngram_join.sketches(t, 3, 2, 2),
    "scored": lambda t: toxicity.scored(t, toxicity.never(), ["doc_id"]),
    "clean_only": lambda t: toxicity.clean_only(t, toxicity.never()),
}


def test_parts_are_the_column():
    texts = ["ab", None, "", "x" * 50, "é", "y" * 7, None]
    for column in (pa.array(texts), pa.array(["z", *texts]).slice(1),
                   pa.array(texts, pa.large_string()), pa.array([], pa.string())):
        for most in (1, 5, 10, 1000):
            parts = list(text_parts(column, most))
            assert [t for _, part in parts for t in part] == [t.as_py() or "" for t in column]
            assert [a for a, _ in parts] == np.cumsum([0, *(len(p) for _, p in parts)])[:-1].tolist()
            assert all(len(p) == 1 or sum(len(t.encode()) for t in p) <= most for _, p in parts)


@pytest.mark.parametrize("name", OPERATORS)
def test_a_batch_is_never_whole_in_python(spark, name):
    words = [f"{i:03d}{'abcdefghijklmnopqrs' * 3}" for i in range(200)]
    text = " ".join(words * (WORDS // 200))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(TEXTS)), "text": [text] * TEXTS})
    task = OPERATORS[name](Task())
    rows = sum(b.num_rows for b in task.run(iter([batch.slice(0, 1)])))  # imports, vocabulary
    tracemalloc.start()
    try:
        got = sum(b.num_rows for b in task.run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == TEXTS * rows
    assert peak < 0.8 * TEXTS * len(text)


def test_the_pipeline_remembers_fewer_words(spark, monkeypatch):
    """Four workers' tables of about 250 bytes a word stay under a twentieth of 3 GB."""
    limits = []
    monkeypatch.setattr(packing, "written", lambda made, _: made)
    monkeypatch.setattr(packing, "pack", lambda made, _: made)
    monkeypatch.setattr(packing, "text_encoder", lambda path, limit=bpe.PACKING_WORDS: (
        limits.append(limit), bpe.text_encoder(path, limit))[1])
    task = corpus_pipeline.packing_stage(spark, Task(), "")
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["two words"]})
    assert sum(b.num_rows for b in task.run(iter([batch]))) == 1
    assert len(limits) == 1 and 4 * 250 * limits[0] <= 150e6


def test_kernel_works_on_few_pairs_at_a_time():
    """Features of many words: the temporary arrays don't grow with the words."""
    marks = toxicity.Landmarks([f"land{c}mark" for c in "abcdefgh"])
    words = [f"lan{i:05d}mark" for i in range(40_000)]
    marks.features(words[:10])
    tracemalloc.start()
    try:
        got = marks.features(words)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    some = slice(19_990, 20_010)
    assert np.allclose(got[some], marks.features(words[some]), atol=1e-6)
    assert peak < 20e6
