"""What a worker holds while languages are identified."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from estate.llm import ppm_language, words

LETTERS = "abcdefghijklmnopqrstuvwxyzéßñ"


def a_text(rng, n):
    return "".join(rng.choice(LETTERS) + (" " if rng.random() < 0.2 else "") for _ in range(n))


@pytest.fixture
def sent(spark, monkeypatch):
    """The function that tasks run and the frame that they read."""
    frames = []

    def caught(self, function, schema):
        frames.append((function, self))
        return self

    docs = spark.createDataFrame([(1, "a", "x")], "doc_id long, text string, lang string")
    monkeypatch.setattr(type(docs), "mapInArrow", caught)
    rng = random.Random(5)
    grams = np.unique(ppm_language._grams(pa.array([a_text(rng, 20_000)]))[0], return_counts=True)
    ppm_language.predict(docs, {"x": ppm_language.Tree.of(*grams), "y": ppm_language.Tree.of(grams[0][::2], grams[1][::2])})
    return frames[0]


def batch_of(sent, texts):
    """The rows as the tasks get them: text under each name that the frame gives it."""
    columns = {"doc_id": pa.array(range(len(texts)), pa.int64()), "lang": pa.array([None] * len(texts), pa.string())}
    return pa.RecordBatch.from_pydict({c: columns.get(c, pa.array(texts, pa.string())) for c in sent[1].columns})


def test_texts_travel_once(sent):
    assert sent[1].columns == ["doc_id", "text", "lang"]


def test_arrays_of_a_batch_are_bounded(sent):
    rng = random.Random(6)
    texts = [a_text(rng, 2000) for _ in range(1500)]
    batch = batch_of(sent, texts)
    list(sent[0](iter([batch])))
    tracemalloc.start()
    rows = sum(out.num_rows for out in sent[0](iter([batch])))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert rows == 1500 and batch.column("text").nbytes > 3 << 20
    assert peak < 32 << 20, peak


def test_models_of_another_operator_go(sent):
    words.worker_model(dict)
    try:
        list(sent[0](iter([])))
        assert not words._model
    finally:
        words._model.clear()


def test_a_score_depends_on_its_own_text_alone(sent):
    rng = random.Random(7)
    texts = ["", *(a_text(rng, n) for n in (40, 1, 700_000, 40)), None, "12", "é", a_text(rng, 300)]

    def scores(chosen):
        batch = batch_of(sent, chosen)
        return [(lang, score) for out in sent[0](iter([batch])) for lang, score in zip(out.column("lang_pred").to_pylist(), out.column("score").to_pylist(), strict=True)]

    assert scores(texts) == [scores([t])[0] for t in texts]
