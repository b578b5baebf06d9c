"""Packing that keeps an order and holds copies apart; the order that the pipeline's mixing stage has written."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from estate.llm import curriculum, slack_packing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def check(found, capacity, copies=True):
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append(r)
    for members in by.values():
        members.sort(key=lambda r: r.offset)
        at = 0
        for r in members:
            assert r.offset == at
            at += r.length
        assert at <= capacity
        if copies:
            assert max(Counter((r.doc_id, r.piece) for r in members).values()) == 1
    assert sorted(by) == list(range(len(by)))
    return by


@pytest.mark.parametrize("windows", [1, 8])
def test_sequences_keep_the_order_and_hold_no_copy_twice(spark, windows):
    rng = random.Random(6)
    docs = [(i, 0, rng.choice([1, 5, 17, 40, 100])) for i in range(300)]
    rows = [(t, *d, 0, 7 * d[0]) for t, d in enumerate(rng.sample(docs * 3, 900))]
    pieces = spark.createDataFrame(rows, "t long, doc_id long, piece int, length long, start long, ids_crc32 long").repartition(3)
    found = slack_packing.pack_in_order(pieces, ["t"], 100, windows).collect()
    assert sorted(r[:6] for r in found) == sorted(rows)
    by = check(found, 100)
    least = -(-sum(r[3] for r in rows) // 100)
    assert len(by) <= least * 1.1 + 3 * windows
    heads = [min(r.t for r in by[s]) for s in sorted(by)]
    assert heads == sorted(heads)
    if windows > 1:
        assert np.corrcoef([r.t for r in found], [r.sequence_id for r in found])[0, 1] > 0.9
    assert slack_packing.pack_in_order(pieces.filter("false"), ["t"], 100).count() == 0


def test_copies_beyond_the_limit_stay_whole(spark):
    pieces = spark.createDataFrame([(t, None, 0, 30, 0, 1) for t in range(50)], "t long, doc_id long, piece int, length long, start long, ids_crc32 long")
    found = slack_packing.pack_in_order(pieces, ["t"], 100, windows=2, copies=4).collect()
    assert len(found) == 50 and len(check(found, 100, copies=False)) >= 17


def test_mixing_decides_the_order_of_sequences(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randint(50, 900))), "en", f"s{i % 3}", 1) for i in range(200)]
    corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, SCHEMA), "").write.parquet(f"{tmp_path}/mixed")
    found = corpus_pipeline.pack_sequences(spark, spark.read.parquet(f"{tmp_path}/mixed"), "").collect()
    assert max(Counter((r.sequence_id, r.doc_id, r.piece) for r in found).values()) == 1
    positions = {}
    for r in curriculum.mix(spark.createDataFrame(rows, SCHEMA)).collect():
        positions.setdefault(r.doc_id, []).append(r.position)
    sequences = {}
    for r in found:
        sequences.setdefault(r.doc_id, []).append(r.sequence_id)
    x = [p for i in sorted(positions) for p in sorted(positions[i])]
    y = [s for i in sorted(positions) for s in sorted(sequences[i])]
    assert len(x) == len(y) and np.corrcoef(x, y)[0, 1] > 0.6
