"""Hard negatives, id planes and fill-in-the-middle against brute force, with the odd rows each must take."""

from __future__ import annotations

import hashlib
import io
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from estate.llm import fill_in_middle as fim
from estate.llm import hard_negatives as hard
from estate.llm import queries, token_planes
from estate.llm.encoder import WordEncoder
from estate.session import new_location
from tests.compare import differences

TOKENIZER = queries.tokenizer_path(queries.PACKING_TOKENIZER)
TEXTS = [
    None, "", " ", "a", "<P>", "x<S>y", "a<M>", "one two  three\n\nfour", "naïve café 😀 é", "<P", "S>", "﻿\x00\x1c", "Ab1c2", "<|endoftext|> x",
    "word " * 3000, "z" * 20_000, "é" * 5000,
]


def docs_of(rows, texts, extra=""):
    return rows([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


# --- fill in the middle ------------------------------------------------------
def middle_by_hand(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def test_fill_in_middle_by_hand(rows):
    data = [(i, t) for i, t in enumerate(TEXTS * 20)] + [(None, "no id"), (None, None), (7, TEXTS[7]), (7, TEXTS[7])]
    made = fim.fill_in_middle(rows(data, "doc_id bigint, text string"))
    found = made.withColumn("restored", fim.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r["doc_id"], *(r[c] for c in ("n", "form", "prefix_chars", "middle_chars", "output", "restored"))) for r in found), key=key) == sorted(
        ((i, *middle_by_hand(i, t)) for i, t in data), key=key
    )
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_fill_in_middle_keeps_other_columns_and_takes_empty_tables(rows):
    made = fim.fill_in_middle(rows([(1, "a b", 5, "x", 7)], "doc_id bigint, text string, n int, _text string, _drawn int"))
    assert made.columns == ["doc_id", "text", "_text", "_drawn", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert made.first()["_text"] == "x" and made.first()["_drawn"] == 7 and made.first()["n"] == 3
    assert fim.fill_in_middle(rows([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_fill_in_middle"])
def test_queries_match_their_sql(spark, sf_dir, con, name):
    assert differences(queries.queries()[name](spark, sf_dir), con, queries.oracle_sql()[name]) == []


# --- id planes ---------------------------------------------------------------
@pytest.mark.parametrize("width", [1, 8])
@pytest.mark.parametrize("ids", [[0], [1], [0, 0, 0], [2**32 - 1, 0, 5], list(range(70_000)), [49_406] * 9])
def test_planes_round_trip(ids, width):
    ids = np.array(ids, np.uint32)
    planes = token_planes.to_planes(ids, width)
    assert len(planes) == -(-int(ids.max()).bit_length() // width)
    assert (token_planes.from_planes(planes, width, len(ids)) == ids).all()


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 16])
def test_file_of_planes_gives_any_stretch(block):
    rng = np.random.default_rng(3)
    sink, ids, total = io.BytesIO(), [], 0
    out = token_planes.PlaneWriter(sink, 1, block)
    for k in range(20):
        lengths = rng.integers(1, 30, 5)
        part = rng.integers(0, 50_000, lengths.sum()).astype(np.uint32)
        out.add(pa.array(range(5 * k, 5 * k + 5)), lengths, part)
        ids.append(part)
        total += len(part)
    out.close()
    whole = np.concatenate(ids)
    file = token_planes.PlaneFile(pa.BufferReader(sink.getvalue()))
    assert sum(file.documents(k).num_rows for k in range(len(file.index))) == 100
    for a, b in [(0, total), (0, 0), (total, total), (5, 6), (total - 3, total), *rng.integers(0, total, (30, 2)).tolist()]:
        assert (file.ids(min(a, b), max(a, b)) == whole[min(a, b) : max(a, b)]).all()
    with pytest.raises(ValueError):
        token_planes.PlaneFile(pa.BufferReader(b"x" * 40))


@pytest.mark.parametrize("block", [5, 1 << 16])
def test_written_ids_are_read_back(spark, rows, block):
    from tokenizers import Tokenizer

    data = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (4, "again"), (4, "again"), (4, "other")] + [(1000 + i, f"row {i}") for i in range(300)]
    location = new_location(spark, "ids")
    index = token_planes.write_ids(rows(data, "doc_id bigint, text string").repartition(3), TOKENIZER, location, block=block)
    found = token_planes.read_ids(spark, location).orderBy("start").collect()
    encode = Tokenizer.from_file(TOKENIZER).encode
    expected = sorted(((-1 if i is None else i, [*encode(t or "", add_special_tokens=False).ids, 2]) for i, t in data), key=str)
    assert sorted(((-1 if r["doc_id"] is None else r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in found), key=str) == expected
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert keys == sorted(keys)
    at = 0
    for r in found:
        assert r["start"] == at and r["n_tokens"] * 4 == len(r["ids"])
        at += r["n_tokens"]
    assert index.agg(F.sum("ids"), F.sum("documents")).first() == (at, len(data))


def test_id_planes_of_an_empty_table_and_of_string_ids(spark, rows):
    location = new_location(spark, "ids")
    token_planes.write_ids(rows([], "doc_id bigint, text string"), TOKENIZER, location)
    assert token_planes.read_ids(spark, location).count() == 0
    location = new_location(spark, "ids")
    token_planes.write_ids(rows([("b", "x", 1), ("a", "y", 2)], "doc_id string, text string, _text int"), TOKENIZER, location)
    assert [r["doc_id"] for r in token_planes.read_ids(spark, location).orderBy("start").collect()] == ["a", "b"]


def test_op12_against_the_tokenizer(spark, sf_dir):
    from tokenizers import Tokenizer

    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    tokenizer, at, expected = Tokenizer.from_file(TOKENIZER), 0, []
    for r in texts:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        expected.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    found = queries.op12_token_planes(spark, sf_dir).orderBy("start").collect()
    assert [tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in found] == expected


def test_words_are_encoded_as_whole_texts_are():
    rng = np.random.default_rng(1)
    parts = ["a", "B", "é", "é", " ", "\t", "\n", " ", "　", "<|endoftext|>", "<|startoftext|>", "1", "'s", "…", "😀", "́", "Σ", "ß", "İ", "!", "\x1c", "​", "가"]
    texts = ["".join(parts[i] for i in rng.integers(0, len(parts), rng.integers(0, 30))) for _ in range(2000)]
    encoder = WordEncoder(TOKENIZER)
    ids, bounds = encoder.ids(pa.array(texts))
    for k, whole in enumerate(encoder.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == whole.ids


# --- hard negatives ----------------------------------------------------------
def test_intervals_hold_every_product():
    rng = np.random.default_rng(5)
    for width in (1, 3, 64, 70, 200):
        rows = rng.integers(-300, 300, (400, width))
        rows[0] = 0
        anchors = rows[rng.integers(0, 400, 30)]
        code, norm, align = hard.encode(rows)
        block = hard.Anchors(np.arange(30), np.arange(30), np.zeros(30, int), anchors)
        low, high = block.interval(code, norm, align, slice(0, 30))
        exact = rows @ anchors.T
        assert (low <= exact).all() and (exact <= high).all()
        assert (high - low).mean() < 2 * np.abs(norm[:, None] * np.sqrt(block.square)).mean()  # it tells more than the norms do
        i, j = np.nonzero(exact >= 0)
        assert (hard._scores(rows, anchors, i, j) == exact[i, j]).all()
        assert (hard._scores(rows, anchors, i[:5], j[:5]) == exact[i[:5], j[:5]]).all()


def mined_by_hand(data, anchor):
    usable = []
    for i, vector, label in data:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            usable.append((i, [math.floor(256 * x) for x in vector], label))
    found = []
    for i, v, label in usable:
        if not anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), o is None, o or 0, o, other) for o, w, other in usable if len(w) == len(v)]
        scored.sort(key=lambda s: s[:3])
        for p in [s for s in scored if s[4] == label and s[3] != i][:5]:
            inside = [s for s in scored if s[4] != label and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]]
            found += [(i, p[3], k + 1, s[3], -p[0], -s[0]) for k, s in enumerate(inside[:10])]
    return sorted(found, key=str)


@pytest.mark.parametrize("block_bytes", [1, 8 * 4 * 3, 8 << 20])
def test_hard_negatives_by_hand(rows, block_bytes):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((4, 6))
    data = [(i, (centres[i % 4] + rng.standard_normal(6) * 0.4).tolist(), int(rng.integers(0, 3))) for i in range(150)]
    data += [(200, None, 1), (300, [1.0] * 6, None), (400, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (500, [float("nan")] + [1.0] * 5, 1), (600, [0.0] * 6, 1)]
    data += [(None, data[5][1], 0), (None, data[6][1], 1), (700, data[0][1], data[0][2]), (700, data[0][1], data[0][2]), (701, data[3][1], 2), (702, data[3][1], 2)]
    data += [(800, [1.0, 2.0], 0), (801, [1.0, 2.0], 0), (802, [1.0, 1.0], 1), (900, [], 0), (901, [], 1), (902, [], 0)]
    table = rows(data, "vec_id bigint, embedding array<double>, label int").withColumn("id", F.lit("x")).withColumn("score", F.lit(1))
    found = hard.mine_negatives(table, F.col("vec_id") % 50 == 0, block_bytes=block_bytes).collect()
    assert sorted((tuple(r) for r in found), key=str) == mined_by_hand(data, lambda i: i is not None and i % 50 == 0)


def test_hard_negatives_without_anchors_or_rows(rows):
    schema = "vec_id bigint, embedding array<float>, label int"
    assert hard.mine_negatives(rows([], schema), F.col("vec_id") % 2 == 0).count() == 0
    assert hard.mine_negatives(rows([(1, [1.0], 1)], schema), F.col("vec_id") % 2 == 0).count() == 0
    assert hard.mine_negatives(rows([(2, [1.0], 1), (3, [1.0], 2)], schema), F.col("vec_id") % 2 == 0).count() == 0
