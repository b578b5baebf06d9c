"""Every operator against brute force, the library it stands for, an exact round trip or held-out labels."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from estate.llm import (
    chat_format,
    curriculum,
    fm_index,
    int8_neighbours,
    ppm_language,
    prefix_tokens,
    queries,
    robust_quality,
    slack_packing,
    substring_dedup,
    superminhash,
    toxicity,
)
from estate.llm.graph import components
from tests.compare import differences
from tests.llm import brute

ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "A b", "a  b\tc\x0bd\r\n e ", "x" * 5000, "é　ß ﬁ  á", "<|im_end|> & &lt;| <|x", "0 1 2 !? ...",
    "日本語のテキスト。", "<|endoftext|>a b<|startoftext|>", "it's YOU'LL don't", " ▁▁ a▁b  ", "same line\nsame line\n same line", "one two three " * 40,
]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    """The documents with odd texts, copies, shared passages and a column whose name clashes."""
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rng, top = random.Random(3), max(r[0] for r in rows) + 1
    long = [r[1] for r in rows if len(r[1]) > 1500][:6]
    extra = list(ODD_TEXTS)
    for text in long:
        w = text.split()
        extra += [text, " ".join(w[:100] + ["changed"] + w[100:]), " ".join(w[30:75]), " ".join(rng.sample(w, 40) + w[50:90])]
        extra += [" ".join(x if rng.random() > 0.03 else x + "s" for x in w) for _ in range(4)]
    rows += [(top + k, t, [None, "en", "de"][k % 3], [None, "src0", "own"][k % 3]) for k, t in enumerate(extra)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, con, key):
    assert differences(queries.queries()[key](spark, sf_dir), con, queries.oracle_sql()[key]) == []


# chat formatting


def chats(spark, turns):
    return chat_format.format_chats(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, formatted int"))


def test_chat_round_trip_and_mask(spark):
    odd = [t for t in ODD_TEXTS if t] + ["<", "|", "&lt;|", "&amp;lt;", "<|im_end|>\n<|im_start|>user\nhi", "a\n\n", "&nl;"]
    turns = [(k, j, ["user", "assistant"][j % 2], t, 7) for k in range(3) for j, t in enumerate(odd)]
    out = chats(spark, turns).select("*", chat_format.read_back("formatted").alias("back"), chat_format.learned_text(queries.F.col("segments")).alias("learned"))
    for r in out.collect():
        mine = [(role, t) for k, _, role, t, _ in turns if k == r.conv_id]
        assert [(x.role, x.text) for x in r.back] == mine
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.learned == "".join(t for role, t in mine if role == "assistant")
        assert r.n_turns == len(mine) and r.valid


def test_chat_machine_nulls_and_ties(spark):
    turns = [
        (1, 0, "user", None, 1), (1, 1, "assistant", "a", 1), (2, 0, "assistant", "a", 1), (3, 0, "system", "s", 1), (3, 1, "system", "s", 1),
        (4, None, None, "x", 1), (5, 0, "user", "b", 1), (5, 0, "user", "a", 1), (None, 0, "user", "n", 1), (6, 0, "system", "s", 1),
        (7, 0, "odd\nrole<|", "t", 1),
    ]
    out = {r.conv_id: r for r in chats(spark, turns).select("*", chat_format.read_back("formatted").alias("back")).collect()}
    assert {k: r.valid for k, r in out.items()} == {1: True, 2: False, 3: False, 4: False, 5: False, None: True, 6: False, 7: False}
    assert [x.text for x in out[5].back] == ["a", "b"] and out[4].back[0].role == "" and out[1].back[0].text == ""
    assert out[7].back[0].role == "odd\nrole<|"
    assert chats(spark, turns).filter("false").count() == 0
    assert chats(spark, []).count() == 0


# quality rules


def test_statistics_match_brute_force(docs, texts):
    found = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in robust_quality.text_statistics(docs).collect()}
    assert found == {i: brute.statistics(t) for i, t in texts}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té#", max_size=40), max_size=6))
def test_statistics_of_any_text(texts):
    found = np.array(robust_quality._counts(pa.array(texts, pa.string()))).T if texts else np.zeros((0, 5))
    assert [tuple(r) for r in found] == [brute.statistics(t) for t in texts]


def test_quality_rejects_outliers_and_keeps_the_rest(spark):
    rng = random.Random(5)
    syllables = ["ba", "lo", "ri", "ten", "mu", "sa", "ve", "ki"]
    sentence = lambda n: " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))
    rows = [(k, sentence(rng.randint(60, 900)), ["en", None][k % 2], ["s", "t"][k % 4 // 2]) for k in range(800)]
    rows += [(1000 + k, " ".join(w + "$$$" for w in sentence(200).split()), "en", "s") for k in range(30)]
    rows += [(1100 + k, sentence(150) + " " + "x" * 6000, "en", "t") for k in range(5)]
    rows += [(1200, None, None, None), (1201, "short", "en", "s"), (1202, "go " * 300, "en", "s"), (1203, sentence(200), "xx", "rare")]
    out = {r.doc_id: r for r in robust_quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert len(out) == len(rows)
    assert sum(not out[k].kept for k in range(800)) <= 2
    assert not any(out[k].kept for k in [*range(1000, 1030), *range(1100, 1105), 1200, 1201, 1202])
    assert out[1200].base_failed and out[1202].base_failed and not out[1000].base_failed
    assert out[1203].kept and out[1203].distance is None


def test_quality_estimate_is_a_minimum_covariance_determinant(spark):
    """Against an exhaustive-style search in numpy: the same half of the rows, up to ties."""
    rng = np.random.default_rng(1)
    clean = rng.normal(size=(300, 4)) * [1, 2, 1.5, 0.5] + [5, 0, 1, 0]
    x = np.vstack([clean, rng.normal(size=(60, 4)) * 0.1 + [20, 20, 0, 5]])
    df = spark.createDataFrame([("g", *map(float, r)) for r in x], "_group string, _x0 double, _x1 double, _x2 double, _x3 double")
    got = robust_quality._fit(df).first()
    floor = np.diag(np.square(robust_quality.FLOORS))
    best = None
    for seed in range(40):
        pick = np.random.default_rng(seed).choice(len(x), 10, replace=False)
        centre, cov = x[pick].mean(0), np.cov(x[pick].T) + floor
        for _ in range(30):
            d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
            near = np.argsort(d)[: len(x) // 2]
            centre, cov = x[near].mean(0), np.cov(x[near].T, bias=True) + floor
        det = np.linalg.slogdet(cov)[1]
        if best is None or det < best[0]:
            best = det, centre
    assert np.abs(np.array(got._centre) - best[1]).max() < 0.5
    d = np.einsum("ij,jk,ik->i", x - got._centre, np.reshape(got._inverse, (4, 4)), x - got._centre)
    assert d[:300].max() < d[300:].min()


def test_chi_square_quantile():
    assert abs(robust_quality.chi_square_quantile(0.975) - 11.1433) < 1e-3 and abs(robust_quality.chi_square_quantile(0.9999) - 23.5127) < 1e-2


# language


def test_language_code_lengths_match_a_plain_model():
    texts = pa.array(["abracadabra", "cadabra abc"])
    grams, _ = ppm_language._grams(texts)
    tree = ppm_language.Tree.of(*(np.asarray(x) for x in np.unique(grams, return_counts=True)))
    seen = defaultdict(lambda: defaultdict(int))
    for t in texts.to_pylist():
        b = b" " * ppm_language.ORDER + t.encode()
        for k in range(ppm_language.ORDER, len(b)):
            for order in range(ppm_language.ORDER + 1):
                seen[b[k - order : k]][b[k]] += 1

    def bits(context, byte):
        for order in range(len(context), -1, -1):
            counts = seen.get(context[len(context) - order :])
            if counts is None:
                continue
            total, distinct = sum(counts.values()), len(counts)
            if byte in counts:
                return np.log2((total + distinct) / counts[byte])
            return np.log2((total + distinct) / distinct) + (bits(context[len(context) - order + 1 :], byte) if order else 8.0)
        return 8.0

    for text in ("abra", "zebra cad", "é", "q"):
        b = b"   " + text.encode()
        want = [bits(b[k - 3 : k], b[k]) for k in range(3, len(b))]
        assert np.allclose(tree.bits(ppm_language._grams(pa.array([text]))[0]), want)


def test_language_held_out_accuracy_and_odd_texts(docs, texts, empty):
    out = {r.doc_id: r for r in ppm_language.identify(docs.withColumn("score", queries.F.lit("x"))).select("doc_id", "lang", "lang_pred", "score", ppm_language.held_out().alias("h")).collect()}
    text = dict(texts)
    assert len(out) == len(texts)
    assert all(r.h == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in out.items())
    for i, r in out.items():
        if text[i] is None or not any(map(str.isalpha, text[i])):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    mine = [r for i, r in out.items() if r.h and i < 200 and len(text[i].split()) > 3]
    assert np.mean([r.lang == r.lang_pred for r in mine]) > 0.95
    assert ppm_language.identify(empty).count() == 0
    assert {r.lang_pred for r in ppm_language.predict(docs, {}).collect()} == {"und"}


# substring dedup


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=4, max_size=12), min_size=1, max_size=6))
def test_fm_index_matching_windows(sequences):
    window = 4
    text = np.array([x for s in sequences for x in (*s, 0)], np.int64)
    length = np.array([len(s) for s in sequences])
    start = np.cumsum(length + 1) - length - 1
    index = fm_index.FMIndex(text, window)
    at, interval = index.matching_windows(text, start, length)
    assert sorted(at) == [a + k for a, n in zip(start, length) for k in range(n - window + 1)]
    for p, g in zip(at, interval):
        rows = index.rows[index.window_start[g] : index.window_start[g + 1]]
        assert sorted(rows) == [k for k in range(len(text) - window + 1) if (text[k : k + window] == text[p : p + window]).all()]


def dedup(df, **options):
    out = substring_dedup.remove_repeats(df, **options).collect()
    return {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in out}


def test_repeats_match_brute_force(docs, texts, empty):
    assert dedup(docs.withColumn("n_words", queries.F.lit("clash"))) == brute.repeats(texts)
    assert substring_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_repeats_of_few_words(spark, seed):
    """Runs, overlaps and near misses: three words make nearly every window repeat somewhere."""
    rng = random.Random(seed)
    rows = [(k, " ".join(rng.choices("abc" if k % 3 else "a", k=rng.choice([3, 6, 9, 40])))) for k in range(60)]
    rows += [(100, " ".join(["For"] * 300)), (101, None), (102, " ".join(["For"] * 7))]
    assert dedup(spark.createDataFrame(rows, "doc_id long, text string"), window=6, anchor=3) == brute.repeats(rows, 6)


def test_repeated_rows_stay_together(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text), (1, text), (2, text), (None, text)]
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 9, r.n_removed) for r in out) == [(1, 0), (1, 0), (2, 30), (9, 30)]


# packing


def test_token_pieces_and_packing(docs, texts, empty):
    from tokenizers import Tokenizer

    path, capacity = queries.tokenizer_path(queries.PACKING_TOKENIZER), 512
    tokenizer = Tokenizer.from_file(path)
    rows = slack_packing.pack_documents(docs, path, capacity).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == {i for i, _ in texts}
    for i, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // capacity)))
        for r in pieces:
            mine = ids[r.start : r.start + r.length]
            assert (r.start, r.length) == (r.piece * capacity, len(mine)) and r.ids_crc32 == zlib.crc32(np.array(mine, "<u4").tobytes())
    for mine in by_sequence.values():
        end = 0
        for r in sorted(mine, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= capacity
    assert len(by_sequence) <= -(-sum(r.length for r in rows) // capacity) * 1.02 + 1
    assert slack_packing.pack_documents(empty, path).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 30), max_size=25))
def test_patterns_use_every_piece_once(counts):
    patterns = slack_packing.slack_patterns(counts, 40)
    used = defaultdict(int)
    for chosen, times in patterns:
        assert sum(chosen) <= 40 and times > 0
        for x in chosen:
            used[x] += times
    assert used == {k: n for k, n in counts.items() if n}


# embeddings


def test_neighbours_match_brute_force(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(int8_neighbours, "TILE", 60)
    monkeypatch.setattr(int8_neighbours, "HELD", 100)
    rng = np.random.default_rng(2)
    base = [list(map(float, r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").limit(150).collect()]
    rows = [(k, v) for k, v in enumerate(base)]
    for k in range(120):
        x = np.array(base[k % 7]) + rng.normal(size=64) * [0.005, 0.05, 0.07][k % 3]
        rows.append((200 + k, x.tolist()))
    rows += [(400 + k, base[3]) for k in range(30)] + [(450, (np.array(base[3]) * 3).tolist()), (451, (-np.array(base[3])).tolist())]
    rows += [(500, None), (501, [0.0] * 64), (502, [float("nan")] * 64), (503, [float("inf")] + [1.0] * 63), (504, [None] + [1.0] * 63), (505, [1.0, 2.0]), (506, [2.0, 4.0]), (507, [])]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in int8_neighbours.neighbours(df).collect()}
    usable = {i: np.array(v, np.float32).astype(float) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [
        (a, b) for a in usable for b in usable
        if a < b and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= 0.9 * np.linalg.norm(usable[a]) * np.linalg.norm(usable[b])
    ]
    low = brute.components([i for i, _ in rows], links)
    degree = defaultdict(int)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    assert len(links) > 300
    assert out == {i: (degree[i], low[i], low[i] == i) for i, _ in rows}
    assert int8_neighbours.neighbours(df.filter("false")).count() == 0


def test_quantisation_bound_holds():
    x = int8_neighbours._unit(np.random.default_rng(0).normal(size=(200, 64)))
    q, s, e = int8_neighbours.quantise(x)
    near = (q.astype(float) * s[:, None]) @ (q.astype(float) * s[:, None]).T
    assert (np.abs(near - x @ x.T) <= e[:, None] + e + e[:, None] * e + 1e-12).all()


def test_both_codes_hold_their_bound():
    x = int8_neighbours._unit(np.random.default_rng(1).normal(size=(200, 64)))
    q, s, _ = int8_neighbours.quantise(x)
    f, t, e = int8_neighbours.quantise(x - q * s[:, None])
    near = q * s[:, None] + f * t[:, None]
    assert (np.abs(near @ near.T - x @ x.T) <= e[:, None] + e + e[:, None] * e + 1e-12).all() and e.max() < 1e-4


def test_pairs_next_to_the_threshold_are_computed_from_the_vectors(spark, monkeypatch):
    """Cosines of 0.9 and a ten-millionth more or less, which no code can settle."""
    monkeypatch.setattr(int8_neighbours, "TILE", 8)
    rng = np.random.default_rng(8)
    base = int8_neighbours._unit(rng.normal(size=(10, 32)))
    rows, want = [], {}
    for k, u in enumerate(base):
        rows.append((100 * k, u.tolist()))
        for n in range(1, 7):
            w = rng.normal(size=32)
            w = w - (w @ u) * u
            c = 0.9 + (1e-7 if n % 2 else -1e-7)
            rows.append((100 * k + n, (n * (c * u + math.sqrt(1 - c * c) * w / np.linalg.norm(w))).tolist()))
    unit = int8_neighbours._unit(np.array([v for _, v in rows]))
    links = [(rows[i][0], rows[j][0]) for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.9, 1)), strict=True)]
    assert sum(a % 100 == 0 for a, _ in links) == 30
    low = brute.components([i for i, _ in rows], links)
    degree = defaultdict(int)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    want = {i: (degree[i], low[i]) for i, _ in rows} | {None: (degree[1] + 1, None), 1000: (0, 1000)}
    for i in [1] + [b if a == 1 else a for a, b in links if 1 in (a, b)]:
        want[i] = (want[i][0] + 1, want[i][1])
    df = spark.createDataFrame([*rows, (None, rows[1][1]), (1000, [-0.0] * 32)], "vec_id long, embedding array<double>")
    out = int8_neighbours.neighbours(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == {**want, None: (want[1][0], None)}


# near duplicates


def test_every_text_of_an_id_is_compared(spark):
    """Two texts an id, in either order of their sets: the links of both count."""
    rnd = np.random.default_rng(5)
    text = lambda: " ".join(f"w{x}" for x in rnd.integers(0, 10_000, 60))
    rows, want = [], {}
    for k in range(0, 60, 3):
        one, two = text(), text()
        rows += [(k, one), (k, two), (k + 1, one + " end"), (k + 2, "start " + two)]
        want |= {k: k, k + 1: k, k + 2: k}
    rows += [(100, rows[0][1]), (100, None), (101, None), (None, rows[0][1])]
    want |= {100: 0, 101: 101}
    out = superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    assert {(r.doc_id, r.component_id) for r in out if r.doc_id is not None and r.n_shingles} == {(k, v) for k, v in want.items() if k != 101}
    assert {(r.doc_id, r.component_id, r.kept) for r in out if not r.n_shingles} == {(100, 100, True), (101, 101, True)}


def test_near_duplicates_match_brute_force(docs, texts, empty):
    out = superminhash.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute.near_duplicates(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out) and len(out) == len(texts)
    assert superminhash.near_duplicates(empty).count() == 0


def test_large_group_without_a_common_original(spark, monkeypatch):
    """Copies of copies: neighbours in the chain are alike, distant ones are not."""
    monkeypatch.setattr(superminhash, "CHUNK", 7)
    rng = random.Random(9)
    w = [f"w{rng.randint(0, 9999)}" for _ in range(200)]
    rows = []
    for k in range(150):
        rows.append((1000 - k, " ".join(w)))
        w = list(w)
        w[rng.randrange(200)] = f"x{k}"
        w[rng.randrange(200)] = f"y{k}"
    rows += [(2000, None), (2001, "  "), (2002, "one"), (2003, "ONE"), (None, "one")]
    out = superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute.near_duplicates([r for r in rows if r[0] is not None])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None} == want
    assert [(r.n_shingles, r.component_id, r.kept) for r in out if r.doc_id is None] == [(1, None, True)]


def test_signatures_estimate_similarity():
    """Unbiased, and with less variance than independent hashes."""
    rng, errors = np.random.default_rng(4), []
    for _ in range(60):
        keys = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        a, b = np.sort(keys[:200]), np.sort(keys[100:])
        s = superminhash.signatures(np.concatenate([a, b]), np.array([0, 200, 400]), 128)
        assert len(set(np.floor(s[0]).astype(int))) >= 1 and np.isfinite(s).all()
        errors.append((s[0] == s[1]).mean() - 1 / 3)
    assert abs(np.mean(errors)) < 0.02 and np.var(errors) < 1.1 * (1 / 3 * 2 / 3) / 128
    one = superminhash.signatures(np.array([5], np.uint64), np.array([0, 1]), 32)[0]
    assert sorted(np.floor(one)) == list(range(32))


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(10, 60)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    out = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {7: 7, **{k: 10 for k in range(10, 61)}, **{100 + k: 100 for k in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# toxicity


def test_toxicity_of_held_out_documents(spark, empty):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    seen = docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "text", queries.F.lit(1).alias("score"))
    out = toxicity.score_toxicity(seen, labels).join(labels, "doc_id").select("doc_id", "score", "predicted", "toxic", toxicity.held_out().alias("h")).collect()
    held = [r for r in out if r.h]
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    caught = sum(r.predicted for r in held if r.toxic) / sum(r.toxic for r in held)
    false = sum(r.predicted for r in held if not r.toxic) / sum(not r.toxic for r in held)
    assert caught > 0.85 and false < 0.02, (caught, false)
    odd = spark.createDataFrame([(-k, t) for k, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    assert all(0 <= r.score <= 1 for r in toxicity.score_toxicity(seen.select("doc_id", "text").unionByName(odd), labels).filter("doc_id <= 0").collect())
    assert toxicity.score_toxicity(empty, labels).count() == 0
    assert {r.score for r in toxicity.score_toxicity(odd, labels.filter("false")).collect()} == {0.0}


def test_plain_words():
    assert toxicity.plain("Idiot!!") == ("idiot", False)
    assert toxicity.plain("1d1ot") == ("idiot", True) and toxicity.plain("i.d.i.o.t") == ("idiot", True) and toxicity.plain("trrrash") == ("trash", True)


# mixing


def test_mix_meets_targets(docs, texts, empty):
    rows = curriculum.mix_sizes(docs).collect()
    size = {i: len(brute.words(t)) for i, t in texts}
    assert {r.doc_id: r.size for r in rows} == size and len(rows) == len(texts)
    source = {r.doc_id: r.source for r in docs.collect()}
    names = sorted({s for s in source.values() if s is not None}) + [None]
    own = {s: sum(size[i] for i in size if source[i] == s) for s in names}
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), float(sum(own.values())), set(names)
    while True:  # reshare by weight until none is above
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * own[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * own[s]
            left -= target[s]
        free -= over
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == own[s] and abs(r.target - target[s]) < 1e-6 * max(target[s], 1) and r.taken <= 3 * r.size
        assert r.positions == sorted(r.positions) and all(0 <= p <= 1 for p in r.positions) and r.taken == r.size * r.copies == r.size * len(r.positions)
    for s in names:
        taken = sum(r.taken for r in rows if source[r.doc_id] == s)
        assert abs(taken - target[s]) <= max(size[i] for i in size if source[i] == s)
    assert sorted(map(tuple, curriculum.mix_sizes(docs.repartition(3)).collect())) == sorted(map(tuple, rows))
    mixed = curriculum.mix(docs.withColumn("position", queries.F.lit("own"))).collect()
    assert len(mixed) == sum(r.copies for r in rows) and [r.position_ for r in mixed] == sorted(r.position_ for r in mixed) and mixed[0].position == "own"
    assert curriculum.mix_sizes(empty).count() == 0 and curriculum.mix(empty).count() == 0


def test_position_inverts_the_integrated_schedule(spark):
    f = queries.F
    for slope in (-1.0, -0.5, 0.0, 0.7, 1.0):
        out = spark.range(1, 10).select((f.col("id") / 10).alias("u"), curriculum.position(f.col("id") / 10, f.lit(slope)).alias("t")).collect()
        assert all(abs((1 - slope) * r.t + slope * r.t**2 - r.u) < 1e-9 for r in out)


def test_mix_of_repeated_and_null_ids(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (1, "c", None), (None, "d", "s"), (None, "e f g", "s"), (2, None, "s"), (3, "x " * 40, "t")]
    out = curriculum.mix_sizes(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(r.size for r in out) == sorted(len(brute.words(t)) for _, t, _ in rows)


# token counts


@pytest.fixture(scope="module")
def counter():
    return prefix_tokens.PrefixCounter(queries.tokenizer_path(queries.COUNTING_MODEL))


def check_prefixes(counter, texts):
    tokens, chars, steps = counter.slice(pa.array(texts, pa.string()))
    assert chars.tolist() == [len(t) for t in texts]
    at = 0
    for text, n, k in zip(texts, tokens, chars):
        counts = np.cumsum(steps[at : at + k])
        at += k
        assert n == len(counter.model.encode(text))
        some = range(1, len(text) + 1) if len(text) < 300 else random.Random(1).sample(range(1, len(text) + 1), 60)
        for p in some:
            assert counts[p - 1] == len(counter.model.encode(text[:p])), (text[:p], p)


def test_every_prefix_of_documents(counter, texts):
    check_prefixes(counter, [t or "" for _, t in texts])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ▁\nabcthe<0xA>s/é日\t.,1"), st.characters(codec="utf-8", exclude_characters="\0")), max_size=30), max_size=4))
def test_every_prefix_of_any_text(counter, texts):
    check_prefixes(counter, texts)


def test_count_and_budget(spark, docs, texts, counter, empty):
    path = queries.tokenizer_path(queries.COUNTING_MODEL)
    counted = prefix_tokens.count_prefixes(docs.withColumn("n_tokens", queries.F.lit("clash")), path)
    text = dict(texts)
    for r in prefix_tokens.fit_budget(counted, 50).collect():
        full = text[r.doc_id] or ""
        assert r.n_tokens == len(counter.model.encode(full)) and r.budget_tokens == len(counter.model.encode(full[: r.budget_chars])) <= 50
        assert r.budget_chars == len(full) or len(counter.model.encode(full[: r.budget_chars + 1])) > 50
    assert prefix_tokens.count_prefixes(empty, path).count() == 0
