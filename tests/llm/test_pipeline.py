"""The stages of the pipeline."""

import hashlib
import random
from collections import Counter

from tokenizers import Tokenizer

import corpus_pipeline
from estate.llm import curriculum, ppm_language, queries
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, n):
    w = [x.lower() for x in brute.words(text)]
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


def similarity(a, b, n):
    return len(shingles(a, n) & shingles(b, n)) / len(shingles(a, n) | shingles(b, n))


def near_pair(changed):
    """A text and one with ``changed`` of its 200 words replaced, far from each other."""
    w = [f"w{k}" for k in range(200)]
    other = [f"x{k}" if k % (200 // changed) == 7 else x for k, x in enumerate(w)]
    return " ".join(w), " ".join(other)


def test_near_duplicates_by_five_words(spark):
    """Over 0.8 on two words and under it on five is no near duplicate; over it on five is one."""
    loose, close = near_pair(8), near_pair(2)
    assert similarity(*loose, 2) > 0.8 > similarity(*loose, 5) and similarity(*close, 5) > 0.8
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(loose)]
    rows += [(10 + k, t.replace("w", "v").replace("x", "y"), "en", "s", len(t)) for k, t in enumerate(close)]
    random.Random(1).shuffle(rows)
    out = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(map(tuple, out)) == sorted(r for r in rows if r[0] != 11)


def test_repeated_rows_and_rows_without_id(spark):
    """One row for each text of an id; texts without an id count as documents after all others."""
    rng = random.Random(4)
    a, b, c, d = (" ".join(f"w{rng.randint(0, 10**9)}" for _ in range(60)) for _ in range(4))
    row = lambda i, t, source="s": (i, t, "en", source, len(t))
    rows = [row(1, a)] * 3 + [row(1, d, "t"), row(1, d, "s"), row(2, a + " end")] + [row(None, b)] * 2 + [row(None, b + " end"), row(None, a), row(None, c), row(7, c)]
    found = sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "").collect()), key=str)
    nameless = [r for r in found if r[0] is None]
    assert [r for r in found if r[0] is not None] == sorted([row(1, a), row(1, d, "s"), row(7, c)], key=str)
    assert len(nameless) == 1 and nameless[0][1] in (b, b + " end")


def five_word_kept(rows):
    """Rows left by stage 2, of ids that are unique and not null."""
    sets = {r[0]: shingles(r[1], 5) if len(brute.words(r[1])) >= 5 else {tuple(x.lower() for x in brute.words(r[1]))} - {()} for r in rows}
    ids = sorted(sets)
    links = [(x, y) for k, x in enumerate(ids) for y in ids[k + 1 :] if sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])]
    low = brute.components(ids, links)
    return [r for r in rows if low[r[0]] == r[0]]


def without_repeats(rows):
    """Rows left by stage 3: ``doc_id`` to text hash."""
    gone = brute.repeats([(r[0], r[1]) for r in rows])
    same = {r[0]: hashlib.sha256((r[1] or "").encode()).hexdigest() for r in rows}
    return {i: h if removed else same[i] for i, (n, removed, h) in gone.items() if not removed or removed < n}


def test_stages_and_run_match_brute_force(spark, sf_dir, tmp_path):
    first = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*corpus_pipeline.COLUMNS).orderBy("doc_id").limit(60).collect()
    rows = [tuple(r) for r in first]
    long = [r for r in rows if len(brute.words(r[1])) > 80][:3]
    top = max(r[0] for r in rows)
    for k, r in enumerate(long):
        w = brute.words(r[1])
        rows += [(top + 10 * k + 1, r[1], *r[2:]), (top + 10 * k + 2, " ".join(w[10:50] + [f"own{k}{j}" for j in range(60)]), *r[2:])]
        rows += [(top + 10 * k + 3, " ".join(w[5:30]), *r[2:])]
    rows += [(top + 100, None, "en", "s", None), (top + 101, "12 !?", "en", None, 5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    own = {r[0]: r for r in rows}

    predicted = ppm_language.identify(docs).collect()
    known = [own[r.doc_id] for r in predicted if r.lang_pred != "und" and r.score >= 0.5]
    assert len(known) > 40 and not {top + 100, top + 101} & {r[0] for r in known}
    by_id = lambda df: sorted(map(tuple, df.collect()))
    assert by_id(corpus_pipeline.identify_language(spark, docs, "")) == sorted(known)
    unique = five_word_kept(known)
    assert len(unique) < len(known)
    assert by_id(corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(known, SCHEMA), "")) == sorted(unique)
    cut = corpus_pipeline.drop_repeated_passages(spark, spark.createDataFrame(unique, SCHEMA), "").collect()
    assert {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in cut} == without_repeats(unique) and len(cut) < len(unique)
    assert all(r.n_chars == len(r.text) for r in cut if r.text != own[r.doc_id][1])

    left = spark.createDataFrame(cut, SCHEMA)
    times = {r.doc_id: r.copies for r in curriculum.mix_sizes(left).collect()}
    mixed = corpus_pipeline.mix_sources(spark, left, "").collect()
    assert Counter(r.doc_id for r in mixed) == {i: n for i, n in times.items() if n} and set(mixed) <= set(cut)
    tokenizer = Tokenizer.from_file(queries.tokenizer_path(queries.PACKING_TOKENIZER))
    tokens = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    packed = corpus_pipeline.pack_sequences(spark, spark.createDataFrame(mixed, SCHEMA), "").collect()
    assert sum(r.length for r in packed) == tokens and {r.doc_id for r in packed} == {r.doc_id for r in mixed}

    pieces = lambda found: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    assert pieces(corpus_pipeline.run(spark, str(tmp_path)).collect()) == pieces(packed)
    empty = docs.filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
