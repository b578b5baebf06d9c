"""Columns of the caller that are named as those of the steps, and languages of long texts alone."""

import random

from estate.llm import curriculum, ppm_language, robust_quality, toxicity

INNER = "_group _lang _source _x0 _x1 _n _row _centre _inverse _d _s _plan _i _o _id _part _raw _score _features features prediction probability rawPrediction label".split()


def documents(spark, n=160):
    rng = random.Random(8)
    text = lambda i: " ".join(rng.choice(["red", "green", "blue", "you fool", "nice day"] if i % 4 else ["fool", "you", "awful"]) for _ in range(80))
    rows = [(i, text(i), "en", f"s{i % 2}", *[f"{c}{i}" for c in INNER]) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in INNER))


def same_columns(out, docs):
    found = {r.doc_id: r for r in out.collect()}
    assert len(found) == docs.count()
    assert all(found[i][c] == f"{c}{i}" for i in found for c in INNER)
    return found


def test_quality_rules_carry_any_column(spark):
    docs = documents(spark)
    plain = {r.doc_id: r for r in robust_quality.quality_rules(docs.select("doc_id", "text", "lang", "source")).collect()}
    found = same_columns(robust_quality.quality_rules(docs), docs)
    assert all((found[i].kept, found[i].n_words) == (plain[i].kept, plain[i].n_words) for i in found)


def test_toxicity_carries_any_column(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, int(i % 4 == 0), "x") for i in range(160)], "doc_id long, toxic int, text string")
    plain = {r.doc_id: r.score for r in toxicity.score_toxicity(docs.select("doc_id", "text"), labels).collect()}
    found = same_columns(toxicity.score_toxicity(docs, labels), docs)
    assert {i: r.score for i, r in found.items()} == plain and len(set(plain.values())) > 1


def test_mixing_carries_any_column(spark):
    docs = documents(spark, 30)
    assert {r.doc_id: r["_plan"] for r in curriculum.mix(docs).collect()}.items() <= {i: f"_plan{i}" for i in range(30)}.items()


def test_a_language_of_long_texts_alone_is_learned(spark):
    rng = random.Random(3)
    text = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(n))
    rows = [(i, text("abcde", 60), "xx") for i in range(30)] + [(100 + i, text("vwxyz", 600 + i), "yy") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = ppm_language.fit(docs, max_bytes=2000)
    assert sorted(trees) == ["xx", "yy"]
    assert all(r.lang_pred == r.lang for r in ppm_language.predict(docs, trees).collect())
