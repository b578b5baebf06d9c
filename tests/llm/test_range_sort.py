"""op9 counts what the training order holds."""

from estate.llm import curriculum, queries
from tests.llm import brute


def test_query_counts_the_sorted_result(spark, sf_dir, monkeypatch):
    """A document that the range-sorted result lacks is not taken."""
    whole = queries.op9_curriculum(spark, sf_dir).collect()
    gone = min(r.doc_id for r in whole if r.taken > 0)
    mix = curriculum.mix
    monkeypatch.setattr(curriculum, "mix", lambda *a, **b: mix(*a, **b).filter(queries.F.col("doc_id") != gone))
    left = queries.op9_curriculum(spark, sf_dir).collect()
    unheld = lambda r: (*r[:4], 0, None, None) if r.doc_id == gone else tuple(r)
    assert sorted(map(tuple, left), key=str) == sorted(map(unheld, whole), key=str)


def test_counted_as_planned(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (1, "c", None), (None, "d", "s"), (None, "e f g", "s"), (2, None, "s"), (3, "x " * 40, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    planned = curriculum.mix_sizes(docs).select("doc_id", "size", "source_size", "target", "taken")
    found = curriculum.mixed_sizes(docs)
    assert found.columns == planned.columns and sorted(map(str, found.collect())) == sorted(map(str, planned.collect()))
    assert sum(r.size for r in found.collect()) == sum(len(brute.words(t)) for _, t, _ in rows)
    assert curriculum.mixed_sizes(docs.filter("false")).count() == 0
