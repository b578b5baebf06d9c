"""Buckets of one set are counted by number; no name of a set travels for them."""

import re

from estate.llm import superminhash


def test_only_crowded_buckets_name_their_sets(spark, monkeypatch):
    texts = [" ".join(f"w{k}x{j}" for j in range(30)) for k in range(20)]
    rows = [*enumerate(texts), (90, texts[3] + " end"), (91, texts[4]), (92, texts[3] + " end"), (92, texts[3] + " end")]
    plans, written, durable = [], [], superminhash.durable

    def seen(df):
        out = durable(df)
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        written.append((set(df.columns), out))
        return out

    monkeypatch.setattr(superminhash, "durable", seen)
    found = superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.component_id) for r in found.collect() if not r.kept} == {(90, 3), (91, 4), (92, 3)}
    assert not [p for p in plans if "explode" in p and re.search(r"Aggregate \[bucket#\d+L, a#", p)]
    named = [df for columns, df in written if columns == {"bucket", "a"}]
    assert len(named) == 1 and named[0].count() < 32 * len(rows) / 4
