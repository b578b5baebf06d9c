"""Substring dedup where one line stands in very many documents."""

import hashlib
import random

import numpy as np

from estate.llm import substring_dedup
from tests.llm import brute


def test_a_frequent_line_between_other_words_stays_out_of_one_index(spark, monkeypatch):
    """Shorter than a window, so nothing of it goes; passages around it that do repeat go as before."""
    monkeypatch.setattr(substring_dedup, "HOT", 50, raising=False)
    bounded = substring_dedup._later_windows

    def watched(spans: np.ndarray, hashes: np.ndarray, window: int) -> np.ndarray:
        if len(spans) > 150:
            raise AssertionError(f"{len(spans)} segments in one index")
        return bounded(spans, hashes, window)

    monkeypatch.setattr(substring_dedup, "_later_windows", watched)
    rng = random.Random(2)
    line = [f"line{k}" for k in range(15)]
    own = lambda n: [f"w{rng.randint(0, 10**9)}" for _ in range(n)]
    rows = [(k, " ".join(own(20) + line + own(20))) for k in range(400)]
    around = own(3) + line + own(4)
    rows += [(500 + k, " ".join(own(5) + around[k % 3 :] + own(5))) for k in range(40)]
    rows += [(600 + k, rows[k][1]) for k in range(20)] + [(700, None), (None, rows[30][1]), (0, rows[0][1])]
    rng.shuffle(rows)
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in out}
    want = brute.repeats([(10**9 if i is None else i, t) for i, t in rows])
    want[None] = want.pop(10**9)
    assert found == want and len(out) == len(rows)
    assert found[5][1] == 0 and found[601][1] == 55 and found[539][1] > 0
