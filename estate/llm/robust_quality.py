"""Quality rules: robust multivariate outliers.

A vector of transformed text statistics per document; per language and source a minimum-covariance-determinant
estimate of their centre and scatter; documents at a large Mahalanobis distance are rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.llm.prefix_tokens import _with
from estate.llm.words import _BYTES, Words, fresh, mix, span_hashes, text_slices
from estate.session import durable

SYMBOLS = "#*$%&|<>"
#: documents with fewer words fail the base rules, as do those where repeats cover more than this percentage
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: smallest standard deviation of each statistic: characters a word, log symbols, log repeated lines, share of repeats
FLOORS = (0.5, 0.5, 0.5, 0.06)
#: a clean document is rejected with about this probability
TAIL = 1e-4
#: smaller groups of language and source are joined: first over the sources of a language, then over all
MIN_GROUP = 100
STEPS = 6

_DIMENSIONS = len(FLOORS)
_PACKED = np.zeros(256, bool)
_PACKED[list(SYMBOLS.encode())] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _counts(texts: pa.Array) -> list[np.ndarray]:
    words = Words(texts)
    n, first, raw = len(texts), words.first, words.raw

    def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
        return total[bounds[1:]] - total[bounds[:-1]]

    n_words = np.diff(first)
    chars = per_text((words.data & 0xC0) != 0x80, words.offsets[first])
    symbols = per_text(_PACKED[raw], words.bounds)

    # lines end at a line feed or with their text
    starts = np.unique(np.r_[words.bounds[:-1], np.flatnonzero(raw == 0x0A) + 1])
    starts = starts[starts < len(raw)]
    ends = np.r_[starts[1:], len(raw)].astype(np.int64)
    ends -= (ends > starts) & (raw[ends - 1] == 0x0A) if len(starts) else 0
    owner = np.searchsorted(words.bounds, starts, side="right") - 1
    worded = np.searchsorted(words.start, ends) > np.searchsorted(words.start, starts)
    keys = mix(span_hashes(_BYTES[raw], starts, ends) + mix(owner.astype(np.uint64)))[worded]
    owner = owner[worded]
    _, once = np.unique(keys, return_index=True)
    dup_lines = np.bincount(owner, minlength=n) - np.bincount(owner[once], minlength=n)

    # windows of three words within a text that are found twice or more in it
    doc = np.repeat(np.arange(n), n_words)
    covered = np.zeros(len(words), bool)
    if len(words) >= 3:
        at = np.flatnonzero(doc[2:] == doc[:-2])
        keys = mix(span_hashes(words.hashes(), at, at + 3) + mix(doc[at].astype(np.uint64)))
        _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
        twice = at[times[back] > 1]
        covered[twice] = covered[twice + 1] = covered[twice + 2] = True
    return [n_words, chars, symbols, dup_lines, per_text(covered, first)]


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` without its text, with the five counts (long) of every whole text; null text has none."""
    keep = [c for c in docs.columns if c.lower() not in (*_COUNTS, "text")]
    at = fresh(docs, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, at):
                counts = [pa.array(c, pa.int64()) for c in _counts(part.column(at))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *counts], names=[*keep, *_COUNTS])

    schema = _with(docs.select(*keep).schema, ", ".join(f"{c} bigint" for c in _COUNTS))
    return docs.select(*keep, F.col("text").alias(at)).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def chi_square_quantile(p: float, dimensions: int = _DIMENSIONS) -> float:
    """For an even number of dimensions, where the tail is a finite sum; found by halving."""
    low, high = 0.0, 1e4
    for _ in range(100):
        x = (low + high) / 2
        tail = math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dimensions // 2))
        low, high = (x, high) if 1 - tail < p else (low, x)
    return low


_X = [f"_x{i}" for i in range(_DIMENSIONS)]


def _vector() -> list[Column]:
    n = F.nullif("n_words", F.lit(0))
    return [
        F.col("word_chars") / n,
        F.log1p(100 * F.col("n_symbols") / n),
        F.log1p(100 * F.col("n_dup_lines") / n),
        F.col("n_repeat_words") / n,
    ]


def _groups(usable: DataFrame) -> DataFrame:
    """``_lang, _source, _group`` for each pair: the pair itself, its language's small sources, or all the rest."""
    pairs = usable.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("_n"))
    small = pairs.filter(F.col("_n") < MIN_GROUP).groupBy(F.col("_lang").alias("_l")).agg(F.sum("_n").alias("_m"))
    text = lambda *cols: F.concat_ws("\n", *[F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in cols])
    return pairs.join(small, F.col("_lang").eqNullSafe(F.col("_l")), "left").select(
        "_lang",
        "_source",
        F.when(F.col("_n") >= MIN_GROUP, text("_lang", "_source")).when(F.col("_m") >= MIN_GROUP, text("_lang")).otherwise("").alias("_group"),
    )


def _distance(centre: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance of the row."""
    diff = [F.col(x) - centre[i] for i, x in enumerate(_X)]
    total = F.lit(0.0)
    for i in range(_DIMENSIONS):
        for j in range(i, _DIMENSIONS):
            total = total + (1 if i == j else 2) * inverse[i * _DIMENSIONS + j] * diff[i] * diff[j]
    return total


def _moments() -> list[Column]:
    """Sums about the group's present centre, which keeps them accurate."""
    diff = [F.col(x) - F.col("_centre")[i] for i, x in enumerate(_X)]
    return [
        F.count(F.lit(1)).alias("_n"),
        F.array(*[F.sum(d) for d in diff]).alias("_sum"),
        F.array(*[F.sum(diff[i] * diff[j]) for i in range(_DIMENSIONS) for j in range(_DIMENSIONS)]).alias("_products"),
    ]


def _estimate(sums: DataFrame, keys: list[str]) -> DataFrame:
    """``_centre, _inverse, _logdet`` from moments: small matrices, one row per group and start."""
    floor = np.diag(np.square(FLOORS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            centres, inverses, dets = [], [], []
            for r in rows:
                n, mean = r["_n"], np.array(r["_sum"]) / r["_n"]
                cov = np.array(r["_products"]).reshape(_DIMENSIONS, _DIMENSIONS) / n - np.outer(mean, mean) + floor
                centres.append((np.array(r["_centre"]) + mean).tolist())
                inverses.append(np.linalg.inv(cov).ravel().tolist())
                dets.append(float(np.linalg.slogdet(cov)[1]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array(centres, pa.list_(pa.float64())), pa.array(inverses, pa.list_(pa.float64())), pa.array(dets, pa.float64())],
                names=[*keys, "_centre", "_inverse", "_logdet"],
            )

    return sums.mapInArrow(run, _with(sums.select(*keys).schema, "_centre array<double>, _inverse array<double>, _logdet double"))


def _fit(rows: DataFrame) -> DataFrame:
    """``_group, _centre, _inverse, _cut`` per group: the estimate of least determinant over two starts.

    A concentration step keeps the half of the group's rows that is nearest under the present estimate and
    estimates anew; the determinant never grows.  Every row of a group takes part in every step; a group with a
    third of all rows is summed in parts.  One start is the median and the median deviation, the other the mean
    and the covariance.
    """
    half = lambda x: F.percentile_approx(x, 0.5, F.lit(10_000))
    medians = rows.groupBy("_group").agg(F.array(*[half(F.col(x)) for x in _X]).alias("_centre"), F.count(F.lit(1)).alias("_rows"))
    medians = durable(medians.filter(F.col("_rows") >= MIN_GROUP).drop("_rows"))
    near = rows.join(medians, "_group")
    spread = near.groupBy("_group", "_centre").agg(
        F.array(*[F.greatest(1.4826 * half(F.abs(F.col(x) - F.col("_centre")[i])), F.lit(FLOORS[i])) for i, x in enumerate(_X)]).alias("_scale")
    )
    diagonal = [1 / F.pow(F.col("_scale")[i], 2) if i == j else F.lit(0.0) for i in range(_DIMENSIONS) for j in range(_DIMENSIONS)]
    start0 = spread.select("_group", F.lit(0).alias("_start"), "_centre", F.array(*diagonal).alias("_inverse"), F.lit(0.0).alias("_logdet"))
    plain = near.groupBy("_group", "_centre").agg(*_moments())
    start1 = _estimate(plain, ["_group"]).select("_group", F.lit(1).alias("_start"), "_centre", "_inverse", "_logdet")
    present = durable(start0.unionByName(start1))
    for _ in range(STEPS):
        scored = rows.join(present, "_group").withColumn("_d", _distance(F.col("_centre"), F.col("_inverse")))
        cut = durable(scored.groupBy("_group", "_start").agg(half(F.col("_d")).alias("_half")))
        kept = scored.join(cut, ["_group", "_start"]).filter("_d <= _half")
        present = durable(_estimate(kept.groupBy("_group", "_start", "_centre").agg(*_moments()), ["_group", "_start"]))
    best = durable(present.groupBy("_group").agg(F.min_by(F.struct("_centre", "_inverse"), F.struct("_logdet", "_start")).alias("_b")).select("_group", "_b.*"))

    # scale to a normal centre, then estimate once more from all rows that are not far
    scored = rows.join(best, "_group").withColumn("_d", _distance(F.col("_centre"), F.col("_inverse")))
    scale = durable(scored.groupBy("_group").agg(F.greatest(half(F.col("_d")) / chi_square_quantile(0.5), F.lit(1.0)).alias("_scale")))
    inner = scored.join(scale, "_group").filter(F.col("_d") <= F.col("_scale") * chi_square_quantile(0.975))
    return durable(_estimate(inner.groupBy("_group", "_centre").agg(*_moments()), ["_group"]).select("_group", "_centre", "_inverse"))


def quality_rules(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """``docs`` without its text, with the five counts, ``base_failed``, ``distance`` and ``kept``.

    ``distance`` is the squared Mahalanobis distance to the estimate of the document's language and source, null for
    documents that fail the base rules and for those of a group that stays under ``MIN_GROUP``, which are kept.
    Estimates are made from all documents that pass the base rules.

    Null text has no words and fails; null lang or source is a value of its own; empty tables give an empty result;
    repeated rows stay and count; columns with the names of the result are replaced, and all others, whatever their names, are carried along.
    """
    own = (*_COUNTS, "base_failed", "distance", "kept", "text")
    # the caller's columns travel as one, so that none of their names meets one of the steps'
    named = docs.select(F.struct(*[c for c in docs.columns if c.lower() not in own]).alias("_row"), "lang", "source", "text")
    # all counts once, in a narrow table: the steps read it again and again
    stats = durable(text_statistics(named).withColumn("base_failed", base_failed()))
    usable = stats.filter(~F.col("base_failed"))
    groups = durable(_groups(usable))
    with_group = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    vectors = durable(usable.join(groups, with_group).select("_group", *[x.alias(n) for x, n in zip(_vector(), _X, strict=True)]))
    model = _fit(vectors)
    scored = (
        stats.join(groups, with_group & ~F.col("base_failed"), "left")
        .join(model, "_group", "left")
        .select("*", *[x.alias(n) for x, n in zip(_vector(), _X, strict=True)])
    )
    far = _distance(F.col("_centre"), F.col("_inverse"))
    return scored.select("_row.*", *_COUNTS, "base_failed", far.alias("distance"), (~F.col("base_failed") & F.coalesce(far <= chi_square_quantile(1 - tail), F.lit(True))).alias("kept"))
