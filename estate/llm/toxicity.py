"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The labelled sample is split by a hash of the id.  The features of each part come from a lexicon that the other parts
give, so no label decides its own features; some parts grow the trees, the others calibrate.  All parts together
give the lexicon that scores the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.llm.prefix_tokens import _with
from estate.llm.words import Memo, Words, fresh, text_slices
from estate.operators.ordering import top_n_per_group
from estate.session import durable

#: documents of each label that are used at most for fitting
MAX_PER_LABEL = 4000
#: entries of the lexicon at most; toxic documents, and the share of them, that must hold an entry
MAX_LEXICON, MIN_TOXIC_DOCUMENTS, MIN_TOXIC_SHARE = 300, 3, 0.01
#: lengths of the stems that are tried besides whole words
STEMS = range(4, 10)
#: a lexicon word this close to a second person counts as aimed at somebody
NEAR = 5
THRESHOLD = 0.7
_PARTS = 5
_TREE_PARTS = (0, 1, 2)

SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros eres su".split()
)
#: signs that stand for letters in obfuscated words
_LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")
_ELONGATED = re.compile(r"(.)\1{2,}")

_SECOND, _CAPITALS, _OBFUSCATED = 1, 2, 4
FEATURES = ("hits", "log_hits", "weight", "top_weight", "aimed", "second_person", "capitals", "marks", "punctuation", "obfuscated", "log_words")


def plain(word: str) -> tuple[str, bool]:
    """The word in lower case with look-alikes, separators and elongations undone, and whether any were inside it."""
    bare = _EDGE.sub("", word.lower())
    if bare.isalpha() and not _ELONGATED.search(bare):
        return bare, False
    # signs at the edges may stand for letters as well, but full stops and the like don't
    inner = _ELONGATED.sub(r"\1", _INNER.sub("", word.lower().strip(".,;:?\"'()").translate(_LOOKALIKES)))
    return inner, any(map(str.isalpha, bare)) and inner != bare


def stems(bare: str) -> list[str]:
    """The word and its beginnings, which compounds and inflections share; a beginning ends with ``*``."""
    return [bare, *(bare[:k] + "*" for k in STEMS if k < len(bare))]


def _flags(word: str, obfuscated: bool, bare: str) -> int:
    letters = sum(map(str.isalpha, word))
    return (_SECOND if bare in SECOND_PERSON else 0) | (_CAPITALS if letters > 1 and word.isupper() else 0) | (_OBFUSCATED if obfuscated else 0)


class _Features:
    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.memo = Memo(np.float32, 2 << 20)

    def of(self, texts: pa.Array) -> np.ndarray:
        words = Words(texts)
        n, first = np.diff(words.first), words.first
        unique, where, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if self.memo.full():
            self.memo.clear()
        new = self.memo.missing(unique)
        if new.any():
            rows = []
            for w in words.array().take(pa.array(where[new])).to_pylist():
                bare, obfuscated = plain(w)
                rows.append((max(self.lexicon.get(x, 0.0) for x in stems(bare)), _flags(w, obfuscated, bare)))
            self.memo.add(unique[new], np.full(len(rows), 2), np.array(rows, np.float32).ravel())
        at = self.memo.find(unique)[0]
        weight = self.memo.values[at][back].astype(np.float64)
        flags = self.memo.values[at + 1][back].astype(np.int64)
        owner = np.repeat(np.arange(len(n)), n)

        def total(values: np.ndarray) -> np.ndarray:
            return np.bincount(owner, values, len(n))

        second = flags & _SECOND > 0
        spot = np.flatnonzero(weight > 0)
        aimed = np.zeros(len(words))
        if len(spot):
            seen = np.r_[0, np.cumsum(second)]
            low = np.maximum(spot - NEAR, first[owner[spot]])
            high = np.minimum(spot + NEAR + 1, first[owner[spot] + 1])
            aimed[spot] = seen[high] > seen[low]
        top = np.zeros(len(n))
        np.maximum.at(top, owner[spot], weight[spot])
        sign = np.zeros(256)
        sign[[0x21, 0x3F]] = 1
        punct = np.zeros(256)
        punct[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = 1

        def by_byte(table: np.ndarray) -> np.ndarray:
            cum = np.r_[0, np.cumsum(table[words.raw])]
            return cum[words.bounds[1:]] - cum[words.bounds[:-1]]

        each = np.maximum(n, 1) / 100
        hits = total(weight > 0)
        return np.stack(
            [hits / each, np.log1p(hits), total(weight) / each, top, total(aimed) / each, total(second) / each, total(flags & _CAPITALS > 0) / each,
             by_byte(sign) / each, by_byte(punct) / each, total((flags & _OBFUSCATED > 0) & (weight > 0)) / each, np.log1p(n)],
            axis=1,
        )


def with_features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``docs`` without its text, with ``_features`` (array of doubles) of every whole text; null counts as empty."""
    keep = [c for c in docs.columns if c.lower() != "text"]
    at = fresh(docs, "_text")
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features(shared.value)
        for batch in batches:
            for part in text_slices(batch, at):
                rows = features.of(part.column(at))
                flat = pa.ListArray.from_arrays((np.arange(len(rows) + 1) * len(FEATURES)).astype(np.int32), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), flat], names=[*keep, "_features"])

    return docs.select(*keep, F.col("text").alias(at)).mapInArrow(run, _with(docs.select(*keep).schema, "_features array<double>"))


def count_words(sample: DataFrame) -> DataFrame:
    """``_part, word, toxic, clean``: documents of each part and label with a word or stem, from ``_part, text, toxic``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[int, str], list[int]] = {}
            columns = [batch.column(c).to_pylist() for c in ("_part", "text", "toxic")]
            for part, text, toxic in zip(*columns, strict=True):
                for word in {x for w in set((text or "").split()) for x in stems(plain(w)[0])} - {""}:
                    seen.setdefault((part, word), [0, 0])[toxic] += 1
            parts, words = ([k[i] for k in seen] for i in (0, 1))
            counts = [pa.array([v[i] for v in seen.values()], pa.int64()) for i in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(words, pa.string()), *counts], names=["_part", "word", "toxic", "clean"])

    counted = sample.select("_part", "text", "toxic").mapInArrow(count, "_part bigint, word string, toxic bigint, clean bigint")
    return counted.groupBy("_part", "word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(counted: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Words and stems with their log odds, from ``word, toxic, clean`` of ``toxic`` and ``clean`` documents.

    At most ``MAX_LEXICON``, by documents that hold them.
    """
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    words = (
        counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") >= max(MIN_TOXIC_DOCUMENTS, MIN_TOXIC_SHARE * toxic))
        .select("word", odds.alias("odds"), "toxic").filter("odds > 1")
        .orderBy((F.col("odds") * F.col("toxic")).desc(), "word").limit(MAX_LEXICON)
    )
    return {r["word"]: float(r["odds"]) for r in words.collect()}


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose labels aren't seen."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_per_label: int = MAX_PER_LABEL) -> DataFrame:
    """``text, toxic, _part`` of at most ``max_per_label`` documents of each label, in the order of a hash of the id.

    A label that several rows give is their maximum; null labels and ids are left out.
    """
    one = labels.filter("toxic IN (0, 1)").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic")).filter(~held_out("_id"))
    chosen = top_n_per_group(one, ["toxic"], [F.xxhash64("_id"), "_id"], max_per_label, salt_on="_id")
    part = F.pmod(F.xxhash64(F.lit("part"), "_id"), F.lit(_PARTS)).alias("_part")
    return docs.join(chosen, F.col("doc_id") == F.col("_id")).select("text", "toxic", part)


def score_toxicity(docs: DataFrame, labels: DataFrame, max_per_label: int = MAX_PER_LABEL, trees: int = 20, depth: int = 3) -> DataFrame:
    """``docs`` without its text, with ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on).

    Scores come from whole texts alone.  Null and empty texts are scored by their features, all zero.  Without
    labels of both kinds to grow and to calibrate, the score is the share of toxic documents in the sample (0 if there is none).
    Repeated rows stay; an empty table gives an empty result; columns with the names of the result are replaced, and all others, whatever
    their names, are carried along.
    """
    own = ("score", "predicted")
    docs = docs.select(*[c for c in docs.columns if c.lower() not in own])
    sample = durable(labelled_sample(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), max_per_label))
    count = {(r["_part"], r["toxic"]): r["n"] for r in sample.groupBy("_part", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    groups = (_TREE_PARTS, tuple(p for p in range(_PARTS) if p not in _TREE_PARTS))
    if not all(sum(count.get((p, label), 0) for p in g) for g in groups for label in (0, 1)):
        share = sum(n for (_, label), n in count.items() if label) / max(sum(count.values()), 1)
        flat = docs.drop("text").withColumn("score", F.lit(float(share)))
        return flat.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

    words = durable(count_words(sample))
    size = lambda label, without=None: sum(n for (p, other), n in count.items() if other == label and p != without)
    parts = []
    for p in range(_PARTS):
        others = learn_lexicon(words.filter(F.col("_part") != p), size(1, p), size(0, p))
        parts.append(with_features(sample.filter(F.col("_part") == p), others))
    lexicon = learn_lexicon(words, size(1), size(0))
    fit = durable(reduce(DataFrame.unionByName, parts)).select(
        "_part", F.col("toxic").cast("double").alias("label"), array_to_vector("_features").alias("features")
    )
    boosted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7).fit(fit.filter(F.col("_part").isin(*_TREE_PARTS)))
    raw = lambda df: boosted.transform(df).withColumn("_raw", vector_to_array("probability")[1])
    calibrated = IsotonicRegression(featuresCol="_raw", labelCol="label", predictionCol="_score").fit(
        raw(fit.filter(~F.col("_part").isin(*_TREE_PARTS))).select("_raw", "label")
    )
    # the caller's columns travel as one, so that none of their names meets one of the model's
    carried = docs.select(F.struct(*[c for c in docs.columns if c.lower() != "text"]).alias("_row"), "text")
    scored = calibrated.transform(raw(with_features(carried, lexicon).withColumn("features", array_to_vector("_features"))))
    score = F.least(F.greatest("_score", F.lit(0.0)), F.lit(1.0))
    return scored.select("_row.*", score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))
