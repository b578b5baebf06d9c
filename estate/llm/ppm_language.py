"""Language identification by prediction by partial matching.

Texts are folded to letters and single spaces.  Per language a byte context tree of variable order, with escape probabilities by method C, frozen after fitting.
The code length of a text is the sum over its bytes of the exact cost in the longest context that the tree knows,
escapes included; the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estate.llm.prefix_tokens import _with
from estate.llm.words import SLICE_BYTES, drop_model, string_buffers, text_slices
from estate.operators.ordering import top_n_per_group

#: longest context in bytes; a gram is one byte more, which is what 32 bits hold
ORDER = 3
UNKNOWN = "und"

#: bytes of text that are worked on at once
_SLICE = SLICE_BYTES // 2

#: letters and bytes of other scripts count, A-Z as a-z; every other ASCII byte is a space
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


@dataclass
class Tree:
    """Context counts of one language: for each order the sorted contexts and the sorted contexts with a next byte."""

    contexts: list[np.ndarray] = field(default_factory=list)
    escape: list[np.ndarray] = field(default_factory=list)
    grams: list[np.ndarray] = field(default_factory=list)
    cost: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def of(cls, grams: np.ndarray, counts: np.ndarray) -> Tree:
        """From counts of the distinct ``ORDER + 1``-byte grams of the training texts."""
        tree, grams = cls(), grams.astype(np.uint32, copy=False)
        for order in range(ORDER + 1):
            short, back = np.unique(grams & np.uint32((1 << 8 * (order + 1)) - 1), return_inverse=True)
            n = np.bincount(back, counts, len(short))
            contexts, where = np.unique(short >> np.uint32(8), return_inverse=True)
            total, distinct = np.bincount(where, n), np.bincount(where)
            tree.contexts.append(contexts)
            tree.escape.append(np.log2((total + distinct) / distinct))
            tree.grams.append(short)
            tree.cost.append(np.log2((total + distinct)[where] / n))
        return tree

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Cost in bits of the last byte of each gram after the bytes before it."""
        out, open_ = np.zeros(len(grams)), np.arange(len(grams))
        for order in range(ORDER, -1, -1):
            now = grams[open_] & np.uint32((1 << 8 * (order + 1)) - 1)
            at = np.minimum(np.searchsorted(self.grams[order], now), len(self.grams[order]) - 1)
            hit = self.grams[order][at] == now
            out[open_[hit]] += self.cost[order][at[hit]]
            open_, now = open_[~hit], now[~hit]
            if not len(open_):
                return out
            context = now >> np.uint32(8)
            at = np.minimum(np.searchsorted(self.contexts[order], context), len(self.contexts[order]) - 1)
            known = self.contexts[order][at] == context
            out[open_[known]] += self.escape[order][at[known]]
        out[open_] += 8.0  # bytes that no training text holds: one of 256
        return out


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``ORDER + 1``-byte grams ending at each byte that counts, and the number before each text.

    Runs of spaces are one, and a text starts after spaces; so signs and digits, which junk of any language may
    hold, neither cost much nor decide.
    """
    bounds, raw = string_buffers(texts)
    raw = _FOLD[raw]
    kept = raw != 0x20
    kept[1:] |= raw[:-1] != 0x20
    sizes = _sums(kept, bounds, np.int64)
    raw = raw[kept]
    bounds = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=bounds[1:])
    # ORDER spaces before each text
    text = np.ones(len(raw) + ORDER * len(sizes), bool)
    text[(bounds[:-1] + ORDER * np.arange(len(sizes)))[:, None] + np.arange(ORDER)] = False
    padded = np.full(len(text), 0x20, np.uint32)
    padded[text] = raw
    gram = padded.copy()
    for back in range(1, ORDER + 1):
        gram[back:] |= padded[:-back] << np.uint32(8 * back)
    return gram[text], bounds


def _sums(values: np.ndarray, bounds: np.ndarray, dtype: type) -> np.ndarray:
    """Sums of ``values[bounds[i]:bounds[i + 1]]``, each of its own values alone, without an array as long as ``values``."""
    out, some = np.zeros(len(bounds) - 1, dtype), np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.add.reduceat(values, bounds[some], dtype=dtype)
    return out


def fit(labelled: DataFrame, max_documents: int = 500, max_bytes: int = 200_000) -> dict[str, Tree]:
    """One tree per language from rows ``doc_id, text, lang``.

    The sample per language is bounded: the first ``max_documents`` documents in the order of a hash of the id, as long
    as their whole texts together stay within ``max_bytes``.  A language all of whose texts are longer is learned from the shortest, whole.
    Of each language the ``max_bytes`` most frequent contexts are kept, which are all of them but for such a text; so what
    reaches the driver is bounded by languages x ``max_bytes``, and what is broadcast by languages x ``max_documents`` ids.
    Rows with null text or lang are left out; repeated rows of a chosen document all count; other columns are ignored.
    """
    order = [F.xxhash64("doc_id"), "doc_id", "_n"]
    every = labelled.select("doc_id", "lang", "text", F.octet_length("text").alias("_n")).filter(F.col("lang").isNotNull() & (F.col("_n") > 0))
    usable = every.filter(F.col("_n") <= max_bytes)
    # ids first: texts follow for the chosen ones only, of which there are at most languages x max_documents
    first = top_n_per_group(usable.select("doc_id", "lang", "_n"), ["lang"], order, max_documents, salt_on="doc_id")
    running = F.sum("_n").over(Window.partitionBy("lang").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    chosen = first.withColumn("_until", running).filter(F.col("_until") <= max_bytes).select("doc_id", "lang", "_n").distinct()
    shortest = every.groupBy("lang").agg(F.min(F.struct("_n", F.xxhash64("doc_id").alias("h"), "doc_id")).alias("_s")).filter(F.col("_s._n") > max_bytes)
    chosen = chosen.unionByName(shortest.select("_s.doc_id", "lang", "_s._n"))
    sample = every.join(F.broadcast(chosen), ["doc_id", "lang", "_n"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_model()
        for batch in batches:
            for part in text_slices(batch, limit=_SLICE):
                langs = np.array(part.column("lang").to_pylist(), object)
                for lang in dict.fromkeys(langs):
                    gram, n = np.unique(_grams(part.column("text").filter(pa.array(langs == lang)))[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n, pa.int64())], names=["lang", "gram", "n"]
                    )

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, gram bigint, n bigint")
    total = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = top_n_per_group(total, ["lang"], [F.col("n").desc(), "gram"], max_bytes, salt_on="gram").toArrow()
    langs = np.array(rows["lang"].to_pylist(), object)
    gram, n = rows["gram"].to_numpy().astype(np.uint32), rows["n"].to_numpy().astype(float)
    return {lang: Tree.of(gram[langs == lang], n[langs == lang]) for lang in sorted(set(langs))}


def predict(docs: DataFrame, trees: dict[str, Tree]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from whole texts alone; columns of these names are replaced.

    ``score`` is the share of the winner when code lengths are read as probabilities, 0 for ``und``.  Null, empty and
    letterless texts are ``und``, as is everything when there are no trees; ties go to the first language by code
    point; repeated rows stay; an empty table gives an empty result.
    """
    keep = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    at = "text" if "text" in keep else next(c for c in keep if c.lower() == "text")
    names = sorted(trees)
    model = docs.sparkSession.sparkContext.broadcast([trees[n] for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_model()
        for batch in batches:
            for part in text_slices(batch, at, _SLICE):
                lang, score = _best(part.column(at), names, model.value)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lang, score], names=[*keep, "lang_pred", "score"])

    return docs.select(*keep).mapInArrow(run, _with(docs.select(*keep).schema, "lang_pred string, score double"))


def _best(texts: pa.Array, names: list[str], trees: list[Tree]) -> tuple[pa.Array, pa.Array]:
    """Language and score of each text.  What it makes on the way, some 25 bytes a byte of text, is gone when it returns."""
    known = np.array([t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()], bool) & bool(names)
    best, score = np.zeros(len(known), np.int64), np.zeros(len(known))
    if names:
        grams, bounds = _grams(texts)
        unique = np.unique(grams)
        back = np.searchsorted(unique, grams)
        bits = np.empty((len(names), len(known)))
        for i, tree in enumerate(trees):
            bits[i] = _sums(tree.bits(unique)[back], bounds, np.float64)
        best = bits.argmin(axis=0)
        score = 1 / np.exp2(bits.min(axis=0) - bits).sum(axis=0)
    lang = np.where(known, np.array([*names, UNKNOWN], object)[best], UNKNOWN)
    return pa.array(lang, pa.string()), pa.array(np.where(known, score, 0.0))


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that the models don't see."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, **bounds: int) -> DataFrame:
    """Fit on the documents that are not held out and have a ``lang``, then predict all."""
    return predict(docs, fit(docs.filter(~held_out()), **bounds))
