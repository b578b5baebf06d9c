"""Token counts by prefix dynamic programming.

For byte-pair pieces a sequence of pieces is the encoding of its text exactly if every two neighbours are the
encoding of theirs.  So the last piece of every prefix follows from shorter prefixes, and one pass stores the
exact token count of every prefix.  No piece holds a space after another character, so the pass works on
units (spaces and what follows them), and each distinct unit is worked out once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.llm.words import Memo, Words, fresh, mix, ragged, text_slices, worker_model

_SPACE = np.zeros(256, bool)
_SPACE[0x20] = True
_MARK = "▁"
#: pairs of pieces whose test is kept in a worker
_PAIRS = 300_000


class PrefixCounter:
    """Token counts of all prefixes of a text under a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self.model
        pieces = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        texts = {i: model.id_to_piece(i) for i in pieces}
        if any(_MARK in t.lstrip(_MARK) or "\n" in t for t in texts.values()):
            raise ValueError("pieces with a space after another character are not supported")
        self.piece, self.tree = texts, {}
        for i, text in texts.items():
            if self._encode(text) == [i]:
                node = self.tree
                for ch in reversed(text):
                    node = node.setdefault(ch, {})
                node[""] = i
        self.pairs: dict[int, bool] = {}
        self.memo = Memo(np.int8, 12 << 20)

    def _encode(self, text: str) -> list[int]:
        """Pieces of a text that stands after no space: a line end before it keeps it from the leading mark."""
        return self.model.encode("\n" + text)[2:]

    def _fits(self, left: int, right: int) -> bool:
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > _PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._encode(self.piece[left] + self.piece[right]) == [left, right]
        return known

    def counts(self, unit: str) -> list[int]:
        """Tokens of each prefix of a unit, the empty one first."""
        count, last = [0], [-1]
        for end in range(1, len(unit) + 1):
            node, at, found = self.tree, end, None
            while at and (node := node.get(unit[at - 1])) is not None:
                at -= 1
                piece = node.get("")
                if piece is not None and (last[at] < 0 or self._fits(last[at], piece)):
                    found = (count[at] + 1, piece)
                    break
            if found is None:  # a character without a piece: its bytes, which join with nothing
                found = (count[end - 1] + len(unit[end - 1].encode()), -1)
            count.append(found[0])
            last.append(found[1])
        return count

    def slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text the token count and the number of characters; per character of all texts the change of the count."""
        if texts.null_count or pa.types.is_null(texts.type):
            texts = texts.cast(pa.string()).fill_null("")
        words = Words(pc.replace_substring(texts, _MARK, " "), _SPACE)  # to the model a mark in a text is a space
        n = len(texts)
        doc = np.repeat(np.arange(n), np.diff(words.first))
        # spaces before each word; the model puts one more before a text
        before = np.empty(len(words), np.int64)
        if len(words):
            before[1:] = words.start[1:] - words.end[:-1]
            before[0] = 0
            heads = np.flatnonzero(np.diff(words.first) > 0)
            before[words.first[:-1][heads]] = words.start[words.first[:-1][heads]] - words.bounds[:-1][heads] + 1
        keys = mix(words.hashes() ^ mix(before.astype(np.uint64)))
        # spaces at the end of a text are a unit of their own
        tail = words.bounds[1:] - words.bounds[:-1]
        has = np.flatnonzero(np.diff(words.first) > 0)
        tail[has] = words.bounds[1:][has] - words.end[words.first[1:][has] - 1]
        alone = np.diff(words.first) == 0
        spaces = tail + (alone & (tail > 0))
        ends = np.flatnonzero(spaces)
        owner = np.concatenate([doc, ends])
        order = np.argsort(owner, kind="stable")
        owner = owner[order]
        keys = np.concatenate([keys, mix(~mix(spaces[ends].astype(np.uint64)))])[order]

        unique, where = np.unique(keys, return_index=True)
        if self.memo.full():
            self.memo.clear()
        new = where[self.memo.missing(unique)]
        if len(new):
            source = order[new]
            text = []
            for i in source:
                if i < len(words):
                    text.append(_MARK * int(before[i]) + bytes(words.data[words.offsets[i] : words.offsets[i + 1]]).decode())
                else:
                    text.append(_MARK * int(spaces[ends[i - len(words)]]))
            steps = [np.diff(self.counts(t)) for t in text]
            self.memo.add(keys[new], np.array([len(s) for s in steps], np.int64), np.concatenate(steps))
        starts, lengths = self.memo.find(keys)
        steps = self.memo.values[ragged(starts, lengths)].astype(np.int8)
        unit_ends = np.cumsum(lengths)
        # the leading mark is no character of the text: its token is counted with the first character
        head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
        lead = (unit_ends - lengths)[head]
        steps[lead + 1] += steps[lead]
        kept = np.ones(len(steps), bool)
        kept[lead] = False
        steps = steps[kept]
        chars = np.bincount(owner, lengths, n).astype(np.int64)
        chars[owner[head]] -= 1
        total = np.r_[0, np.cumsum(steps, dtype=np.int64)]
        bounds = np.r_[0, np.cumsum(chars)]
        return total[bounds[1:]] - total[bounds[:-1]], chars, steps


def count_prefixes(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` with ``n_tokens`` (long) and ``token_steps`` (binary) by the sentencepiece model at path ``model``.

    Byte ``i`` of ``token_steps`` is the signed change of the token count when character ``i`` is added; their running
    sum is the exact count of every prefix.  Columns of these names are replaced.

    Null text counts as empty; an empty text has 0 tokens; texts of any length are taken whole; repeated rows
    stay; an empty table gives an empty result.  The model file must be readable on every executor.
    """
    keep = [c for c in docs.columns if c.lower() not in ("n_tokens", "token_steps")]
    at = fresh(docs, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_model(PrefixCounter, model)
        for batch in batches:
            for part in text_slices(batch, at):
                tokens, chars, steps = counter.slice(part.column(at))
                offsets = np.r_[0, np.cumsum(chars)].astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(chars), [None, pa.py_buffer(offsets), pa.py_buffer(steps)])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(tokens, pa.int64()), packed], names=[*keep, "n_tokens", "token_steps"]
                )

    fields = [docs.schema[c] for c in keep]
    schema = docs.select(*keep).schema if fields else docs.select().schema
    return docs.select(*keep, F.col("text").alias(at)).mapInArrow(run, _with(schema, "n_tokens bigint, token_steps binary"))


def _with(schema, more: str):
    from pyspark.sql.types import StructType, _parse_datatype_string

    return StructType([*schema.fields, *_parse_datatype_string(more).fields])


def fit_budget(counted: DataFrame, budget: int) -> DataFrame:
    """Add ``budget_chars`` and ``budget_tokens``: the longest prefix of at most ``budget`` tokens, from ``token_steps`` alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars, tokens = [], []
            for steps in batch.column("token_steps"):
                counts = np.r_[0, np.cumsum(np.frombuffer(steps.as_buffer(), np.int8), dtype=np.int64)]
                chars.append(int(np.flatnonzero(counts <= budget)[-1]))
                tokens.append(int(counts[chars[-1]]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(chars, pa.int64()), pa.array(tokens, pa.int64())],
                names=[*batch.schema.names, "budget_chars", "budget_tokens"],
            )

    return counted.mapInArrow(run, _with(counted.schema, "budget_chars bigint, budget_tokens bigint"))


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
