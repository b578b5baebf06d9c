"""Substring dedup by an FM-index per shard.

A window of ``WINDOW`` words that occurs twice holds the same smallest run of ``ANCHOR`` words both times.  So
each document is cut into segments, stretches of windows with the same anchor, and the anchor's hash
names the shard: whatever can match meets there, and no document visits more than its own anchors' shards.

1. Blocks of documents (by a hash of the id) count their distinct segments per anchor, and the shard tells which anchors
   are hot: have more than ``HOT`` in all, such as a frequent line that stands between other words each time.  Windows with
   a hot anchor are segments of their own, and a second hash of their words takes the place of the anchor.
2. Blocks send the anchor and content hash of each distinct segment with its first place.  A passage that a third of
   all documents share is one row per block.
3. The shard answers which segments come later than an equal one, and which are the first of their kind but
   share an anchor with a different segment; anchors that occur once end here.
4. Blocks send the words of the latter; each distinct segment is sent once in all.
5. The shard builds the FM-index of its segments and streams them through it: backward search over the wavelet
   matrix gives the matching statistics, and an interval whose earliest place lies before the window's own is reported.
6. Blocks take the reported intervals out of their documents.

The exchange of the documents by block is written once and read four times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.fm_index import FMIndex
from estate.llm.prefix_tokens import _with
from estate.llm.words import SLICE_BYTES, Words, fresh, mix, partitions, span_hashes, string_buffers

WINDOW, ANCHOR = 20, 8
#: blocks per shuffle partition: a block of documents is held in memory
BLOCKS = 4
#: distinct segments of an anchor, summed over the blocks, from which on it is hot: no anchor brings more into an index
HOT = 4096

_TALLY = np.dtype([("anchor", "<u8"), ("n", "<i8")])
_ENTRY = np.dtype([("anchor", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("start", "<i4")])
_REPLY = np.dtype([("anchor", "<u8"), ("content", "<u8"), ("later", "u1"), ("index", "u1")])
_SPAN = np.dtype([("doc", "<i8"), ("start", "<i4"), ("length", "<i4")])
_MESSAGES = "target int, block int, kind int, data binary"
_LAST = np.iinfo(np.int64).max


def _ids(column: pa.Array) -> np.ndarray:
    """Ids as numbers; null comes last."""
    return column.cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)


class _Segments:
    """The segments of a few documents: anchor and content hash, document, first word, number of words.

    Each window with one of the ``hot`` anchors (sorted) is a segment; equal windows have the same anchor, so all are.
    """

    def __init__(self, ids: np.ndarray, texts: pa.Array, window: int, anchor: int, hot: np.ndarray):
        words = Words(texts)
        self.hashes = words.hashes()
        n, first = len(self.hashes), words.first
        owner = np.repeat(np.arange(len(ids)), np.diff(first))
        self.shape = first
        at = np.flatnonzero(first[owner + 1] - np.arange(n) >= window) if n else np.zeros(0, np.int64)
        if not len(at):
            self.rows = np.zeros(0, _ENTRY)
            self.length = self.place = self.owner = np.zeros(0, np.int64)
            return
        grams = np.arange(n - anchor + 1)
        key = span_hashes(self.hashes, grams, grams + anchor)
        best = _leftmost_smallest(key, window - anchor + 1)[at]
        alone = np.isin(key[best], hot)
        head = np.flatnonzero(np.r_[True, (best[1:] != best[:-1]) | (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]]) | alone[1:]])
        start, end = at[head], at[np.r_[head[1:] - 1, len(at) - 1]] + window
        self.place, self.length, self.owner = start, end - start, owner[start]
        self.rows = np.zeros(len(start), _ENTRY)
        self.rows["anchor"] = key[best[head]]
        alone = np.flatnonzero(alone[head])
        if len(alone):
            self.rows["anchor"][alone] = span_hashes(mix(self.hashes), start[alone], end[alone])
        self.rows["content"] = span_hashes(self.hashes, start, end)
        self.rows["doc"] = ids[self.owner]
        self.rows["start"] = start - first[self.owner]


def _leftmost_smallest(key: np.ndarray, width: int) -> np.ndarray:
    """For each place the leftmost place of the smallest key among the next ``width`` (fewer at the end)."""
    best, have = np.arange(len(key)), 1
    while have < width:
        step = min(have, width - have)
        right = best[np.minimum(np.arange(len(key)) + step, len(key) - 1)]
        best = np.where(key[right] < key[best], right, best)
        have += step
    return best


def _blocks(table: pa.Table, text: str) -> Iterator[pa.RecordBatch]:
    """A block in slices of a few megabytes of text, so that working arrays stay small."""
    batch = table.combine_chunks()
    for piece in batch.to_batches():
        offsets = string_buffers(piece.column(text))[0]
        at = 0
        while at < piece.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
            end = min(end, piece.num_rows)
            yield piece.slice(at, end - at)
            at = end


def _first_places(rows: np.ndarray) -> np.ndarray:
    """One row per anchor and content, the earliest."""
    rows = rows[np.lexsort((rows["start"], rows["doc"], rows["content"], rows["anchor"]))]
    return rows[_heads(rows["anchor"], rows["content"])]


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys change."""
    if not len(keys[0]):
        return np.zeros(0, bool)
    change = np.zeros(len(keys[0]) - 1, bool)
    for k in keys:
        change |= k[1:] != k[:-1]
    return np.r_[True, change]


def _deal(keys: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each key."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    keys, rows = keys[order], rows[order]
    cut = np.flatnonzero(_heads(keys))
    for a, b in zip(cut, np.append(cut[1:], len(keys)), strict=True):
        yield int(keys[a]), rows[a:b]


def _messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["target", "block", "kind", "data"])


def _payload(table: pa.Table, dtype: np.dtype) -> np.ndarray:
    found = [np.frombuffer(x.as_buffer(), dtype) for x in table.column("data")]
    return np.concatenate(found) if found else np.zeros(0, dtype)


_SENT, _SPANS, _HOT = 0, 1, 2


def _of_kind(table: pa.Table, kind: int) -> pa.Table:
    return table.filter(pc.equal(table.column("kind"), kind))


def _pack(spans: np.ndarray, hashes: np.ndarray) -> bytes:
    return np.int64(len(spans)).tobytes() + spans.tobytes() + hashes.astype("<u8").tobytes()


def _unpack(data: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    raw = data.as_buffer()
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    return np.frombuffer(raw, _SPAN, n, 8), np.frombuffer(raw, "<u8", offset=8 + n * _SPAN.itemsize)


def _later_windows(spans: np.ndarray, hashes: np.ndarray, window: int) -> np.ndarray:
    """Step 4: stretches of the given segments made of windows that start earlier elsewhere among them."""
    length = spans["length"].astype(np.int64)
    alphabet, symbols = np.unique(hashes, return_inverse=True)
    # the sequences one after the other, a 0 behind each
    start = np.cumsum(length + 1) - (length + 1)
    text = np.zeros(int((length + 1).sum()), np.int64)
    inside = np.ones(len(text), bool)
    inside[start + length] = False
    text[inside] = symbols + 1
    owner = np.repeat(np.arange(len(spans)), length + 1)
    doc, place = spans["doc"][owner], spans["start"][owner] + (np.arange(len(text)) - start[owner])
    order = np.lexsort((place, doc))
    rank = np.empty(len(text), np.int64)
    rank[order] = np.cumsum(_heads(doc[order], place[order])) - 1

    index = FMIndex(text, window)
    earliest = np.minimum.reduceat(rank[index.rows], index.window_start[:-1])
    at, interval = index.matching_windows(text, start, length)
    at = np.sort(at[earliest[interval] < rank[at]])
    if not len(at):
        return np.zeros(0, _SPAN)
    head = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])])
    last = at[np.r_[head[1:] - 1, len(at) - 1]]
    out = np.zeros(len(head), _SPAN)
    out["doc"], out["start"], out["length"] = doc[at[head]], place[at[head]], last - at[head] + window
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``: the words outside repeated windows, joined by a space.

    A word goes if a window of ``window`` words around it has the words of a window that starts earlier: in a document
    of smaller ``doc_id``, or in the same one before it.  Windows are judged on the texts as given.

    Null and empty texts have no words and an empty ``kept_text``; null ids come last, as one id; rows that share an id do
    not count as earlier than each other at the same place, so exact repetitions of a row stay together; texts are taken
    whole; an empty table gives an empty result; columns with the names of the result are replaced.
    Words are compared by 64-bit hashes, segments by pairs of them.
    """
    own = ("n_words", "n_removed", "kept_text")
    docs = docs.select(*[c for c in docs.columns if c.lower() not in own])
    shards = partitions(docs)
    block = fresh(docs, "_block")
    dealt = docs.withColumn(block, F.pmod(F.xxhash64("doc_id"), F.lit(shards * BLOCKS)).cast("int"))
    whole = dealt.repartition(shards, block)

    def firsts_of(table: pa.Table, hot: np.ndarray) -> np.ndarray:
        found = [_first_places(s.rows) for s in _cut(table, hot)]
        return _first_places(np.concatenate(found)) if found else np.zeros(0, _ENTRY)

    def count(key: tuple, table: pa.Table) -> pa.Table:
        anchors, n = np.unique(firsts_of(table, np.zeros(0, np.uint64))["anchor"], return_counts=True)
        rows = np.zeros(len(anchors), _TALLY)
        rows["anchor"], rows["n"] = anchors, n
        shard = (anchors % np.uint64(shards)).astype(np.int32)
        return _messages([(k, key[0].as_py(), _SENT, part.tobytes()) for k, part in _deal(shard, rows)])

    def judge(key: tuple, table: pa.Table) -> pa.Table:
        rows = _payload(table, _TALLY)
        source = np.repeat(table.column("block").to_numpy(), [len(x.as_buffer()) // _TALLY.itemsize for x in table.column("data")])
        _, kind = np.unique(rows["anchor"], return_inverse=True)
        hot = np.bincount(kind, rows["n"])[kind] > HOT if len(rows) else np.zeros(0, bool)
        return _messages([(b, b, _HOT, part.tobytes()) for b, part in _deal(source[hot], rows["anchor"][hot])])

    def announce(key: tuple, table: pa.Table, tallies: pa.Table) -> pa.Table:
        hot, b = np.unique(_payload(tallies, np.dtype("<u8"))), key[0].as_py()
        rows = firsts_of(table, hot)
        shard = (rows["anchor"] % np.uint64(shards)).astype(np.int32)
        messages = [(k, b, _SENT, part.tobytes()) for k, part in _deal(shard, rows)]
        if len(hot):  # comes back with the replies
            messages.append((b % shards, b, _HOT, hot.tobytes()))
        return _messages(messages)

    def _cut(table: pa.Table, hot: np.ndarray) -> Iterator[_Segments]:
        for part in _blocks(table, "text"):
            yield _Segments(_ids(part.column("doc_id")), part.column("text"), window, anchor, hot)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        back = [(b, b, _HOT, x.as_py()) for b, x in zip(_of_kind(table, _HOT)["block"].to_pylist(), _of_kind(table, _HOT)["data"], strict=True)]
        table = _of_kind(table, _SENT)
        rows = _payload(table, _ENTRY)
        source = np.repeat(table.column("block").to_numpy(), [len(x.as_buffer()) // _ENTRY.itemsize for x in table.column("data")])
        order = np.lexsort((rows["start"], rows["doc"], rows["content"], rows["anchor"]))
        rows, source = rows[order], source[order]
        head = _heads(rows["anchor"], rows["content"])
        kind = np.cumsum(head) - 1
        first = np.flatnonzero(head)[kind] if len(rows) else kind
        later = (rows["doc"] != rows["doc"][first]) | (rows["start"] != rows["start"][first])
        by_anchor = np.cumsum(_heads(rows["anchor"])) - 1
        several = np.bincount(by_anchor, head)[by_anchor] > 1 if len(rows) else later
        reply = np.zeros(len(rows), _REPLY)
        reply["anchor"], reply["content"] = rows["anchor"], rows["content"]
        reply["later"], reply["index"] = later, several & ~later
        needed = later | several
        return _messages(back + [(b, b, _SENT, part.tobytes()) for b, part in _deal(source[needed], reply[needed])])

    def send(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        reply, hot = _payload(_of_kind(replies, _SENT), _REPLY), np.unique(_payload(_of_kind(replies, _HOT), np.dtype("<u8")))
        reply = reply[np.lexsort((reply["content"], reply["anchor"]))]
        found = [s for s in _cut(table, hot)]
        firsts = _first_places(np.concatenate([s.rows for s in found])) if found else np.zeros(0, _ENTRY)
        known = mix(reply["anchor"]) ^ reply["content"]
        order = np.argsort(known, kind="stable")
        known, reply = known[order], reply[order]
        own = mix(firsts["anchor"]) ^ firsts["content"]
        by_own = np.argsort(own, kind="stable")
        own, firsts = own[by_own], firsts[by_own]
        messages, spans = [], []
        for s in found:
            if not len(s.rows):
                continue
            name = mix(s.rows["anchor"]) ^ s.rows["content"]
            mine = firsts[np.searchsorted(own, name)]
            here = (s.rows["doc"] == mine["doc"]) & (s.rows["start"] == mine["start"])
            later, index = ~here, np.zeros(len(here), bool)
            if len(known):
                at = np.minimum(np.searchsorted(known, name), len(known) - 1)
                hit = known[at] == name
                later |= hit & (reply["later"][at] == 1)
                index = hit & here & (reply["index"][at] == 1)
            span = np.zeros(len(s.rows), _SPAN)
            span["doc"], span["start"], span["length"] = s.rows["doc"], s.rows["start"], s.length
            spans.append(_joined(span[later]))
            pick = np.flatnonzero(index)
            shard = (s.rows["anchor"][pick] % np.uint64(shards)).astype(np.int32)
            for k, chosen in _deal(shard, pick):
                places = np.concatenate([np.arange(p, p + n) for p, n in zip(s.place[chosen], s.length[chosen], strict=True)])
                messages.append((k, key[0].as_py(), _SENT, _pack(span[chosen], s.hashes[places])))
        if spans and sum(map(len, spans)):
            b = key[0].as_py()
            messages.append((b % shards, b, _SPANS, np.concatenate(spans).tobytes()))
        return _messages(messages)

    def search(key: tuple, table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        source, data = table.column("block").to_pylist(), table.column("data")
        messages = [(source[i], source[i], _SPANS, data[i].as_py()) for i in np.flatnonzero(kind == _SPANS)]
        sent = np.flatnonzero(kind == _SENT)
        if len(sent):
            parts = [_unpack(data[i]) for i in sent]
            spans, hashes = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            home = np.repeat([source[i] for i in sent], [len(p[0]) for p in parts])
            reported = _later_windows(spans, hashes, window)
            by_doc, first = np.unique(spans["doc"], return_index=True)
            block_of = home[first[np.searchsorted(by_doc, reported["doc"])]]
            messages += [(b, b, _SPANS, part.tobytes()) for b, part in _deal(block_of, reported)]
        return _messages(messages)

    keep = docs.columns

    def finish(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        spans = _payload(replies, _SPAN)
        spans = spans[np.argsort(spans["doc"], kind="stable")]
        out = []
        for part in _blocks(table, "text"):
            words = Words(part.column("text"))
            ids, n = _ids(part.column("doc_id")), np.diff(words.first)
            low, high = np.searchsorted(spans["doc"], ids), np.searchsorted(spans["doc"], ids, side="right")
            change = np.zeros(len(words) + 1, np.int64)
            for i in np.flatnonzero(high > low):
                mine = spans[low[i] : high[i]]
                a = np.minimum(mine["start"], n[i]) + words.first[i]
                b = np.minimum(mine["start"] + mine["length"], n[i]) + words.first[i]
                np.add.at(change, a, 1)
                np.add.at(change, b, -1)
            kept = np.cumsum(change)[:-1] == 0
            total = np.r_[0, np.cumsum(kept)]
            left = total[words.first]
            chosen = words.array().filter(pa.array(kept)).cast(pa.string())
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), chosen), " ")
            out.append(
                pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(n, pa.int64()), pa.array(n - np.diff(left), pa.int64()), texts],
                    names=[*keep, "n_words", "n_removed", "kept_text"],
                )
            )
        schema = pa.schema([*(table.schema.field(c) for c in keep), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])
        return pa.Table.from_batches([b.cast(schema) for b in out], schema)

    grouped = whole.groupBy(block)
    tallies = grouped.applyInArrow(count, _MESSAGES).groupBy("target").applyInArrow(judge, _MESSAGES)
    announced = grouped.cogroup(tallies.groupBy("target")).applyInArrow(announce, _MESSAGES)
    replies = announced.groupBy("target").applyInArrow(answer, _MESSAGES)
    sent = grouped.cogroup(replies.groupBy("target")).applyInArrow(send, _MESSAGES)
    reported = sent.groupBy("target").applyInArrow(search, _MESSAGES)
    schema = _with(docs.schema, "n_words bigint, n_removed bigint, kept_text string")
    return grouped.cogroup(reported.groupBy("target")).applyInArrow(finish, schema)


def _joined(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching stretches of a document as one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["start"], spans["doc"]))]
    end = spans["start"] + spans["length"]
    # furthest end so far within the document
    group = np.cumsum(_heads(spans["doc"])) - 1
    wide = group.astype(np.int64) << 32
    reach = np.maximum.accumulate(wide + end)
    head = np.r_[True, (wide + spans["start"])[1:] > reach[:-1]]
    out = spans[head]
    out["length"] = (reach[np.r_[np.flatnonzero(head)[1:] - 1, len(spans) - 1]] & 0xFFFFFFFF) - out["start"]
    return out
