"""Best-fit packing by minimum bin slack.

Per bin, bitset subset-sum dynamic programming over the available lengths finds the fullest feasible
combination, which is then removed.  Documents of one length are alike to the packing, so it runs on the
number of pieces of each length, a table of at most ``capacity`` rows whatever the corpus, and a combination is
taken as often as the counts allow.  Pieces are then numbered within their length and look up their place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.encoder import WordEncoder
from estate.llm.words import fresh, text_slices, worker_model
from estate.operators.ordering import number_rows
from estate.session import durable

CAPACITY = 4096
#: stretches of an order that are packed apart, and copies of a piece that are
WINDOWS, COPIES = 8, 8
#: id that ends each document
END = 1


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, id_column: str = "doc_id") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each document's ids and ``end``, cut only beyond ``capacity``.

    Null and empty texts are one piece of the end id; texts are taken whole; repeated rows stay.
    """
    text, key = fresh(docs, "_text"), fresh(docs, "_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_model(WordEncoder, tokenizer)
        for batch in batches:
            for part in text_slices(batch, text):
                ids, bounds = encoder.ids(part.column(text))
                lengths = np.diff(bounds) + 1
                n = -(-lengths // capacity)
                owner = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                size = np.minimum(lengths[owner] - start, capacity)
                crc = np.empty(len(owner), np.int64)
                last = np.array([end], "<u4").tobytes()
                flat = ids.astype("<u4", copy=False)
                for i, (d, s, k) in enumerate(zip(owner.tolist(), start.tolist(), size.tolist(), strict=True)):
                    a = int(bounds[d]) + s
                    b = min(a + k, int(bounds[d + 1]))
                    c = zlib.crc32(flat[a:b])
                    crc[i] = zlib.crc32(last, c) if b - a < k else c
                yield pa.RecordBatch.from_arrays(
                    [part.column(key).take(pa.array(owner)), *(pa.array(x, pa.int64()) for x in (start, size, crc)), pa.array(piece, pa.int32())],
                    names=["doc_id", "start", "length", "ids_crc32", "piece"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias(key), F.col("text").alias(text)).mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, piece int"
    )


def slack_patterns(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Combinations of lengths and how often each is used; together they use every piece once.

    Each takes the largest length left, so that no piece is put off for ever, and fills the rest as far as can be.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    lengths = sorted(left, reverse=True)
    patterns: list[tuple[list[int], int]] = []
    while lengths:
        largest = lengths[0]
        room = capacity - largest
        left[largest] -= 1
        mask, reach, full = (1 << room + 1) - 1, 1, 1 << room
        layers: list[tuple[int, int]] = []
        for length in lengths:
            if length > room or not left[length]:
                continue
            for _ in range(min(left[length], room // length)):
                grown = (reach | reach << length) & mask
                if grown == reach:
                    break
                layers.append((length, reach))
                reach = grown
                if reach & full:
                    break
            if reach & full:
                break
        left[largest] += 1
        chosen, total = [largest], reach.bit_length() - 1
        for length, before in reversed(layers):
            if not before >> total & 1:
                chosen.append(length)
                total -= length
        times = min(left[x] // chosen.count(x) for x in set(chosen))
        for x in chosen:
            left[x] -= times
        patterns.append((chosen, times))
        lengths = [x for x in lengths if left[x]]
    return patterns


def _slots(patterns: list[tuple[list[int], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each place of a pattern: its length and first number within the length, first sequence, offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for chosen, times in patterns:
        offset = 0
        for length in chosen:
            first = used.get(length, 0)
            rows.append((length, first, sequence, offset))
            used[length] = first + times
            offset += length
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` ``length``.

    Rows of equal length, id and piece are interchangeable.  Only the counts per length, at most ``capacity``
    rows, reach the driver, and the table of places, whose size depends on them alone, goes to the tasks.
    """
    kept = durable(pieces)
    counts = {int(r["length"]): int(r["n"]) for r in kept.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    length, first, sequence, offset = _slots(slack_patterns(counts, capacity))
    key = length << 48 | first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy() - 1
            at = np.searchsorted(key, size << 48 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(c for c, f in zip(batch.columns, batch.schema.names, strict=True) if f != "_rank"),
                 pa.array(sequence[at] + rank - first[at], pa.int64()), pa.array(offset[at], pa.int64())],
                names=[*(f for f in batch.schema.names if f != "_rank"), "sequence_id", "offset"],
            )

    ranked = number_rows(kept, ["doc_id", "piece"], ["length"], ordinal="_rank")
    fields = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes)
    return ranked.mapInArrow(run, f"{fields}, sequence_id bigint, offset bigint")


def pack_in_order(pieces: DataFrame, order: Sequence[str], capacity: int = CAPACITY, windows: int = WINDOWS, copies: int = COPIES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` so that sequences keep the given order of the pieces, and hold no piece twice.

    The order is cut into ``windows`` of equal numbers of pieces, and the first, second and later copies of a piece are apart; each of
    these groups is packed for itself, from its counts per length, in a task of its own.  Sequences are numbered by their first piece.
    Each group may leave one sequence partly filled.  Beyond ``copies`` repeated rows of a piece, copies may meet again.
    Pieces of equal order are interchangeable; an empty table gives an empty result.
    """
    placed = number_rows(durable(pieces), [*order, "piece"], ordinal="_place")
    numbered = number_rows(placed, ["_place"], ["doc_id", "piece", "ids_crc32"], ordinal="_copy")
    total = numbered.count()
    window = F.floor((F.col("_place") - 1) * windows / max(total, 1))
    grouped = durable(numbered.withColumn("_group", (window * copies + F.pmod(F.col("_copy") - 1, F.lit(copies))).cast("int")).drop("_copy"))

    def fill(table: pa.Table) -> pa.Table:
        counts = dict(zip(table.column("length").to_pylist(), table.column("n").to_pylist(), strict=True))
        columns = _slots(slack_patterns(counts, capacity))
        group = np.full(len(columns[0]), table.column("_group")[0].as_py(), np.int32)
        return pa.table([pa.array(group), *map(pa.array, columns)], names=["_group", "length", "first", "sequence", "offset"])

    counts = grouped.groupBy("_group", "length").agg(F.count(F.lit(1)).alias("n"))
    slots = counts.groupBy("_group").applyInArrow(fill, "_group int, length bigint, first bigint, sequence bigint, offset bigint").toArrow()
    # one row for each place of a pattern: their number depends on groups and lengths, not on the pieces
    slots = slots.sort_by([("_group", "ascending"), ("length", "ascending"), ("first", "ascending")])
    group, length, first, sequence, offset = (slots.column(c).to_numpy() for c in ("_group", "length", "first", "sequence", "offset"))
    key = (group.astype(np.int64) * (capacity + 1) + length) << 40 | first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, size, rank = (batch.column(c).to_numpy() for c in ("_group", "length", "_rank"))
            at = np.searchsorted(key, (own.astype(np.int64) * (capacity + 1) + size) << 40 | (rank - 1), side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence[at] + rank - 1 - first[at], pa.int64()), pa.array(offset[at], pa.int64())],
                names=[*batch.schema.names, "_sequence", "offset"],
            )

    ranked = number_rows(grouped, ["_place"], ["_group", "length"], ordinal="_rank")
    fields = ", ".join(f"`{n}` {t}" for n, t in ranked.dtypes)
    found = durable(ranked.mapInArrow(run, f"{fields}, _sequence bigint, offset bigint"))
    heads = found.groupBy(F.col("_group").alias("_g"), F.col("_sequence").alias("_q")).agg(F.min("_place").alias("_head"))
    named = number_rows(heads, ["_head"], ordinal="sequence_id")
    out = found.join(named, (F.col("_group") == F.col("_g")) & (F.col("_sequence") == F.col("_q")))
    return out.select(*pieces.columns, (F.col("sequence_id") - 1).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``token_pieces`` of ``docs``, packed.

    Null and empty texts are one piece of the end id; texts are taken whole; repeated rows and null ids are documents like all others;
    other columns are ignored; an empty table gives an empty result.
    """
    return pack(token_pieces(docs, tokenizer, capacity, end), capacity)
