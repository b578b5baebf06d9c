"""Hard negatives by rotated one-bit codes.

A vector is rotated at random and stored as the signs of its components, its norm and its alignment, the cosine ``a`` of the
vector and its code.  With ``t`` the product of a code and an anchor, the product of vector and anchor is the norm times
``a t``, give or take ``sqrt(1 - a^2) sqrt(|anchor|^2 - t^2)``: what the code leaves out is orthogonal to it, and Cauchy and
Schwarz bound the rest.  Popcounts over the bit planes of the anchor give ``t`` to a known error.  Only rows whose interval
may reach what is sought are scored, in whole numbers.

Anchors are a stated query set.  They meet all rows in blocks of a bounded size, one scan of the codes a block and
search; a task keeps the best few rows per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.llm.words import worker_model
from estate.operators.ordering import number_rows
from estate.session import durable, new_location

POSITIVES, NEGATIVES = 5, 10
#: the scores of negatives lie between these percentages of the positive's
LOW, HIGH = 30, 90
SCALE = 256
#: bits of a component of an anchor
PLANES = 6
#: bytes of the anchors that meet the rows at once, and rows and anchors whose products are estimated at once
BLOCK_BYTES, ROWS, ANCHORS = 8 << 20, 1024, 512
_LEAST = np.iinfo(np.int64).min


def rotation(width: int) -> np.ndarray:
    """An orthogonal matrix, the same on every machine."""
    q, r = np.linalg.qr(np.random.default_rng(width).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code words, norms and alignments of the rows."""
    width = vectors.shape[1]
    values = vectors.astype(np.float64)
    norm = np.sqrt(np.einsum("ij,ij->i", values, values))
    turned = values @ worker_model(rotation, width) if width else values
    bits = np.zeros((len(values), -(-width // 64) * 64), np.uint8)
    bits[:, :width] = turned >= 0
    with np.errstate(invalid="ignore", divide="ignore"):
        align = np.where(norm > 0, np.abs(turned).sum(axis=1) / (norm * np.sqrt(max(width, 1))), 1.0)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64), norm, np.minimum(align, 1.0)


class Anchors:
    """Anchors of one width, ready to be met by codes."""

    def __init__(self, number: np.ndarray, ids: np.ndarray, label: np.ndarray, vectors: np.ndarray):
        self.number, self.ids, self.label, self.vectors = number, ids, label, vectors
        self.width = width = vectors.shape[1]
        values = vectors.astype(np.float64)
        self.square = np.einsum("ij,ij->i", values, values)
        turned = values @ rotation(width) if width else values
        low = turned.min(axis=1, initial=0)
        step = np.maximum(turned.max(axis=1, initial=0) - low, 1e-300) / ((1 << PLANES) - 1)
        level = np.rint((turned - low[:, None]) / step[:, None])
        near = low[:, None] + level * step[:, None]
        root = np.sqrt(max(width, 1))
        self.low, self.step, self.root = low, step, root
        self.sum = near.sum(axis=1)
        # the error of a product with any code, and a margin for rounding
        self.error = np.abs(turned - near).sum(axis=1) / root + 1e-9 * (np.sqrt(self.square) + 1)
        bits = np.zeros((PLANES, len(values), -(-width // 64) * 64), np.uint8)
        for k in range(PLANES):
            bits[k, :, :width] = level.astype(np.int64) >> k & 1
        self.planes = np.packbits(bits, axis=2, bitorder="little").view(np.uint64)

    def interval(self, code: np.ndarray, norm: np.ndarray, align: np.ndarray, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the products of rows and the anchors of ``part``."""
        ones = np.zeros((len(code), part.stop - part.start), np.int32)
        for k in range(PLANES):
            for w in range(code.shape[1]):
                ones += np.bitwise_count(code[:, w, None] & self.planes[k, part, w]).astype(np.int32) << k
        own = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        t = 2 * (own[:, None] * self.low[part] + ones * self.step[part]) - self.sum[part]
        t /= self.root
        error = self.error[part]
        least = np.maximum(np.abs(t) - error, 0)
        rest = np.sqrt(np.maximum(self.square[part] - least * least, 0))
        rest *= np.sqrt(np.maximum(1 - align * align, 0) + 1e-12)[:, None]
        rest += align[:, None] * error + 1e-9 * np.sqrt(self.square[part])
        t *= align[:, None]
        return (t - rest) * norm[:, None] - 1e-6, (t + rest) * norm[:, None] + 1e-6


def _scores(rows: np.ndarray, anchors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whole-number products of ``rows[i]`` and ``anchors[j]``."""
    most = int(np.abs(rows).max(initial=0)) * int(np.abs(anchors).max(initial=0)) * max(1, rows.shape[1])
    if most >= 1 << 63:
        raise OverflowError("a product of these vectors does not fit a long")
    if most < 1 << 53 and len(i) * 8 > len(rows) * len(anchors):  # sums of whole numbers below 2**53 are exact in doubles
        return (rows.astype(np.float64) @ anchors.astype(np.float64).T)[i, j].astype(np.int64)
    out = np.empty(len(i), np.int64)
    for a in range(0, len(i), 1 << 16):
        out[a : a + (1 << 16)] = np.einsum("ij,ij->i", rows[i[a : a + (1 << 16)]], anchors[j[a : a + (1 << 16)]])
    return out


class _Best:
    """The first ``keep`` rows of each list by score, then id, nulls last; ``least`` is the score a new row needs."""

    def __init__(self, lists: int, keep: int):
        self.keep = keep
        self.least = np.full(lists, _LEAST)
        self.rows = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.bool_, np.int64))

    def add(self, at: np.ndarray, score: np.ndarray, absent: np.ndarray, ids: np.ndarray) -> None:
        at, score, absent, ids = (np.concatenate(x) for x in zip(self.rows, (at, score, absent, ids), strict=True))
        order = np.lexsort((ids, absent, -score, at))
        at = at[order]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
        chosen = order[rank < self.keep]
        last = rank == self.keep - 1
        self.least[at[last]] = score[order[last]]
        self.rows = at[rank < self.keep], score[chosen], absent[chosen], ids[chosen]


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """``ids, absent, label, vectors, code, norm, align`` of the rows of each width."""
    for width in pc.unique(batch.column("width")).to_pylist():
        part = batch.filter(pc.equal(batch.column("width"), width))
        ids = part.column("id")
        n = part.num_rows
        vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(n, width)
        words = -(-width // 64)
        code = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint64).reshape(n, words)
        yield (
            width, ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), part.column("label"),
            vectors, code, part.column("norm").to_numpy(), part.column("align").to_numpy(),
        )


def _search(batches: Iterator[pa.RecordBatch], blocks: dict[int, Anchors], labels: pa.Array, same: bool, bands: dict[int, tuple], keep: int):
    """Per width the lists of a task: the best rows of the anchor's label, or of other labels within each of the anchor's bands."""
    lists = {w: _Best(len(a.ids) * (1 if same else bands[w][0].shape[1]), keep) for w, a in blocks.items()}
    for batch in batches:
        for width, ids, absent, label, vectors, code, norm, align in _rows_of(batch):
            if width not in blocks:
                continue
            anchors, best = blocks[width], lists[width]
            group = pc.index_in(label, value_set=labels).fill_null(-1).to_numpy(zero_copy_only=False)
            for r in range(0, len(ids), ROWS):
                rows = slice(r, min(r + ROWS, len(ids)))
                for a in range(0, len(anchors.ids), ANCHORS):
                    part = slice(a, min(a + ANCHORS, len(anchors.ids)))
                    low, high = anchors.interval(code[rows], norm[rows], align[rows], part)
                    alike = group[rows, None] == anchors.label[part]
                    if same:
                        other = absent[rows, None] | (ids[rows, None] != anchors.ids[part])
                        i, j = np.nonzero(alike & other & (high >= best.least[part]))
                    else:
                        floor, ceiling = (b[part] for b in bands[width])
                        need = np.maximum(floor, best.least.reshape(bands[width][0].shape)[part]).astype(np.float64)
                        need[floor > ceiling] = np.inf
                        i, j = np.nonzero(~alike & (high >= need.min(axis=1)) & (low <= ceiling.max(axis=1)))
                    if not len(i):
                        continue
                    score = _scores(vectors[rows], anchors.vectors[part], i, j)
                    if same:
                        good = score >= best.least[part][j]
                        best.add(j[good] + a, score[good], absent[rows][i[good]], ids[rows][i[good]])
                        continue
                    times = floor.shape[1]
                    for b in range(times):
                        good = (score >= floor[j, b]) & (score <= ceiling[j, b]) & (score >= best.least[(j + a) * times + b])
                        if good.any():
                            best.add((j[good] + a) * times + b, score[good], absent[rows][i[good]], ids[rows][i[good]])
    return lists


def _valid(label: Column, vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return label.isNotNull() & vector.isNotNull() & F.coalesce(finite, F.lit(False))


def code_vectors(vectors: DataFrame, anchor: Column, scale: int, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``id, label, is_anchor, width, vector, code, norm, align``: whole-number vectors with their codes."""
    doubles = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    narrow = vectors.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(label_column).cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"), doubles.alias("vector"),
    )
    usable = narrow.filter(_valid(F.col("label"), F.col("vector")))
    whole = usable.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("bigint"))).withColumn("width", F.size("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width in pc.unique(batch.column("width")).to_pylist():
                part = batch.filter(pc.equal(batch.column("width"), width))
                n = part.num_rows
                code, norm, align = encode(part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(n, width))
                packed = pa.array([x.tobytes() for x in code], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, packed, pa.array(norm), pa.array(align)], names=[*part.schema.names, "code", "norm", "align"])

    return whole.mapInArrow(run, "id bigint, label string, is_anchor boolean, vector array<bigint>, width int, code binary, norm double, align double")


def _first(found: DataFrame, keys: list[str], keep: int, rank: str) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= keep)


def mine_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``, a score is the inner product of the whole numbers; higher ones come first, equal ones by id.
    An anchor is a row for which ``anchor`` holds; its positives are its first rows of the same label and another id.  For each, the
    first rows of other labels whose score is at least ``low`` and at most ``high`` percent of the positive's are returned.

    Rows with a null label, a null vector or a null or non-finite component take no part.  Vectors of different length are not
    compared.  A row with a null id is no anchor unless ``anchor`` says so; among equal scores it comes last.  Repeated rows
    all count, and each row that is an anchor has its own lists.  No anchors, or an empty table, give an empty
    result; other columns are ignored.  Products that no long can hold are an error.
    """
    spark = vectors.sparkSession
    coded = durable(code_vectors(vectors, anchor, scale, id_column, vector_column, label_column))
    chosen = coded.filter("is_anchor").select("id", "label", "width", "vector", F.xxhash64("vector").alias("_tie"))
    numbered = durable(number_rows(chosen, [F.col("id").asc_nulls_last(), "label", "_tie"], ordinal="number"))
    n, widest = numbered.agg(F.count(F.lit(1)), F.max("width")).first()
    size = max(1, block_bytes // (8 * max(1, widest or 1)))
    folder, parts = new_location(spark, "negatives"), []
    for start in range(0, n, size):
        held = numbered.filter((F.col("number") > start) & (F.col("number") <= start + size)).toArrow().combine_chunks()
        blocks, labels = _anchor_blocks(held)

        def nearest(batches, blocks=blocks, labels=labels):
            for width, best in _search(batches, blocks, labels, True, {}, positives).items():
                at, score, absent, ids = best.rows
                yield pa.RecordBatch.from_arrays([pa.array(blocks[width].number[at]), pa.array(score), pa.array(ids, mask=absent)], names=["number", "score", "id"])

        narrow = coded.drop("is_anchor")
        near = _first(narrow.mapInArrow(nearest, "number bigint, score bigint, id bigint"), ["number"], positives, "place").toArrow()
        bands, chosen_positives = _bands(blocks, near, positives, low, high)

        def within(batches, blocks=blocks, labels=labels, bands=bands, chosen_positives=chosen_positives):
            for width, best in _search(batches, blocks, labels, False, bands, negatives).items():
                at, score, absent, ids = best.rows
                place = at % positives
                who = at // positives
                found, none, own = (x[who, place] for x in chosen_positives[width])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks[width].number[who]), pa.array(blocks[width].ids[who]), pa.array(place), pa.array(found, mask=none),
                     pa.array(own), pa.array(score), pa.array(ids, mask=absent)],
                    names=["number", "anchor_id", "place", "positive_id", "positive_score", "score", "id"],
                )

        met = narrow.mapInArrow(within, "number bigint, anchor_id bigint, place bigint, positive_id bigint, positive_score bigint, score bigint, id bigint")
        parts.append(f"{folder}/{start}")
        _first(met, ["number", "place"], negatives, "rank").write.parquet(parts[-1])
    schema = "number bigint, anchor_id bigint, place bigint, positive_id bigint, positive_score bigint, score bigint, id bigint, rank int"
    found = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
    return found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _anchor_blocks(held: pa.Table) -> tuple[dict[int, Anchors], pa.Array]:
    """The anchors of a block by width, with their labels as places in the array of labels."""
    labels = pc.unique(held.column("label"))
    blocks = {}
    for width in pc.unique(held.column("width")).to_pylist():
        part = held.filter(pc.equal(held.column("width"), width)).combine_chunks()
        vectors = pc.list_flatten(part.column("vector")).to_numpy().reshape(part.num_rows, width)
        group = pc.index_in(part.column("label"), value_set=labels).to_numpy()
        blocks[width] = Anchors(part.column("number").to_numpy(), part.column("id").fill_null(0).to_numpy(), group, vectors)
    return blocks, labels


def _bands(blocks: dict[int, Anchors], near: pa.Table, positives: int, low: int, high: int) -> tuple[dict, dict]:
    """Least and greatest score of the negatives for each anchor and positive, and the positives themselves."""
    number, place = near.column("number").to_numpy(), near.column("place").to_numpy() - 1
    score, ids = near.column("score").to_numpy(), near.column("id")
    absent, ids = ids.is_null().to_numpy(), ids.fill_null(0).to_numpy()
    bands, chosen = {}, {}
    for width, anchors in blocks.items():
        shape = (len(anchors.ids), positives)
        floor, ceiling = np.ones(shape, np.int64), np.zeros(shape, np.int64)  # empty where there is no positive
        found, none, own = np.zeros(shape, np.int64), np.zeros(shape, bool), np.zeros(shape, np.int64)
        order = np.argsort(anchors.number)
        at = np.minimum(np.searchsorted(anchors.number, number, sorter=order), len(order) - 1)
        who = order[at]
        mine = anchors.number[who] == number
        who, where = who[mine], place[mine]
        floor[who, where] = [-(-low * s // 100) for s in score[mine].tolist()]
        ceiling[who, where] = [high * s // 100 for s in score[mine].tolist()]
        found[who, where], none[who, where], own[who, where] = ids[mine], absent[mine], score[mine]
        bands[width], chosen[width] = (floor, ceiling), (found, none, own)
    return bands, chosen
