"""Embedding near-duplicates by int8 tile products.

Unit vectors are quantised to ``scale * int8`` and the norm of what that leaves out is kept per vector.  The
product of two quantised vectors then misses their cosine by at most ``e1 + e2 + e1 * e2``.  What is left out is
quantised once more, with a bound of its own.  Codes, scales and bounds travel, two bytes a component; a pair that the
first codes cannot rule out is looked at with both, and only one that is still within the bounds of the threshold
fetches its two vectors and is computed in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.llm.graph import components
from estate.operators.ordering import number_in_place
from estate.session import durable

COSINE = 0.9
#: vectors in a tile, fewest tiles where there are enough vectors for as many small ones, and rows multiplied at once
TILE, SMALL_TILE, LEAST_TILES, STRIP = 16384, 2048, 4, 256
#: pairs of a task that are held before they become a forest
HELD = 1 << 20
_CODES = "weight bigint, width int, code binary, scale double, error double, fine_scale double, fine_error double"
_MET = "id bigint, links bigint, root bigint, other bigint"


def _valid(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _unit(values: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaling by the largest component first keeps squares in range."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt(np.einsum("ij,ij->i", values, values))[:, None]


def quantise(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, scales, and upper bounds of the norms of the quantisation errors."""
    scale = np.abs(rows).max(axis=1) / 127
    scale = np.where(scale > 0, scale, 1.0)
    codes = np.rint(rows / scale[:, None]).astype(np.int8)
    left = rows - codes * scale[:, None]
    return codes, scale, np.sqrt(np.einsum("ij,ij->i", left, left)) * (1 + 1e-9) + 1e-12


def _rows(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _unit(flat.reshape(len(column), -1))


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both codes of each vector, with scales and bounds; vectors of one length at a time."""
    for batch in batches:
        widths = pc.list_value_length(batch.column("vector"))
        for width in pc.unique(widths).to_pylist():
            part = batch.filter(pc.equal(widths, width))
            unit = _rows(part.column("vector"))
            codes, scale, error = quantise(unit)
            fine, fine_scale, fine_error = quantise(unit - codes * scale[:, None])
            n = part.num_rows
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * (2 * width))
            code = pa.Array.from_buffers(pa.binary(), n, [None, offsets.buffers()[1], pa.py_buffer(np.hstack([codes, fine]).tobytes())])
            yield pa.RecordBatch.from_arrays(
                [part.column("_h2"), part.column("low"), part.column("vector"), part.column("weight"), pa.array(np.full(n, width, np.int32)), code]
                + [pa.array(x) for x in (scale, error, fine_scale, fine_error)],
                names=["_h2", "low", "vector", *(f.split()[0] for f in _CODES.split(", "))],
            )


class _Side:
    """The codes of some classes of one tile."""

    def __init__(self, table: pa.Table, rows: np.ndarray, width: int):
        table = table.take(pa.array(rows))
        both = np.frombuffer(b"".join(table.column("code").to_pylist()), np.int8).reshape(len(rows), 2 * width)
        self.codes, self.fine = both[:, :width], both[:, width:]
        self.scale, self.error, self.fine_scale, self.fine_error = (table.column(c).to_numpy() for c in ("scale", "error", "fine_scale", "fine_error"))

    def near(self, rows: np.ndarray) -> np.ndarray:
        """The vectors as both codes give them."""
        return self.codes[rows] * self.scale[rows, None] + self.fine[rows] * self.fine_scale[rows, None]


def _close(x: _Side, y: _Side, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Index pairs that may reach the threshold, and whether they do so for certain; of a tile with itself each pair once."""
    # sums of products of int8 are whole numbers far below 2**24 x 2 for rows up to 1000 long: float32 tiles are exact there
    kind = np.float32 if x.codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
    right = y.codes.T.astype(kind)
    for a in range(0, len(x.codes), STRIP):
        strip = slice(a, a + STRIP)
        product = x.codes[strip].astype(kind) @ right
        # (threshold - bound) / scales, as one comparison per pair
        slack = threshold - 1e-9 - x.error[strip, None] - y.error[None, :] * (1 + x.error[strip, None])
        i, j = np.nonzero(product >= slack / (x.scale[strip, None] * y.scale[None, :]) * (1 - 1e-6) - 1e-3)
        i += a
        if same:
            i, j = i[i < j], j[i < j]
        for b in range(0, len(i), 1 << 14):
            p, q = i[b : b + (1 << 14)], j[b : b + (1 << 14)]
            value = np.einsum("ij,ij->i", x.near(p), y.near(q))
            bound = x.fine_error[p] + y.fine_error[q] * (1 + x.fine_error[p])
            may = value + bound >= threshold
            yield p[may], q[may], (value - bound >= threshold)[may]


def _exact(threshold: float):
    """Keeps the pairs of vectors ``one`` and ``two`` whose cosine, in double precision, reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = pc.list_value_length(batch.column("one"))
            for width in pc.unique(widths).to_pylist():
                part = batch.filter(pc.equal(widths, width))
                keep = np.einsum("ij,ij->i", _rows(part.column("one")), _rows(part.column("two"))) >= threshold
                yield part.filter(pa.array(keep)).select(["a", "b", "weight_a", "weight_b"])

    return run


def _forest(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """A link from each vertex to the smallest one of its component: the components of many pairs, not the pairs."""
    label = np.arange(n)
    while True:
        before = label.copy()
        for p, q in pairs:
            low = np.minimum(label[p], label[q])
            np.minimum.at(label, p, low)
            np.minimum.at(label, q, low)
        label = label[label]
        if (label == before).all():
            child = np.flatnonzero(label != np.arange(n))
            return child, label[child]


def neighbours(vectors: DataFrame, threshold: float = COSINE, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row.

    Equal vectors are one class with a weight, so a vector that a third of all rows hold is compared once.  Classes are numbered,
    and tiles of at most ``TILE`` of them meet pairwise; a pair of tiles returns the number of links of each vector and a
    spanning forest, at most a row per vector, however many pairs are close.  Pairs that the codes leave open leave the task in
    batches and are settled by two joins on the number of the class.  Vectors of different length are not compared.

    Vectors that are null, empty or zero or hold null or non-finite components link with nothing; rows with a
    null id count as links of others but have no component; repeated ids are linked by their id only if their
    vectors are; an empty table gives an empty result; other columns are ignored.
    """
    source = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
    # a negative zero is a zero
    usable = source.filter(_valid(F.col("vector"))).withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, F.lit(0)).otherwise(x)))
    named = durable(usable.select("id", F.md5(F.to_json(F.struct("vector"))).alias("_h2"), "vector"))
    classes = named.groupBy("_h2").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("weight"), F.first("vector").alias("vector"))
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema.fields}
    coded = durable(classes.mapInArrow(_encode, f"_h2 string, low {kinds['low']}, vector {kinds['vector']}, {_CODES}"))
    numbered = durable(number_in_place(coded, ["_h2"], ordinal="id"))
    count = numbered.count()
    tiles = max(1, math.ceil(count / TILE), min(LEAST_TILES, math.ceil(count / SMALL_TILE)))
    # tile t meets every other one once: it goes to all pairs that hold it
    tile = F.pmod("id", F.lit(tiles))
    partner = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tiles - 1).cast("bigint")))
    dealt = numbered.select("id", tile.alias("tile"), partner.alias("_p"), *[f.split()[0] for f in _CODES.split(", ")]).withColumn(
        "pair", F.least("tile", "_p") * tiles + F.greatest("tile", "_p")
    )

    def compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = key[0].as_py()
        low, high = divmod(key[1].as_py(), tiles)
        table = pa.Table.from_batches(list(batches))
        tile, ids, weight = (table.column(c).to_numpy() for c in ("tile", "id", "weight"))
        a = np.flatnonzero(tile == low)
        b = a if low == high else np.flatnonzero(tile == high)
        x = _Side(table, a, width)
        y = x if low == high else _Side(table, b, width)
        links = np.zeros(len(ids), np.int64)
        found, held = [], 0
        none = lambda n: pa.nulls(n, pa.int64())
        for p, q, certain in _close(x, y, threshold, low == high):
            p, q = a[p], b[q]
            unsure = np.flatnonzero(~certain)
            if len(unsure):
                yield pa.RecordBatch.from_arrays([pa.array(ids[p[unsure]]), none(len(unsure)), none(len(unsure)), pa.array(ids[q[unsure]])], names=["id", "links", "root", "other"])
            p, q = p[certain], q[certain]
            np.add.at(links, p, weight[q])
            np.add.at(links, q, weight[p])
            found.append((p, q))
            held += len(p)
            if held > HELD:
                found, held = [_forest(len(ids), found)], 0
        root = np.arange(len(ids))
        child, to = _forest(len(ids), found)
        root[child] = to
        some = np.flatnonzero(links > 0)
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(ids[root[some]]), none(len(some))], names=["id", "links", "root", "other"])

    met = durable(dealt.drop("_p").groupBy("width", "pair").applyInArrow(compare, _MET))
    one, two = (numbered.select(F.col("id").alias(k), F.col("vector").alias(v), F.col("weight").alias(f"weight_{k}")) for k, v in (("a", "one"), ("b", "two")))
    open_ = met.filter("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b"))
    settled = durable(open_.join(one, "a").join(two, "b").mapInArrow(_exact(threshold), "a bigint, b bigint, weight_a bigint, weight_b bigint"))
    sure = met.filter("other IS NULL")
    ends = F.array(F.struct(F.col("a").alias("id"), F.col("weight_b").alias("links")), F.struct(F.col("b").alias("id"), F.col("weight_a").alias("links")))
    total = sure.select("id", "links").unionByName(settled.select(F.inline(ends))).groupBy("id").agg(F.sum("links").alias("links"))
    edges = sure.filter("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(settled.select("a", "b"))
    found = components(edges).withColumnRenamed("component", "group")
    weighted = durable(numbered.select("_h2", "id", "low", "weight").join(total, "id", "left").join(found, "id", "left").withColumn("group", F.coalesce("group", "id")))
    lowest = durable(weighted.groupBy("group").agg(F.min("low").alias("component")))
    by_class = durable(weighted.join(lowest, "group").select("_h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component"))
    linked = named.select("id", "_h2").join(by_class, "_h2").select("id", "n_links", "component")
    alone = source.filter(~_valid(F.col("vector"))).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    both = linked.unionByName(alone)
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return both.select(F.col("id").alias("vec_id"), "n_links", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
