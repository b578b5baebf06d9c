"""Near-duplicate documents by SuperMinHash.

Every shingle owns a pseudo-random permutation of the signature's slots and offers slot ``p(j)`` the value
``j + r`` with ``r`` uniform: the ranks of one shingle are correlated, which lowers the variance of the signature.
Offers come level by level, and a text stops early once no slot can improve.  Bands of the signature give candidates,
full shingle sets verify them, and verified links are grouped by their smallest reachable id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.graph import components
from estate.llm.words import SLICE_BYTES, Words, mix, span_hashes, text_slices
from estate.session import durable

SHINGLE = 2
PERCENT = 80
#: 32 bands of 5: a pair at similarity 0.8 is missed with probability 3e-6, one at 0.9 with 1e-12
BANDS, ROWS = 32, 5
#: rows of a bucket on either side of a comparison, and shingles in a matrix product
CHUNK, WIDTH = 256, 2048


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and the number before each text.

    A-Z are lower-cased.  A text of fewer words is one shingle, one without words has none.
    """
    words = Words(texts)
    hashes, n_words = words.hashes(lower=True), np.diff(words.first)
    n = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    owner = np.repeat(np.arange(len(n)), n)
    at = words.first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    keys = span_hashes(hashes, at, at + np.minimum(n_words[owner], shingle))
    order = np.lexsort((keys, owner))
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return keys[new], np.r_[0, np.cumsum(np.bincount(owner[new], minlength=len(n)))].astype(np.int64)


def signatures(keys: np.ndarray, bounds: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash signature of each set ``keys[bounds[i]:bounds[i + 1]]``; rows of empty sets stay infinite.

    Works level by level on all sets at once.  On level ``j`` a shingle draws the ``j``-th entry of its permutation
    (a swap of the list 0..slots-1, followed back through its earlier swaps) and a fraction.  A set is done after
    level ``j`` if all its slots hold less than ``j + 1``.
    """
    n = len(bounds) - 1
    out = np.full(n * slots, np.inf)
    open_ = np.diff(bounds) > 0
    owner = np.repeat(np.arange(n), np.diff(bounds))
    element, swaps, level = keys, [], 0
    while len(element):
        draw = mix(element + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        fraction = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        other = mix(draw ^ np.uint64(0xA5A5A5A55A5A5A5A))
        place = level + ((other >> np.uint64(32)) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
        slot = place
        for earlier in range(level - 1, -1, -1):
            slot = np.where(swaps[earlier] == slot, earlier, slot)
        np.minimum.at(out, owner * slots + slot, level + fraction)
        level += 1
        if level == slots:
            break
        open_ &= out.reshape(n, slots).max(axis=1) >= level
        stay = open_[owner]
        element, owner = element[stay], owner[stay]
        swaps = [s[stay] for s in (*swaps, place)]
    return out.reshape(n, slots)


def _names(keys: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A 128-bit name of each set."""
    name = np.stack([span_hashes(k, bounds[:-1], bounds[1:]) for k in (keys, mix(keys))], axis=1)
    return pa.array([x.tobytes() for x in name], pa.binary())


def _sign(docs: DataFrame, bands: int, rows: int, shingle: int) -> DataFrame:
    """``_id, n_shingles, _set, _bands``: a 128-bit name of the set and a bucket per band (none for empty sets)."""
    slots = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text", SLICE_BYTES // 2):
                keys, bounds = shingle_sets(part.column("_text"), shingle)
                size = np.diff(bounds)
                full = size > 0
                values = signatures(keys, bounds, slots)[full].view(np.uint64).ravel()
                start = np.arange(len(values) // rows) * rows
                bucket = span_hashes(values, start, start + rows).reshape(-1, bands)
                bucket = mix(bucket ^ mix(np.arange(1, bands + 1, dtype=np.uint64)))
                lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum(full * bands)].astype(np.int32), pa.array(bucket.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(size, pa.int64()), _names(keys, bounds), lists],
                    names=["_id", "n_shingles", "_set", "_bands"],
                )

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"_id {kind}, n_shingles bigint, _set binary, _bands array<bigint>")


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``_set, _keys``: the name of each text's shingle set and the full set as sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                keys, bounds = shingle_sets(part.column("_text"), shingle)
                offsets = (bounds * 8).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(keys)])
                yield pa.RecordBatch.from_arrays([_names(keys, bounds), packed], names=["_set", "_keys"])

    return docs.mapInArrow(run, "_set binary, _keys binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` with ``100 * intersection >= percent * union`` on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            link = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("_x"), batch.column("_y"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = sorted((x, y), key=len)
                if 100 * len(small) < percent * len(large):
                    continue
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                link[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(link))

    joined = pairs.join(sets.select(F.col("_set").alias("a"), F.col("_keys").alias("_x")), "a").join(
        sets.select(F.col("_set").alias("b"), F.col("_keys").alias("_y")), "b"
    )
    return joined.select("a", "b", "_x", "_y").mapInArrow(run, "a binary, b binary")


def _crossed(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between components inside a bucket, from ``bucket, a, ca, ch``: set, its component, the hub's.

    Rows of other components than the hub's are compared with the whole bucket, chunk by chunk of about ``CHUNK`` rows
    on either side, so the size of a bucket bounds no task.  A chunk counts common shingles by matrix products and
    returns one link for each row and component that it reaches, never the pairs.
    """
    other = F.col("ca") != F.col("ch")
    sizes = durable(mixed.groupBy("bucket").agg(*[F.ceil(F.count(x) / CHUNK).alias(n) for x, n in ((F.lit(1), "all_chunks"), (F.when(other, 1), "other_chunks"))]))
    rows = mixed.join(sizes, "bucket")
    own = lambda n: F.pmod(F.xxhash64("a", "bucket"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    left = rows.filter(other).withColumn("o", own("other_chunks")).withColumn("m", each("all_chunks"))
    right = rows.withColumn("m", own("all_chunks")).withColumn("o", each("other_chunks"))
    dealt = left.select("bucket", "o", "m", F.lit(True).alias("left"), "a", "ca").unionByName(right.select("bucket", "o", "m", F.lit(False).alias("left"), "a", "ca"))
    dealt = dealt.join(sets.select(F.col("_set").alias("a"), F.col("_keys").alias("keys")), "a").select("bucket", "o", "m", "left", "a", "ca", "keys")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        left = table.column("left").to_numpy()
        ids = table.column("a").combine_chunks()
        component = pc.rank(table.column("ca").combine_chunks(), tiebreaker="dense").to_numpy()
        lists = [np.frombuffer(k.as_buffer(), np.uint64) for k in table.column("keys")]
        size = np.array([len(x) for x in lists])
        names, row = np.concatenate(lists), np.repeat(np.arange(len(lists)), size)
        shared = np.intersect1d(names[left[row]], names[~left[row]])
        at = np.minimum(np.searchsorted(shared, names), max(len(shared) - 1, 0))
        hit = shared[at] == names if len(shared) else np.zeros(len(names), bool)
        row, at = row[hit], at[hit]
        order = np.argsort(at, kind="stable")
        row, at = row[order], at[order]
        x, y = np.flatnonzero(left), np.flatnonzero(~left)
        both = np.zeros((len(x), len(y)), np.float32)
        for low in range(0, len(shared), WIDTH):
            a, b = np.searchsorted(at, (low, low + WIDTH))
            present = np.zeros((len(lists), WIDTH), np.float32)
            present[row[a:b], at[a:b] - low] = 1
            both += present[x] @ present[y].T
        link = 100 * both >= percent * (size[x][:, None] + size[y][None, :] - both)
        i, j = np.nonzero(link & (component[x][:, None] != component[y][None, :]))
        _, first = np.unique(np.stack([i, component[y][j]]), axis=1, return_index=True) if len(i) else (None, np.zeros(0, np.int64))
        return pa.table({"a": ids.take(pa.array(x[i[first]])), "b": ids.take(pa.array(y[j[first]]))})

    return dealt.groupBy("bucket", "o", "m").applyInArrow(compare, "a binary, b binary")


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, id_column: str = "doc_id"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Documents whose shingle sets have a similarity of ``percent`` or more are linked; ``component_id`` is the smallest
    id reachable by links and ``kept`` says whether that is the document's own.

    Equal sets are one class, compared once.  In each bucket all classes are compared with one of them, chosen by a hash
    that differs from bucket to bucket, so a group of thousands needs a few comparisons per class, not all
    pairs.  What a bucket then still holds of other components is compared with the rest of the bucket as well, so no
    candidate pair is left out unless its ends are connected already.

    Null or wordless text has an empty set and is linked with nothing, nor is a null id (which is its own
    component, null); rows that share an id are one document if their texts agree and linked by the id in any case, and each
    of their texts is compared; texts are taken whole; an empty table gives an empty result; other columns are ignored.
    """
    texts = docs.select(F.col(id_column).alias("_id"), F.col("text").alias("_text"))
    signed = durable(_sign(texts, bands, rows, shingle))
    usable = F.col("_id").isNotNull() & (F.col("n_shingles") > 0)
    member = durable(signed.filter(usable).select("_set", "_id").distinct())
    classes = durable(member.groupBy("_set").agg(F.min("_id").alias("_class")))

    # sets by bucket, each from one of its texts, only of buckets that hold two or more
    bucketed = signed.filter(usable).join(classes.select(F.col("_class").alias("_id"), F.col("_set").alias("_s")), "_id").filter("_set = _s")
    entries = bucketed.select(F.explode("_bands").alias("bucket"), F.col("_set").alias("a"))
    # most buckets hold one set: they are counted by number alone, and only sets of the others are told apart and given a hub
    crowded = durable(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket"))
    together = durable(entries.join(crowded, "bucket", "left_semi")).distinct()
    hubs = together.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("bucket", "a").alias("h"), "a"))["a"].alias("hub"), F.count(F.lit(1)).alias("n"))
    shared = durable(together.join(durable(hubs.filter("n > 1")), "bucket").select("bucket", "a", "hub"))
    pair = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    wanted = durable(shared.select(F.col("a").alias("_set")).distinct().join(classes, "_set"))
    named = _sets(texts.join(wanted.select(F.col("_class").alias("_id")).distinct(), "_id", "left_semi"), shingle)
    sets = durable(named.join(wanted.select("_set"), "_set", "left_semi").dropDuplicates(["_set"]))
    links = durable(_verified(pair(shared.filter("a != hub").select("a", F.col("hub").alias("b"))), sets, percent))

    found = components(links)
    label = lambda ids, key, name: ids.join(found.select(F.col("id").alias(key), F.col("component").alias(name)), key, "left").withColumn(
        name, F.coalesce(name, key)
    )
    labelled = durable(label(label(shared, "a", "ca"), "hub", "ch"))
    others = durable(labelled.filter("ca != ch"))
    if not others.isEmpty():
        mixed = labelled.join(others.select("bucket").distinct(), "bucket", "left_semi")
        links = links.unionByName(durable(_crossed(mixed, sets, percent)))

    # an id with several texts joins their sets; a component is named by the smallest id of its sets
    first = member.groupBy("_id").agg(F.min("_set").alias("a"), F.max("_set").alias("_last")).filter("a != _last")
    same_id = member.join(first, "_id").filter("_set != a").select("a", F.col("_set").alias("b"))
    final = classes.join(components(links.unionByName(same_id)), F.col("_set") == F.col("id"), "left")
    final = durable(final.select("_set", "_class", F.coalesce("component", "_set").alias("_group")))
    lowest = final.groupBy("_group").agg(F.min("_class").alias("component"))
    placed = durable(final.join(lowest, "_group").select("_set", "component"))
    out = signed.select("_id", "n_shingles", F.when(usable, F.col("_set")).alias("_set")).join(placed, "_set", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "_id")).otherwise(F.col("_id"))
    return out.select(F.col("_id").alias("doc_id"), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("_id"), F.lit(True)).alias("kept"))
