"""Fill-in-the-middle by list arrays.

Per batch: texts are split into units as list arrays, flattened with the index of their text, numbered within it, filtered by
role (before the first cut, between the cuts, after them), made lists again and joined.  No unit becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from estate.llm.words import fresh, text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: percent of the documents that are transformed, and of those that have the suffix first
RATE, SPM_RATE = 90, 20
SEED = "1"
#: a byte that is in no UTF-8 text
_CUT = b"\xff"
#: a run of letters, or any other code point: in bytes, because the cut is no character
_UNIT = rb"[A-Za-z]+|[\x00-\x40\x5b-\x60\x7b-\x7f]|[\xc0-\xff][\x80-\xbf]*"
_COLUMNS = ("n", "form", "prefix_chars", "middle_chars", "output")


def draws(doc_id: Column, seed: str = SEED) -> Column:
    """Four unsigned 32-bit numbers of a document: the first groups of the hash of seed and id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)])


def split_units(texts: pa.Array) -> pa.ListArray:
    """The units of each text as a list; a last, empty one ends each list."""
    return pc.split_pattern(pc.replace_substring_regex(texts, pattern=_UNIT, replacement=rb"\0" + _CUT), pattern=_CUT)


def _pieces(units: pa.ListArray, n: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    """The units up to the first cut, between the cuts and after them, joined for each text."""
    flat, parent = units.flatten(), pc.list_parent_indices(units).to_numpy()
    starts = np.cumsum(n + 1) - (n + 1)
    ordinal = np.arange(len(flat)) - starts[parent]
    after_first, after_second = ordinal >= first[parent], ordinal >= second[parent]
    roles = ((~after_first, first), (after_first & ~after_second, second - first), (after_second, n + 1 - second))
    found = []
    for role, counts in roles:
        offsets = np.zeros(len(n) + 1, np.int32)
        np.cumsum(counts, out=offsets[1:])
        found.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), flat.filter(pa.array(role))), b""))
    return found


def transform(texts: pa.Array, drawn: np.ndarray, rate: int = RATE, spm_rate: int = SPM_RATE) -> list[pa.Array]:
    """``n, form, prefix_chars, middle_chars, output`` of the texts; ``drawn`` has four numbers a row."""
    data = texts.fill_null("").cast(pa.binary())
    units = split_units(data)
    n = pc.list_value_length(units).to_numpy().astype(np.int64) - 1
    cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
    prefix, middle, suffix = _pieces(units, n, cuts[:, 0], cuts[:, 1])
    marked = np.zeros(len(n), bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.match_substring(data, mark.encode()).to_numpy(zero_copy_only=False)
    plain = pa.array((n == 0) | marked | (drawn[:, 2] % 100 >= rate))
    spm = pa.array(drawn[:, 3] % 100 < spm_rate)
    p, s, m = (pa.scalar(x.encode(), pa.binary()) for x in (PREFIX, SUFFIX, MIDDLE))
    none = pa.scalar(b"", pa.binary())
    psm_text = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    spm_text = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    output = pc.if_else(plain, data, pc.if_else(spm, spm_text, psm_text))
    form = pc.if_else(plain, PLAIN, pc.if_else(spm, SPM, PSM))
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(x.cast(pa.string())).cast(pa.int64())) for x in (prefix, middle)]
    return [pa.array(n), form, *chars, output.cast(pa.string())]


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: str = SEED, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``; columns of these names are replaced.

    Null text counts as empty; an empty text is plain, and so is one that holds a mark, whose output could not be taken apart; texts are
    taken whole, and a task holds one slice of texts, or one longer text, with some 30 bytes a unit; rows of one id are
    cut by the same numbers; repeated rows stay; an empty table gives an empty result.
    """
    keep = [c for c in docs.columns if c.lower() not in _COLUMNS]
    text, drawn = fresh(docs, "_text"), fresh(docs, "_drawn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                numbers = part.column(drawn).flatten().to_numpy().reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), *transform(part.column(text), numbers, rate, spm_rate)], names=[*keep, *_COLUMNS]
                )

    more = _parse_datatype_string("n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    ready = docs.select(*keep, F.col("text").alias(text), draws(F.col(id_column), seed).alias(drawn))
    return ready.mapInArrow(run, StructType([*docs.select(*keep).schema.fields, *more.fields]))


def restored(output: Column, form: Column) -> Column:
    """The text of an output.  Texts that hold a mark are plain, so the first mark of each kind is the one that was put in."""
    body = lambda a, b: F.substring(output, a, b)
    at_s, at_p, at_m = (F.locate(mark, output) for mark in (SUFFIX, PREFIX, MIDDLE))
    middle = body(at_m + 3, F.length(output))
    psm = F.concat(body(F.lit(4), at_s - 4), middle, body(at_s + 3, at_m - at_s - 3))
    spm = F.concat(body(at_p + 3, at_m - at_p - 3), middle, body(F.lit(4), at_p - 4))
    return F.when(form == PLAIN, output).when(form == PSM, psm).otherwise(spm)
