"""Classification columns.  Rules are data, compiled to ``when`` chains; first match wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from estate.functions import paths, rules


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_match(tests: Sequence[tuple[Column, Column | str]], otherwise: Column | str) -> Column:
    chain: Column | None = None
    for test, label in tests:
        value = F.lit(label) if isinstance(label, str) else label
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    last = F.lit(otherwise) if isinstance(otherwise, str) else otherwise
    return last if chain is None else chain.otherwise(last)


def match_rules(text: Column | str, rule_list, otherwise: Column | str) -> Column:
    """Rules ``(label, codes, words)``: codes match the raw text, words the lower-cased text."""
    raw = F.coalesce(_col(text), F.lit(""))
    low = F.lower(raw)
    tests = []
    for label, codes, words in rule_list:
        hit = F.lit(False)
        for code in codes:
            hit = hit | F.contains(raw, F.lit(code))
        for word in words:
            hit = hit | F.contains(low, F.lit(word))
        tests.append((hit, label))
    return first_match(tests, otherwise)


def classify_error(error: Column | str, rule_set: str = "log", detail_chars: int | None = rules.DETAIL_PREFIX_CHARS) -> Column:
    """Failure class under one of the rule sets log, monitor, insight, insight_detail.

    An unnamed class of ``insight_detail`` is the text before the first colon, cut to ``detail_chars``; None keeps it whole, so that
    causes which differ late stay apart.
    """
    text = _col(error)
    if rule_set == "insight_detail":
        known = F.coalesce(text, F.lit(rules.UNKNOWN_ERROR))
        prefix = F.substring_index(known, ":", 1)
        detail = F.when(
            F.contains(known, F.lit(":")),
            prefix if detail_chars is None else F.left(prefix, F.lit(detail_chars)),
        ).otherwise(F.lit(rules.ERROR_OTHERWISE["insight"]))
        return match_rules(text, rules.ERROR_RULES["insight"], detail)
    return match_rules(text, rules.ERROR_RULES[rule_set], rules.ERROR_OTHERWISE[rule_set])


def error_prefix(error: Column | str) -> Column:
    """Text before the first colon."""
    return F.substring_index(F.coalesce(_col(error), F.lit(rules.UNKNOWN_ERROR)), ":", 1)


def document_type(name: Column | str) -> Column:
    low = F.lower(_col(name))
    tests = [(F.contains(low, F.lit(word)), label) for word, label in rules.DOCUMENT_WORDS]
    for suffixes, label in rules.DOCUMENT_EXTENSIONS:
        hit = F.lit(False)
        for suffix in suffixes:
            hit = hit | F.endswith(low, F.lit(suffix))
        tests.append((hit, label))
    return first_match(tests, rules.DOCUMENT_OTHERWISE)


def truncate_message(text: Column | str, chars: int = rules.MESSAGE_CHARS) -> Column:
    t = _col(text)
    return F.when(F.length(t) > chars, F.concat(F.left(t, F.lit(chars)), F.lit("..."))).otherwise(t)


def path_tail(path: Column | str, chars: int = rules.PATH_TAIL_CHARS) -> Column:
    return F.right(_col(path), F.lit(chars))


def is_transfer_type(name: Column | str) -> Column:
    return paths.extension(name).isin(rules.TRANSFER_EXTENSIONS)
