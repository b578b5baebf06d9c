"""Plain answers to hold the operators against."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def components(ids, links):
    low = {i: i for i in ids}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                moved = True
    return low


def near_duplicates(docs, percent=80):
    """doc_id -> (n_shingles, component)."""
    sets = {}
    for i, text in docs:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
        sets[i] = {tuple(w[k : k + 2]) for k in range(len(w) - 1)} if len(w) > 1 else ({tuple(w)} if w else set())
    ids = [i for i, s in sets.items() if s]
    links = []
    for a, b in combinations(ids, 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if 100 * small >= percent * large:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (small + large - both):
                links.append((a, b))
    low = components(list(sets), links)
    return {i: (len(s), low[i]) for i, s in sets.items()}


def repeats(docs, window=20):
    """doc_id -> (n_words, n_removed, sha256 of what is left)."""
    first, texts = {}, {i: words(t) for i, t in docs}
    for i in sorted(texts):
        for k in range(len(texts[i]) - window + 1):
            first.setdefault(tuple(texts[i][k : k + window]), (i, k))
    out = {}
    for i, w in texts.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (i, k):
                gone.update(range(k, k + window))
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    lines = Counter(x for x in text.split("\n") if words(x))
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    times = Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if times[g] > 1 for j in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, sum(n - 1 for n in lines.values()), len(covered)
