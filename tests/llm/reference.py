"""Brute-force versions of the operators, over lists of rows in plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, width=5):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= width:
        return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def alike(a, b):
    shared = len(a & b)
    return bool(a) and bool(b) and 100 * shared >= 80 * (len(a) + len(b) - shared)


def classes(sets):
    """The least member of each set's class, by position."""
    label = list(range(len(sets)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for shingle in s:
            holders[shingle].append(i)
    met = {(i, j) for own in holders.values() for n, i in enumerate(own) for j in own[n + 1 :]}
    for i, j in met:
        if alike(sets[i], sets[j]):
            a, b = find(i), find(j)
            label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def jaccard_classes(rows):
    """``{doc_id: (n_shingles, component_id)}`` of ``(doc_id, text)`` rows with ids of their own."""
    rows = sorted(rows)
    sets = [shingle_set(text) for _, text in rows]
    return {rows[i][0]: (len(sets[i]), rows[c][0]) for i, c in enumerate(classes(sets))}


def repeats(texts, span):
    """Per text (bytes, removed bytes, runs, digest of the rest) when repeated strings of ``span`` bytes go."""
    bodies = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + span] for b in bodies for i in range(len(b) - span + 1))
    result = []
    for b in bodies:
        gone = [False] * len(b)
        for i in range(len(b) - span + 1):
            if counts[b[i : i + span]] > 1:
                gone[i : i + span] = [True] * span
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        result.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return result


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        repeated += bool(WORD.search(line)) and line in seen
        seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeated, len(inside)
