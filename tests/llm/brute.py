"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ANY_WORD = re.compile(r"[^\x20\x09-\x0D]+")
TO_LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text: str | None) -> str:
    return (text or "").translate(TO_LOWER)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, window=10):
    """{doc_id: (n_words, n_hit, items)} with windows searched as lists of words."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        words = BENCH_WORD.findall(lower(text))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        words = BENCH_WORD.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                own = windows.get(tuple(words[i : i + n]))
                if own is not None:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in own if x is not None}
        out[doc] = (len(words), len(hit), sorted(found))
    return out


def shingle_set(text, size):
    words = ANY_WORD.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def near_components(docs, size, percent=80):
    """{doc_id: (set size, component)} by comparing all pairs that share a shingle."""
    sets = {doc: shingle_set(text, size) for doc, text in docs}
    holders: dict = {}
    for doc, own in sets.items():
        for s in own:
            holders.setdefault(s, []).append(doc)
    shared: dict = {}
    for own in holders.values():
        for pair in combinations(sorted(own), 2):
            shared[pair] = shared.get(pair, 0) + 1
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {doc: (len(own), find(doc)) for doc, own in sets.items()}


def exact(docs):
    """{doc_id: (keep_id, size)}."""
    groups: dict = {}
    for doc, text in docs:
        groups.setdefault(lower(text), []).append(doc)
    return {d: (max(g), len(g)) for g in groups.values() for d in g}
