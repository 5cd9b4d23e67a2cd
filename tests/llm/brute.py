"""Plain Python versions of the near-duplicate rules, for small fixtures."""

import re
from collections import defaultdict
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text, k):
    w = WORD.findall((text or "").translate(UPPER))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def components(rows, k, threshold: Fraction):
    """rows: (id, text); ids may repeat. Returns id -> component."""
    sets = [(i, frozenset(shingles(t, k))) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(a, b):
        a, b = sorted((root(a), root(b)))
        parent[b] = a

    first = {}
    for i, s in sets:
        if s:
            join(first.setdefault(s, i), i)
    distinct = list(first)
    where = defaultdict(list)
    for n, s in enumerate(distinct):
        for g in s:
            where[g].append(n)
    for n, s in enumerate(distinct):
        shared = defaultdict(int)
        for g in s:
            for m in where[g]:
                if m < n:
                    shared[m] += 1
        for m, c in shared.items():
            if c >= threshold * (len(s) + len(distinct[m]) - c):
                join(first[s], first[distinct[m]])
    return {i: root(i) for i in parent}
