"""Plain versions of the operators, for small tables."""

import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def unite(nodes, links):
    """Smallest node that each node reaches."""
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(words)] if len(words) == 1 else zip(words, words[1:]))


def near_copies(rows):
    """rows: (doc_id, text). Multiset of (doc_id, set size, component)."""
    sets = [(i, shingles(t)) for i, t in rows]
    real = [(i, s) for i, s in sets if i is not None and s]
    links = [(i, j) for k, (i, s) in enumerate(real) for j, t in real[:k]
             if 100 * len(s & t) >= 80 * len(s | t)]
    component = unite({i for i, _ in sets if i is not None}, links)
    return Counter((i, len(s), component.get(i)) for i, s in sets)


def close_vectors(rows, least=0.9):
    """rows: (vec_id, list). {vec_id: (links, component)} for distinct ids."""
    def usable(v):
        if v is None or not len(v) or any(x is None for x in v):
            return False
        v = np.array(v, float)
        return bool(np.isfinite(v).all() and v.any())

    real = [(i, np.array(v, float) / np.abs(v).max()) for i, v in rows if i is not None and usable(v)]
    links = []
    for k, (i, v) in enumerate(real):
        for j, w in real[:k]:
            if len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= least:
                links.append((i, j))
    count = Counter(x for pair in links for x in pair)
    component = unite({i for i, _ in rows if i is not None}, links)
    return {i: (count[i], c) for i, c in component.items()}


def repeated_lines(rows, least=50):
    """rows: (doc_id, text), in order. {doc_id: places among all lines} in runs of `least` words or
    more that stand earlier."""
    removed = defaultdict(set)
    sequences = []
    for i, text in rows:
        found = [(at, x.strip(" \t\n\x0b\x0c\r"), len(WORD.findall(x))) for at, x in enumerate((text or "").split("\n"))]
        sequences.append((i, [x for x in found if x[2]]))
    runs = defaultdict(list)
    for order, (_, lines) in enumerate(sequences):
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if sum(x[2] for x in lines[a:b + 1]) >= least:
                    runs[tuple(x[1] for x in lines[a:b + 1])].append((order, a, b))
    for places in runs.values():
        for order, a, b in sorted(places)[1:]:
            i, lines = sequences[order]
            removed[i].update(x[0] for x in lines[a:b + 1])
    return removed
