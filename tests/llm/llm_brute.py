"""Plain Python models of the corpus operators, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def near_components(rows, percent=85):
    """doc_id -> (n_shingles, component_id) of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = [i for i in sorted(sets) if sets[i]]
    where = {}
    for i in ids:
        for s in sets[i]:
            where.setdefault(s, []).append(i)
    for i in ids:
        for j in {j for s in sets[i] for j in where[s] if j < i}:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}
