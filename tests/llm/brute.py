"""Plain Python versions of the operators, for small inputs."""

import collections
import hashlib

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.translate(LOWER) if lower else raw).split()


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def substring_dedup(docs, k=50):
    """[(doc_id, text)] -> {row: (n_words, n_removed, kept)}"""
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - k + 1):
            if d is not None:
                key = tuple(w[i : i + k])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if d is not None and first[tuple(w[i : i + k])] < d:
                gone[i : i + k] = [True] * k
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def near_duplicates(docs, share=85):
    """[(doc_id, text)], distinct ids -> {doc_id: (n_shingles, component)}"""
    sets = {}
    for d, t in docs:
        w = words(t, True)
        sets[d] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])]
    comp = components(sets, links)
    return {d: (len(sets[d]), comp[d]) for d in sets}


def packing_is_sound(rows, size):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= size
    assert sorted(by) == list(range(len(by)))
