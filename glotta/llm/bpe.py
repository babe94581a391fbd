"""Byte-pair merging of many words at once, in numpy.

Words of equal length advance together: one step finds each row's best pair,
merges it, and probes the sorted pair keys for the two pairs that changed.  All
rows still in the batch have had the same number of merges, so they stay of
equal length and need no padding.
"""

from __future__ import annotations

import heapq

import numpy as np

_NONE = np.int32(2**31 - 1)
#: Longer words merge one at a time, in a heap.
LONG = 512


class Merger:
    """``left``, ``right``: symbols of each rule, ``made``: the result, in rank
    order.  The lowest rank merges first, the leftmost pair among equals."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray, rank: np.ndarray, symbols: int):
        self.n = np.int64(symbols)
        keys = left.astype(np.int64) * self.n + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], rank[order].astype(np.int32)
        self.made = np.zeros(int(rank.max()) + 1 if len(rank) else 1, np.int32)
        self.made[rank] = made

    def probe(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = a.astype(np.int64) * self.n + b
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[at] == k, self.rank[at], _NONE)

    def __call__(self, symbols: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat symbols of all words and offsets, before and after merging."""
        size = np.diff(offs)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.argsort(size, kind="stable")
        edges = np.flatnonzero(np.diff(size[order], prepend=-1))
        for a, b in zip(edges, np.append(edges[1:], len(order)), strict=True):
            length = int(size[order[a]])
            if not length:
                continue
            if length > LONG:
                done += [(order[i : i + 1], self._one(symbols[offs[order[i]] : offs[order[i] + 1]])[None, :]) for i in range(a, b)]
                continue
            step = max(1, 400_000 // length)
            for c in range(a, b, step):
                rows = order[c : min(b, c + step)]
                self._many(rows, symbols[offs[rows][:, None] + np.arange(length)], done)
        n = np.zeros(len(size), np.int64)
        for rows, ids in done:
            n[rows] = ids.shape[1]
        to = np.concatenate([[0], np.cumsum(n)])
        out = np.empty(to[-1], np.int32)
        for rows, ids in done:
            out[to[rows][:, None] + np.arange(ids.shape[1])] = ids
        return out, to

    def _many(self, rows: np.ndarray, s: np.ndarray, done: list) -> None:
        pair = self.probe(s[:, :-1], s[:, 1:])
        while len(rows) and s.shape[1] > 1:
            j = pair.argmin(axis=1)
            best = pair[np.arange(len(rows)), j]
            go = best != _NONE
            if not go.all():
                done.append((rows[~go], s[~go]))
                rows, s, pair, j, best = rows[go], s[go], pair[go], j[go], best[go]
                if not len(rows):
                    return
            at, width = np.arange(len(rows)), s.shape[1] - 1
            later = np.arange(width)[None, :] > j[:, None]
            s = np.where(later, s[:, 1:], s[:, :-1])
            s[at, j] = self.made[best]
            pair = np.where(later[:, : width - 1] | (np.arange(width - 1)[None, :] == j[:, None]), pair[:, 1:], pair[:, :-1])
            has = np.flatnonzero(j > 0)
            pair[has, j[has] - 1] = self.probe(s[has, j[has] - 1], s[has, j[has]])
            has = np.flatnonzero(j < width - 1)
            pair[has, j[has]] = self.probe(s[has, j[has]], s[has, j[has] + 1])
        if len(rows):
            done.append((rows, s))

    def _one(self, s: np.ndarray) -> np.ndarray:
        sym = s.tolist()
        nxt, prev = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        live = [True] * len(sym)
        heap = [(int(r), i, sym[i], sym[i + 1]) for i, r in enumerate(self.probe(s[:-1], s[1:])) if r != _NONE]
        heapq.heapify(heap)

        def push(i: int, k: int) -> None:
            r = int(self.probe(np.array([sym[i]]), np.array([sym[k]]))[0])
            if r != _NONE:
                heapq.heappush(heap, (r, i, sym[i], sym[k]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            k = nxt[i]
            if not live[i] or k >= len(sym) or sym[i] != a or sym[k] != b:
                continue
            sym[i] = int(self.made[r])
            live[k] = False
            nxt[i] = nxt[k]
            if nxt[i] < len(sym):
                prev[nxt[i]] = i
                push(i, nxt[i])
            if prev[i] >= 0:
                push(prev[i], i)
        return np.array([x for x, keep in zip(sym, live, strict=True) if keep], np.int32)


def gather(values: np.ndarray, offs: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``which`` of a ragged array, end to end, and their offsets."""
    n = (offs[1:] - offs[:-1])[which]
    to = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(to[-1]) + np.repeat(offs[which] - to[:-1], n)
    return values[at], to
