"""Interpolated modified Kneser-Ney language model.

Counting (Spark): tasks hash the n-grams of whole training texts and pre-add
equal ones; n-grams are dealt by their context and a salt of the last word, so
a word that starts a third of all n-grams is dealt to ``SALT`` tasks.  Each
task ends with exact counts of its n-grams, writes them as sorted hash arrays
to the shared folder, and passes on partial sums per context and last word.
Those are added up per word into one more family of sorted arrays.

Scoring by that model, ``score_by``: workers memory-map the arrays, look up
each slice's distinct n-grams in sorted order, and interpolate

    p(w | h) = max(c(hw) - D, 0) / c(h) + g(h) p(w | h without its first word)
    p1(w)    = max(N1+(.w) - D', 0) / N1+(..) + g' / (V + 1)

with the three discounts D estimated from counts of counts, g(h) what they
free, and the last term shared by all V known words and one unknown.

``score`` does the same for the corpus that the model is of, in
``kneser_ney_scores``, by one exchange of its n-grams and without a model on disk.

``order`` is the n-grams' length.  Those shorter than ``order`` count the
distinct n-grams that end in them.  Texts get order - 1 starts before them and
one end token.  A hash has 64 bits.

Edge cases: null or empty text is the end token alone; a null doc_id is
training data (its remainder isn't 2) and scored like others; without training
rows every token has the uniform probability 1.
"""

from __future__ import annotations

import os
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, batch, blob, mix, plain, shared_dir, ship, text_bytes, text_slices

FOLDS, HELD_OUT = 7, 2
SALT = 16
#: Text bytes whose n-grams a task adds up before it passes them on.
ADD_BYTES = 24 << 20
#: Text bytes for each part of the counts, so that one fits in a task's memory.
PART_BYTES = 32 << 20
#: Arrays that a worker keeps mapped; others are mapped again when needed.
MAPS = 800
#: Bytes of arrays that a worker holds where the folder isn't mounted.
HELD_BYTES = 256 << 20

_START = np.uint64(0xA5A5A5A55A5A5A5A)
_END = np.uint64(0x0F1E2D3C4B5A6978)
#: kind: 0 contexts, 1 words, 2 and 4 counts of counts of bigrams and longer, 3 n-grams, 9 a part by itself
_SUMS = pa.schema([("part", pa.int32()), ("kind", pa.int8()), ("sums", pa.binary())])


def held_out(column: str = "doc_id") -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token's one-word context and own hash, and the documents' offsets."""
    w = Words(texts, lower=True)
    n = w.counts()
    first = w.first + np.arange(len(w.first))
    token = np.empty(len(w.start) + len(n), np.uint64)
    ends = first[1:] - 1
    inner = np.ones(len(token), bool)
    inner[ends] = False
    token[inner], token[ends] = w.hashes(), _END
    context = np.empty_like(token)
    context[1:], context[first[:-1]] = token[:-1], _START
    return context, token, first


def _contexts(context: np.ndarray, token: np.ndarray, first: np.ndarray, order: int) -> list[np.ndarray]:
    """Each token's contexts of order - 1, ..., 1 words; starts fill them up."""
    out = [context]
    for _ in range(order - 2):
        longer = np.empty_like(context)
        longer[1:], longer[first[:-1]] = gram(out[0], token)[:-1], _START
        out.insert(0, longer)
    return out


def gram(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(context * np.uint64(0xD1342543DE82EF95) + (token ^ (token >> np.uint64(31))))


def part_of(context: np.ndarray, token: np.ndarray, parts: int) -> np.ndarray:
    """A context's n-grams lie in at most SALT of the parts."""
    return (mix(context + (mix(token) >> np.uint64(60)) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(parts)).astype(np.int64)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin, in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _dealt(context: np.ndarray, token: np.ndarray, n: np.ndarray, shorter: list[np.ndarray], parts: int) -> tuple[list[int], list[bytes]]:
    """N-grams packed for each of their parts."""
    part = part_of(context, token, parts)
    order = np.argsort(part, kind="stable")
    part = part[order]
    table = np.stack([context[order], token[order], n[order].astype(np.uint64), *(c[order] for c in shorter)], axis=1)
    head = _heads(part)
    rows = [], []
    for a, b in zip(head, np.append(head[1:], len(part)), strict=True):
        rows[0].append(int(part[a]))
        rows[1].append(_packed(table[a:b]))
    return rows


def _count(parts: int, n_order: int):
    def flush(held):
        context, token, n, *shorter = (np.concatenate(c) for c in zip(*held, strict=True))
        if len(held) > 1:
            order = np.argsort(gram(context, token), kind="stable")
            context, token, n, *shorter = (c[order] for c in (context, token, n, *shorter))
            head = _heads(context, token)
            context, token, n, *shorter = context[head], token[head], np.add.reduceat(n, head), *(c[head] for c in shorter)
        parts_, blobs = _dealt(context, token, n, shorter, parts)
        return batch(_SUMS, parts_, [3] * len(parts_), blobs)

    def run(batches):
        held, size = [], 0
        for b in text_slices(batches, 0):
            context, token, first = _tokens(b.column(0))
            context, *shorter = _contexts(context, token, first, n_order)
            g = gram(context, token)
            order = np.argsort(g, kind="stable")
            g, context, token, *shorter = (c[order] for c in (g, context, token, *shorter))
            head = _heads(context, token)
            held.append((context[head], token[head], np.diff(head, append=len(g)), *(c[head] for c in shorter)))
            size += b.column(0).nbytes
            if size >= ADD_BYTES // (n_order - 1):
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return run


def _as_bytes(n: np.ndarray) -> list[np.ndarray]:
    """Numbers in one byte each; where those of 255 and more are, and what."""
    wide = np.flatnonzero(n > 254)
    return [np.minimum(n, 255).astype(np.uint8), wide.astype(np.uint32), n[wide].astype(np.uint64)]


def _from_bytes(small: np.ndarray, wide: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = small.astype(np.int64)
    out[wide] = values.astype(np.int64)
    return out


def _planes(a: np.ndarray) -> np.ndarray:
    """All first bytes of the numbers, then all second ones, so that the
    shuffle's codec finds the zeros of small ones."""
    return np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T).ravel()


def _numbers(planes: np.ndarray, kind) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).ravel().view(kind)


def _joined(*arrays: np.ndarray) -> bytes:
    return blob(np.array([len(arrays), *(a.nbytes for a in arrays)], np.uint64)) + b"".join(blob(a) for a in arrays)


def _parted(raw: bytes, *kinds) -> list[np.ndarray]:
    sizes = np.frombuffer(raw, np.uint64, len(kinds), 8).tolist()
    at, out = 8 * (len(kinds) + 1), []
    for n, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(raw, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


def _packed(table: np.ndarray) -> bytes:
    """Rows (context, token, count, shorter contexts): steps between the distinct
    contexts, their numbers of tokens, the distinct words, and tokens and shorter
    contexts as places among these, with counts."""
    table = table[np.argsort(table[:, 0], kind="stable")]
    head = _heads(table[:, 0])
    word, at = np.unique(np.concatenate([table[:, 1], table[head, 3:].ravel()]), return_inverse=True)
    at = at.astype(np.uint32)
    steps = np.diff(table[head, 0], prepend=np.uint64(0))
    return _joined(_planes(steps), *_as_bytes(np.diff(head, append=len(table))), word, _planes(at[: len(table)]), _planes(at[len(table) :]), *_as_bytes(table[:, 2]))


def _unpacked(raw: bytes) -> tuple[np.ndarray, ...]:
    steps, a, b, c, word, tokens, shorter, *count = _parted(raw, np.uint8, np.uint8, np.uint32, np.uint64, np.uint64, np.uint8, np.uint8, np.uint8, np.uint32, np.uint64)
    context, times = np.cumsum(_numbers(steps, np.uint64), dtype=np.uint64), _from_bytes(a, b, c)
    below = word[_numbers(shorter, np.uint32)].reshape(len(context), -1).T if len(shorter) else []
    return np.repeat(context, times), word[_numbers(tokens, np.uint32)], _from_bytes(*count), *(np.repeat(x, times) for x in below)


def _packed_sums(keys: np.ndarray, sums: np.ndarray) -> bytes:
    """Sorted keys and rows of sums."""
    return _joined(_planes(np.diff(keys, prepend=np.uint64(0))), *_as_bytes(sums.ravel()))


def _added(packed: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys, each once, and the sums of their rows."""
    keys, sums = [np.zeros(0, np.uint64)], [np.zeros((0, width), np.int64)]
    for raw in packed:
        steps, *small = _parted(raw, np.uint8, np.uint8, np.uint32, np.uint64)
        keys.append(np.cumsum(_numbers(steps, np.uint64), dtype=np.uint64))
        sums.append(_from_bytes(*small).reshape(-1, width))
    return _sum_by(np.concatenate(keys), np.concatenate(sums))


class Folder:
    """Arrays in the shared folder: mapped where it is mounted, else read through
    the Arrow filesystem of its URI.  One that is missing is an error."""

    def __init__(self, uri: str):
        self.uri = uri
        self.path = uri[len("file://") :] if uri.startswith("file://") else uri if "://" not in uri else None

    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.uri)

    def save(self, name: str, a: np.ndarray) -> None:
        if self.path is None:
            system, root = self._fs()
            system.create_dir(root)
            with system.open_output_stream(f"{root}/{name}") as f:
                f.write(blob(a))
            return
        os.makedirs(self.path, exist_ok=True)
        part = f"{self.path}/.{name}.{os.getpid()}.{os.urandom(4).hex()}"
        with open(part, "wb") as f:
            f.write(blob(a))
        os.replace(part, f"{self.path}/{name}")  # a repeated task writes the same

    def save_bytes(self, name: str, part: int, n: np.ndarray) -> None:
        """Numbers in a byte each, and the few of 255 and more apart."""
        small, wide, values = _as_bytes(n)
        self.save(f"{name}-{part}", small)
        self.save(f"{name}_wide-{part}", np.stack([wide.astype(np.uint64), values], axis=1))

    def map(self, name: str, kind) -> np.ndarray:
        if self.path is not None:
            path = f"{self.path}/{name}"
            return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
        system, root = self._fs()
        with system.open_input_file(f"{root}/{name}") as f:
            return np.frombuffer(f.read(), kind)


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    head = _heads(keys)
    return keys[head], np.add.reduceat(values, head, axis=0) if len(head) else values[:0]


def _of_level(name: str, level: int) -> str:
    return name if level == 2 else f"{name}{level}"


def _save_contexts(folder: Folder, level: int, part: int, sums: list[bytes]) -> None:
    key, c = _added(sums, 4)
    folder.save(f"{_of_level('context', level)}-{part}", key)
    folder.save_bytes(_of_level("context_sums", level), part, c.ravel())


def _merge(folder: Folder, parts: int, level: int, top: int):
    """Exact counts of a part's n-grams of ``level`` words; partial sums for
    their contexts, and their shorter n-grams, each counted once, or words."""

    def run(table: pa.Table) -> pa.Table:
        part, kinds, blobs = table.column("part")[0].as_py(), table.column("kind").to_pylist(), table.column("sums").to_pylist()
        if level < top:
            _save_contexts(folder, level + 1, part, [s for k, s in zip(kinds, blobs, strict=True) if k == 0])
        rows = [], [], []

        def add(to: int, kind: int, raw: bytes) -> None:
            for r, x in zip(rows, (to, kind, raw), strict=True):
                r.append(x)

        for k, s in zip(kinds, blobs, strict=True):
            if k in (1, 2, 4):
                add(part, k, s)
        add(part, 9, b"")
        # context, token, count and level - 2 shorter contexts
        held = [_unpacked(r) for k, r in zip(kinds, blobs, strict=True) if k == 3] or [(np.zeros(0, np.uint64),) * (level + 1)]
        context, token, n, *shorter = (np.concatenate(c) for c in zip(*held, strict=True))
        n = n.astype(np.int64)
        del held, blobs
        g = gram(context, token)
        order = np.argsort(g, kind="stable")
        g, context, token, n, *shorter = (c[order] for c in (g, context, token, n, *shorter))
        head = _heads(g, context, token)
        g, context, token, n, *shorter = g[head], context[head], token[head], np.add.reduceat(n, head) if len(head) else n, *(c[head] for c in shorter)
        folder.save(f"{_of_level('gram', level)}-{part}", g)
        folder.save_bytes(_of_level("count", level), part, n)
        own = np.stack([n, n == 1, n == 2, n > 2], axis=1).astype(np.int64)
        # a word's count is that of the longest n-grams, its contexts are those of bigrams
        last = np.stack([n if level == top else np.zeros_like(n), np.full_like(n, level == 2)], axis=1).astype(np.int64)
        kept = [(0, context, own)] + ([(1, token, last)] if level in (2, top) else [])
        for kind, keys, sums in ((k, *_sum_by(keys, sums)) for k, keys, sums in kept if len(keys)):
            to = (mix(keys) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            head = _heads(to[order])
            for a, b in zip(head, np.append(head[1:], len(order)), strict=True):
                i = order[a:b]
                add(int(to[i[0]]), kind, _packed_sums(keys[i], sums[i]))
        totals = [int((n == k).sum()) for k in (1, 2, 3, 4)]
        add(part, 2 if level == 2 else 4, blob(np.array(totals if level == 2 else [level, *totals], np.int64)))
        if level > 2 and len(n):
            lower, *shorter = shorter
            order = np.argsort(gram(lower, token), kind="stable")
            lower, token, *shorter = (c[order] for c in (lower, token, *shorter))
            head = _heads(lower, token)
            times = np.diff(head, append=len(lower))
            for to, raw in zip(*_dealt(lower[head], token[head], times, [c[head] for c in shorter], parts), strict=True):
                add(to, 3, raw)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _SUMS, strict=True)], schema=_SUMS)

    return run


_TOTALS = pa.schema([("totals", pa.list_(pa.int64()))])


def _words(folder: Folder, order: int):
    """Per word: its count and numbers of contexts, and its sums as a context."""

    def run(table: pa.Table) -> pa.Table:
        part, kinds, sums = table.column("part")[0].as_py(), table.column("kind").to_numpy(), table.column("sums").to_pylist()
        _save_contexts(folder, 2, part, [s for k, s in zip(kinds, sums, strict=True) if k == 0])
        w_key, w = _added([s for k, s in zip(kinds, sums, strict=True) if k == 1], 2)
        for name, a in (("word", w_key), ("word_sums", w)):
            folder.save(f"{name}-{part}", a)
        seen = w[:, 1] if len(w) else np.zeros(0, np.int64)
        grams = np.sum([np.frombuffer(s, np.int64) for k, s in zip(kinds, sums, strict=True) if k == 2] or [np.zeros(4, np.int64)], axis=0)
        totals = [int(w[:, 0].sum()) if len(w) else 0, len(w_key), int(seen.sum()), *(int((seen == k).sum()) for k in (1, 2, 3, 4)), int((seen > 2).sum()), *(int(x) for x in grams)]
        upper = np.zeros((order + 1, 4), np.int64)
        for k, s in zip(kinds, sums, strict=True):
            if k == 4:
                level, *counts = np.frombuffer(s, np.int64).tolist()
                upper[level] += counts
        totals += upper[3:].ravel().tolist()
        return pa.Table.from_arrays([pa.array([totals], pa.list_(pa.int64()))], schema=_TOTALS)

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more."""
    if not (n1 and n2):
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return np.array([min(max(x, 0.0), float(i)) for i, x in enumerate(d)])


class Model(NamedTuple):
    folder: str
    parts: int
    tokens: int  # N
    words: int  # V, the end token included
    types: int  # distinct n-grams
    by_contexts: tuple[int, int, int]  # words of one, two and more contexts
    grams: tuple[float, ...]  # discounts
    unigrams: tuple[float, ...]
    longer: tuple[tuple[float, ...], ...] = ()  # discounts of trigrams and so on


def train(docs: DataFrame, parts: int | None = None, order: int = 2) -> Model:
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = docs.sparkSession
    ship(spark)
    folder = Folder(shared_dir(spark) + "/kneser-ney")
    parts = parts or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")), text_bytes(docs) * (order - 1) // PART_BYTES)
    texts = plain(docs, "text").select(F.col("text").cast("string"))
    sums = texts.mapInArrow(_count(parts, order), "part int, kind byte, sums binary")
    # every part runs at every level, and so has all of its files
    sums = sums.unionAll(spark.range(parts).select(F.col("id").cast("int"), F.lit(9).cast("byte"), F.lit(b"")))
    for level in range(order, 1, -1):
        sums = sums.groupBy("part").applyInArrow(_merge(folder, parts, level, order), "part int, kind byte, sums binary")
    words = sums.groupBy("part").applyInArrow(_words(folder, order), "totals array<long>")
    rows = words.agg(F.array(*[F.sum(F.col("totals")[i]) for i in range(12 + 4 * (order - 2))])).first()[0]
    t = [int(x or 0) for x in rows]
    longer = tuple(tuple(discounts(*t[i : i + 4])) for i in range(12, len(t), 4))
    return Model(folder.uri, parts, t[0], t[1], t[2], (t[3], t[4], t[7]), tuple(discounts(*t[8:12])), tuple(discounts(*t[3:7])), longer)


class Reader:
    """A worker's view of the memory-mapped arrays."""

    def __init__(self, model: Model):
        self.m, self.folder, self.maps, self.held = model, Folder(model.folder), {}, 0

    def _map(self, name: str, part: int, kind, width: int = 1) -> np.ndarray:
        key = f"{name}-{part}"
        if key not in self.maps:
            a = self.folder.map(key, kind)
            own = 0 if isinstance(a, np.memmap) else a.nbytes
            while self.maps and (len(self.maps) >= MAPS or own and self.held + own > HELD_BYTES):
                _, old = self.maps.pop(next(iter(self.maps)))  # the oldest: parts are read in turn
                self.held -= old
            self.held += own
            self.maps[key] = (a.reshape(-1, width) if width > 1 else a), own
        return self.maps[key][0]

    def _look(self, part: np.ndarray, key: np.ndarray, names: tuple[str, str], kind, width: int) -> np.ndarray:
        """Values of distinct keys, each in its part's arrays; zero if absent."""
        out = np.zeros((len(key), width), np.int64)
        order = np.lexsort((key, part))
        head = _heads(part[order])
        for a, b in zip(head, np.append(head[1:], len(order)), strict=True):
            i = order[a:b]
            p = int(part[i[0]])
            have, values = self._map(names[0], p, np.uint64), self._map(names[1], p, kind, width)
            if not len(have):
                continue
            at = np.minimum(np.searchsorted(have, key[i]), len(have) - 1)
            hit = have[at] == key[i]
            found = np.asarray(values[at[hit]]).reshape(-1, width).astype(np.int64)
            if kind is np.uint8 and (full := found == 255).any():
                wide = self._map(f"{names[1]}_wide", p, np.uint64, 2)
                row, column = np.nonzero(full)
                place = at[hit][row].astype(np.uint64) * np.uint64(width) + column.astype(np.uint64)
                found[full] = wide[np.searchsorted(wide[:, 0], place), 1]
            out[i[hit]] = found
        return out

    def score(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base and model log10 probability."""
        m = self.m
        context, token, first = _tokens(texts)
        head = first[:-1]
        word, of_word = np.unique(token, return_inverse=True)
        sums = self._look((mix(word) % np.uint64(m.parts)).astype(np.int64), word, ("word", "word_sums"), np.int64, 2)
        count, contexts = sums[:, 0], sums[:, 1]
        base = np.log10((count + 1) / (m.tokens + m.words + 1))
        d1 = np.array(m.unigrams)
        if m.types:
            free = float(np.dot(d1[1:], m.by_contexts)) / m.types
            lower = np.maximum(contexts - d1[np.minimum(contexts, 3)], 0) / m.types + free / (m.words + 1)
        else:
            lower = np.full(len(word), 1 / (m.words + 1))
        p = lower[of_word]
        contexts = _contexts(context, token, first, 2 + len(m.longer))[::-1]
        for level, (context, d) in enumerate(zip(contexts, map(np.array, (m.grams, *m.longer)), strict=True), 2):
            g, at, of_gram = np.unique(gram(context, token), return_index=True, return_inverse=True)
            own = self._look(part_of(context[at], token[at], m.parts), g, (_of_level("gram", level), _of_level("count", level)), np.uint8, 1)[:, 0]
            before, of_before = np.unique(context[at], return_inverse=True)
            c = self._look((mix(before) % np.uint64(m.parts)).astype(np.int64), before, (_of_level("context", level), _of_level("context_sums", level)), np.uint8, 4)[of_before]
            total = np.maximum(c[:, 0], 1)
            back = np.where(c[:, 0] > 0, (c[:, 1:] @ d[1:]) / total, 1.0)
            p = (np.maximum(own - d[np.minimum(own, 3)], 0) / total)[of_gram] + back[of_gram] * p
        log_p = np.log10(p)
        return np.diff(first), np.add.reduceat(count[of_word] > 0, head, dtype=np.int64), np.add.reduceat(base[of_word], head), np.add.reduceat(log_p, head)


_OUT = pa.schema([("row_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("perplexity", pa.float64())])


def _apply(model: Model):
    def run(batches):
        reader = Reader(model)
        for b in text_slices(batches, 1):
            n, known, base, score = reader.score(b.column(1))
            yield batch(_OUT, b.column(0), n, known, np.full(len(n), model.tokens), base, score, 10 ** np.minimum(-score / n, 300.0))

    return run


def score(docs: DataFrame, parts: int | None = None, order: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and
    perplexity of every row, by a model of the rows that aren't held out."""
    from .kneser_ney_scores import scores

    return scores(plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")), parts, order)


def score_by(model: Model, docs: DataFrame) -> DataFrame:
    """What ``score`` returns, by a model that ``train`` has left in the folder."""
    docs = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = docs.mapInArrow(_apply(model), "row_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
    out = out.withColumnRenamed("row_id", "doc_id").withColumn("held_out", held_out())
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
