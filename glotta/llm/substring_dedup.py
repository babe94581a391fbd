"""Substring dedup: drop words covered by windows seen in an earlier document.

A window is ``k`` consecutive words.  A word goes when some window over it also
starts in a document with a smaller ``doc_id``; windows are judged on the input.

Plan, with no group of equal windows in one task:

1. *Sketch.*  Every task feeds a count-min sketch with the winnowing key of
   each window (the least hash of its ``k // 2``-word runs: equal windows have
   equal keys, and neighbours share one, so there are far fewer keys than
   windows).  Keys count once a document.  The merged sketch overestimates
   each window's document count; only its ">= 2" bits travel on.  Its cells
   follow the bytes of text up to ``MOST_CELLS``, which bounds the broadcast at
   ``ROWS * MOST_CELLS / 8`` bytes; beyond that more windows pass the sketch,
   and none is lost.
2. *Exact pass.*  Windows estimated as repeated are grouped on a 128-bit hash.
   Each task first keeps the least doc_id of each window among ``HELD``
   candidates, so a passage in a third of all rows gives one entry for as many.
   Buckets follow the bytes of text, so one fits in a task's memory.
3. *Removal.*  The windows found go back to their documents by doc_id.

Edge cases: a null or empty text has no words; a null doc_id neither removes
nor loses words; rows with one doc_id never remove from each other; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, Words, batch, blob, by_membership, flat_bytes, materialize, mix, plain, ship, sliding_min, text_bytes, text_slices

WINDOW = 50
#: Cells in each of the sketch's rows, for each so many bytes of text: about
#: four times the keys there.  A merged row travels as cells / 8 bytes.
CELL_BYTES = 16
LEAST_CELLS, MOST_CELLS = 1 << 20, 1 << 29
ROWS = 2
#: Keys and candidate windows that a task adds up before it passes them on.
HELD = 1 << 19
#: Bytes of text for each bucket of the exact pass.
BUCKET_BYTES = 16 << 20
_BLOCK = 1 << 16

_ONE, _TWO, _RUN = Rolling(0x5851F42D4C957F2D), Rolling(0x14057B7EF767814F), Rolling(0x2545F4914F6CDD1D)
_SKETCH = pa.schema([("block", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])
_CANDIDATES = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("payload", pa.binary())])
_FLAGS = pa.schema([("doc_id", pa.int64()), ("hashes", pa.binary())])
_OUT = pa.schema([("row_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def _cells(keys: np.ndarray, cells: int) -> list[np.ndarray]:
    return [(mix(keys + np.uint64(977 * r + 1)) % np.uint64(cells)).astype(np.int64) + r * cells for r in range(ROWS)]


class _Windows:
    """Hashes of the windows of a slice, with each one's document and start."""

    def __init__(self, texts: pa.Array, k: int):
        self.words = w = Words(texts)
        h = w.hashes()
        n = max(0, len(h) - k + 1)
        self.ok = np.zeros(n, bool)
        last = w.first[1:] - k
        for a, b in zip(w.first[:-1][last >= w.first[:-1]], last[last >= w.first[:-1]], strict=True):
            self.ok[a : b + 1] = True
        self.at = np.flatnonzero(self.ok)
        self.doc = np.searchsorted(w.first, self.at, "right") - 1
        self.h, self.k = h, k

    def keys(self) -> np.ndarray:
        run = max(1, self.k // 2)
        return sliding_min(_RUN(self.h, run), self.k - run + 1)[self.at]

    def one(self) -> np.ndarray:
        return _ONE(self.h, self.k)[self.at]

    def two(self) -> np.ndarray:
        return _TWO(self.h, self.k)[self.at]


def _known(b: pa.RecordBatch) -> pa.RecordBatch:
    return b.filter(b.column(0).is_valid()) if b.column(0).null_count else b


def cells_for(size: int) -> int:
    """A power of two of cells for so many bytes of text."""
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << max(0, size // CELL_BYTES - 1).bit_length()))


def _sketch(k: int, cells: int):
    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = [], [], []
        for cell in _cells(np.concatenate(held), cells):
            cell.sort()
            head = np.flatnonzero(np.diff(cell, prepend=-1))
            more = np.diff(head, append=len(cell)) > 1
            used = cell[head]
            edge = np.flatnonzero(np.diff(used // _BLOCK, prepend=-1))
            low = (used % _BLOCK).astype("<u2")
            for a, b in zip(edge.tolist(), np.append(edge[1:], len(used)).tolist(), strict=True):
                some, twice = low[a:b], more[a:b]
                for to, x in zip(rows, (int(used[a] // _BLOCK), blob(some[~twice]), blob(some[twice])), strict=True):
                    to.append(x)
        return batch(_SKETCH, *rows)

    def run(batches):
        held, n = [], 0
        for b in text_slices(batches, 1):
            w = _Windows(_known(b).column(1), k)
            if not len(w.at):
                continue
            keys = w.keys()
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (w.doc[1:] != w.doc[:-1])
            keys, doc = keys[new], w.doc[new]
            order = np.lexsort((keys, doc))
            keys, doc = keys[order], doc[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
            held.append(keys[new])
            n += len(held[-1])
            if n >= HELD:
                yield flush(held)
                held, n = [], 0
        if held:
            yield flush(held)

    return run


def _merge(batches):
    """Blocks of counts, saturated at two, of which only the ">= 2" bits leave."""
    have: dict[int, np.ndarray] = {}
    for b in batches:
        for i, once, more in zip(*(c.to_pylist() for c in b.columns), strict=True):
            a = have.get(i)
            if a is None:
                a = have[i] = np.zeros(_BLOCK, np.uint8)
            x = np.frombuffer(once, "<u2")
            a[x] = np.minimum(2, a[x] + 1)
            a[np.frombuffer(more, "<u2")] = 2
    rows = [(i, blob(np.packbits(a >= 2, bitorder="little"))) for i, a in have.items() if (a >= 2).any()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["block", "bits"])


def repeated_bits(docs: DataFrame, k: int, cells: int) -> np.ndarray:
    """One bit a cell: did at least two documents meet there?  The result has
    ``ROWS * cells / 8`` bytes, whatever the input."""
    parts = docs.mapInArrow(_sketch(k, cells), "block int, once binary, more binary")
    merged = parts.repartition("block").mapInArrow(_merge, "block int, bits binary")
    bits = np.zeros(ROWS * cells // 8, np.uint8)
    for r in merged.toLocalIterator():
        bits[r.block * _BLOCK // 8 :][: _BLOCK // 8] = np.frombuffer(r.bits, np.uint8)
    return bits


def _candidates(k: int, cells: int, bits, buckets: int):
    def flush(held: list[tuple]) -> pa.RecordBatch:
        keys, one, two, doc = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((doc, two, one))
        keys, one, two, doc = keys[order], one[order], two[order], doc[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        pair = doc > least  # a smaller document of this task has it
        rows = [], [], []
        # the least document of each window is judged by the others' tasks
        # the windows of a common passage share keys: they are dealt to four buckets each
        bucket = (mix(keys[new] + (one[new] & np.uint64(3))) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        table = np.stack([one[new], two[new], doc[new].view(np.uint64)], axis=1)[order]
        _cut(rows, bucket[order], table, 0)
        if pair.any():
            found = np.unique(np.stack([doc[pair].view(np.uint64), one[pair], two[pair]], axis=1), axis=0)
            bucket = (mix(found[:, 0]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            _cut(rows, bucket[order], found[order], 1)
        return batch(_CANDIDATES, *rows)

    def run(batches):
        is_repeated, held, n = bits.value, [], 0
        for b in text_slices(batches, 1):
            b = _known(b)
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            w = _Windows(b.column(1), k)
            if not len(w.at):
                continue
            keys = w.keys()
            hit = np.ones(len(keys), bool)
            for cell in _cells(keys, cells):
                hit &= (is_repeated[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0
            if not hit.any():
                continue
            held.append((keys[hit], w.one()[hit], w.two()[hit], ids[w.doc[hit]]))
            n += int(hit.sum())
            if n >= HELD:
                yield flush(held)
                held, n = [], 0
        if held:
            yield flush(held)

    return run


def _cut(rows, bucket: np.ndarray, table: np.ndarray, kind: int) -> None:
    head = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(head, np.append(head[1:], len(bucket)), strict=True):
        rows[0].append(int(bucket[a]))
        rows[1].append(kind)
        rows[2].append(blob(table[a:b]))


def _judge(table: pa.Table) -> pa.Table:
    """Exact minima within a bucket; what each document loses by them."""
    kind, payload = table.column("kind").to_numpy(), table.column("payload").to_pylist()
    found = []
    windows = [p for k, p in zip(kind, payload, strict=True) if k == 0]
    if windows:
        t = np.frombuffer(b"".join(windows), np.uint64).reshape(-1, 3)
        one, two, doc = t[:, 0], t[:, 1], t[:, 2].view(np.int64)
        order = np.lexsort((doc, two, one))
        one, two, doc = one[order], two[order], doc[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        later = doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        found.append(np.stack([doc[later].view(np.uint64), one[later], two[later]], axis=1))
    found += [np.frombuffer(p, np.uint64).reshape(-1, 3) for k, p in zip(kind, payload, strict=True) if k == 1]
    ids, blobs = [], []
    if found:
        t = np.concatenate(found)
        t = t[np.argsort(t[:, 0].view(np.int64), kind="stable")]
        head = np.flatnonzero(np.diff(t[:, 0], prepend=t[:1, 0] + np.uint64(1))) if len(t) else []
        for a, b in zip(head, np.append(head[1:], len(t)) if len(t) else [], strict=True):
            ids.append(int(t[a, 0].view(np.int64)))
            blobs.append(blob(t[a:b, 1:]))
    return pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], schema=_FLAGS)


def _lost(texts: pa.Array, flags: list, k: int) -> dict[int, np.ndarray]:
    """For each text with flagged windows, which of its words go."""
    marked = [i for i, f in enumerate(flags) if f]
    lost = {}
    if marked:
        w = _Windows(texts.take(pa.array(marked)), k)
        both = np.stack([w.one(), w.two()], axis=1).view("V16").ravel()
        edge = np.searchsorted(w.doc, np.arange(len(marked) + 1))
        for j, i in enumerate(marked):
            s = slice(edge[j], edge[j + 1])
            mine, which = np.unique(both[s], return_inverse=True)
            gone = np.intersect1d(mine, np.frombuffer(b"".join(flags[i]), "V16"), return_indices=True)[1]
            hit = w.at[s][np.isin(which, gone)] - w.words.first[j]
            n = w.words.first[j + 1] - w.words.first[j]
            d = np.zeros(n + 1, np.int64)
            np.add.at(d, hit, 1)
            np.add.at(d, np.minimum(hit + k, n), -1)
            lost[i] = np.cumsum(d[:n]) > 0
    return lost


def _digest(k: int):
    def run(batches):
        for b in text_slices(batches, 1):
            buf, offs = flat_bytes(b.column(1))
            raw = buf.tobytes()
            lost = _lost(b.column(1), b.column(2).to_pylist(), k)
            n_words, n_removed, sha = [], [], []
            for i in range(b.num_rows):
                words = raw[offs[i] : offs[i + 1]].split()
                n_words.append(len(words))
                if i in lost:
                    words = [words[j] for j in np.flatnonzero(~lost[i])]
                n_removed.append(n_words[-1] - len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield batch(_OUT, b.column(0), n_words, n_removed, sha)

    return run


def _repeats(docs: DataFrame, k: int, cells: int | None) -> DataFrame:
    """(doc_id, hashes) of the windows that each document loses."""
    spark = docs.sparkSession
    ship(spark)
    docs = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = text_bytes(docs)
    cells = cells or cells_for(size)
    bits = spark.sparkContext.broadcast(repeated_bits(docs, k, cells))
    buckets = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    found = docs.mapInArrow(_candidates(k, cells, bits, buckets), "bucket int, kind byte, payload binary")
    flags = materialize(found.groupBy("bucket").applyInArrow(_judge, "doc_id long, hashes binary"), "repeats")
    return flags.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list("hashes").alias("_hashes"))


def remove_repeats(docs: DataFrame, k: int = WINDOW, cells: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the words left, joined by
    one space) for every row."""
    flags = _repeats(docs, k, cells)
    docs = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _flagged(docs, flags, _digest(k), "row_id long, n_words long, n_removed long, kept_sha256 string").withColumnRenamed("row_id", "doc_id")


def _flagged(docs: DataFrame, flags: DataFrame, run, schema) -> DataFrame:
    """``run`` over ``docs`` with their flags as a last column; texts without any
    stay out of the shuffle."""
    names = docs.columns
    some, others = by_membership(docs, "doc_id", flags.select("_id"))

    def plain_ones(batches):
        for b in others(batches):
            none = pa.nulls(b.num_rows, pa.list_(pa.binary()))
            yield from run(iter([pa.RecordBatch.from_arrays([*b.columns, none], names=[*b.schema.names, "_hashes"])]))

    members = docs.mapInArrow(some, docs.schema)
    joined = members.join(flags, members["doc_id"] == flags["_id"], "left").select(*[members[c] for c in names], flags["_hashes"])
    return joined.mapInArrow(run, schema).unionAll(docs.mapInArrow(plain_ones, schema))


def without_repeats(docs: DataFrame, k: int = WINDOW, cells: int | None = None) -> DataFrame:
    """``docs`` with the repeated words gone from ``text``.  A text that loses
    none stays as it is, white space included; one that loses all of its words
    becomes empty.  An ``n_chars`` follows the text."""
    flags = _repeats(docs, k, cells)
    names = docs.columns
    text = names.index("text")

    def run(batches):
        for b in text_slices(batches, text):
            col = b.column(text)
            lost = _lost(col, b.column(len(names)).to_pylist(), k)
            if lost:
                values = col.to_pylist()
                for i, gone in lost.items():
                    words = values[i].encode().split()
                    values[i] = b" ".join(words[j] for j in np.flatnonzero(~gone)).decode()
                col = pa.array(values, col.type)
            yield pa.RecordBatch.from_arrays([col if i == text else b.column(i) for i in range(len(names))], names=names)

    out = _flagged(docs, flags, run, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
