"""Near-duplicate classes by min-max hashing.

A document's set holds its distinct 3-word shingles (lower-case A-Z).  Links
join documents with ``100 * intersection >= 85 * union``; a class is what links
reach.  Both numbers are parameters; a lower share takes narrower bands and a
lower ``LEAST``.

Plan:

1. One Arrow pass gives each document a 128-bit digest of its set and a min-max
   signature: each of 70 permutations leaves both its least and its greatest
   value, so 140 values cost 70 hash evaluations a shingle.
2. Documents with equal sets fold into one representative (the least doc_id)
   by a plain aggregate; copies are never paired.
3. Representatives meet in 28 bands of 5 values.  Buckets of one are dropped;
   large buckets are dealt into blocks, and block pairs compare signatures.
   Estimates of ``LEAST`` or more become candidate edges, as a spanning forest.
   At 0.85 a link shares no band with probability 7e-8, and is estimated below
   LEAST (over 5 standard deviations off) about as rarely.
4. Candidate components gather their texts, again in block pairs when they are
   large, and all pairs are decided exactly on the full sets: an incidence
   matrix times its transpose gives every intersection.
5. Confirmed links are closed by connected components.

Edge cases: no words or null text: empty set, linked with nothing.  Fewer than
three words: the whole sequence is the one shingle.  A null doc_id gets a null
component and is kept.  Rows that share a doc_id count as one node.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import Words, batch, blob, by_membership, join_counted, materialize, mix, only_members, plain, settled, ship, text_slices
from .components import connected_components

SHINGLE = 3
SHARE = 85
PERMUTATIONS = 70
BAND = 5
LEAST = 0.68
#: Members, and about how many shingles, that make one side of a comparison.
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
#: Text bytes that are shingled at a time, and whose groups are decided at a
#: time; one group may have more.
SIGN_BYTES, DECIDE_BYTES = 3 << 19, 2 << 20

_VALUES = 2 * PERMUTATIONS
_SIGNED = pa.schema([("row_id", pa.int64()), ("n_shingles", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("signature", pa.binary())])
_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])
_rng = np.random.default_rng(20240611)
_MUL = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.int64).astype(np.uint64)


def shingles(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each document, and the offsets."""
    w = Words(texts, lower=True)
    h, counts = w.hashes(), w.counts()
    docs = len(counts)
    run = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for i in range(n):
        run = mix(run ^ h[i : len(h) - n + 1 + i]) if len(run) else run
    ok = np.zeros(len(run), bool)
    last = w.first[1:] - n
    for a, b in zip(w.first[:-1][last >= w.first[:-1]], last[last >= w.first[:-1]], strict=True):
        ok[a : b + 1] = True
    at = np.flatnonzero(ok)
    doc, value = np.searchsorted(w.first, at, "right") - 1, run[at]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        more = []
        for d in short:
            x = np.full(1, 0x5DEECE66D + counts[d], np.uint64)
            for i in range(w.first[d], w.first[d + 1]):
                x = mix(x ^ h[i : i + 1])
            more.append(x[0])
        doc, value = np.concatenate([doc, short]), np.concatenate([value, np.array(more, np.uint64)])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return value, np.searchsorted(doc, np.arange(docs + 1))


def signatures(value: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(documents, values) of 16 bits: columns 2p and 2p+1 hold permutation p's
    minimum and maximum.  Rows of empty sets are zero."""
    full = np.flatnonzero(np.diff(offs))
    out = np.zeros((len(offs) - 1, _VALUES), np.uint16)
    if not len(full):
        return out
    head = offs[full]
    for p in range(PERMUTATIONS):
        v = value * _MUL[p] + _ADD[p]
        out[full, 2 * p] = mix(np.minimum.reduceat(v, head)) >> np.uint64(48)
        out[full, 2 * p + 1] = mix(np.maximum.reduceat(v, head)) >> np.uint64(48)
    return out


def _digests(value: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set that tell it from others."""
    n = np.diff(offs)
    one, two = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        one[full] = np.add.reduceat(mix(value), offs[full])
        two[full] = np.add.reduceat(mix(value ^ np.uint64(0xABCDEF)), offs[full])
    return one.view(np.int64), two.view(np.int64)


def _sign(batches, shingle: int = SHINGLE):
    for b in text_slices(batches, 1, SIGN_BYTES):
        value, offs = shingles(b.column(1), shingle)
        n = np.diff(offs)
        yield batch(_SIGNED, b.column(0), n, *_digests(value, offs), [blob(r) if m else None for r, m in zip(signatures(value, offs), n, strict=True)])


def _with_set(docs: DataFrame, some, names: list[str], shingle: int) -> DataFrame:
    """``some`` of the documents with the digests of their sets."""
    text = docs.columns.index("text")

    def run(batches):
        for b in text_slices(some(batches), text, SIGN_BYTES):
            digests = _digests(*shingles(b.column(text).cast(pa.string()), shingle))
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, digests)], names=[*b.schema.names, *names])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *(StructField(n, LongType()) for n in names)]))


def _groups(batches, size: int):
    """Rows of one group together; the input is sorted by its first three
    columns, which name the group.  Yields lists of row-index arrays, with the
    columns, for many small groups at once."""
    held: list[pa.RecordBatch] = []

    def cut(t: pa.Table, final: bool):
        if not t.num_rows:
            return None, None, t
        key = np.stack([t.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
        head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        stop = t.num_rows if final else int(head[-1])
        head = head[head < stop]
        return t.slice(0, stop), np.append(head, stop), t.slice(stop)

    rows = 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= size:
            done, edges, rest = cut(pa.Table.from_batches(held).combine_chunks(), False)
            if done is not None and done.num_rows:
                yield done, edges
            held = rest.to_batches()
            rows = 0
    if held:
        done, edges, _ = cut(pa.Table.from_batches(held).combine_chunks(), True)
        if done is not None and done.num_rows:
            yield done, edges


def _forest(close: np.ndarray) -> np.ndarray:
    """For each member the least member index it is joined with."""
    label = np.arange(len(close))
    while True:
        new = np.minimum(label, np.where(close, label[None, :], len(label)).min(axis=1, initial=len(label)))
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _compare(batches, least: float = LEAST):
    """Candidate edges: a spanning forest of each group's close estimates."""
    for t, edges in _groups(batches, 20_000):
        ids = t.column("rep").to_numpy()
        sig = np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint16).reshape(-1, _VALUES)
        u, v = [], []
        size = np.diff(edges)
        for a in edges[:-1][size == 2]:
            u.append(a)
            v.append(a + 1)
        if u:
            a, b = np.array(u), np.array(v)
            close = (sig[a] == sig[b]).mean(axis=1) >= least
            yield batch(_EDGES, ids[a[close]], ids[b[close]])
        for a, n in zip(edges[:-1][size > 2], size[size > 2], strict=True):
            s, who = sig[a : a + n], ids[a : a + n]
            close = np.zeros((n, n), bool)
            for i in range(n - 1):
                close[i, i + 1 :] = (s[i + 1 :] == s[i]).mean(axis=1) >= least
            label = _forest(close | close.T)
            to = np.flatnonzero(label != np.arange(n))
            if len(to):
                yield batch(_EDGES, who[to], who[label[to]])


def intersections(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Exact sizes of all pairwise intersections."""
    m = len(sets)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    column = np.cumsum(np.concatenate([[0], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    n = np.bincount(column) if len(column) else np.zeros(0, np.int64)
    keep = n[column] > 1 if len(column) else np.zeros(0, bool)
    column, owner = column[keep], owner[keep]
    out = np.zeros((m, m), np.int64)
    if not len(column):
        return out
    column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
    for at in range(0, int(column[-1]) + 1, columns):
        s = slice(*np.searchsorted(column, [at, at + columns]))
        x = np.zeros((m, min(columns, int(column[-1]) + 1 - at)), np.float32)
        x[owner[s], column[s] - at] = 1
        out += (x @ x.T).astype(np.int64)
    return out


def _verify(share: int, shingle: int = SHINGLE):
    def run(batches):
        for t, edges in _groups(text_slices(batches, 4, DECIDE_BYTES), 64):
            ids, text = t.column("rep").to_numpy(), t.column("text").combine_chunks()
            size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
            at = 0
            while at < len(edges) - 1:
                to = max(at + 1, int(np.searchsorted(size[edges], size[edges[at]] + DECIDE_BYTES, "right")) - 1)
                u, v = _links(text.slice(edges[at], edges[to] - edges[at]), edges[at : to + 1] - edges[at], share, shingle)
                if len(u):
                    yield batch(_EDGES, ids[edges[at] + u], ids[edges[at] + v])
                at = to

    return run


def _links(texts: pa.Array, edges: np.ndarray, share: int, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links within each group of texts."""
    value, offs = shingles(texts, shingle)
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a < 2:
            continue
        sets = [value[offs[i] : offs[i + 1]] for i in range(a, b)]
        both = intersections(sets)
        n = np.array([len(s) for s in sets])
        close = 100 * both >= share * (n[:, None] + n[None, :] - both)
        label = _forest(close & (n > 0)[:, None] & (n > 0)[None, :])
        to = np.flatnonzero(label != np.arange(b - a))
        u.append(a + to)
        v.append(a + label[to])
    return np.concatenate(u), np.concatenate(v)


def _in_blocks(members: DataFrame, group: str, blocks: F.Column) -> DataFrame:
    """(group, i, j, rep): every two members of a group meet in a block pair."""
    members = members.withColumn("_n", blocks.cast("int")).withColumn("_b", F.pmod(F.xxhash64("rep"), F.col("_n")).cast("int"))
    return (
        members.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .select(F.col(group).alias("group"), F.least("_b", "_o").alias("i"), F.greatest("_b", "_o").alias("j"), "rep")
    )


def _total(table: DataFrame, size: str) -> int:
    return table.agg(F.sum(size)).first()[0] or 0


def _bounds(share: int) -> tuple[int, float]:
    """Values of a band, and the least estimate, for links of ``share``: both
    as likely to lose a link as at 85, or less."""
    if share >= SHARE:
        return BAND, LEAST
    s = share / 100
    band = max(b for b in range(1, BAND + 1) if _VALUES % b == 0 and (b == 1 or (1 - s**b) ** (_VALUES // b) <= 7e-8))
    return band, s - 5.7 * (s * (1 - s) / _VALUES) ** 0.5


def _classes(docs: DataFrame, share: int, block: int, shingle: int) -> DataFrame:
    """As ``classes``, with the digest of each row's set."""
    size_of_band, least = _bounds(share)
    ship(docs.sparkSession)
    docs = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = docs.mapInArrow(partial(_sign, shingle=shingle), "row_id long, n_shingles long, one long, two long, signature binary")
    signed = materialize(signed.withColumnRenamed("row_id", "doc_id"), "signed")

    known = signed.where("doc_id is not null and n_shingles > 0")
    rep = [F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("shingles"), F.first("signature").alias("signature")]
    reps = materialize(known.groupBy("one", "two").agg(*rep), "reps")

    width = 2 * size_of_band
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("signature", 1 + i * width, width)) for i in range(_VALUES // size_of_band)])
    bands = reps.select("rep", F.explode(keys).alias("key"))

    def candidates_() -> DataFrame:
        counts = materialize(bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "bands")
        met = _in_blocks(join_counted(bands, counts, ["key"], "size", _total(counts, "size")), "key", F.ceil(F.col("size") / block))
        met = met.join(reps.select("rep", "signature"), "rep").select("group", "i", "j", "rep", "signature")
        near = met.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "rep").mapInArrow(partial(_compare, least=least), "u long, v long")
        sized = reps.groupBy(F.col("rep").alias("node")).agg(F.max("shingles").alias("shingles"))
        return connected_components(near).join(sized, "node")

    candidates = settled(candidates_, "candidates")

    def components_() -> DataFrame:
        sizes = materialize(candidates.groupBy("component").agg(F.count("*").alias("size"), F.sum("shingles").alias("shingles_")), "sizes")
        members = join_counted(candidates.select(F.col("node").alias("rep"), "component"), sizes, ["component"], "size", _total(sizes, "size"))
        blocks = F.greatest(F.ceil(F.col("size") / block), F.least("size", F.ceil(F.col("shingles_") / BLOCK_SHINGLES)))
        members = _in_blocks(members, "component", blocks)
        some = only_members(docs, "doc_id", candidates.select("node"))
        texts = members.join(some, members.rep == some.doc_id).select("group", "i", "j", "rep", "text")
        links = texts.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "rep").mapInArrow(_verify(share, shingle), "u long, v long")
        return connected_components(links)

    components = settled(components_, "components")

    named = reps.select("one", "two", "rep", "copies").join(components, F.col("rep") == F.col("node"), "left")
    named = named.select("one", "two", "copies", F.coalesce("component", "rep").alias("component"))
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    rows = signed.select("doc_id", "n_shingles", "one", "two")
    return (
        join_counted(rows, named, ["one", "two"], "copies", _total(reps, "copies"), "left")
        .withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        .select("doc_id", "n_shingles", "component_id", "kept", "one", "two")
    )


def classes(docs: DataFrame, share: int = SHARE, block: int = BLOCK, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; links
    share ``share`` per cent of their shingles of ``shingle`` words."""
    return _classes(docs, share, block, shingle).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, share: int = SHARE, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without the near duplicates; the least doc_id of a class stays.
    Rows are told apart by doc_id and set, so of several texts of one doc_id
    those in other classes stay."""
    gone = materialize(_classes(docs, share, BLOCK, shingle).where("not kept").select("doc_id", "one", "two").distinct(), "gone")
    typed = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    some, others = by_membership(typed, "doc_id", gone.select("doc_id"))
    names = [next(n for n in (f"_{k}{'_' * i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns) for k in ("one", "two")]
    kept = _with_set(typed, some, names, shingle).join(gone.toDF("doc_id", *names), ["doc_id", *names], "left_anti")
    return typed.mapInArrow(others, typed.schema).unionAll(kept.select(*docs.columns)).select(*[F.col(f"`{c}`").cast(docs.schema[c].dataType) for c in docs.columns])
