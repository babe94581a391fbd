"""Helpers shared by the training-data operators.

Storage rule: intermediate tables go to the shared folder named by
``spark.checkpoint.dir``.  Only a local session without that setting (tests)
gets a temporary folder; a cluster without it is an error.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import spread, table

# Workers live on between tasks: what a batch held goes back to the system.
pa.set_memory_pool(pa.system_memory_pool())

#: Bytes of text that one numpy pass handles at a time.
CHUNK_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(table(spark, sf_dir, name))


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the session's checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _test_dir()
    return f"{base.rstrip('/')}/glotta-{uuid.uuid4().hex}"


_TEST_DIR: list[str] = []


def _test_dir() -> str:
    if not _TEST_DIR:
        _TEST_DIR.append(tempfile.mkdtemp(prefix="glotta-"))
        atexit.register(shutil.rmtree, _TEST_DIR[0], ignore_errors=True)
    return f"file://{_TEST_DIR[0]}"


#: Tables that ``materialize`` made and nobody has deleted.
_MADE: list[str] = []


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there, and a lost executor costs no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    _MADE.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def made() -> int:
    return len(_MADE)


def settled(make: Callable[[], DataFrame], name: str, since: int | None = None) -> DataFrame:
    """``make()`` written and read back; the tables made on its way, or since
    ``made()`` was ``since``, are deleted."""
    since = len(_MADE) if since is None else since
    df = materialize(make(), name)
    for path in _MADE[since:-1]:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder.getParent(), True)
    del _MADE[since:-1]
    return df


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    package = os.path.join(root, "glotta")
    folder = tempfile.mkdtemp(prefix="glotta-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "glotta_workers.zip")
    with zipfile.ZipFile(target, "w") as z:
        for d, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def salt_of(n: int, *cols) -> F.Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, by one scan of that column: what tables, buckets and
    sketches are sized by, so that a task's share stays the same at any input."""
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0


# ---------------------------------------------------------------- Arrow text


def text_slices(batches, text: int | str, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of at most ``max_bytes`` of text (or one row)."""
    for b in batches:
        if not b.num_rows:
            continue
        col = b.column(text) if isinstance(text, int) else b.column(b.schema.get_field_index(text))
        size = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            seen = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, seen + max_bytes, "right")))
            yield b.slice(at, to - at)
            at = to


def flat_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column laid end to end, and its offsets."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    if not len(col) or bufs[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([0] + [(1 << (8 * i)) - 1 for i in range(1, 9)], dtype=np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S32, _S29 = np.uint64(32), np.uint64(29)


def mix(z: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    z = z * _A
    z ^= z >> _S32
    z *= _B
    z ^= z >> _S29
    z *= _A
    z ^= z >> _S32
    return z


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes, equal hash."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray(shape=(len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = end - start
    h = mix(left.astype(np.uint64) + np.uint64(seed))
    at = start
    h = mix(h ^ (eight[at] & _MASK[np.minimum(left, 8)]))
    rest = np.flatnonzero(left > 8)
    done = 8
    while len(rest):
        h[rest] = mix(h[rest] ^ (eight[start[rest] + done] & _MASK[np.minimum(left[rest] - done, 8)]))
        done += 8
        rest = rest[left[rest] > done]
    return h


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a slice of texts.

    ``start``/``end`` are byte positions in ``buf``; document d has the words
    ``first[d]:first[d + 1]``.
    """

    def __init__(self, col: pa.Array, lower: bool = False, classes: np.ndarray | None = None):
        self.buf, self.offs = flat_bytes(col)
        if lower:
            self.buf = _LOWER[self.buf]
        n = len(self.buf)
        gap = (_SPACE if classes is None else classes)[self.buf]
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = gap[:-1], gap[1:]
        inner = self.offs[(self.offs > 0) & (self.offs < n)]
        before[inner] = True
        after[inner - 1] = True
        word = ~gap
        self.start = np.flatnonzero(word & before)
        self.end = np.flatnonzero(word & after) + 1
        self.first = np.searchsorted(self.start, self.offs)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return span_hashes(self.buf, self.start, self.end, seed)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offs) - 1), self.counts())


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Hashes of every run of ``k`` values, by prefix sums modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self._p = self._i = np.ones(1, np.uint64)

    def __call__(self, h: np.ndarray, k: int) -> np.ndarray:
        n = len(h)
        if n < k:
            return np.zeros(0, np.uint64)
        if len(self._p) < n + 1:
            self._p, self._i = powers(self.base, n), powers(self.inverse, n)
        s = np.zeros(n + 1, np.uint64)
        np.cumsum(h * self._p[:n], dtype=np.uint64, out=s[1:])
        return mix((s[k:] - s[: n - k + 1]) * self._i[: n - k + 1])


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    have, out = 1, a
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        more = width - have
        out = np.minimum(out[:-more], out[more:])
    return out


def blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def batch(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def plain(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; extra columns never reach an operator."""
    return df.select(*[F.col(f"`{n}`") for n in names])


# ------------------------------------------------------------ id membership

#: Bits of a membership filter: its size, whatever the input.
FILTER_BITS = 1 << 26
_FILTER_BLOCK = 1 << 16


def _bit_positions(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mix(ids.view(np.uint64) + np.uint64(31 * r + 7)) % np.uint64(bits)).astype(np.int64) for r in range(2)]


def membership(ids: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter of a long column as packed bits, ``bits / 8`` bytes.  It
    has every id; when it fills up it only lets more others through."""

    def mark(batches):
        seen = np.zeros(bits, bool)
        for b in batches:
            for at in _bit_positions(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), bits):
                seen[at] = True
        used = np.flatnonzero(seen)
        block = used // _FILTER_BLOCK
        head = np.flatnonzero(np.diff(block, prepend=-1))
        if len(used):
            parts = [blob((used[a:b] % _FILTER_BLOCK).astype("<u2")) for a, b in zip(head, np.append(head[1:], len(used)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(block[head].astype(np.int32)), pa.array(parts, pa.binary())], names=["block", "at"])

    def merge(batches):
        have: dict[int, np.ndarray] = {}
        for b in batches:
            for i, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                have.setdefault(i, np.zeros(_FILTER_BLOCK, bool))[np.frombuffer(at, "<u2")] = True
        if have:
            yield pa.RecordBatch.from_arrays([pa.array(list(have), pa.int32()), pa.array([blob(np.packbits(x, bitorder="little")) for x in have.values()], pa.binary())], names=["block", "bits"])

    out = np.zeros(bits // 8, np.uint8)
    marked = ids.mapInArrow(mark, "block int, at binary").repartition("block").mapInArrow(merge, "block int, bits binary")
    for r in marked.toLocalIterator():
        out[r.block * _FILTER_BLOCK // 8 :][: _FILTER_BLOCK // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def by_membership(df: DataFrame, column: str, ids: DataFrame, bits: int = FILTER_BITS):
    """Two filters of ``df``'s batches for ``mapInArrow``: rows whose ``column``
    may be in ``ids``, and the others, which surely aren't.  A join for the
    former then keeps most wide rows out of the shuffle.  What else a task does
    to a batch goes into the same function, as each has a worker of its own."""
    sent = df.sparkSession.sparkContext.broadcast(membership(ids, bits))
    k = df.columns.index(column)

    def only(wanted: bool):
        def run(batches):
            has = sent.value
            for b in batches:
                x = b.column(k)
                found = x.is_valid().to_numpy(zero_copy_only=False)
                for at in _bit_positions(pc.fill_null(x, 0).to_numpy(zero_copy_only=False).astype(np.int64), bits):
                    found = found & ((has[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0)
                if (found == wanted).any():
                    yield b.filter(pa.array(found == wanted))

        return run

    return only(True), only(False)


def only_members(df: DataFrame, column: str, ids: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    return df.mapInArrow(by_membership(df, column, ids, bits)[0], df.schema)


# ---------------------------------------------------------------- heavy keys

#: A key of more rows than HEAVY is joined by broadcast.  The bound rises with
#: the rows, so that fewer than MOST_HEAVY keys are.
HEAVY, MOST_HEAVY = 200, 50_000


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``table``, which has a row per key and in
    ``size`` the rows of that key, at most ``total`` over all.  Keys of many
    rows stay where they are and get their table row by broadcast; the others
    meet in a shuffled join."""
    bound = max(HEAVY, total // MOST_HEAVY)
    heavy = table.where(F.col(size) > bound).withColumn("_heavy", F.lit(True))
    marked = rows.join(F.broadcast(heavy), keys, "left")
    light = marked.where("_heavy is null").select(*rows.columns).join(table.where(F.col(size) <= bound), keys, how)
    return marked.where("_heavy").select(*light.columns).unionAll(light)
