"""Packing of token sequences by shortest-pack-first over the length histogram.

1. One Arrow pass tokenizes whole texts, adds the end id, cuts documents of
   more than ``size`` tokens into pieces and notes each piece's length, its
   partition and its rank among that partition's pieces of the same length.
2. The histogram (at most ``size`` rows) is all that reaches the driver.
   Lengths are placed longest first, each into the emptiest open pattern that
   has room; only counts of patterns change, never single pieces.
3. A pattern's claim on a length is an interval of ranks.  The intervals (at
   most a few times ``size``) are broadcast, and each piece finds its sequence
   and offset by binary search.  Global ranks are partition offsets plus local
   ranks, so no length's pieces ever meet in one task.

Edge cases: a null or empty text is the end id alone.  Rows are packed as they
come, also with null or repeated doc_ids.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import word_bpe
from .common import batch, materialize, plain, ship, text_slices

SIZE = 2048
END = 1
_FIELDS = [("row_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("part", pa.int32()), ("local", pa.int64())]
_DDL = "row_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, local long"


def _cut(path: str, size: int, with_ids: bool):
    schema = pa.schema(_FIELDS + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches):
        tokenizer, part = word_bpe.load(path), TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for b in text_slices(batches, 1):
            ids, to = tokenizer.texts(b.column(1))
            n = np.diff(to) + 1
            pieces = (n + size - 1) // size
            doc = np.repeat(np.arange(len(n)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * size
            length = np.minimum(size, n[doc] - start)
            flat = ids.astype("<u4")
            end = np.array([END], "<u4").tobytes()
            crc, kept = [], []
            for d, s, m, last in zip(doc.tolist(), start.tolist(), length.tolist(), (start + length == n[doc]).tolist(), strict=True):
                at = int(to[d]) + s
                c = zlib.crc32(flat[at : at + m - last])
                crc.append(zlib.crc32(end, c) if last else c)
                if with_ids:
                    kept.append(np.append(ids[at : at + m - last], [END] * last).astype(np.int32))
            order = np.argsort(length, kind="stable")
            head = np.flatnonzero(np.diff(length[order], prepend=-1))
            run_of = np.repeat(np.arange(len(head)), np.diff(head, append=len(order)))
            local = np.empty(len(order), np.int64)
            local[order] = seen[length[order]] + np.arange(len(order)) - head[run_of]
            np.add.at(seen, length, 1)
            yield batch(schema, b.column(0).take(pa.array(doc)), start, length, crc, n[doc], np.full(len(doc), part), local, *([pa.array(kept, pa.list_(pa.int32()))] if with_ids else []))

    return run


def patterns(histogram: np.ndarray, size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns for ``histogram[length]`` pieces of each length:
    (how many sequences, [(length, times), ...] longest first)."""
    room: list[list] = [[] for _ in range(size + 1)]  # room[free] = open patterns
    for length in range(size, 0, -1):
        left = int(histogram[length])
        # every open pattern takes one piece at a time; those with most room first
        free = size
        while left:
            while free >= length and not room[free]:
                free -= 1
            if free < length:  # a new pattern, as full as this length makes it at once
                times = min(size // length, left)
                many = left // times
                room[size - times * length].append((many, [(length, times)]))
                left -= many * times
                continue
            many, pattern = room[free].pop()
            used = min(many, left)
            if used < many:
                room[free].append((many - used, pattern))
            if pattern and pattern[-1][0] == length:
                grown = [*pattern[:-1], (length, pattern[-1][1] + 1)]
            else:
                grown = [*pattern, (length, 1)]
            room[free - length].append((used, grown))
            left -= used
    return [p for free in room for p in free]


def intervals(found: list[tuple[int, list[tuple[int, int]]]], size: int) -> dict[str, np.ndarray]:
    """Per (pattern, length): the ranks it claims and where they go."""
    cursor, base, rows = [0] * (size + 1), 0, []
    for many, pattern in found:
        at = 0
        for length, times in pattern:
            rows.append((length, cursor[length], base, times, at))
            cursor[length] += many * times
            at += length * times
        base += many
    t = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"key": (t[:, 0] << 48) + t[:, 1], "low": t[:, 1], "base": t[:, 2], "times": t[:, 3], "at": t[:, 4]}


def _place(table, schema: pa.Schema):
    def run(batches):
        t = table.value
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in ("length", "rank"))
            i = np.searchsorted(t["key"], (length << 48) + rank, "right") - 1
            nth = rank - t["low"][i]
            more = [pa.array(t["base"][i] + nth // t["times"][i]), pa.array(t["at"][i] + nth % t["times"][i] * length)]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k, f in enumerate(b.schema) if f.name != "rank"], *more], schema=schema)

    return run


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and with ``with_ids`` the ids themselves."""
    spark = docs.sparkSession
    ship(spark)
    docs = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ddl = _DDL + (", ids array<int>" if with_ids else "")
    pieces = materialize(docs.mapInArrow(_cut(path or word_bpe.default_path(), size, with_ids), ddl), "pieces")
    local = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = np.zeros(size + 1, np.int64)
    for r in local.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r.length] = r.n
    table = spark.sparkContext.broadcast(intervals(patterns(histogram, size), size))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = local.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    extra = ["ids"] if with_ids else []
    ranked = pieces.join(shift, ["length", "part"]).select("row_id", "start", "length", "ids_crc32", "doc_tokens", *extra, (F.col("local") + F.col("shift")).alias("rank"))
    fields = [f for f in _FIELDS if f[0] not in ("part", "local")] + ([("ids", pa.list_(pa.int32()))] if with_ids else []) + [("sequence_id", pa.int64()), ("offset", pa.int64())]
    ddl = "row_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if with_ids else "") + ", sequence_id long, offset long"
    return ranked.mapInArrow(_place(table, pa.schema(fields)), ddl).withColumnRenamed("row_id", "doc_id")
