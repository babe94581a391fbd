"""Approximate nearest neighbours by a permutation index.

Each vector is represented by its ``PREFIX`` nearest of ``PIVOTS`` pivots in
order.  Every vector is posted, with the pivot's place, to the inverted files of
its pivots; as a prefix names half of the pivots, a file is a dense row of
places.  A query walks the files of its own pivots and adds up the footrule
distance (a missing pivot counts as place ``PREFIX``).  A block has two sets of
pivots, and so two indexes: vectors as they come, many of them from where the
vectors are dense, and vectors apart from each other, so that a crowd doesn't
take the first places of all permutations.  The nearest by each footrule, half
of ``SHARE`` of the block's vectors (but no fewer than an answer needs), are
reranked by true distance.

Vectors of one length are dealt into blocks of ``BLOCK_VALUES`` numbers by a hash
of vec_id, so no cluster or group of copies meets in one block; a block's pivots
are chosen among its vectors by a hash of their ids.  Each block answers with its ``k``
best and a small top-k per query joins them.  Equal vectors fold into one within
a block, so copies crowd nothing out.  Neither vectors nor pivots leave the
executors, and the result doesn't depend on how many there are.

Edge cases: vectors that are null, zero, or hold null or non-finite components
take no part, nor does a null vec_id.  Vectors of different lengths have no
distance; each length has an index of its own.  Rows that repeat a vec_id: as
candidates the nearest one counts, once; as queries the least vector, in the
order of arrays.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_counted, mix, plain, ship

PIVOTS = 256
PREFIX = 128
#: Share of a block reranked by true distance.
SHARE = 0.1
#: Numbers in a block's vectors: 32 MB.
BLOCK_VALUES = 1 << 22
#: Queries that meet a block at a time.
QUERIES = 16_384

_OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _matrix(col: pa.ChunkedArray, n: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks)
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _places(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each vector in order, ties to the first pivot."""
    d = (pivots**2).sum(1)[None, :] - 2 * (x @ pivots.T)
    return np.argsort(d, axis=1, kind="stable")[:, :prefix]


class Index:
    """The inverted files of one block's distinct vectors."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, prefix: int):
        self.vectors, self.pivots, self.prefix = vectors, pivots, min(prefix, len(pivots))
        self.files = np.full((len(pivots), len(vectors)), self.prefix, np.int16)
        place = np.arange(self.prefix, dtype=np.int16)
        for a in range(0, len(vectors), 4096):
            near = _places(vectors[a : a + 4096], pivots, self.prefix)
            np.put_along_axis(self.files[:, a : a + 4096], near.T, np.broadcast_to(place[:, None], near.T.shape), axis=0)
        # footrule of a vector that shares no pivot with a query
        self.apart = self.prefix * (self.prefix + 1)

    def footrule(self, near: np.ndarray) -> np.ndarray:
        """Distances of all vectors from a query with these nearest pivots."""
        out = np.full(len(self.vectors), self.apart, np.int32)
        some = np.zeros(len(self.vectors), np.int16)
        for q, p in enumerate(near.tolist()):
            # shared: |place - q| instead of both sides' distance to the end
            file = self.files[p]
            some += np.abs(file - np.int16(q))
            some += file
            if q % 32 == 31:  # before 16 bits overflow
                out += some
                some[:] = 0
        return out + some - sum(2 * self.prefix - q for q in range(len(near)))

    def candidates(self, query: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` first by footrule, with ties."""
        if count >= len(self.vectors):
            return np.arange(len(self.vectors))
        foot = self.footrule(_places(query[None, :], self.pivots, self.prefix)[0])
        return np.flatnonzero(foot <= np.partition(foot, count - 1)[count - 1])


def _apart(x: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the vectors, in order, each at least half of the median
    distance from those before."""
    d = np.sqrt(np.maximum((x**2).sum(1)[:, None] + (x**2).sum(1)[None, :] - 2 * x @ x.T, 0))
    least, near, out = np.median(d) / 2, np.zeros(len(x), bool), []
    for i in range(len(x)):
        if not near[i]:
            out.append(i)
            near |= d[i] < least
            if len(out) == n:
                break
    return x[out]


class Indexes:
    """A block's two indexes."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, pivots: int, prefix: int):
        self.vectors = vectors
        some = vectors[np.argsort(mix(ids.view(np.uint64)), kind="stable")[: 5 * pivots]]
        apart = _apart(some[pivots:] if len(some) > 2 * pivots else some, pivots)
        self.both = [Index(vectors, p, prefix) for p in (some[:pivots], apart)]

    def nearest(self, query: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Candidates, ``count`` by each index, and their true distances."""
        at = np.union1d(*(i.candidates(query, count) for i in self.both))
        return at, np.sqrt(((self.vectors[at] - query) ** 2).sum(axis=1))


def _search(k: int, pivots: int, prefix: int, share: float):
    def run(key, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return _OUT.empty_table()
        x = _matrix(vectors.column("vector"), vectors.num_rows)
        ids = vectors.column("vec_id").to_numpy().astype(np.int64)
        q = _matrix(queries.column("vector"), queries.num_rows)
        qid = queries.column("vec_id").to_numpy().astype(np.int64)
        # equal vectors fold; their k + 1 least ids are enough to answer with
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        _, head, which = np.unique((x + 0.0).view(f"V{8 * x.shape[1]}").ravel(), return_index=True, return_inverse=True)
        by = np.argsort(which, kind="stable")
        edge = np.searchsorted(which[by], np.arange(len(head) + 1))
        indexes = Indexes(x[head], ids[head], pivots, prefix)
        count = max(k + 1, int(np.ceil(share / 2 * len(head))))
        out = [], [], []
        for i in range(len(qid)):
            at, d = indexes.nearest(q[i], count)
            if len(at) > k + 1:
                best = d <= np.partition(d, k)[k]
                at, d = at[best], d[best]
            found = []
            for a, dist in zip(at, d, strict=True):
                mine = np.unique(ids[by[edge[a] : edge[a + 1]]])
                mine = mine[mine != qid[i]][:k]
                found += [(float(dist), int(v)) for v in mine]
            for dist, v in sorted(found)[:k]:
                out[0].append(int(qid[i]))
                out[1].append(v)
                out[2].append(dist)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, _OUT, strict=True)], schema=_OUT)

    return run


def search(vectors: DataFrame, is_query: F.Column, k: int = 10, pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE, block: int = BLOCK_VALUES) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) for each query row of
    ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    ship(spark)
    v = plain(vectors, "vec_id", "embedding").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = v.where("vec_id is not null and vector is not null and size(vector) > 0").where(sound & F.exists("vector", lambda x: x != 0))
    v = v.withColumn("dim", F.size("vector"))
    queries = v.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    counts = v.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(is_query).alias("asked")).where("asked > 0")
    n, blocks_, asked = counts.select(F.sum("n"), F.sum(F.ceil(F.col("n") * F.col("dim") / block)), F.sum("asked")).first()
    # queries of a block may be dealt to several tasks; that changes no result
    tasks = spark.sparkContext.defaultParallelism
    counts = counts.select("dim", "n", F.ceil(F.col("n") * F.col("dim") / block).cast("int").alias("blocks"), F.ceil(F.col("asked") / QUERIES).cast("int").alias("by_size"))
    counts = counts.select("dim", "n", "blocks", F.greatest("by_size", F.lit(min(-(-tasks // (blocks_ or 1)), asked or 1))).alias("shares"))
    left = join_counted(queries, counts, ["dim"], "n", n or 0)
    left = left.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("shares")).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = join_counted(v, counts, ["dim"], "n", n or 0)
    right = right.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    keys, columns = ["dim", "block", "part"], ["dim", "block", "part", "vec_id", "vector"]
    left, right = (x.select(*[F.col(c).alias(c) for c in columns]) for x in (left, right))
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k, pivots, prefix, share), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
