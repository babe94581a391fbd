"""Toxic passages by maximum-scoring segments.

Training, on at most ``TRAIN_ROWS`` labelled documents chosen by hash:

1. A token's features are the word and its prefixes of 4 to 8 bytes, so that
   compounds share evidence.  Each feature gets a log-odds ratio of document
   counts under an informative Dirichlet prior (as strong as a share of the
   training documents, in proportion to the feature's frequency) and a z score.
2. A token's score is the log-odds of its feature of greatest absolute z: above
   zero where z passes a threshold, below where it passes ``CLEAN`` times that
   threshold on the other side (toxic documents are few, so no word that they
   lack can have a z as great).  Every other token costs ``DRIFT``.
3. On a fold that gave no counts, the maxima of clean documents fit an
   extreme-value law, P(max < s) = exp(-K n exp(-lambda s)), by censored
   likelihood; a logistic curve on lambda s - ln(K n) gives the score.  The
   prior and threshold with the least loss on this fold are kept.

Scoring walks each text once: all maximal scoring segments come from one pass
over its toxic words, between which sums of scores say what clean ones cost.
The model holds the features that pass the least threshold; they come from at
most ``TRAIN_ROWS`` documents.

Edge cases: null or empty text scores as a text without hits; rows without
labels are scored like others; labels that are null, not 0 or 1, or without a
document are ignored (several labels of a document: the greatest); with one
class only or no labels at all the score is the base rate.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, batch, materialize, plain, ship, span_hashes, text_slices

#: Bound on the labelled documents that training reads.
TRAIN_ROWS = 40_000
DRIFT = 0.1
#: The threshold for clean words, as a share of that for toxic ones.
CLEAN = 0.5
PREFIXES = (4, 5, 6, 7, 8)
PRIORS = (0.005, 0.02)
THRESHOLDS = (3.0, 4.0, 5.0, 6.0, 8.0)
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
#: Text bytes whose features a task holds at a time.
SLICE_BYTES = 1 << 20

_GAP = np.ones(256, bool)
_GAP[97:123] = False
_GAP[128:] = False


def fold(column: str = "doc_id") -> F.Column:
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(FOLDS))


def _features(texts: pa.Array) -> tuple[Words, list[tuple[np.ndarray, np.ndarray]]]:
    """The tokens, and for each kind of feature (tokens that have it, hash)."""
    w = Words(pc.utf8_lower(texts), classes=_GAP)
    out = [(np.arange(len(w.start)), w.hashes(1))]
    size = w.end - w.start
    for k in PREFIXES:
        i = np.flatnonzero(size >= k)
        out.append((i, span_hashes(w.buf, w.start[i], w.start[i] + k, 2)))
    return w, out


_COUNTS = pa.schema([("feature", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])


def _count(batches):
    # each token has up to six features, so slices are small
    for b in text_slices(batches, 0, SLICE_BYTES):
        label = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
        w, kinds = _features(b.column(0))
        doc = w.doc()
        pairs = np.unique(np.stack([np.concatenate([h for _, h in kinds]), np.concatenate([doc[i] for i, _ in kinds]).astype(np.uint64)], axis=1).view("V16").ravel()).view(np.uint64).reshape(-1, 2) if len(w.start) else np.zeros((0, 2), np.uint64)
        order = np.argsort(pairs[:, 0], kind="stable")
        feature, is_toxic = pairs[order, 0], label[pairs[order, 1].astype(np.int64)]
        head = np.flatnonzero(np.concatenate([[True], feature[1:] != feature[:-1]])) if len(feature) else np.zeros(0, np.int64)
        n = np.diff(head, append=len(feature))
        t = np.add.reduceat(is_toxic, head, dtype=np.int64) if len(head) else n
        yield batch(_COUNTS, feature[head].view(np.int64), t, n - t)


class Table(NamedTuple):
    """Sorted feature hashes with log-odds and z, and a bit map to skip by."""

    keys: np.ndarray
    odds: np.ndarray
    z: np.ndarray
    maybe: np.ndarray


def table(keys: np.ndarray, odds: np.ndarray, z: np.ndarray) -> Table:
    order = np.argsort(keys)
    maybe = np.zeros(1 << 18, bool)
    maybe[(keys & np.uint64((1 << 18) - 1)).astype(np.int64)] = True
    return Table(keys[order], odds[order], z[order], maybe)


def log_odds(toxic: np.ndarray, clean: np.ndarray, docs: tuple[int, int], share: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds ratio and z of document counts under the Dirichlet prior."""
    n_clean, n_toxic = docs
    strength = share * (n_clean + n_toxic)
    a = strength * (toxic + clean) / (n_clean + n_toxic)
    t, c = toxic + a, clean + a
    odds = np.log(t / np.maximum(n_toxic + strength - t, 1e-9)) - np.log(c / np.maximum(n_clean + strength - c, 1e-9))
    return odds, odds / np.sqrt(1 / t + 1 / c)


def _scores(w: Words, kinds, t: Table) -> np.ndarray:
    """Each token's score by the table: its best feature's log-odds."""
    best, score = np.zeros(len(w.start)), np.full(len(w.start), -DRIFT)
    low = np.uint64(len(t.maybe) - 1)
    for i, h in kinds if len(t.keys) else []:
        some = np.flatnonzero(t.maybe[(h & low).astype(np.int64)])
        at = np.minimum(np.searchsorted(t.keys, h[some]), len(t.keys) - 1)
        found = t.keys[at] == h[some]
        at, token = at[found], i[some[found]]
        better = np.abs(t.z[at]) > best[token]
        best[token[better]], score[token[better]] = np.abs(t.z[at[better]]), t.odds[at[better]]
    return score


def segments(at: list[int], before: list[float], after: list[float]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first token, last token) of a text,
    from the places of its positive scores and the sums of all scores before and
    after each; linear in those places."""
    out: list[list] = []  # sum before, sum after, first, last
    for p, b, a in zip(at, before, after, strict=True):
        new = [b, a, p, p]
        while True:
            k = len(out) - 1
            while k >= 0 and out[k][0] >= new[0]:
                k -= 1
            if k < 0 or out[k][1] >= new[1]:
                out.append(new)
                break
            new = [out[k][0], new[1], out[k][2], new[3]]
            del out[k:]
    return [(b - a, first, end) for a, b, first, end in out]


def _found(w: Words, kinds, t: Table) -> list[list[tuple[float, int, int]]]:
    """The segments of each document; tokens count from its first one."""
    score = _scores(w, kinds, t)
    total = np.cumsum(score)
    at = np.flatnonzero(score > 0)
    edge, after, before = np.searchsorted(at, w.first).tolist(), total[at].tolist(), (total[at] - score[at]).tolist()
    place = (at - np.repeat(w.first[:-1], np.diff(edge))).tolist()
    return [segments(place[a:b], before[a:b], after[a:b]) if a < b else [] for a, b in zip(edge[:-1], edge[1:], strict=True)]


class Model(NamedTuple):
    table: Table
    rate: float
    scale: float  # lambda
    size: float  # K
    curve: tuple[float, float, float] | None


def evidence(found: list[float], n: int, scale: float, size: float) -> tuple[float, float]:
    """The best segment's score in nats beyond chance, and what others add."""
    chance = math.log(max(size * max(n, 1), 1e-12))
    x = sorted((scale * s - chance for s in found), reverse=True)
    best = x[0] if x else -chance
    return min(best, 60.0), min(sum(v for v in x[1:] if v > 0), 60.0)


def extreme_value(s: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """lambda and K by likelihood; documents without a segment are censored."""
    hit, n = s > 0, np.maximum(n, 1)
    if hit.sum() < 5:
        return 1.0, max(0.5, float(hit.sum())) / float(n.sum())
    best = None
    for scale in np.geomspace(0.05, 8, 60):
        e = n * np.exp(-scale * s)
        k = hit.sum() / e.sum()
        loss = -(hit.sum() * math.log(k * scale) - scale * s[hit].sum() - k * e.sum())
        if best is None or loss < best[0]:
            best = (loss, float(scale), float(k))
    return best[1], best[2]


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients (intercept first) and mean loss, with a slight ridge."""
    a = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w = np.zeros(a.shape[1])
    ridge = np.array([1e-3, *[1e-2] * x.shape[1]])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -35, 35)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(ridge), a.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
    p = np.clip(1 / (1 + np.exp(-np.clip(a @ w, -35, 35))), 1e-9, 1 - 1e-9)
    return w, float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


_TRIALS = pa.schema([("toxic", pa.int32()), ("n", pa.int64()), ("values", pa.list_(pa.float64()))])


def _try(tables, laws: list[tuple[float, float]] | None = None):
    """Per calibration document a number for each candidate table, its best
    segment's score, or two by the tables' extreme-value laws, its evidence."""

    def run(batches):
        for b in text_slices(batches, 0, SLICE_BYTES):
            w, kinds = _features(b.column(0))
            n = w.counts().tolist()
            values: list[list] = [[] for _ in n]
            for i, t in enumerate(tables.value):
                for to, m, found in zip(values, n, _found(w, kinds, t), strict=True):
                    scores = [f[0] for f in found]
                    to.extend(evidence(scores, m, *laws[i]) if laws else [max(scores, default=0.0)])
            yield batch(_TRIALS, b.column(1).cast(pa.int32()), n, values)

    return run


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    spark = docs.sparkSession
    ship(spark)
    labels = plain(labels, "doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)")
    labels = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    # bounded: at most ``rows`` rows of two numbers, so it may be broadcast
    sample = labels.where(fold() != HELD_OUT).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    docs = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    train = materialize(docs.join(F.broadcast(sample), "doc_id").select("text", "toxic", (fold() == CALIBRATION).alias("calibrate")), "labelled")
    n = {(r.calibrate, r.toxic): r["count"] for r in train.groupBy("calibrate", "toxic").count().collect()}
    every = {y: n.get((False, y), 0) + n.get((True, y), 0) for y in (0, 1)}
    rate = (every[1] + 0.5) / (every[0] + every[1] + 1)
    sizes = (n.get((False, 0), 0), n.get((False, 1), 0))
    empty = table(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    if min(sizes) == 0 or min(n.get((True, 0), 0), n.get((True, 1), 0)) == 0:
        return Model(empty, rate, 1.0, 1.0, None)

    counts = train.where("not calibrate").select("text", "toxic").mapInArrow(_count, "feature long, toxic long, clean long")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # features that pass the least threshold under some prior, by the formula of log_odds
    n_clean, n_toxic = sizes
    total, passing = n_clean + n_toxic, F.lit(False)
    for share in PRIORS:
        a = F.lit(share) * (F.col("toxic") + F.col("clean"))
        t, c, strength = F.col("toxic") + a, F.col("clean") + a, share * total
        odds = F.log(t / F.greatest(n_toxic + strength - t, F.lit(1e-9))) - F.log(c / F.greatest(n_clean + strength - c, F.lit(1e-9)))
        z = odds / F.sqrt(1 / t + 1 / c)
        passing = passing | (z >= 0.999 * min(THRESHOLDS)) | (z <= -0.999 * CLEAN * min(THRESHOLDS))
    kept = counts.where(passing).toPandas()
    keys, toxic, clean = kept.feature.to_numpy().view(np.uint64), kept.toxic.to_numpy(), kept.clean.to_numpy()
    tables = []
    for share in PRIORS:
        odds, z = log_odds(toxic, clean, sizes, share)
        for least in THRESHOLDS:
            good = (z >= least) | (z <= -CLEAN * least)
            tables.append(table(keys[good], odds[good], z[good]))
    sent = spark.sparkContext.broadcast(tables)
    # a few numbers for each of at most ``rows`` documents come to the driver
    tried = lambda *laws: train.where("calibrate").select("text", "toxic").mapInArrow(_try(sent, *laws), "toxic int, n long, values array<double>").collect()
    trials = tried()
    y, n_tokens, top = np.array([r.toxic for r in trials]), np.array([r.n for r in trials]), np.array([r["values"] for r in trials])
    laws = [extreme_value(top[y == 0, i], n_tokens[y == 0]) for i in range(len(tables))]
    trials = tried(laws)
    y, x = np.array([r.toxic for r in trials]), np.array([r["values"] for r in trials])
    best = None
    for i, (t, law) in enumerate(zip(tables, laws, strict=True)):
        w, loss = logistic(x[:, 2 * i : 2 * i + 2], y)
        if best is None or loss < best[0] - 1e-6:
            best = (loss, Model(t, rate, *law, tuple(float(v) for v in w)))
    return best[1]


def _score(model: Model, found: list[float], n: int) -> float:
    if model.curve is None:
        return model.rate
    a, b = evidence(found, n, model.scale, model.size)
    z = model.curve[0] + model.curve[1] * a + model.curve[2] * b
    return 1 / (1 + math.exp(-min(max(z, -35.0), 35.0)))


def _judged(model: Model, texts: pa.Array) -> tuple[list[float], list[list], list[int]]:
    """Score, segments and tokens of each text."""
    w, kinds = _features(texts)
    n, found = w.counts().tolist(), _found(w, kinds, model.table)
    return [_score(model, [s for s, _, _ in f], m) for f, m in zip(found, n, strict=True)], found, n


_OUT = pa.schema([("row_id", pa.int64()), ("score", pa.float64()), ("passages", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("evidence", pa.float64())])))])


def _apply(model):
    def run(batches):
        m = model.value
        for b in text_slices(batches, 1, SLICE_BYTES):
            scores, found, n = _judged(m, b.column(1))
            beyond = [[(evidence([s], k, m.scale, m.size)[0], i, j) for s, i, j in f] for f, k in zip(found, n, strict=True)]
            yield batch(_OUT, b.column(0), scores, [[{"first": i, "last": j, "evidence": e} for e, i, j in x if e > 0] for x in beyond])

    return run


def score(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted and passages (token positions, and
    evidence in nats) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, rows))
    docs = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = docs.mapInArrow(_apply(model), "row_id long, score double, passages array<struct<first:long,last:long,evidence:double>>")
    out = out.withColumnRenamed("row_id", "doc_id")
    return out.select("doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")


def keep_clean(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the rows predicted toxic; columns as they were."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, rows))
    text = docs.columns.index("text")

    def run(batches):
        for b in text_slices(batches, text, SLICE_BYTES):
            scores, _, _ = _judged(model.value, b.column(text).cast(pa.string()))
            yield b.filter(pa.array([x < 0.5 for x in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
