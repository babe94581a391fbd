"""Interval algebra and sequential packing of clips."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import ConcatConfig, MergeConfig, PackConfig, SegmentConfig
from .models import split_at_silence
from .ordering import number_rows


def merge_close(df: DataFrame, key: str, start: str, end: str, gap: int, ties: list[str] | None = None) -> DataFrame:
    """Intervals at most ``gap`` apart joined per key: (key, start, end, n)."""
    order = [start, end, *(ties or [])]
    w = Window.partitionBy(key).orderBy(*order)
    seen = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_new", F.when(F.col(start) - seen <= gap, 0).otherwise(1))
    marked = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(key, "_island").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("n")).drop("_island")


def halves(start: Column, end: Column, longest: int, depth: int = 40) -> Column:
    """Pieces of [start, end) after halving until none is over ``longest``.

    Halving by integer midpoints equals cutting in 2**k pieces level by level;
    the expression grows with ``log2(length / longest)`` levels only."""
    first = F.array(F.struct(start.cast("long").alias("start"), end.cast("long").alias("end")))

    def step(pieces: Column, _: Column) -> Column:
        def cut(p: Column) -> Column:
            mid = F.floor((p["start"] + p["end"]) / 2).cast("long")
            one = F.struct(p["start"].alias("start"), mid.alias("end"))
            two = F.struct(mid.alias("start"), p["end"].alias("end"))
            return F.when(p["end"] - p["start"] > longest, F.array(one, two)).otherwise(F.array(p))

        return F.flatten(F.transform(pieces, cut))

    levels = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(end - start, F.lit(1)) / F.lit(longest))) + 1).cast("int")
    rounds = F.when(levels > 0, F.sequence(F.lit(1), F.least(levels, F.lit(depth)))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rounds, first, step)


def between(pieces: Column, least: int, longest: int) -> Column:
    return F.filter(pieces, lambda p: (p["end"] - p["start"]).between(least, longest))


def segment_pipeline(df: DataFrame, key: str, start: str, end: str, gap: int, least: int, longest: int, ties: list[str] | None = None) -> DataFrame:
    """Merge, cut, filter and number a key's segments: (key, idx, start, end)."""
    merged = merge_close(df, key, start, end, gap, ties)
    pieces = merged.select(key, F.explode(between(halves(F.col("start"), F.col("end"), longest), least, longest)).alias("p")).select(key, "p.start", "p.end")
    return pieces.withColumn("idx", F.row_number().over(Window.partitionBy(key).orderBy("start", "end")) - 1)


def subsplit(x: np.ndarray, start: int, end: int, longest: int, top_db: float = 35.0, frame: int = 2048, hop: int = 512) -> list[tuple[int, int]]:
    """[start, end) of a signal in pieces of at most ``longest``: cut at its
    silences, which go, and where it has none at the midpoint."""
    if end - start <= longest:
        return [(start, end)]
    spans = split_at_silence(x[start:end], top_db, frame, hop)
    if len(spans) <= 1:
        mid = (start + end) // 2
        spans = [(0, mid - start), (mid - start, end - start)]
    return [p for a, b in spans for p in subsplit(x, start + a, start + b, longest, top_db, frame, hop)]


def segment_audio(df: DataFrame, key: str, samples: str, config: SegmentConfig = SegmentConfig(), top_db: float = 35.0, frame: int = 2048, hop: int = 512) -> DataFrame:
    """A signal's speech: found by energy, merged, cut at silences, filtered by
    length and numbered: (key, idx, start, end), in samples."""
    gap, least, longest = int(config.rate * config.gap_ms / 1000), int(config.rate * config.min_s), int(config.rate * config.max_s)

    def pieces(x) -> list[dict]:
        x, merged = np.asarray(x, float), []
        for a, b in split_at_silence(x, top_db, frame, hop):
            if merged and a - merged[-1][1] <= gap:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        cut = [p for a, b in merged for p in subsplit(x, a, b, longest, top_db, frame, hop)]
        return [{"start": a, "end": b} for a, b in cut if least <= b - a <= longest]

    @F.pandas_udf("array<struct<start:long,end:long>>")
    def spans(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else pieces(x))

    return df.select(key, F.posexplode(spans(samples)).alias("idx", "p")).select(key, "idx", "p.start", "p.end")


# ------------------------------------------------------------------- packing


def pack_short(df: DataFrame, order: str, duration: str, text: str, config: PackConfig = PackConfig()) -> DataFrame:
    """Short clips in groups of ``max_terms`` by position.

    While ``max_terms`` clips with pauses fit in ``max_s`` (as short clips do),
    a group is full by count alone, so its number follows from the position.
    """
    if config.max_terms * (config.short_s + config.pause_s) > config.max_s:
        raise ValueError("groups may fill up by duration; use pack_by_fold")
    rows = number_rows(df, order, "_n").withColumn("group", F.floor((F.col("_n") - 1) / config.max_terms).cast("long"))
    return _grouped(rows, duration, text, config)


#: Rows of a block that one task folds.
BLOCK = 1 << 16


def pack_by_fold(df: DataFrame, order: str, duration: str, text: str, config: PackConfig = PackConfig(), block: int = BLOCK) -> DataFrame:
    """As ``pack_short`` for any bounds.  A group that is full by duration with
    fewer than ``min_terms`` clips also loses the clip that did not fit, as in
    the reference.

    Each group depends on the one before, but what a block of rows takes over is
    an open group of the last clips before it, ``max_terms`` at most.  So each
    block tells how it would end after each number of them, the driver goes
    through these few rows a block, and the blocks are folded from where they
    begin.  Only numbers and durations are folded; texts follow their groups.
    """
    block = max(block, config.max_terms)

    def step(state, d):
        _, group, n, used = state
        d = (d if d and d == d else 0.0) + config.pause_s  # no duration counts as none
        if n < config.max_terms and used + d <= config.max_s:
            return group, group, n + 1, used + d
        if n < config.min_terms or d > config.max_s:
            return -1, group + 1, 0, 0.0
        return group + 1, group + 1, 1, d

    def ends(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_n")
        before = int((rows["_n"] <= rows["_block"] * block).sum())
        d = rows["_d"].tolist()
        out = []
        for taken in range(before + 1):
            state = (0, 0, 0, 0.0)
            for x in d[before - taken : before]:
                state = step(state, x)
            if state[1:3] == (0, taken):  # else these clips aren't one group
                for x in d[before:]:
                    state = step(state, x)
                out.append((rows["_block"].iloc[0], taken, *state[1:]))
        return pd.DataFrame(out, columns=["block", "taken", "groups", "n", "used"])

    def folded(rows: pd.DataFrame) -> pd.DataFrame:
        rows, out = rows.sort_values("_n"), []
        state = (0, *starts[rows["_block"].iloc[0]])
        for x in rows["_d"].tolist():
            state = step(state, x)
            out.append(state[0])
        return pd.DataFrame({"_n": rows["_n"], "group": pd.Series(out, dtype="int64", index=rows.index)})

    rows = number_rows(df, order, "_n", [duration])
    own = F.floor((F.col("_n") - 1) / block)
    slim = rows.select("_n", F.col(duration).cast("double").alias("_d"))
    both = F.when((F.col("_n") - 1) % block >= block - config.max_terms, F.array(own, own + 1)).otherwise(F.array(own))
    last = slim.select("_n", "_d", F.explode(both).alias("_block")).groupBy("_block").applyInPandas(ends, "block long, taken int, groups long, n int, used double")
    table = {(r.block, r.taken): (r.groups, r.n, r.used) for r in last.collect()}  # a few rows a block
    starts, at = {}, (0, 0, 0.0)
    for i in range(len({b for b, _ in table})):
        starts[i] = at
        groups, n, used = table[i, at[1]]
        at = (at[0] + groups, n, used)
    assigned = slim.withColumn("_block", own).groupBy("_block").applyInPandas(folded, "_n long, group long").where("group >= 0")
    return _grouped(rows.join(assigned, "_n"), duration, text, config)


def _grouped(rows: DataFrame, duration: str, text: str, config: PackConfig) -> DataFrame:
    # texts apart from durations: a query without them then leaves them where they are
    listed = lambda c, name: F.sort_array(F.collect_list(F.struct("_n", F.col(c).alias(name))))
    groups = rows.groupBy("group").agg(listed(duration, "d").alias("clips"), listed(text, "t").alias("said")).withColumn("n_terms", F.size("clips"))
    total = F.aggregate("clips", F.lit(0.0), lambda s, c: s + c["d"])
    kept = F.col("n_terms") >= config.min_terms
    groups = groups.withColumn("duration", total + F.when(kept, (F.col("n_terms") - 1) * config.pause_s).otherwise(0.0))
    groups = groups.where(kept | (F.col("duration") >= config.single_s))
    return groups.select("group", F.when(kept, "concatenated").otherwise("short_kept").alias("source"), "n_terms", "duration", F.transform("said", lambda c: c["t"]).alias("texts"))


def _folded(df: DataFrame, key: str, order: list[str], duration: str, step, name: str) -> DataFrame:
    """A sequential assignment per key, streamed: rows of a key reach one task
    in order, which keeps a few numbers and no rows."""
    schema = StructType(list(df.drop(name).schema.fields)).add(name, "long")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, state = object(), None
        for b in batches:
            out = []
            for k, d in zip(b[key].tolist(), b[duration].tolist(), strict=True):
                if k != last:
                    last, state = k, None
                state = step(state, d)
                out.append(state[0])
            b[name] = pd.Series(out, dtype="int64")
            yield b

    return df.repartition(key).sortWithinPartitions(key, *order).mapInPandas(run, schema)


def pack_by_source(df: DataFrame, key: str, order: list[str], duration: str, config: MergeConfig = MergeConfig(), name: str = "chunk") -> DataFrame:
    """Short clips of a source joined up to ``max_s``; long ones stand alone."""

    def step(state, d):
        chunk, buffered, used = state or (0, 0.0, False)  # used: the chunk is taken
        if d >= config.min_s:
            if used:
                chunk += 1
            return chunk, None, True
        if buffered is None:  # after a clip that stands alone
            return chunk + 1, d, True
        if not used:
            return chunk, d, True
        if buffered + config.silence_s + d > config.max_s:
            return chunk + 1, d, True
        return chunk, buffered + d + config.silence_s, True

    return _folded(df, key, order, duration, step, name)


def pack_to_length(df: DataFrame, key: str, order: list[str], duration: str, config: ConcatConfig = ConcatConfig(), name: str = "file") -> DataFrame:
    """Clips of a folder joined in files up to ``max_s``; the test leaves the
    next pause out, the length counts it."""

    def step(state, d):
        if state is None:
            return 1, d
        file, buffered = state
        if buffered + d > config.max_s:
            return file + 1, d
        return file, buffered + config.silence_s + d

    return _folded(df, key, order, duration, step, name)


def pack_counters(packed: DataFrame, key: str, duration: str, chunk: str = "chunk", config: MergeConfig = MergeConfig()) -> DataFrame:
    """Input and output clips, those kept as they are, and buffers written for
    lack of room or at the end (not those written before a long clip)."""
    groups = packed.groupBy(key, chunk).agg(F.count("*").alias("n"), F.max(F.when(F.col(duration) >= config.min_s, 1).otherwise(0)).alias("alone"))
    w = Window.partitionBy(key).orderBy(chunk)
    groups = groups.withColumn("before_long", F.coalesce(F.lead("alone").over(w), F.lit(0)))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_input"),
        F.count("*").alias("total_saved"),
        F.coalesce(F.sum("alone"), F.lit(0)).cast("long").alias("kept_as_is"),
        F.count_if((F.col("alone") == 0) & (F.col("before_long") == 0)).alias("short_merged"),
    )
