import random

import pytest
from pyspark.sql import functions as F

from glotta.config import ConcatConfig
from glotta.operators import manifest as M
from glotta.operators import ordering
from glotta.operators import segments as G


def test_merge_close(spark):
    rows = [("a", 0, 100), ("a", 11125, 12000), ("a", 23026, 24000), ("b", 5, 6)]
    df = spark.createDataFrame(rows, "k string, s long, e long")
    got = sorted(tuple(r) for r in G.merge_close(df, "k", "s", "e", 11025).collect())
    assert got == [("a", 0, 12000, 2), ("a", 23026, 24000, 1), ("b", 5, 6, 1)]
    again = spark.createDataFrame([g[:3] for g in got], "k string, s long, e long")
    assert sorted(tuple(r)[:3] for r in G.merge_close(again, "k", "s", "e", 11025).collect()) == [g[:3] for g in got]


def test_halves(spark):
    def cut(a, b, most):
        return [(a, b)] if b - a <= most else cut(a, (a + b) // 2, most) + cut((a + b) // 2, b, most)

    rnd = random.Random(1)
    rows = [(rnd.randint(0, 99), rnd.randint(100, 9999)) for _ in range(50)] + [(0, 40), (7, 7), (0, 15)]
    df = spark.createDataFrame(rows, "s long, e long").select("s", "e", G.halves(F.col("s"), F.col("e"), 15).alias("p"))
    for r in df.collect():
        assert [tuple(p) for p in r.p] == cut(r.s, r.e, 15)


def by_source(durations):
    out, chunk, buffered, filled = [], 0, 0.0, False
    for d in durations:
        if d >= 10:
            chunk += filled
            out.append(chunk)
            chunk, buffered, filled = chunk + 1, 0.0, False
        elif filled and buffered + 0.3 + d > 15:
            chunk += 1
            out.append(chunk)
            buffered = d
        else:
            buffered += d + (0.3 if filled else 0)
            filled = True
            out.append(chunk)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_pack_by_source(spark, seed):
    rnd = random.Random(seed)
    keys = {k: [round(rnd.uniform(0.1, 13), 3) for _ in range(rnd.randint(1, 60))] for k in range(12)} | {99: [4.0, 4.0, 4.0, 4.0, 12.0, 3.0]}
    df = spark.createDataFrame([(k, i, d) for k, ds in keys.items() for i, d in enumerate(ds)], "k int, i int, d double")
    got = {k: [] for k in keys}
    for r in G.pack_by_source(df, "k", ["i"], "d").orderBy("k", "i").collect():
        got[r.k].append(r.chunk)
    assert got == {k: by_source(ds) for k, ds in keys.items()}
    assert got[99] == [0, 0, 0, 1, 2, 3]


def test_pack_to_length(spark):
    df = spark.createDataFrame([("f", i, float(d)) for i, d in enumerate([200, 90, 20])], "k string, i int, d double")
    assert [r.file for r in G.pack_to_length(df, "k", ["i"], "d").orderBy("i").collect()] == [1, 1, 2]
    assert G.pack_to_length(df, "k", ["i"], "d", ConcatConfig(max_s=1000)).select("file").distinct().count() == 1


def test_pack_short(spark):
    df = spark.createDataFrame([(i, 2.0, f"t{i}.") for i in range(9)], "i long, d double, t string")
    got = G.pack_short(df, "i", "d", "t").orderBy("group").collect()
    assert [(r.source, r.n_terms, round(r.duration, 6)) for r in got] == [("concatenated", 4, 9.2)] * 2 + [("short_kept", 1, 2.0)]
    assert G.pack_short(df.where("i < 1").withColumn("d", F.lit(1.0)), "i", "d", "t").count() == 0


@pytest.mark.parametrize("n, want", [(10, (8, 1, 1)), (30, (27, 2, 1)), (70, (63, 4, 3)), (2, (0, 1, 1)), (1, (0, 0, 1))])
def test_split_counts(spark, n, want):
    df = spark.range(n).withColumnRenamed("id", "k")
    split = ordering.split_train_val_test(df, "k")
    n_by = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert tuple(n_by.get(s, 0) for s in ("train", "val", "test")) == want
    assert split.select("k").distinct().count() == n


@pytest.mark.parametrize("few", [0, 100_000])
def test_number_rows(spark, monkeypatch, few):
    monkeypatch.setattr(ordering, "FEW", few)
    values = [random.Random(4).randint(-50, 50) for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(500, None)], "i int, v long").repartition(7)
    got = [(r.v, r.i) for r in ordering.number_rows(df, "v", "n", ["i"]).orderBy("n").collect()]
    assert got == [(None, 500)] + sorted((v, i) for i, v in enumerate(values))
    assert ordering.number_rows(df.limit(0), "v", "n").count() == 0


def test_metadata(spark):
    lines = ["filename|text", "a.wav|un|x", "b|deux", "a.wav|trois", "seul", "|vide"]
    df = spark.createDataFrame(list(enumerate(lines)), "line int, value string")
    got = {r.stem: r.text for r in M.last_wins(M.metadata_rows(df)).collect()}
    assert got == {"a": "trois", "b": "deux"}


def test_small_manifest_rules(spark):
    one = spark.createDataFrame([("x.wav", "a|b", "c")], "s string, r string, n string")
    assert one.select(M.ljspeech_line(M.group_key(F.lit("x")), F.col("r"), F.col("n"))).first()[0] == "x|a b|c"
    keys = spark.createDataFrame([("rec01_0003",), ("rec01_003",), ("x",)], "s string").select(M.group_key(F.col("s"))).collect()
    assert [k[0] for k in keys] == ["rec01", "rec01_003", "x"]
    d = spark.createDataFrame([("a|b",), ("a;b;c",), ("a\tb",), ("ab",)], "t string").select(M.delimiter(F.col("t"))).collect()
    assert [x[0] for x in d] == ["|", ";", "\t", ","]


def test_numbers_over_many_cuts(spark, monkeypatch):
    from glotta.operators import ordering

    monkeypatch.setattr(ordering, "FEW", 0)
    monkeypatch.setattr(ordering, "ROWS", 10)
    keys = [(i * 37 % 1009, i) for i in range(1000)] + [(5, -1), (5, -2), (None, -3)]
    got = ordering.number_rows(spark.createDataFrame(keys, "k long, id long"), "k", "n", ["id"]).collect()
    want = sorted(keys, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r.k, r.id) for r in sorted(got, key=lambda r: r.n)] == want
    assert sorted(r.n for r in got) == list(range(1, 1004))


def burst(*lengths):
    """Loud and silent stretches in turn."""
    import numpy as np

    return np.concatenate([np.full(n, 0.5 if i % 2 == 0 else 0.0) * (-1.0) ** np.arange(n) for i, n in enumerate(lengths)])


def test_subsplit_at_silences():
    x = burst(6000, 3000, 9000, 3000, 4000)
    cut = G.subsplit(x, 0, len(x), 10_000, frame=256, hop=64)
    assert len(cut) == 3 and all(abs(a - b) <= 256 for p, q in zip(cut, [(0, 6000), (9000, 18000), (21000, 25000)], strict=True) for a, b in zip(p, q, strict=True))
    assert G.subsplit(burst(40), 0, 40, 15, frame=8, hop=2) == [(0, 10), (10, 20), (20, 30), (30, 40)]
    assert G.subsplit(x, 5, 1000, 10_000) == [(5, 1000)]


def test_segment_audio(spark):
    from glotta.config import SegmentConfig

    # at 1000 a second: a gap of 300 ms merges, 1 s stays apart, 200 ms is too short
    x = burst(2000, 300, 2000, 1000, 200, 1000, 9000)
    df = spark.createDataFrame([("a", x.tolist()), ("b", None)], "k string, x array<double>")
    got = [tuple(r) for r in G.segment_audio(df, "k", "x", SegmentConfig(rate=1000, max_s=5.0), frame=64, hop=16).orderBy("idx").collect()]
    assert [(k, i) for k, i, _, _ in got] == [("a", 0), ("a", 1), ("a", 2)]
    assert all(abs(a - b) <= 64 for g, w in zip(got, [(0, 4300), (6500, 11000), (11000, 15500)], strict=True) for a, b in zip(g[2:], w, strict=True))


def test_trim_cascade(spark):
    import numpy as np

    from glotta.operators import models

    # loud for 0.3 s, then 17 dB below that: only 20 dB keeps half a second
    x = np.concatenate([np.zeros(400), burst(300), burst(400) * 10 ** (-17 / 20), np.zeros(400)])
    a, b = models.trim_cascade(x, 1000, frame=64, hop=16)
    assert abs(a - 400) <= 64 and abs(b - 1100) <= 64
    assert models.trim_cascade(x, 1000, (15.0,), frame=64, hop=16) is None
    df = spark.createDataFrame([(x.tolist(),), (None,), ([0.0] * 300,)], "x array<double>")
    got = [r.x for r in models.trimmed(df, "x", 1000, frame=64, hop=16).collect()]
    assert len(got[0]) == b - a and got[1:] == [None, None]


@pytest.mark.parametrize("bound", [28.0, 7.0, 3.0])
def test_pack_by_fold(spark, bound):
    from glotta.config import PackConfig

    rnd = random.Random(bound)
    clips = [round(rnd.uniform(0.2, 3.9), 2) for _ in range(81)]
    want, i = [], 0
    while i < len(clips):
        group, used = [], 0.0
        while i < len(clips) and len(group) < 4 and used + clips[i] + 0.4 <= bound:
            used += clips[i] + 0.4
            group.append(i)
            i += 1
        if len(group) < 2:
            if len(group) == 1 and clips[group[0]] >= 1.5:
                want.append((group, "short_kept"))
            i += 1
        else:
            want.append((group, "concatenated"))
    df = spark.createDataFrame([(i, d, str(i)) for i, d in enumerate(clips)], "pos int, d double, t string").repartition(3)
    got = G.pack_by_fold(df, "pos", "d", "t", PackConfig(max_s=bound)).orderBy("group").collect()
    assert [([int(t) for t in r.texts], r.source) for r in got] == want
    assert [r.duration for r in got] == pytest.approx([sum(clips[i] for i in g) + 0.4 * (len(g) - 1) for g, _ in want])
    if bound == 28.0:
        assert [r.texts for r in G.pack_short(df, "pos", "d", "t").orderBy("group").collect()] == [r.texts for r in got]
