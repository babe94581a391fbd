import random

from glotta.streaming import dictation


def machine(events):
    recording = paused = done = False
    n, total = 0, 0.0
    for kind, value in events:
        if kind == "f1" and not recording and not done:
            recording = True
        elif kind == "f2" and recording:
            paused = not paused
        elif kind == "f3" and recording:
            recording, done = False, True
        elif kind == "chunk" and recording and not paused:
            n, total = n + 1, total + value
    return (n, round(total, 6), done) if recording or done else None


def sample():
    rnd = random.Random(5)
    return [(s, i, i, rnd.choice(["f1", "f2", "f3", "chunk", "chunk", "chunk"]), float(rnd.randint(1, 9))) for s in range(30) for i in range(25)]


SCHEMA = "session long, ts long, event_id long, kind string, value double"


def test_batch(spark):
    rows = sample()
    want = {s: m for s in range(30) if (m := machine([(k, v) for x, _, _, k, v in rows if x == s]))}
    got = {r.session: (r.n_chunks, round(r.total, 6), r.ended) for r in dictation.sessions(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_stream_equals_batch(spark, tmp_path):
    rows = sample()
    for i, some in enumerate((rows[: len(rows) // 2], rows[len(rows) // 2 :])):
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    schema = spark.createDataFrame([], SCHEMA).schema
    dictation.run_stream(spark, str(tmp_path / "in/*"), schema, str(tmp_path / "out"), str(tmp_path / "ck"))
    last = {}
    for r in spark.read.parquet(str(tmp_path / "out")).orderBy("batch").collect():
        last[r.session] = (r.n_chunks, round(r.total, 6), r.ended)
    want = {r.session: (r.n_chunks, round(r.total, 6), r.ended) for r in dictation.sessions(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert last == want
