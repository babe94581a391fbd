import wave

import numpy as np
from pyspark.sql import functions as F

from glotta.functions import signal as S
from glotta.operators import manifest, models, reports, validate
from glotta.plans import stages
from glotta.sources import readers, sinks


def wav(path, seconds, rate=16000, channels=1):
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.sin(np.arange(int(seconds * rate) * channels)) * 9000).astype("<i2").tobytes())


def test_audio(spark, tmp_path):
    for name, s in (("a.wav", 0.1), ("b.WAV", 0.6), ("c.wav", 5)):
        wav(tmp_path / name, s)
    wav(tmp_path / "d.wav", 1, 8000, 2)
    (tmp_path / "e.wav").write_bytes(b"")
    (tmp_path / "f.wav").write_bytes((tmp_path / "c.wav").read_bytes()[:20])
    (tmp_path / "g.txt").write_text("x")
    listing = readers.audio_listing(spark, str(tmp_path))
    assert sorted(r.stem for r in listing.collect()) == list("abcdef")
    got = {r.stem: r for r in readers.probed(spark, str(tmp_path)).collect()}
    stereo = spark.read.format("binaryFile").load(str(tmp_path / "d.wav"))
    assert (got["a"].duration_s, got["b"].duration_s, got["c"].duration_s) == (0.1, 0.6, 5.0)
    assert (got["d"].sample_rate, got["d"].channels) == (8000, 2)
    assert stereo.select(F.size(readers.wav_samples("content"))).first()[0] == 8000
    assert got["e"].audio_err == "fichier vide (0 octets)" and got["f"].audio_err.startswith("illisible")


def test_text_readers(spark, tmp_path):
    (tmp_path / "t.txt").write_text(" a \n\nb\n")
    (tmp_path / "t.csv").write_text("id;Text\n1; x \n2;\n3;y\n")
    (tmp_path / "m.csv").write_text("filename|text\na.wav|un\nb.wav|deux\na.wav|trois\nseul\n")
    assert [r.text for r in readers.texts(spark, str(tmp_path / "t.txt")).orderBy("line").collect()] == ["a", "b"]
    assert [r.text for r in readers.texts(spark, str(tmp_path / "t.csv")).orderBy("line").collect()] == ["x", "y"]
    assert {r.stem: r.text for r in readers.metadata(spark, str(tmp_path / "m.csv")).collect()} == {"a": "trois", "b": "deux"}
    assert {r.stem: r.text for r in readers.text_files(spark, str(tmp_path)).collect()} == {"t": "a \n\nb"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s1", "a|b", None, "train"), ("s2", "c", "d", "val")], "stem string, text string, norm_text string, split string")
    sinks.write_ljspeech(df, str(tmp_path / "lj"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "lj")).collect()) == ["s1|a b|a b", "s2|c|d"]
    sinks.write_splits(df, str(tmp_path / "sp"))
    assert [r.value for r in spark.read.text(str(tmp_path / "sp/split=val")).collect()] == ["s2"]
    sinks.write_manifest(df, str(tmp_path / "m"))
    assert readers.manifest(spark, str(tmp_path / "m")).count() == 2
    sinks.write_summary(reports.count_by(df, "split").limit(1), str(tmp_path / "j"))
    assert "split" in spark.read.text(str(tmp_path / "j")).first().value
    stats = spark.createDataFrame([("f", "bad")], "filename string, reject_reason string")
    assert sinks.write_rejected(stats, str(tmp_path / "r")) and not sinks.write_rejected(stats.limit(0), str(tmp_path / "q"))
    sinks.write_stats(stats, str(tmp_path / "st"))
    sinks.write_dataset(df, str(tmp_path / "ds"))
    assert spark.read.parquet(str(tmp_path / "ds")).where("split = 'train'").count() == 1
    clips = spark.createDataFrame([("z.wav", [0.0, 2.0, -0.5])], "name string, samples array<double>")
    readers.write_wavs(clips, str(tmp_path / "wavs"))
    assert readers.probe_wav((tmp_path / "wavs/z.wav").read_bytes())[1:] == (16000, 1, None)


def test_check_golden(spark):
    rows = [("1", "data/x.wav", "  ", "", 0.3, 16000, None), ("2", "data/y.wav", "t", None, None, None, "fichier introuvable"), ("3", None, None, "tts_rapport", 1.0, 16000, None), ("4", "a/b.wav", "t", "tts_rapport", 31.0, 8000, None)]
    df = spark.createDataFrame(rows, "id string, audio_path string, transcription string, source string, duration_s double, sample_rate int, audio_err string")
    got = {r.id: (r.status, "; ".join(r.issues)) for r in validate.check(df).collect()}
    assert got["1"] == ("AVERTISSEMENT", "transcription_vide; trop_court_0.30s")
    assert got["2"] == ("ERREUR", "audio_fichier_introuvable")
    assert got["3"] == ("ERREUR", "transcription_vide; chemin_audio_absent")
    assert got["4"] == ("AVERTISSEMENT", "trop_long_31.00s; sample_rate_inhabituel_8000Hz; prefixe_inattendu(attendu=tts_, fichier=b)")


def test_score_modes(spark):
    rows = [("a.wav", 5.0, "un deux", "un trois", None), ("b.wav", 0.5, "x", "x", None), ("c.wav", 5.0, None, "hyp", None), ("d.wav", 5.0, None, None, None), ("e.wav", None, "x", "y", "boom")]
    df = spark.createDataFrame(rows, "filename string, duration_s double, reference string, hypothesis string, load_error string")
    got = {r.filename[0]: r for r in validate.score(df).collect()}
    assert (got["a"].wer, got["a"].flagged, got["a"].reject_reason) == (0.5, True, "")
    assert got["b"].reject_reason == "too_short (0.50s < 1.0s)" and got["c"].text == "hyp"
    assert got["d"].reject_reason == "empty_text_after_normalisation" and got["e"].reject_reason == "load_failed: boom"
    got = {r.filename[0]: r for r in validate.score(df, transcribe=False).collect()}
    assert got["b"].reject_reason == "duration 0.50s out of range" and got["d"].reject_reason == "" and got["c"].text == ""


def test_signal(spark):
    x = np.sin(np.arange(400) / 7) * np.linspace(0.1, 1, 400)
    df = spark.createDataFrame([(x.tolist(),), ([],), ([0.0] * 100,)], "x array<double>")
    c = F.col("x")
    got = df.select(S.rms_db(c), S.snr_db(c, 40, 16), S.normalize_rms(c), S.fade(c, 100, 100, 200), S.trim(c, 20, 5)).collect()
    frames = np.lib.stride_tricks.sliding_window_view(x, 40)[::16]
    floor = np.percentile(np.sqrt((frames**2).mean(axis=1)), 10)
    assert np.isclose(got[0][0], 20 * np.log10(np.sqrt((x**2).mean()))) and np.isclose(got[0][1], 20 * np.log10(np.sqrt((x**2).mean()) / floor))
    assert np.isclose(np.sqrt(np.mean(np.square(got[0][2]))), 0.1)
    want = x.copy()
    want[:10] *= np.linspace(0, 1, 10)
    want[-20:] *= np.linspace(1, 0, 20)
    assert np.allclose(got[0][3], want)
    loud = np.flatnonzero(np.abs(x) > np.abs(x).max() * 0.1)
    assert np.allclose(got[0][4], x[max(0, loud[0] - 5) : min(400, loud[-1] + 5)])
    assert got[1][0] is None and got[1][2] == [] and (got[2][0], got[2][1]) == (-100.0, 60.0)


def test_models(spark):
    def load():
        def model(s):
            if "bad" in set(s):
                raise ValueError("no")
            return [v.upper() for v in s]

        return model

    df = spark.createDataFrame([("a",), ("bad",), ("c",)], "t string").coalesce(1)
    got = {r.t: (r.hypothesis, r.error) for r in models.transcribe(df, load, "t").collect()}
    assert got == {"a": ("A", None), "bad": (None, "no"), "c": ("C", None)}
    x = np.concatenate([np.zeros(100), np.ones(100), np.zeros(100), np.ones(50)])
    assert [(a // 10, b // 10) for a, b in models.speech_spans(x, 10, 10)] == [(10, 20), (30, 35)]


def test_documents(spark, tmp_path):
    rtf = r"{\rtf1\ansi{\fonttbl{\f0 Arial;}}{\*\generator x;}\f0\fs24 - Premi\'e8re ligne\par \u8226? Deuxi\u232?me ligne\par abc\par a \{b\} \\ c d\par}"
    (tmp_path / "a.rtf").write_text(rtf)
    assert [r.text for r in readers.rtf_lines(spark, str(tmp_path / "*.rtf")).orderBy("line").collect()] == ["Première ligne", "Deuxième ligne", "a {b} \\ c d"]
    (tmp_path / "a.pdf").write_bytes(b"-- 1 of 2\nune ligne\nab\fseconde page")
    (tmp_path / "b.pdf").write_bytes(b"\xff")
    pages = lambda raw: raw.decode().split("\f")
    got = [(r.page, r.text) for r in readers.pdf_lines(spark, str(tmp_path / "*.pdf"), pages).orderBy("page").collect()]
    assert got == [(0, "une ligne"), (1, "seconde page")]


def test_clip_lists(spark, tmp_path):
    for name in ("b.wav", "a.wav", "c.WAV", "d.mp3"):
        wav(tmp_path / name, 0.1)
    (tmp_path / "order.txt").write_text("# first\nb.wav\n\nmissing.wav\na.wav\n")
    names = lambda df: [r.path.rsplit("/", 1)[1] for r in df.orderBy("line").collect()]
    assert names(readers.clip_list(spark, str(tmp_path), str(tmp_path / "order.txt"))) == ["b.wav", "a.wav"]
    assert names(readers.clip_list(spark, str(tmp_path), str(tmp_path / "none.txt"))) == ["a.wav", "b.wav", "c.WAV"]


def test_samples_at_a_rate(spark, tmp_path):
    t = np.arange(16000) / 16000
    (tmp_path / "x.wav").write_bytes(readers.wav_bytes(0.5 * np.sin(2 * np.pi * 440 * t), 16000))
    (tmp_path / "y.raw").write_bytes(b"codec")
    (tmp_path / "z.raw").write_bytes(b"junk")
    df = spark.read.format("binaryFile").load(str(tmp_path))

    def decode(raw):
        if raw != b"codec":
            raise ValueError("no")
        return np.ones(100), 22050

    got = {r.path[-5]: r.samples for r in readers.audio_samples(df, decode=decode).select("path", "samples").collect()}
    want = 0.5 * np.sin(2 * np.pi * 440 * np.arange(22050) / 22050)
    assert len(got["x"]) == 22050 and np.abs(np.array(got["x"]) - want)[200:-200].max() < 2e-3
    assert len(got["y"]) == 100 and got["z"] is None
    assert {r.path[-5]: r.samples for r in readers.audio_samples(df).collect()}["y"] is None


def test_splits_errors_and_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", None), (2, "val", "boom")], "i int, split string, error string")
    assert [r.i for r in sinks.write_errors(df, str(tmp_path / "errors")).collect()] == [1]
    assert spark.read.json(str(tmp_path / "errors")).first().error == "boom"
    sinks.write_dataset(df, str(tmp_path / "ds"))
    parts = readers.read_splits(spark, str(tmp_path / "ds"))
    assert list(parts) == ["train", "val"] and [r.i for r in parts["val"].collect()] == [2]
    (tmp_path / "s.txt").write_text("new")
    (tmp_path / "t.txt").write_text("t")
    paths = spark.createDataFrame([(str(tmp_path / "s.txt"),), (f"file://{tmp_path}/t.txt",)], "path string")
    (tmp_path / "to").mkdir()
    (tmp_path / "to" / "t.txt").write_text("old")
    sinks.place_files(paths, str(tmp_path / "to"))
    assert ((tmp_path / "to/s.txt").read_text(), (tmp_path / "to/t.txt").read_text()) == ("new", "old")
    sinks.place_files(paths, str(tmp_path / "links"), link=True)
    assert (tmp_path / "links/s.txt").is_symlink() and (tmp_path / "links/s.txt").read_text() == "new"
    log = sinks.logger("glotta-test", str(tmp_path / "log.txt"))
    assert sinks.logger("glotta-test") is log
    log.info("hello")
    assert "hello" in (tmp_path / "log.txt").read_text()


def test_stages(spark):
    seen, said = [], []

    def fail():
        raise RuntimeError("no")

    steps = [("a", lambda: seen.append("a")), ("b", fail), ("c", lambda: seen.append("c"))]
    assert [(r.name, r.status) for r in stages.run(steps, tell=said.append)] == [("a", "done"), ("b", "failed"), ("c", "skipped")] and seen == ["a"]
    assert [r.status for r in stages.run(steps, {"a", "c"}, tell=said.append)] == ["done", "skipped", "done"]
    assert {r.status for r in stages.run(steps, dry=True, tell=said.append)} == {"planned"} and seen == ["a", "a", "c"]
    df, counts = stages.observed(spark.range(10).repartition(3), "id > 6")
    df.collect()
    assert counts.get == {"rows": 10, "failed": 3}


def test_plugins_and_filters(spark):
    df = spark.createDataFrame([([1.0, 3.0],), (None,), ([-1.0],)], "x array<double>")
    assert models.denoised(df, "x") is df

    def halve(x):
        if len(x) == 1:
            raise ValueError("short")
        return x / 2

    assert [r.x for r in models.denoised(df, "x", halve).collect()] == [[0.5, 1.5], None, [-1.0]]
    labels = spark.createDataFrame([([1, 2],), ([1, 2, 3],)], "labels array<int>")
    assert manifest.trainable(labels).count() == 1
    voices = spark.createDataFrame(manifest.VOICES, "voice string, rate string")
    assert manifest.voices_of(voices).count() == 8 and manifest.voices_of(voices, locale="fr-BE").count() == 2
