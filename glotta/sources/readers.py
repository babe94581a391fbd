"""Readers of manifests, metadata, texts and audio listings."""

from __future__ import annotations

import io
import re
import struct
import wave
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from ..functions import text as T
from ..operators.manifest import last_wins, metadata_rows, with_columns
from ..operators.ordering import number_rows

AUDIO = ("wav", "mp3", "m4a", "flac", "ogg")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A CSV manifest with header, all strings, optional columns filled in."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return with_columns(df, "id", "audio_path", "transcription", "source")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) of one text file; line counts from 0."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n")).alias("line", "value"))


def sniff(spark: SparkSession, path: str, size: int = 2048) -> str:
    """The delimiter, from the file's beginning; read on the driver."""
    head = "\n".join(r.value for r in spark.read.text(path).limit(64).collect())[:size]
    return "|" if "|" in head else max(",;\t", key=lambda d: (head.count(d), -",;\t".index(d)))


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """stem and text of a delimited metadata file; the last duplicate wins."""
    sep = sniff(spark, path)
    return last_wins(metadata_rows(numbered_lines(spark, path), sep=r"\|" if sep == "|" else sep)).select("stem", "text")


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(line, text): the ``text`` column of a CSV, else a text a line."""
    if path.lower().endswith(".csv"):
        df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("sep", sniff(spark, path)).csv(path)
        column = next((c for c in df.columns if c.strip().lower() == "text"), None)
        if column is None:
            raise ValueError(f"{path} has no column named text")
        rows = df.select(F.monotonically_increasing_id().alias("line"), F.col(f"`{column}`").alias("text"))
    else:
        rows = numbered_lines(spark, path).withColumnRenamed("value", "text")
    return rows.select("line", T.strip(F.coalesce("text", F.lit(""))).alias("text")).where("text <> ''")


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """(stem, text) of the folder's TXT files, stripped, empty ones left out."""
    df = spark.read.text(folder, wholetext=True, pathGlobFilter="*.[tT][xX][tT]")
    rows = df.select(T.stem(F.col("_metadata.file_path")).alias("stem"), T.strip(F.col("value")).alias("text"))
    return rows.where("text <> ''")


_RTF = re.compile(r"\\'([0-9a-fA-F]{2})|\\u(-?\d+) ?\??|\\([a-zA-Z]+)(-?\d+)? ?|\\(.)|([{}])|([^\\{}]+)", re.S)
_RTF_SIGNS = {"par": "\n", "line": "\n", "tab": "\t", "emdash": "—", "endash": "–", "bullet": "•", "lquote": "‘", "rquote": "’", "ldblquote": "“", "rdblquote": "”"}
_RTF_SILENT = frozenset("fonttbl colortbl stylesheet info pict header footer generator themedata listtable listoverridetable".split())


def rtf_text(raw: bytes) -> str:
    """Text of an RTF file: groups of tables and pictures are silent, and so are
    those marked as ignorable."""
    out, silent = [], [False]
    for m in _RTF.finditer(raw.decode("latin-1")):
        byte, code, word, _, sign, brace, text = m.groups()
        if brace == "{":
            silent.append(silent[-1])
        elif brace == "}":
            if len(silent) > 1:
                silent.pop()
        elif word in _RTF_SILENT or sign == "*":
            silent[-1] = True
        elif silent[-1]:
            continue
        elif byte:
            out.append(bytes([int(byte, 16)]).decode("cp1252", "replace"))
        elif code:
            out.append(chr(int(code) % 65536))
        elif word:
            out.append(_RTF_SIGNS.get(word, ""))
        elif sign:
            out.append({"~": "\u00a0", "\n": "\n", "\r": "\n"}.get(sign, sign if sign in "\\{}" else ""))
        elif text:
            out.append(re.sub(r"[\r\n]", "", text))
    return "".join(out)


def document_lines(spark: SparkSession, path: str, pages: Callable[[bytes], list[str]], keep: Callable[[Column], Column]) -> DataFrame:
    """(path, page, line, text) of files in any format: ``pages`` gives a file's
    page texts (none, if it fails), ``keep`` the lines of a page to keep."""

    def one(raw) -> list[str]:
        try:
            return list(pages(bytes(raw)))
        except Exception:
            return []

    @F.pandas_udf("array<string>")
    def texts_of(content: pd.Series) -> pd.Series:
        return content.map(one)

    files = spark.read.format("binaryFile").load(path).select("path", F.posexplode(texts_of("content")).alias("page", "text"))
    return files.select("path", "page", F.posexplode(keep(F.coalesce("text", F.lit("")))).alias("line", "text"))


def rtf_lines(spark: SparkSession, path: str, least: int = 6) -> DataFrame:
    """Lines of RTF files without their bullets, of ``least`` characters or more."""
    return document_lines(spark, path, lambda raw: [rtf_text(raw)], lambda c: F.filter(F.transform(T.lines(c), T.bullet_strip), lambda x: F.length(x) >= least))


def pdf_lines(spark: SparkSession, path: str, pages: Callable[[bytes], list[str]], least: int = 5) -> DataFrame:
    """Lines of PDF files without page headers; ``pages`` is the decoder."""
    return document_lines(spark, path, pages, lambda c: T.page_lines(c, least))


def read_splits(spark: SparkSession, path: str, split: str = "split") -> dict[str, DataFrame]:
    """The splits of a dataset that ``sinks.write_dataset`` wrote."""
    df = spark.read.parquet(path)
    names = [r[0] for r in df.select(split).distinct().orderBy(split).collect()]  # a few folders
    return {n: df.where(F.col(split) == n).drop(split) for n in names}


def clip_list(spark: SparkSession, folder: str, manifest: str | None = None) -> DataFrame:
    """(line, path) of a folder's clips: those of the manifest that exist, in its
    order; without a manifest, or if it is missing, all WAV files by name."""
    found = audio_listing(spark, folder).where(F.lower("path").endswith(".wav")).withColumn("name", F.regexp_extract("path", "[^/]*$", 0))
    if manifest and _exists(spark, manifest):
        return manifest_order(numbered_lines(spark, manifest), found).join(found, "name").select("line", "path")
    return number_rows(found, "name", "line").select((F.col("line") - 1).alias("line"), "path")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def is_audio(path: Column) -> Column:
    return F.lower(path).rlike(r"\.(" + "|".join(AUDIO) + r")$")


def audio_listing(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """path, stem and size of audio files.  Contents aren't read; the listing
    is the filesystem's own, as Spark's readers pass over files of no bytes."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, recursive)
    rows = []
    while found.hasNext():
        f = found.next()
        rows.append((f.getPath().toString(), f.getLen()))
    df = spark.createDataFrame(rows, "path string, size long").where(is_audio(F.col("path")))
    return df.select("path", T.stem(F.col("path")).alias("stem"), "size")


#: Bytes at the beginning of a file that hold its header.
HEAD = 64 << 10


def _heads(batches):
    """(path, size) -> what the file's header says; only its beginning is read."""
    from pyarrow import fs

    for b in batches:
        rows = []
        for path, size in zip(b["path"], b["size"], strict=True):
            try:
                system, at = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:/", "file:///", 1))
                with system.open_input_stream(at) as f:
                    rows.append(probe_wav(f.read(HEAD)))
            except OSError as e:
                rows.append((None, None, None, f"illisible : {e}"))
        yield b.join(pd.DataFrame(rows, columns=["duration_s", "sample_rate", "channels", "audio_err"], index=b.index))


def probed(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """The listing with duration_s, sample_rate, channels and audio_err."""
    listing = audio_listing(spark, folder, recursive)
    tasks = max(1, min(listing.count() // 64, 4 * spark.sparkContext.defaultParallelism))
    schema = "path string, stem string, size long, duration_s double, sample_rate int, channels int, audio_err string"
    return listing.select("path", "stem", "size").repartition(tasks).mapInPandas(_heads, schema)


def manifest_order(lines: DataFrame, files: DataFrame, value: str = "value", on: str = "name") -> DataFrame:
    """The manifest's entries that exist, in its order; comments and blanks go."""
    rows = lines.select("line", T.strip(F.col(value)).alias(on)).where(f"{on} <> '' and not startswith({on}, '#')")
    return rows.join(files.select(on).distinct(), on, "left_semi")


def probe_wav(data: bytes | None) -> tuple[float | None, int | None, int | None, str | None]:
    """(seconds, rate, channels, error) from the header of a WAV file."""
    if data is None:
        return None, None, None, "fichier introuvable"
    if not data:
        return None, None, None, "fichier vide (0 octets)"
    try:
        with wave.open(io.BytesIO(data)) as w:
            if not w.getframerate():
                return None, None, None, "sample rate = 0"
            return w.getnframes() / w.getframerate(), w.getframerate(), w.getnchannels(), None
    except (wave.Error, EOFError, struct.error) as e:
        return None, None, None, f"illisible : {e}"


@F.pandas_udf(Y.StructType([Y.StructField("duration_s", Y.DoubleType()), Y.StructField("sample_rate", Y.IntegerType()), Y.StructField("channels", Y.IntegerType()), Y.StructField("audio_err", Y.StringType())]))
def wav_probe(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([probe_wav(None if c is None else bytes(c)) for c in content], columns=["duration_s", "sample_rate", "channels", "audio_err"])


def _pcm16(data: bytes):
    """Mono samples of a 16-bit WAV file; None for other widths."""
    import numpy as np

    with wave.open(io.BytesIO(data)) as w:
        if w.getsampwidth() != 2:
            return None
        x = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels())
    return (x.mean(axis=1) / 32768).astype("float32")


@F.pandas_udf(Y.ArrayType(Y.FloatType()))
def wav_samples(content: pd.Series) -> pd.Series:
    """Mono samples of 16-bit WAV files in [-1, 1]; null where unreadable."""

    def one(data):
        try:
            return _pcm16(bytes(data))
        except (wave.Error, EOFError, struct.error, TypeError):
            return None

    return content.map(one)


def resample(x, rate: int, to: int, width: int = 16):
    """Samples at another rate, by a windowed sinc that also cuts what the lower
    of both rates can't hold."""
    import numpy as np

    x = np.asarray(x, "float64")
    if rate == to or not len(x):
        return x.astype("float32")
    scale = min(1.0, to / rate)
    reach = int(np.ceil(width / scale))
    padded, out = np.pad(x, reach + 1), np.empty(int(np.ceil(len(x) * to / rate)))
    for a in range(0, len(out), 1 << 16):
        at = np.arange(a, min(len(out), a + (1 << 16))) * rate / to
        near = np.floor(at).astype(np.int64)[:, None] + np.arange(-reach, reach + 1)[None, :]
        off = at[:, None] - near
        weight = scale * np.sinc(scale * off) * np.where(np.abs(off) < reach, 0.5 + 0.5 * np.cos(np.pi * off / reach), 0.0)
        out[a : a + len(at)] = (padded[near + reach + 1] * weight).sum(axis=1)
    return out.astype("float32")


def audio_samples(df: DataFrame, content: str = "content", rate: int = 22050, decode: Callable[[bytes], tuple] | None = None, name: str = "samples") -> DataFrame:
    """Mono samples at ``rate``; null where unreadable.  16-bit WAV is read here;
    ``decode`` (bytes to samples and their rate) is the boundary to codecs, for
    what isn't."""

    def one(raw):
        try:
            raw = bytes(raw)
            try:
                with wave.open(io.BytesIO(raw)) as w:
                    own = w.getframerate()
                x = _pcm16(raw)
            except (wave.Error, EOFError, struct.error):
                x = None
            if x is None:
                if decode is None:
                    return None
                x, own = decode(raw)
            return resample(x, own, rate)
        except Exception:
            return None

    @F.pandas_udf(Y.ArrayType(Y.FloatType()))
    def samples(s: pd.Series) -> pd.Series:
        return s.map(one)

    return df.withColumn(name, samples(content))


def wav_bytes(samples, rate: int) -> bytes:
    """Samples in [-1, 1], clipped, as a 16-bit mono WAV file."""
    import numpy as np

    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(np.asarray(samples, "float64"), -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def write_wavs(df: DataFrame, folder: str, name: str = "name", samples: str = "samples", rate: int = 16000) -> None:
    """One WAV file per row, into a folder that all executors share."""

    def run(rows) -> None:
        import os

        os.makedirs(folder, exist_ok=True)
        for r in rows:
            part = f"{folder}/.{r[name]}.{os.getpid()}"
            with open(part, "wb") as f:
                f.write(wav_bytes(r[samples], rate))
            os.replace(part, f"{folder}/{r[name]}")

    df.select(name, samples).foreachPartition(run)
