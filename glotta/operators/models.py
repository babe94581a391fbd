"""The boundary to models: batches in, one result or one error per row out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Scorer = Callable[[pd.Series], list]


def transcribe(df: DataFrame, load: Callable[[], Scorer], column: str, name: str = "hypothesis") -> DataFrame:
    """``load`` runs once per task and gives the model; a batch that fails is
    tried row by row, and a row that fails gets an ``error``."""
    schema = StructType(list(df.schema.fields)).add(name, "string").add("error", "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for b in batches:
            try:
                b[name], b["error"] = list(model(b[column])), None
            except Exception:
                out = []
                for v in b[column]:
                    try:
                        out.append((model(pd.Series([v]))[0], None))
                    except Exception as e:  # the row's own error is its result
                        out.append((None, str(e)))
                b[name], b["error"] = [o[0] for o in out], [o[1] for o in out]
            yield b

    return df.mapInPandas(run, schema)


def echo() -> Scorer:
    """A stand-in model: the input in lower case."""
    return lambda s: [None if v is None else str(v).lower() for v in s]


def speech_spans(x: np.ndarray, frame: int, hop: int, top_db: float = 35.0) -> list[tuple[int, int]]:
    """Runs of frames within ``top_db`` of the loudest frame."""
    if len(x) < frame or not np.any(x):
        return []
    level = np.sqrt((np.lib.stride_tricks.sliding_window_view(np.asarray(x, float), frame)[::hop] ** 2).mean(axis=1))
    loud = np.concatenate([[False], level > level.max() * 10 ** (-top_db / 20), [False]])
    edge = np.flatnonzero(loud[1:] != loud[:-1])
    return [(int(a * hop), int(min(len(x), (b - 1) * hop + frame))) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def energy_vad(df: DataFrame, samples: str, frame: int, hop: int, top_db: float = 35.0) -> DataFrame:
    """``spans``: where a signal is loud."""

    @F.pandas_udf("array<struct<start:long,end:long>>")
    def spans(s: pd.Series) -> pd.Series:
        return s.map(lambda x: [{"start": a, "end": b} for a, b in speech_spans(np.asarray(x), frame, hop, top_db)])

    return df.withColumn("spans", spans(samples))


def loud_frames(x: np.ndarray, top_db: float, frame: int = 2048, hop: int = 512) -> np.ndarray:
    """Per centred frame: is it within ``top_db`` of the loudest?  Levels below
    1e-5 count as that, so a silent signal is all loud."""
    x = np.pad(np.asarray(x, float), frame // 2)
    level = np.sqrt((np.lib.stride_tricks.sliding_window_view(x, frame)[::hop] ** 2).mean(axis=1))
    db = 20 * np.log10(np.maximum(level, 1e-5))
    return db - db.max() > -top_db


def split_at_silence(x: np.ndarray, top_db: float = 35.0, frame: int = 2048, hop: int = 512) -> list[tuple[int, int]]:
    """The spans of loud frames, in samples."""
    if not len(x):
        return []
    loud = np.concatenate([[False], loud_frames(x, top_db, frame, hop), [False]])
    edge = np.minimum(np.flatnonzero(loud[1:] != loud[:-1]) * hop, len(x))
    return [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def trim_cascade(x: np.ndarray, rate: int, levels: tuple[float, ...] = (20.0, 15.0, 10.0), least_s: float = 0.5, frame: int = 2048, hop: int = 512) -> tuple[int, int] | None:
    """What the first of ``levels`` that leaves ``least_s`` leaves between the
    quiet ends; None if each leaves less."""
    for top_db in levels:
        spans = split_at_silence(x, top_db, frame, hop)
        if spans and spans[-1][1] - spans[0][0] >= int(least_s * rate):
            return spans[0][0], spans[-1][1]
    return None


def trimmed(df: DataFrame, samples: str, rate: int, levels: tuple[float, ...] = (20.0, 15.0, 10.0), least_s: float = 0.5, frame: int = 2048, hop: int = 512) -> DataFrame:
    """``samples`` without its quiet ends; null where too little is left."""

    @F.pandas_udf("array<double>")
    def cut(s: pd.Series) -> pd.Series:
        def one(x):
            span = None if x is None else trim_cascade(x, rate, levels, least_s, frame, hop)
            return None if span is None else np.asarray(x, float)[span[0] : span[1]]

        return s.map(one)

    return df.withColumn(samples, cut(samples))


def denoised(df: DataFrame, samples: str, reduce: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """``samples`` through a noise reduction; without one, or where it fails,
    they stay as they are."""
    if reduce is None:
        return df

    def one(x):
        if x is None:
            return None
        try:
            return np.asarray(reduce(np.asarray(x, float)), float)
        except Exception:
            return np.asarray(x, float)

    @F.pandas_udf("array<double>")
    def clean(s: pd.Series) -> pd.Series:
        return s.map(one)

    return df.withColumn(samples, clean(samples))
