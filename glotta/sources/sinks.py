"""Writers of manifests, splits and summaries."""

from __future__ import annotations

import logging
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.manifest import ljspeech_line


def write_manifest(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_ljspeech(df: DataFrame, path: str, stem: str = "stem", raw: str = "text", norm: str = "norm_text") -> None:
    df.select(ljspeech_line(F.col(stem), F.col(raw), F.coalesce(norm, raw)).alias("value")).write.mode("overwrite").text(path)


def write_splits(df: DataFrame, path: str, stem: str = "stem", split: str = "split") -> None:
    """A folder of stems per split."""
    df.select(F.col(stem).alias("value"), split).write.mode("overwrite").partitionBy(split).text(path)


def write_stats(df: DataFrame, path: str) -> None:
    columns = ["filename", "duration", "rms_db", "snr_db", "wer", "flagged", "reject_reason", "text"]
    df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]).write.mode("overwrite").option("header", True).csv(path)


def write_summary(summary: DataFrame, path: str) -> None:
    summary.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_dataset(df: DataFrame, path: str, split: str = "split") -> None:
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def write_rejected(stats: DataFrame, path: str) -> bool:
    """Names of rejected files; nothing is written without any."""
    bad = stats.where("reject_reason <> ''").select(F.col("filename").alias("value"))
    if bad.isEmpty():
        return False
    bad.write.mode("overwrite").text(path)
    return True


def write_errors(df: DataFrame, path: str, error: str = "error") -> DataFrame:
    """Rows with an error go to ``path``; the others come back, without it."""
    df.where(F.col(error).isNotNull()).write.mode("append").json(path)
    return df.where(F.col(error).isNull()).drop(error)


def place_files(df: DataFrame, folder: str, path: str = "path", link: bool = False) -> None:
    """Files copied or linked into a folder that all executors share; what is
    there already stays.  Links are relative where the file lies below."""

    def run(rows) -> None:
        import os
        import shutil

        os.makedirs(folder, exist_ok=True)
        for r in rows:
            source = os.path.realpath(r[path].removeprefix("file://"))
            target = os.path.join(folder, os.path.basename(source))
            if os.path.lexists(target):
                continue
            if link:
                below = os.path.commonpath([source, os.path.realpath(folder)]) == os.path.realpath(folder)
                os.symlink(os.path.relpath(source, folder) if below else source, target)
            else:
                part = f"{target}.{os.getpid()}"
                shutil.copy2(source, part)
                os.replace(part, target)

    df.select(path).foreachPartition(run)


def logger(name: str, path: str | None = None, level: int = logging.INFO) -> logging.Logger:
    """The driver's log, to standard output and to a file, set up once a name."""
    log = logging.getLogger(name)
    if not log.handlers:
        log.setLevel(level)
        log.propagate = False
        shape = logging.Formatter("%(asctime)s %(levelname)-8s %(name)s: %(message)s")
        for h in [logging.StreamHandler(sys.stdout), *([logging.FileHandler(path, encoding="utf-8")] if path else [])]:
            h.setFormatter(shape)
            log.addHandler(h)
    return log
