"""Summaries of manifests and validation results; each is one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def count_by(df: DataFrame, key: str = "source") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def check_summary(checked: DataFrame) -> DataFrame:
    d = F.col("duration_s")
    return checked.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "OK").alias("ok"),
        F.count_if(F.col("status") == "AVERTISSEMENT").alias("warnings"),
        F.count_if(F.col("status") == "ERREUR").alias("errors"),
        F.round(F.sum(d), 3).alias("total_s"),
        F.round(F.avg(d), 3).alias("mean_s"),
        F.min(d).alias("min_s"),
        F.max(d).alias("max_s"),
    )


def issue_counts(checked: DataFrame, column: str = "issues") -> DataFrame:
    return checked.select(F.explode(column).alias("issue")).groupBy("issue").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "issue")


def check_global(checked: DataFrame, key: str) -> DataFrame:
    """Per manifest and over all (null key): rows, problems and hours; a zero
    duration counts as none."""
    return checked.rollup(key).agg(F.count("*").alias("total"), F.count_if(F.col("status") == "OK").alias("ok"), F.count_if(F.col("status") != "OK").alias("problems"), F.round(F.sum(F.when(F.col("duration_s") > 0, F.col("duration_s"))) / 3600, 4).alias("hours"))


def problem_report(checked: DataFrame) -> DataFrame:
    return checked.where("status <> 'OK'").select("status", "id", "source", "duration_s", "sample_rate", "audio_path", "transcription", F.array_join("issues", "; ").alias("issues"))


def clean_report(df: DataFrame, duration: str, error: str, short_s: float = 4.0) -> DataFrame:
    ok = F.col(error).isNull()
    d = F.when(ok, F.col(duration))
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("succeeded"),
        F.round(100 * F.count_if(ok) / F.count("*"), 1).alias("rate_pct"),
        F.round(F.avg(d), 3).alias("mean_s"),
        F.min(d).alias("min_s"),
        F.max(d).alias("max_s"),
        F.count_if(ok & (F.col(duration) < short_s)).alias("short"),
        F.count_if(ok & (F.col(duration) >= short_s)).alias("long"),
    )


def concat_stats(df: DataFrame, duration: str = "duration", text: str = "transcription", source: str = "source") -> DataFrame:
    counts = [F.count_if(F.col(source) == s).alias(s) for s in ("long_original", "concatenated", "short_kept")]
    d = F.col(duration)
    return df.agg(F.count("*").alias("total"), *counts, F.round(F.avg(d), 3).alias("mean_s"), F.round(F.min(d), 3).alias("min_s"), F.round(F.max(d), 3).alias("max_s"), F.round(F.avg(T.word_count(F.col(text))), 4).alias("mean_words"))


def dataset_summary(stats: DataFrame, split: str = "split") -> DataFrame:
    ok = F.col("reject_reason") == ""
    return stats.agg(
        F.count("*").alias("total_files"),
        F.count_if(ok).alias("valid_files"),
        F.count_if(~ok).alias("rejected_files"),
        F.count_if(ok & F.col("flagged")).alias("flagged_files"),
        F.round(F.sum(F.when(ok, F.col("duration"))), 2).alias("total_duration_s"),
        *[F.count_if(F.col(split) == s).alias(s) for s in ("train", "val", "test")],
    )


def corpus_wer(df: DataFrame, ref: str, hyp: str) -> DataFrame:
    """All edits over all reference words, in per cent."""
    r, h = T.words(F.lower(F.col(ref))), T.words(F.lower(F.col(hyp)))
    pairs = df.select(F.size(r).alias("n"), T.word_edits(r, h).alias("e"))
    return pairs.agg(F.sum("e").alias("edits"), F.sum("n").alias("words"), F.round(100 * F.sum("e") / F.sum("n"), 2).alias("wer_pct"))
