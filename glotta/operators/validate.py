"""Row validation: rules as columns, with the first fatal one ending a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CheckConfig, ScoreConfig
from ..functions import text as T

#: Expected file prefix by source; sources without one are never checked.
PREFIXES = {
    "cerebral_pdf": "cerebral_",
    "expression_medicale": "audio_",
    "new_rapports": "new_",
    "tts_expression": "tts_",
    "tts_cerebral": "tts_",
    "tts_rapport": "tts_",
    "concatenated": "concat_",
}


def two_places(c: Column) -> Column:
    return F.format_string("%.2f", F.round(c, 2))


def check(df: DataFrame, config: CheckConfig = CheckConfig()) -> DataFrame:
    """status, issues and issue codes beside a manifest's own columns.

    Reads id, audio_path, transcription, source and the probe's duration_s,
    sample_rate and audio_err.  Nulls count as empty strings.
    """
    text = T.strip(F.coalesce("transcription", F.lit("")))
    path = T.strip(F.coalesce("audio_path", F.lit("")))
    source = F.coalesce("source", F.lit(""))
    no_path, error = path == "", F.coalesce("audio_err", F.lit(""))
    fatal = no_path | (error != "")
    stem = T.stem(path)
    prefix = F.create_map(*[F.lit(x) for kv in PREFIXES.items() for x in kv])[source]
    d, rate = F.col("duration_s"), F.col("sample_rate")
    rules = [
        ("transcription_vide", text == "", F.lit("transcription_vide")),
        ("chemin_audio_absent", no_path, F.lit("chemin_audio_absent")),
        ("audio", ~no_path & (error != ""), F.concat(F.lit("audio_"), F.replace(error, F.lit(" "), F.lit("_")))),
        ("trop_court", ~fatal & (d < config.min_s), F.concat(F.lit("trop_court_"), two_places(d), F.lit("s"))),
        ("trop_long", ~fatal & (d > config.max_s), F.concat(F.lit("trop_long_"), two_places(d), F.lit("s"))),
        ("sample_rate", ~fatal & ~rate.isin(*config.rates), F.concat(F.lit("sample_rate_inhabituel_"), rate.cast("string"), F.lit("Hz"))),
        ("prefixe", ~fatal & prefix.isNotNull() & ~stem.startswith(prefix), F.concat(F.lit("prefixe_inattendu(attendu="), prefix, F.lit(", fichier="), stem, F.lit(")"))),
    ]
    found = F.filter(F.array(*[F.when(hit, F.struct(F.lit(code).alias("code"), said.alias("said"))) for code, hit, said in rules]), lambda x: x.isNotNull())
    out = df.withColumn("_found", found)
    return out.select(
        F.coalesce("id", F.lit("")).alias("id"),
        path.alias("audio_path"),
        source.alias("source"),
        F.substring(text, 1, 80).alias("transcription"),
        F.when(fatal, "ERREUR").when(F.size("_found") > 0, "AVERTISSEMENT").otherwise("OK").alias("status"),
        F.transform("_found", lambda x: x["said"]).alias("issues"),
        F.transform("_found", lambda x: x["code"]).alias("issue_codes"),
        F.when(~fatal, F.round(d, 3)).alias("duration_s"),
        F.when(~fatal, rate).alias("sample_rate"),
    )


def _plain(x: float) -> str:
    return repr(float(x)) if x != int(x) else f"{x:.1f}"


def duration_reason(d: Column, config: ScoreConfig = ScoreConfig()) -> Column:
    """Why a duration is out of range; empty if it isn't."""
    short = F.concat(F.lit("too_short ("), two_places(d), F.lit(f"s < {_plain(config.min_s)}s)"))
    long = F.concat(F.lit("too_long ("), two_places(d), F.lit(f"s > {_plain(config.max_s)}s)"))
    return F.when(d < config.min_s, short).when(d > config.max_s, long).otherwise("")


def score(df: DataFrame, config: ScoreConfig = ScoreConfig(), transcribe: bool = True, normalize: Callable[[Column], Column] = T.normalize_text) -> DataFrame:
    """filename, duration, wer, flagged, reject_reason, text and norm_text.

    Reads filename, duration_s, reference, load_error and (with ``transcribe``)
    hypothesis.  Rows over the WER threshold are flagged and kept.  Without
    transcription there is one duration reason and no empty-text rejection.
    """
    d, failed = F.col("duration_s"), F.coalesce("load_error", F.lit(""))
    ref = F.coalesce("reference", F.lit(""))
    if transcribe:
        hyp = F.coalesce("hypothesis", F.lit(""))
        bad = F.when(failed != "", F.concat(F.lit("load_failed: "), failed)).otherwise(duration_reason(d, config))
        text = F.when((ref == "") & (bad == ""), hyp).otherwise(ref)
    else:
        hyp = F.lit("")
        out = (d < config.min_s) | (d > config.max_s)
        bad = F.when(failed != "", failed).when(out, F.concat(F.lit("duration "), two_places(d), F.lit("s out of range"))).otherwise("")
        text = ref
    df = df.withColumn("_bad", bad).withColumn("_text", text)
    wer = F.when((F.col("_bad") == "") & (ref != "") & (hyp != ""), T.word_error_rate(ref, hyp))
    df = df.withColumn("_wer", wer).withColumn("_norm", F.when(F.col("_bad") == "", normalize(F.col("_text"))))
    reason = F.when((F.col("_bad") == "") & (F.col("_norm") == ""), "empty_text_after_normalisation").otherwise(F.col("_bad")) if transcribe else F.col("_bad")
    kept_duration = F.when(failed != "", F.lit(0.0 if transcribe else None).cast("double")).otherwise(F.round(d, 3))
    return df.select("filename", kept_duration.alias("duration"), F.round("_wer", 4).alias("wer"), F.coalesce(F.col("_wer") > config.mismatch, F.lit(False)).alias("flagged"), reason.alias("reject_reason"), F.col("_text").alias("text"), F.col("_norm").alias("norm_text"))
