"""Schemas of the manifests and reports that the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


MANIFEST_ALL = _struct("id string, audio_path string, transcription string, source string")
MANIFEST_CLEAN = _struct("audio_path string, transcription string, duration double")
MANIFEST_CONCAT_FULL = _struct("audio_path string, transcription string, source string, duration double, n_terms int")
MANIFEST_CONCAT = _struct("audio_path string, transcription string")
MANIFEST_TTS = _struct("audio_path string, transcription string, source string")
STAGE3_META = _struct("filename string, text string")
LJ_META = _struct("stem string, raw_text string, norm_text string")
STATS = _struct("filename string, duration double, rms_db double, snr_db double, wer double, flagged boolean, reject_reason string, text string")
CHECK_REPORT = _struct("status string, id string, source string, duration_s double, sample_rate int, audio_path string, transcription string, issues string")
SUMMARY = _struct("total_files long, valid_files long, rejected_files long, flagged_files long, total_duration_s double, train long, val long, test long")
VOICE_CONFIG = _struct("idx int, voice string, rate string")
ERROR_LOG = _struct("index long, text string, error string")
SEGMENT = _struct("start long, end long")
