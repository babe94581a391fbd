"""Parameters of the operators, with the values the pipelines use."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CheckConfig:
    min_s: float = 0.5
    max_s: float = 30.0
    rates: tuple[int, ...] = (16000, 22050, 44100, 48000)


@dataclass(frozen=True)
class PackConfig:
    short_s: float = 4.0
    pause_s: float = 0.4
    min_terms: int = 2
    max_terms: int = 4
    max_s: float = 28.0
    single_s: float = 1.5


@dataclass(frozen=True)
class MergeConfig:
    min_s: float = 10.0
    max_s: float = 15.0
    silence_s: float = 0.3


@dataclass(frozen=True)
class ConcatConfig:
    silence_s: float = 0.5
    max_s: float = 300.0
    fade_ms: float = 10.0


@dataclass(frozen=True)
class SegmentConfig:
    rate: int = 22050
    min_s: float = 1.0
    max_s: float = 15.0
    gap_ms: float = 500.0
    target_rms_db: float = -20.0
    headroom_db: float = -1.0


@dataclass(frozen=True)
class ScoreConfig:
    min_s: float = 1.0
    max_s: float = 15.0
    mismatch: float = 0.35


@dataclass(frozen=True)
class SplitConfig:
    train: float = 0.90
    val: float = 0.05
    seed: int = 42
