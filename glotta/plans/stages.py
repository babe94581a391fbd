"""Stages one after the other, on the driver: each reads what others wrote."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class Result(NamedTuple):
    name: str
    status: str  # done, failed, skipped or planned
    seconds: float = 0.0
    error: str | None = None


def run(stages: Iterable[tuple[str, Callable[[], object]]], only: set[str] | None = None, dry: bool = False, tell: Callable[[str], object] = print) -> list[Result]:
    """Run the stages (those of ``only``, if given) in order.  The first that
    raises halts the rest; a dry run only says what would run."""
    out, halted = [], False
    for name, stage in stages:
        if halted or only is not None and name not in only:
            out.append(Result(name, "skipped"))
            continue
        if dry:
            tell(f"would run {name}")
            out.append(Result(name, "planned"))
            continue
        began = time.monotonic()
        try:
            stage()
            out.append(Result(name, "done", time.monotonic() - began))
            tell(f"{name}: done")
        except Exception as e:
            out.append(Result(name, "failed", time.monotonic() - began, str(e)))
            tell(f"{name}: failed: {e}")
            halted = True
    return out


def observed(df: DataFrame, failed: str | None = None) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows, and those where ``failed`` holds, as they
    pass; the counts are there when its action ends."""
    seen = Observation()
    bad = F.count_if(F.expr(failed)) if failed else F.lit(0).cast("long")
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), bad.alias("failed")), seen
