"""Dictation sessions: f1 starts, f2 pauses or resumes, f3 ends.

A block of audio counts while the session records and isn't paused.  A session
records once: events after its end change nothing.  The batch form states the
machine with windows; the streaming form keeps four flags per session.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

OUTPUT = "session long, n_chunks long, total double, ended boolean"


def sessions(events: DataFrame) -> DataFrame:
    """n_chunks, total and ended of every session that started.

    ``events``: session, ts, event_id (the order), kind, value."""
    order = Window.partitionBy("session").orderBy("ts", "event_id")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    seen = events.withColumn("started", F.max(F.when(F.col("kind") == "f1", 1).otherwise(0)).over(upto))
    # an end before any start is no end
    seen = seen.withColumn("ends", F.sum(F.when((F.col("kind") == "f3") & (F.col("started") == 1), 1).otherwise(0)).over(upto))
    live = (F.col("started") == 1) & (F.col("ends") == 0)
    seen = seen.withColumn("pauses", F.sum(F.when(live & (F.col("kind") == "f2"), 1).otherwise(0)).over(upto))
    counted = live & (F.col("kind") == "chunk") & (F.col("pauses") % 2 == 0)
    out = seen.groupBy("session").agg(
        F.count_if(counted).alias("n_chunks"), F.coalesce(F.sum(F.when(counted, F.col("value"))), F.lit(0.0)).alias("total"), (F.max("ends") > 0).alias("ended"), F.max("started").alias("started")
    )
    return out.where("started = 1").drop("started")


class Recorder(StatefulProcessor):
    """The machine over a stream; events of a batch are put in order first."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("session", "recording boolean, paused boolean, done boolean, n long, total double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        recording, paused, done, n, total = self.state.get() if self.state.exists() else (False, False, False, 0, 0.0)
        events = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        for kind, value in zip(events["kind"], events["value"], strict=True):
            if kind == "f1" and not recording and not done:
                recording = True
            elif kind == "f2" and recording:
                paused = not paused
            elif kind == "f3" and recording:
                recording, done = False, True
            elif kind == "chunk" and recording and not paused:
                n, total = n + 1, total + float(value)
        self.state.update((recording, paused, done, n, total))
        if recording or done:
            yield pd.DataFrame({"session": [key[0]], "n_chunks": [n], "total": [total], "ended": [done]})

    def close(self) -> None:
        pass


def stream_sessions(events: DataFrame) -> DataFrame:
    """A row per session and trigger with what it holds so far."""
    return events.groupBy("session").transformWithStateInPandas(statefulProcessor=Recorder(), outputStructType=StructType.fromDDL(OUTPUT), outputMode="Update", timeMode="None")


def run_stream(spark: SparkSession, folder: str, schema: StructType, out: str, checkpoint: str) -> None:
    """All files of ``folder`` through the machine, into Parquet."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = stream_sessions(spark.readStream.schema(schema).parquet(folder))

    def save(df: DataFrame, batch: int) -> None:
        df.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save).trigger(availableNow=True).start().awaitTermination()


def session_durations(events: DataFrame, rate: int, block: int) -> DataFrame:
    """Seconds of audio of ended sessions, from blocks of ``block`` samples."""
    return sessions(events).where("ended").select("session", "n_chunks", F.round(F.col("n_chunks") * block / rate, 3).alias("duration_s"))
