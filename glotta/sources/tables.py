"""Parquet tables, spread over the cores when they come in few pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Bytes of input that are worth a task of their own.
PIECE = 1 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` as it is if its scan has a task for every core; a small file of
    one row group is dealt out, for work that costs more than the exchange."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, size // PIECE)
    return df.repartition(wanted) if wanted > 1 and df.rdd.getNumPartitions() < wanted else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
