"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; its
result is written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glotta.llm import minhash_dedup, packing, pii, substring_dedup, toxicity
from glotta.llm.common import made, read_table, settled


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model predicts toxic go."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document of least doc_id stays."""
    return minhash_dedup.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has go; documents without a
    repeat keep their text as it is."""
    return substring_dedup.without_repeats(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL can't express the classifier, nor the tokenizer; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; what a stage wrote goes when the next one is done."""
    docs, since = read_table(spark, sf_dir, "documents"), made()
    for name, stage in STAGES[:-1]:
        docs = settled(lambda: stage(spark, docs, sf_dir), name, since)  # noqa: B023
    return STAGES[-1][1](spark, docs, sf_dir)
