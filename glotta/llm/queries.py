"""The queries ``opN_<name>``: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kneser_ney, minhash_dedup, packing, permutation_ann, pii, progressive_jpeg, sentence_pieces, substring_dedup, toxicity, wrapper_induction
from .common import read_table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_permutation_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_ann.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper_induction.main_text(read_table(spark, sf_dir, "pages"))


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digests(read_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(read_table(spark, sf_dir, "documents"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.classes(read_table(spark, sf_dir, "documents"))


def op8_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progressive_jpeg.digests(progressive_jpeg.store(read_table(spark, sf_dir, "documents")))


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score(read_table(spark, sf_dir, "documents"), order=3)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_substring_dedup, op2_toxicity, op3_permutation_ann, op4_wrapper_induction, op5_sentence_pieces, op6_pii, op7_minhash_dedup, op8_progressive_jpeg, op9_kneser_ney, op10_packing)
}
