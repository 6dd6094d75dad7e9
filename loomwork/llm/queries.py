"""The registered queries of this subpackage and their SQL, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import ann, decontam, license, packing, pii, quality, simhash, substring, tokens, toxicity
from loomwork.session import read


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(read(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash(read(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(read(spark, sf_dir, "documents"))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_output(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeats(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_ann, op2_packing, op3_quality, op4_license, op5_simhash, op6_pii, op7_tokens, op8_decontam, op9_toxicity, op10_substring, pipeline)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    return {"op4_license": license.oracle()} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
