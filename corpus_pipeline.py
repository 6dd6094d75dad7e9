"""From documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again
as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomwork.llm import decontam, packing, pii, simhash, toxicity
from loomwork.session import new_path, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose severity model puts at least half on a grade above 0 go."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every SimHash component the smallest doc_id stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.keep_uncontaminated(docs, read(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars follows."""
    return pii.mask(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack_sequences),
]

#: Trained models, XXH64 fingerprints and tokenizers are beyond SQL; a test holds every stage against a brute-force version at a small scale.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents; each result is written and read again.

    Rows are judged by their own text, so null and repeated doc_ids lose nothing but what
    their texts deserve: null and empty texts have no features, spans or items, and all of
    them are near copies of each other, so one stays. Repeated rows are near copies too. An
    empty table passes through all stages to no sequences; other columns are kept up to
    the last stage. Ties: the smallest doc_id of a group stays; packing goes by length, then
    doc_id and piece.
    """
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
