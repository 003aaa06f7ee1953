"""The corpus pipeline: documents -> clean, deduplicated, packed token sequences.

Each stage calls one operator of ``tidecast.llm`` on everything that the stage
before it kept, and is written as Parquet before the next one reads it.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import crf, packing, repeats, rules, simhash
from tidecast.llm.common import columns_of, documents, prepare, stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.

    Null and empty texts are scored as texts without tokens; repeated rows go
    or stay together; extra columns stay; no documents give no rows.
    """
    return crf.not_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go.

    Null and empty texts have no words, which a rule rejects; repeated rows go
    or stay together; extra columns stay; no documents give no rows.
    """
    prepare(spark)
    return rules.kept(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays.

    Repeated and null ids are documents of their own, so one row of each group
    stays; extra columns stay; no documents give no rows.
    """
    return simhash.keep_one(docs, words=3, distance=3)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that 400 bytes found elsewhere cover leave the texts; n_chars follows.

    A null text stays null; a text may become empty, its row stays; repeated
    rows lose each other's bytes; extra columns stay; no documents give no rows.
    """
    return repeats.remove(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*columns_of(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their ids, and their places in sequences.

    A null or empty text is the end id alone; no documents give no pieces.
    """
    return packing.pack(packing.token_pieces(docs, vocabularies.path("byte_bpe_50k.json"), end_id=2, with_ids=True))


STAGES = [
    ("toxicity", toxicity),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_dedup),
    ("suffix-array dedup", repeat_removal),
    ("best-fit packing", pack_sequences),
]

#: SQL can express neither the model nor the tokens; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again.  No documents give no rows."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
