"""Registered queries of the dealt operators, with production parameters over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import (ann, bitplanes, bpe, crf, lm, packing, periods, pu, repeats, rules, separators, simhash,
                          tokenfiles)
from tidecast.llm.common import documents, prepare

BYTE_BPE = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
MULTI_BPE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted: quality of every document by positive-unlabelled learning."""
    return pu.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and the verdict of the rule cascade."""
    prepare(spark)
    return rules.base_counts(documents(spark, sf_dir))


def op3_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document because 400 bytes around them start elsewhere too."""
    return repeats.report(documents(spark, sf_dir))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes decoded from them."""
    return bpe.round_trip(documents(spark, sf_dir), vocabularies.path(MULTI_BPE), vocabularies.PATTERN)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from Huffman-coded token files."""
    out = tokenfiles.write_files(documents(spark, sf_dir), vocabularies.path(WORD_BPE), tokenfiles.new_folder(spark),
                                 keeps_space=False, end_id=1, vocabulary=49_408)
    return tokenfiles.read_files(spark, out)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    pieces = packing.token_pieces(documents(spark, sf_dir), vocabularies.path(BYTE_BPE), end_id=2)
    return packing.pack(pieces)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir), words=3, distance=3)


def op8_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted: toxicity of every document from the marginals of its tokens."""
    return crf.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows found for every row whose vec_id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.search(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens of every document, counted by separators in flat token files."""
    return separators.token_counts(documents(spark, sf_dir), vocabularies.path(BYTE_BPE), end_id=50_256)


def op11_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by the attention model and by add-one word counts."""
    return lm.score(documents(spark, sf_dir), vocabularies.path(BYTE_RANKS), vocabularies.PATTERN, end=50_256,
                    vocabulary=50_257)


def op12_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and exact squared distance of every vector after three rounds over 16 centroids."""
    return bitplanes.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=16, rounds=3, seed=1, scale=64.0)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document and digests of its collapsed text."""
    return periods.report(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over ``documents``."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_pu_quality, op2_rule_cascade, op3_repeat_removal, op4_byte_bpe, op5_token_files, op6_packing, op7_simhash,
    op8_crf_toxicity, op9_learned_partitions, op10_token_counts, op11_attention_lm, op12_bit_planes, op13_periodic_runs,
    pipeline)}

ORACLE: dict[str, str] = {"op2_rule_cascade": rules.SQL, "op12_bit_planes": bitplanes.sql(k=16, rounds=3, seed=1)}
