"""Registered queries of this package, each over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import (
    centroid_clusters,
    conversation_trie,
    cotraining,
    line_frequency,
    oracles,
    pareto_mix,
    patience_scan,
    pii_examples,
    pii_spans,
    positional_index,
    repeated_spans,
    secret_scan,
    segment_join,
    tensored_minhash,
    token_transducer,
)
from stratum.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op3_line_frequency": oracles.LINE_FREQUENCY,
    "op5_tensored_minhash": oracles.NEAR_DUPLICATES,
    "op7_positional_index": oracles.CONTAMINATION,
    "op12_paren_trie": oracles.CONVERSATION_TRIE,
    "op13_centroid_clusters": oracles.centroid_clusters(),
}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op3_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return line_frequency.verdicts(read(spark, folder, "documents"))


@query
def op4_token_transducer(spark: SparkSession, folder: str) -> DataFrame:
    return token_transducer.token_counts(read(spark, folder, "documents"), vocabulary_path())


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op7_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    return positional_index.report(read(spark, folder, "documents"), read(spark, folder, "benchmark")).drop("digest")


@query
def op9_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    return pareto_mix.report(read(spark, folder, "documents"))


@query
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(read(spark, folder, "documents"))


@query
def op5_tensored_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return tensored_minhash.report(read(spark, folder, "documents"))


@query
def op6_bwt_intervals(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans.report(read(spark, folder, "documents"))


@query
def op1_segment_join(spark: SparkSession, folder: str) -> DataFrame:
    return segment_join.report(read(spark, folder, "documents"))


@query
def op2_patience_scan(spark: SparkSession, folder: str) -> DataFrame:
    return patience_scan.report(read(spark, folder, "documents"))


@query
def op10_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    return cotraining.scored(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op11_shape_crf(spark: SparkSession, folder: str) -> DataFrame:
    return pii_spans.report(read(spark, folder, "documents"), pii_spans.fitted(pii_examples.examples(spark)))


@query
def op12_paren_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.trie(read(spark, folder, "conversations"))


@query
def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters.report(read(spark, folder, "embeddings"))
