"""Registered queries of the operators: each over its whole table, with production settings."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe,
    extraction,
    fingerprints,
    language,
    manifest,
    minhash,
    negatives,
    neighbours,
    packing,
    quality,
    scoring,
    sharding,
    vectors,
)
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


@query("op1_minhash")
def op1_minhash(spark: SparkSession, directory: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, directory, "documents"))


@query("op2_quality")
def op2_quality(spark: SparkSession, directory: str) -> DataFrame:
    return quality.quality(table(spark, directory, "documents"), table(spark, directory, "labels"))


@query("op10_language")
def op10_language(spark: SparkSession, directory: str) -> DataFrame:
    return language.languages(table(spark, directory, "documents"))


@query("op7_bpe")
def op7_bpe(spark: SparkSession, directory: str) -> DataFrame:
    return bpe.digests(table(spark, directory, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    return fingerprints.compared(table(spark, directory, "documents"))


@query("op3_vectors")
def op3_vectors(spark: SparkSession, directory: str) -> DataFrame:
    return vectors.near_vectors(table(spark, directory, "embeddings"))


@query("op5_extraction")
def op5_extraction(spark: SparkSession, directory: str) -> DataFrame:
    return extraction.extracted(table(spark, directory, "pages"))


@query("op4_packing", packing.oracle_sql())
def op4_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.packed(table(spark, directory, "documents"))


@query("op6_sharding")
def op6_sharding(spark: SparkSession, directory: str) -> DataFrame:
    return sharding.sharded(table(spark, directory, "documents"))


@query("op8_scoring")
def op8_scoring(spark: SparkSession, directory: str) -> DataFrame:
    return scoring.scored(table(spark, directory, "documents"))


@query("op11_neighbours")
def op11_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    return neighbours.nearest(table(spark, directory, "embeddings"))


@query("op12_negatives", negatives.oracle_sql())
def op12_negatives(spark: SparkSession, directory: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, directory, "embeddings"))


@query("op13_manifest", manifest.oracle_sql())
def op13_manifest(spark: SparkSession, directory: str) -> DataFrame:
    return manifest.manifest(table(spark, directory, "documents"))
