"""The corpus pipeline: quality, language, near duplicates, packing; each stage is written and reread.

Decisions are made row by row: rows that share a doc_id, or have none, may fare differently. All columns but
doc_id, text and lang pass through unread, whatever their names; null, empty and very long texts are decided
like others. No rows give none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, minhash, packing, quality
from tidemark.llm.common import keep, sent_ids, table

#: The first two stages are learned models, which SQL can't express; tests compare with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows whose text is scored below the acceptance of the quality classifier. Without labels
    every row stays. Equal texts are scored alike."""
    model = quality.fitted(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score_of_text(model)(F.col("text")) >= quality.Settings().accept)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows of undetermined language: null texts, texts without a letter, and all if no row has
    a language to learn from."""
    model = language.train(docs)
    return docs.where(language.language_of_text(model)(F.col("text")) != language.UNDETERMINED)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: five words, 0.8. Of a group, equal texts among
    them, the first row as written stays; rows without words stay, each."""
    named = [f"`{c}`" for c in docs.columns]
    rows = keep(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*named).alias("_doc")))
    decided = minhash.near_duplicates(
        rows.select(F.col("_row").alias("doc_id"), F.col("_doc.text").alias("text")), minhash.Settings(width=5)
    )
    rejected = keep(decided.where("not kept").select(F.col("doc_id").alias("_row")))
    return rows.join(sent_ids(rejected), "_row", "left_anti").select("_doc.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of the pieces of all remaining rows; a text without words is one empty piece."""
    return packing.packed(docs)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", dedup_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
