"""Gapless numbers within keys of any size: counts of chunks first, then numbers inside chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNKS = 1024


def numbered(
    df: DataFrame, name: str, keys: Sequence[str], chunk: Column, order: Sequence[str | Column]
) -> DataFrame:
    """Add ``name``: 0, 1, ... within ``keys``, by ``chunk`` (from 0 to a fixed bound) and ``order``.

    No task sees more than one chunk of one key. ``keys`` must have few values, so that the counts,
    one row per key and chunk, stay small whatever the number of rows.
    """
    parts = [*keys, "_chunk"]
    placed = df.withColumn("_chunk", chunk)
    before = Window.partitionBy(*keys) if keys else Window.partitionBy()
    offsets = (
        placed.groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.sum("_rows").over(before.orderBy("_chunk")) - F.col("_rows"))
        .drop("_rows")
    )
    inside = Window.partitionBy(*parts).orderBy(*order)
    return (
        placed.join(F.broadcast(offsets), parts)
        .withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_chunk", "_offset")
    )
