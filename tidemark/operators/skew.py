"""Finding and separating keys that hold too many rows for one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

# A key with more rows than this is processed in time slices instead of as one group.
HEAVY_KEY_ROWS = 2_000_000


def heavy_keys(
    df: DataFrame, *keys: str, min_rows: int = HEAVY_KEY_ROWS
) -> dict[str, DataFrame | None]:
    """Per key column the values with more than ``min_rows`` rows as a frame, None if there are none.

    Only the key columns are scanned and counts are combined before the shuffle. The lists are
    written once and stay frames, however long they are.
    """
    lists = [
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > min_rows)
        .select(F.lit(key).alias("_key"), key)
        for key in keys
    ]
    found = materialize(
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lists)
    )
    held = {r["_key"] for r in found.select("_key").distinct().collect()}  # one row per key column
    return {
        key: found.filter(F.col("_key") == key).select(key) if key in held else None for key in keys
    }


def split_heavy(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of heavy keys). Spark picks the join by the size of the list."""
    return df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi")
