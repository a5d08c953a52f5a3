"""Numbering and running totals over a whole table without one task holding it.

The rows are range-partitioned in order and written once; each partition is worked on by itself
and receives what the partitions before it add up to, a frame of one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

# monotonically_increasing_id() is the partition number above this bit and the position below it.
_POSITION_BITS = 33


def _placed(df: DataFrame) -> DataFrame:
    """Add the partition ``_part`` and the position in it, fixed by writing the rows once."""
    placed = materialize(df.withColumn("_place", F.monotonically_increasing_id()))
    return placed.withColumns(
        {
            "_part": F.shiftright("_place", _POSITION_BITS),
            "_position": F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    ).drop("_place")


def consecutive(df: DataFrame, name: str, order: Sequence[str | Column] = (), start: int = 1):
    """Number all rows ``start, start + 1, ...`` in the given order, without gaps."""
    placed = _placed(df.orderBy(*order) if order else df)
    # One row per partition, so its size is bounded by the number of tasks.
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_position") + F.lit(start))
        .drop("_part", "_position", "_offset")
    )


def running_sums(df: DataFrame, order: Sequence[str | Column], values: Sequence[str]) -> DataFrame:
    """For each value column add ``running_<v>``, inclusive of the row, and ``total_<v>``."""
    placed = _placed(df.orderBy(*order))
    inside = (
        Window.partitionBy("_part")
        .orderBy("_position")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    # One row per partition, so its size is bounded by the number of tasks.
    parts = placed.groupBy("_part").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    carried = parts.select(
        "_part",
        *[F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_c_{v}") for v in values],
        *[F.sum(f"_sum_{v}").over(everything).alias(f"total_{v}") for v in values],
    )
    return (
        placed.withColumns({f"running_{v}": F.sum(v).over(inside) for v in values})
        .join(F.broadcast(carried), "_part")
        .withColumns({f"running_{v}": F.col(f"running_{v}") + F.col(f"_c_{v}") for v in values})
        .drop("_part", "_position", *[f"_c_{v}" for v in values])
    )
