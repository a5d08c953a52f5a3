"""Set-wise changes that yield a new snapshot of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.ordering import consecutive
from tidemark.sources import manifests


def methods_to_deactivate(transactions: DataFrame) -> DataFrame:
    """Payment methods with a declined transaction, other than by botting."""
    botting = F.coalesce(F.col("fraud_type") == S.BOTTING, F.lit(False))
    return (
        transactions.filter((F.col("transaction_status") == S.DECLINED) & ~botting)
        .select(F.col("payment_id").alias("payment_method_id"))
        .distinct()
    )


def deactivate(payment_methods: DataFrame, methods: DataFrame) -> DataFrame:
    """The table after the listed methods are set inactive."""
    hit = methods.select("payment_method_id").distinct().withColumn("_hit", F.lit(True))
    columns = payment_methods.columns
    return (
        payment_methods.join(hit, "payment_method_id", "left")
        .withColumn(
            "payment_is_active",
            F.when(F.col("_hit"), F.lit(0)).otherwise(F.col("payment_is_active")),
        )
        .select(*columns)
    )


def deactivated_rows(payment_methods: DataFrame, methods: DataFrame) -> DataFrame:
    """The rows a deactivation touches; empty means that nothing changed."""
    return payment_methods.join(methods.select("payment_method_id"), "payment_method_id", "left_semi")


def deactivate_in_place(spark, table: str, methods: DataFrame) -> int:
    """Set the listed methods of a table kept by ``sources.manifests`` inactive, rewriting only the files
    that hold one that is active; the number of rows that changed."""
    listed = methods.select("payment_method_id").distinct()

    def hit(rows: DataFrame) -> DataFrame:
        changing = rows.filter(~F.col("payment_is_active").eqNullSafe(0))
        return changing.join(listed, "payment_method_id", "left_semi")

    return manifests.update(spark, table, hit, lambda rows: deactivate(rows, listed))


def append_with_keys(existing: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Give new rows the keys after the largest one in use, in the given order.

    Returns the new rows only; ``sources.tables.append_table`` writes them.
    """
    last = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("last")).first()["last"]
    numbered = consecutive(new, key, order, start=last + 1)
    return numbered.select(key, *[c for c in new.columns if c != key])
