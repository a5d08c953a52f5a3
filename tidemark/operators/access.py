"""Lookups and histories for many keys at once, instead of one query per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S

HISTORY_COLUMNS = (
    "user_id",
    "device_id",
    "transaction_amount_usd",
    "transaction_status",
    "payment_id",
    "transaction_timestamp",
    "transaction_country",
    "merchant_id",
    "transaction_channel",
)


def rows_of_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``keys``. Spark broadcasts the keys only if known to be few."""
    return df.join(keys.select(key), key, "left_semi")


def active_payment_methods(payment_methods: DataFrame, users: DataFrame) -> DataFrame:
    """The active payment methods of the given users."""
    active = payment_methods.filter(F.col("payment_is_active") == 1)
    return rows_of_keys(active, users, "user_id")


def since(df: DataFrame, as_of: Column, hours: int) -> DataFrame:
    """Transactions not older than ``hours`` before ``as_of``; a literal reaches the scan."""
    return df.filter(F.col("transaction_timestamp") >= as_of - F.expr(f"INTERVAL {hours} HOURS"))


def user_history(
    transactions: DataFrame,
    merchants: DataFrame,
    users: DataFrame,
    as_of: Column,
    hours: int = S.LONGEST_LOOKBACK // S.HOUR,
    how: str = "inner",
) -> DataFrame:
    """Recent transactions of the given users with the merchant category.

    ``how="left"`` also keeps transactions of unknown merchants, as feature jobs need.
    """
    recent = rows_of_keys(since(transactions, as_of, hours), users, "user_id")
    categories = merchants.select("merchant_id", "merchant_category")
    kept = [c for c in (*HISTORY_COLUMNS, "transaction_id") if c in transactions.columns]
    return recent.join(categories, "merchant_id", how).select(*kept, "merchant_category")


def device_history(
    transactions: DataFrame, devices: DataFrame, as_of: Column, hours: int
) -> DataFrame:
    """Recent transactions on the given devices."""
    return rows_of_keys(since(transactions, as_of, hours), devices, "device_id")


def with_merchant(df: DataFrame, merchants: DataFrame) -> DataFrame:
    """All merchant columns next to each transaction, NULL for unknown merchants."""
    renamed = merchants.withColumnRenamed("country", "merchant_country")
    return df.join(renamed, "merchant_id", "left")


def with_payment_method(df: DataFrame, payment_methods: DataFrame) -> DataFrame:
    """Payment method, provider, activity and creation time next to each transaction."""
    info = payment_methods.select(
        F.col("payment_method_id").alias("payment_id"),
        "payment_method",
        "payment_service_provider",
        "payment_is_active",
        F.col("created_at").alias("payment_created_at"),
    )
    return df.join(info, "payment_id", "left")


def read_rates(spark, path: str) -> DataFrame:
    """Exchange rates from a JSON document, either ``{currency: rate}`` or with the rates nested
    under ``conversion_rates``: one row per currency."""
    document = spark.read.text(path, wholetext=True)
    nested = F.from_json("value", "conversion_rates map<string,string>")["conversion_rates"]
    flat = F.from_json("value", "map<string,string>")
    return document.select(F.explode(F.coalesce(nested, flat)).alias("currency", "rate")).select(
        "currency", F.col("rate").try_cast("decimal(18,6)").alias("rate")
    )


def with_rate(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Exchange rate of the transaction's currency."""
    rates = rates.select(F.col("currency").alias("transaction_currency"), "rate")
    return df.join(rates, "transaction_currency", "left")


def earliest_active_payment_method(payment_methods: DataFrame) -> DataFrame:
    """Per user the active method created first, ties by id; combined before the shuffle."""
    rest = [c for c in payment_methods.columns if c != "user_id"]
    return (
        payment_methods.filter(F.col("payment_is_active") == 1)
        .groupBy("user_id")
        .agg(F.min_by(F.struct(*rest), F.struct("created_at", "payment_method_id")).alias("first"))
        .select("user_id", "first.*")
    )


def random_rows(df: DataFrame, n: int = 1, seed: int = S.SEED) -> DataFrame:
    """``n`` rows picked at random; each task keeps its best ``n`` only."""
    return df.orderBy(F.rand(seed)).limit(n)


def random_row_per_key(df: DataFrame, key: str, row_id: str, seed: int = S.SEED) -> DataFrame:
    """One row per key picked by a seeded hash of its id; combined before the shuffle."""
    rest = [c for c in df.columns if c != key]
    drawn = F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f":{seed}")))
    return (
        df.groupBy(key)
        .agg(F.min_by(F.struct(*rest), F.struct(drawn, F.col(row_id))).alias("drawn"))
        .select(key, "drawn.*")
    )


def time_ordered(df: DataFrame, tie: str = "transaction_id") -> DataFrame:
    """Rows in event-time order, for a sink that needs them so."""
    return df.orderBy("transaction_timestamp", tie)


def merchant_ids(merchants: DataFrame) -> DataFrame:
    return merchants.select("merchant_id")


def merchant_categories(df: DataFrame) -> DataFrame:
    """Distinct (merchant, category) pairs of the given rows."""
    return df.select("merchant_id", "merchant_category").distinct()


def with_incoming(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """History and incoming rows together, each transaction once."""
    return history.unionByName(incoming).dropDuplicates(["transaction_id"])
