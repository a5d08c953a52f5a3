"""The six business tables expressed as views over the driver's generic parquet tables.

Every view is lazy and built from whole tables; see FIXTURES.md for the mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S

# Transactions whose k is at least FIRST_UNKNOWN name a merchant this far off, which no merchant
# has, so that lookups have something to miss.
FIRST_UNKNOWN, UNKNOWN_OFFSET = 95, 1_000_000_000

METHODS = ("credit_card", "debit_card", "bank_transfer", "crypto_currency")
PROVIDERS = ("Renowned", "Mid")
FX_RATES = {
    "USD": "1.0000",
    "CNY": "7.1050",
    "INR": "83.2150",
    "CAD": "1.3475",
    "JPY": "147.3300",
    "EUR": "0.9205",
    "GBP": "0.7895",
}


def _pick(values, index) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


class Fixture:
    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def transactions(self) -> DataFrame:
        k = F.regexp_extract("props", r'"k": *(\d+)', 1).cast("int")
        kind, value = F.col("event_type"), F.col("value")
        events = self.raw("events").withColumn("k", k)
        currency = F.create_map(
            *[F.lit(x) for pair in S.COUNTRY_CURRENCY.items() for x in pair]
        )
        country = _pick(S.COUNTRY_CURRENCY, F.col("k") % 8)
        fraud = (kind == "error") & (value < 10)
        return events.select(
            F.col("event_id").alias("transaction_id"),
            F.col("ts").cast("timestamp").alias("transaction_timestamp"),
            value.cast(S.MONEY).alias("transaction_amount_usd"),
            F.when(kind == "error", S.DECLINED).otherwise(S.APPROVED).alias("transaction_status"),
            currency[country].alias("transaction_currency"),
            country.alias("transaction_country"),
            F.when(kind.isin("click", "purchase", "error"), S.ONLINE)
            .otherwise(S.LOCAL)
            .alias("transaction_channel"),
            "user_id",
            F.when(F.col("k") < FIRST_UNKNOWN, F.col("k").cast("long"))
            .otherwise(F.col("k") + F.lit(UNKNOWN_OFFSET).cast("long"))
            .alias("merchant_id"),
            (F.col("user_id") * 4 + F.col("k") % 4).alias("payment_id"),
            F.expr("user_id div 3").alias("device_id"),
            fraud.cast("int").alias("is_fraudulent"),
            F.when(fraud, "Card Probing").otherwise("No Fraud").alias("fraud_type"),
        )

    def merchants(self) -> DataFrame:
        return (
            self.raw("part")
            .select(
                F.col("p_partkey").alias("merchant_id"),
                F.col("p_name").alias("merchant_name"),
                _pick(S.COUNTRY_CURRENCY, F.col("p_partkey") % 8).alias("country"),
                F.when(F.col("p_size") < 10, "Unknown")
                .when(F.col("p_size") < 30, "Mid")
                .otherwise("Renowned")
                .alias("rating"),
                _pick(S.MERCHANT_CATEGORIES, F.col("p_partkey") % 8).alias("merchant_category"),
            )
        )

    def payment_methods(self) -> DataFrame:
        return (
            self.transactions()
            .groupBy(F.col("payment_id").alias("payment_method_id"))
            .agg(
                F.min("user_id").alias("user_id"),
                F.min("transaction_timestamp").alias("created_at"),
            )
            .select(
                "payment_method_id",
                "user_id",
                _pick(METHODS, F.col("payment_method_id") % 4).alias("payment_method"),
                _pick(PROVIDERS, F.col("payment_method_id") % 2).alias("payment_service_provider"),
                F.lit(1).alias("payment_is_active"),
                "created_at",
            )
        )

    def users(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("name"),
            _pick(S.COUNTRY_CURRENCY, F.col("c_nationkey") % 8).alias("country"),
        )

    def user_devices(self) -> DataFrame:
        return (
            self.transactions()
            .groupBy("device_id")
            .agg(
                F.min("user_id").alias("user_id"),
                F.min("transaction_timestamp").alias("first_used"),
                F.max("transaction_timestamp").alias("last_used"),
            )
        )

    def fx_rates(self) -> DataFrame:
        return self.spark.createDataFrame(
            list(FX_RATES.items()), "currency string, rate string"
        ).select("currency", F.col("rate").cast("decimal(18,6)").alias("rate"))

    def scored(self) -> DataFrame:
        """Label and a heavily tied score, for metric queries."""
        return self.raw("events").select(
            F.col("event_id").alias("transaction_id"),
            ((F.col("event_type") == "error") & (F.col("value") < 10))
            .cast("int")
            .alias("label"),
            (F.floor("value") / 1000).cast("double").alias("score"),
        )
