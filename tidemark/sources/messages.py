"""Transaction messages: building them, parsing them, and the topics they travel on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.operators.quality import missing_names

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_MALFORMED = "_malformed"

# A message without these cannot be stored or scored. The id may be given by the topic position.
REQUIRED = (
    "transaction_id",
    "user_id",
    "device_id",
    "merchant_id",
    "payment_id",
    "transaction_amount_usd",
    "transaction_timestamp",
    "transaction_status",
)


def to_messages(transactions: DataFrame, payment_methods: DataFrame) -> DataFrame:
    """(key, value) rows for a topic: the transaction as JSON with the creation time of its
    payment method. Keyed by user, so that a user's messages keep their order."""
    created = payment_methods.select(
        F.col("payment_method_id").alias("payment_id"),
        F.col("created_at").alias("payment_created_at"),
    )
    joined = transactions.join(created, "payment_id", "left")
    times = ("transaction_timestamp", "payment_created_at")
    fields = []
    for f in S.TRANSACTION_MESSAGE.fields:
        if f.name in times:
            column = F.date_format(f.name, TIME_FORMAT)
        elif f.name in joined.columns:
            column = F.col(f.name).cast(f.dataType)
        else:
            column = F.lit(None).cast(f.dataType)
        fields.append(column.alias(f.name))
    return joined.select(
        F.col("user_id").cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )


def position_id() -> Column:
    """An id that a retry reproduces: the digest of topic, partition and offset."""
    return F.sha2(F.concat_ws(":", "topic", "partition", "offset"), 256)


def parse(messages: DataFrame, fallback_id: Column | None = None) -> DataFrame:
    """Typed transaction columns plus ``problems``, an array that is empty for usable messages.

    ``fallback_id`` stands in for a missing ``transaction_id``. No message raises an error.
    """
    schema = T.StructType([*S.TRANSACTION_MESSAGE.fields, T.StructField(_MALFORMED, T.StringType())])
    if fallback_id is None:
        fallback_id = F.sha2(F.col("value").cast("string"), 256)
    data = F.from_json(
        F.col("value").cast("string"), schema, {"columnNameOfCorruptRecord": _MALFORMED}
    )
    # As a generator's output the fields are parsed once; a plain projection would be substituted
    # into every filter on them, parsing the text again for each mention.
    flat = messages.select(
        F.col("value").cast("string").alias("_value"),
        fallback_id.alias("_id"),
        F.inline(F.array(data)),
    )
    malformed = F.col(_MALFORMED).isNotNull() | F.col("_value").isNull()
    typed = flat.withColumns(
        {
            "transaction_id": F.coalesce("transaction_id", "_id"),
            "transaction_timestamp": F.try_to_timestamp("transaction_timestamp"),
            "payment_created_at": F.try_to_timestamp("payment_created_at"),
        }
    )
    channel = F.col("transaction_channel")
    problems = (
        F.when(malformed, F.array(F.lit("malformed")))
        .when(
            channel.isNull() | ~channel.isin(S.ONLINE, S.LOCAL),
            F.array_append(missing_names(REQUIRED), F.lit("transaction_channel")),
        )
        .otherwise(missing_names(REQUIRED))
    )
    return typed.withColumn("problems", problems).drop("_id", _MALFORMED)


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.size("problems") == 0).drop("problems", "_value")


def rejected(parsed: DataFrame) -> DataFrame:
    """The raw text of unusable messages and what is wrong with them."""
    return parsed.filter(F.size("problems") > 0).select(
        F.col("_value").alias("value"), F.array_join("problems", ", ").alias("problems")
    )


def conform(messages: DataFrame) -> DataFrame:
    """The ten columns of a stored history row: amount in exact cents, time as a timestamp."""
    return messages.select(
        "user_id",
        "device_id",
        F.col("transaction_amount_usd").cast(S.MONEY).alias("transaction_amount_usd"),
        "transaction_status",
        "payment_id",
        F.try_to_timestamp(F.col("transaction_timestamp").cast("string")).alias(
            "transaction_timestamp"
        ),
        "transaction_country",
        "merchant_id",
        "transaction_channel",
        "merchant_category",
    )


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str = "transactions",
    starting: str = "latest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw messages of a topic. Needs the Kafka source package on the session."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**(options or {}))
        .load()
    )


def file_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Messages from text files, one JSON document per line, as they appear in a folder."""
    return (
        spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(path)
    )


def to_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Publish (key, value) rows, or whole rows as JSON where there is no ``value`` column."""
    if "value" not in df.columns:
        df = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    df.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()
