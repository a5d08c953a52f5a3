"""Table schemas, message schema and the vocabularies the rules rely on."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)


def _table(*columns: tuple) -> T.StructType:
    return T.StructType([T.StructField(c[0], c[1], len(c) < 3 or c[2]) for c in columns])


USERS = _table(
    ("user_id", T.LongType(), False),
    ("name", T.StringType()),
    ("email", T.StringType()),
    ("country", T.StringType()),
    ("city", T.StringType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("created_at", T.TimestampType()),
)

USER_DEVICES = _table(
    ("device_id", T.LongType(), False),
    ("user_id", T.LongType(), False),
    ("device_type", T.StringType()),
    ("first_used", T.TimestampType()),
    ("last_used", T.TimestampType()),
)

PAYMENT_METHODS = _table(
    ("payment_method_id", T.LongType(), False),
    ("user_id", T.LongType(), False),
    ("payment_method", T.StringType()),
    ("payment_service_provider", T.StringType()),
    ("payment_is_active", T.IntegerType()),
    ("created_at", T.TimestampType()),
)

MERCHANTS = _table(
    ("merchant_id", T.LongType(), False),
    ("merchant_name", T.StringType()),
    ("country", T.StringType()),
    ("rating", T.StringType()),
    ("merchant_category", T.StringType()),
)

TRANSACTIONS = _table(
    ("transaction_id", T.StringType(), False),
    ("transaction_amount_local", MONEY),
    ("transaction_amount_usd", MONEY),
    ("transaction_timestamp", T.TimestampType()),
    ("transaction_status", T.StringType()),
    ("transaction_currency", T.StringType()),
    ("transaction_country", T.StringType()),
    ("transaction_channel", T.StringType()),
    ("user_id", T.LongType(), False),
    ("merchant_id", T.LongType(), False),
    ("payment_id", T.LongType(), False),
    ("device_id", T.LongType(), False),
    ("is_fraudulent", T.IntegerType()),
    ("fraud_type", T.StringType()),
)

FRAUD_ALERTS = _table(
    ("alert_id", T.LongType(), False),
    ("transaction_id", T.StringType(), False),
    ("user_id", T.LongType(), False),
    ("fraud_probability", T.DoubleType()),
    ("model_name", T.StringType()),
    ("alerted_at", T.TimestampType()),
)

TABLES = {
    "users": USERS,
    "user_devices": USER_DEVICES,
    "payment_methods": PAYMENT_METHODS,
    "merchants": MERCHANTS,
    "transactions": TRANSACTIONS,
    "fraud_alerts": FRAUD_ALERTS,
}

PRIMARY_KEYS = {
    "users": "user_id",
    "user_devices": "device_id",
    "payment_methods": "payment_method_id",
    "merchants": "merchant_id",
    "transactions": "transaction_id",
    "fraud_alerts": "alert_id",
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = (
    ("transactions", "user_id", "users", "user_id"),
    ("transactions", "merchant_id", "merchants", "merchant_id"),
    ("transactions", "payment_id", "payment_methods", "payment_method_id"),
    ("transactions", "device_id", "user_devices", "device_id"),
    ("payment_methods", "user_id", "users", "user_id"),
    ("user_devices", "user_id", "users", "user_id"),
    ("fraud_alerts", "transaction_id", "transactions", "transaction_id"),
)

# Topic payload: times travel as ISO strings, money as exact decimals.
TRANSACTION_MESSAGE = _table(
    ("transaction_id", T.StringType()),
    ("user_id", T.LongType()),
    ("device_id", T.LongType()),
    ("merchant_id", T.LongType()),
    ("payment_id", T.LongType()),
    ("transaction_amount_usd", MONEY),
    ("transaction_amount_local", MONEY),
    ("transaction_currency", T.StringType()),
    ("transaction_country", T.StringType()),
    ("transaction_channel", T.StringType()),
    ("transaction_status", T.StringType()),
    ("transaction_timestamp", T.StringType()),
    ("is_fraudulent", T.IntegerType()),
    ("fraud_type", T.StringType()),
    ("payment_created_at", T.StringType()),
)

# --- Fixed values: these must equal the values stored in the data -----------------------------
APPROVED = "Approved"
DECLINED = "Declined"
ONLINE = "Online"
LOCAL = "Local"

MERCHANT_CATEGORIES = (
    "Groceries",
    "Electronics",
    "Restaurants",
    "Travel",
    "Clothing",
    "Gift Cards",
    "Healthcare",
    "Other",
)

COUNTRY_CURRENCY = {
    "US": "USD",
    "CN": "CNY",
    "IN": "INR",
    "CA": "CAD",
    "JP": "JPY",
    "DE": "EUR",
    "GB": "GBP",
    "FR": "EUR",
}

# Spending band -> smallest amount in the band
SPENDING_BANDS = {
    "Mini Level Spending": "0.50",
    "Low Level Spending": "11",
    "Mid Level Spending": "101",
    "High Level Spending": "10001",
}

RENOWNED = "Renowned"
CARD_METHODS = ("credit_card", "debit_card")
BOTTING = "Botting"

# Identifiers and label-leaking columns that never become model inputs
NON_FEATURE_COLUMNS = (
    "transaction_id",
    "transaction_timestamp",
    "transaction_amount_local",
    "transaction_currency",
    "transaction_country",
    "user_id",
    "device_id",
    "merchant_id",
    "payment_id",
    "fraud_type",
)

TEST_FRACTION = 0.2
SEED = 23
ALERT_THRESHOLD = 0.5
# ----------------------------------------------------------------------------------------------

MINUTE = 60
HOUR = 3600
DAY = 86400

# The longest look-back of any feature (category novelty); bounds every history read.
LONGEST_LOOKBACK = 30 * DAY

LABEL = "is_fraudulent"
