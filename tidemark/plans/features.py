"""Per-transaction risk features, identical in batch and in the stream.

Each feature group names its frame measures per user and per device and the columns derived from
them. Whatever groups are asked for together share one exchange per key: the lookups come first,
then everything by user, then everything by device.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import (
    age_days,
    below_flag,
    epoch_seconds,
    guarded_ratio,
    sample_stddev,
)
from tidemark.operators.sketches import FrameApproxDistinct, approximate_distincts
from tidemark.operators.skew import HEAVY_KEY_ROWS, heavy_keys
from tidemark.operators.sliding import FrameDistinct, FrameSum, Gap, Measure, Novelty, sliding
from tidemark.schemas import DAY, DECLINED, HOUR, LONGEST_LOOKBACK, MINUTE
from tidemark.session import materialize

ROW_ID = "transaction_id"
TIME = "_seconds"
PAYMENT_TIME = "_payment_seconds"


@dataclass(frozen=True)
class FeatureGroup:
    outputs: tuple[str, ...]
    by_user: tuple[Measure, ...] = ()
    by_device: tuple[Measure, ...] = ()
    derived: Callable[[], dict[str, Column]] = field(default=dict)


VELOCITY = FeatureGroup(
    outputs=(
        "user_transaction_count_1h",
        "user_decline_count_1h",
        "user_decline_rate_1h",
        "user_unique_payment_methods_1h",
        "user_transaction_count_5min",
        "device_transaction_count_5min",
    ),
    by_user=(
        FrameSum("user_transaction_count_1h", "1", HOUR),
        FrameSum(
            "user_decline_count_1h",
            f"CASE WHEN transaction_status = '{DECLINED}' THEN 1 ELSE 0 END",
            HOUR,
        ),
        FrameDistinct("user_unique_payment_methods_1h", "payment_id", HOUR),
        FrameSum("user_transaction_count_5min", "1", 5 * MINUTE),
    ),
    by_device=(FrameSum("device_transaction_count_5min", "1", 5 * MINUTE),),
    derived=lambda: {
        "user_decline_rate_1h": F.col("user_decline_count_1h")
        / F.col("user_transaction_count_1h")
    },
)


def _amount_measures() -> tuple[Measure, ...]:
    amount = "transaction_amount_usd"
    present = f"CASE WHEN {amount} IS NULL THEN 0 ELSE 1 END"
    return (
        FrameSum("_count_24h", present, DAY),
        FrameSum("_sum_24h", amount, DAY),
        FrameSum("_squares_24h", f"{amount} * {amount}", DAY),
        FrameSum("_count_7d", present, 7 * DAY),
        FrameSum("_sum_7d", amount, 7 * DAY),
    )


def _amount_columns() -> dict[str, Column]:
    amount = F.col("transaction_amount_usd")
    mean_24h = guarded_ratio(F.col("_sum_24h"), F.col("_count_24h"))
    mean_7d = guarded_ratio(F.col("_sum_7d"), F.col("_count_7d"))
    return {
        "user_avg_amount_24h": mean_24h,
        "user_stddev_amount_24h": sample_stddev(
            F.col("_count_24h"), F.col("_sum_24h"), F.col("_squares_24h")
        ),
        "user_amount_ratio_24h": guarded_ratio(amount, mean_24h),
        "user_avg_amount_7d": mean_7d,
        "user_amount_ratio_7d": guarded_ratio(amount, mean_7d),
    }


AMOUNT = FeatureGroup(
    outputs=(
        "user_avg_amount_24h",
        "user_stddev_amount_24h",
        "user_amount_ratio_24h",
        "user_avg_amount_7d",
        "user_amount_ratio_7d",
    ),
    by_user=_amount_measures(),
    derived=_amount_columns,
)

BEHAVIOR = FeatureGroup(
    outputs=(
        "seconds_since_last_transaction",
        "user_unique_merchants_24h",
        "user_unique_countries_24h",
        "user_unique_merchant_categories_24h",
        "is_new_merchant_category",
    ),
    by_user=(
        Gap("seconds_since_last_transaction"),
        FrameDistinct("user_unique_merchants_24h", "merchant_id", DAY),
        FrameDistinct("user_unique_countries_24h", "transaction_country", DAY),
        FrameDistinct("user_unique_merchant_categories_24h", "merchant_category", DAY),
        Novelty("is_new_merchant_category", "merchant_category", LONGEST_LOOKBACK),
    ),
)

DEVICE = FeatureGroup(
    outputs=(
        "device_unique_users_24h",
        "device_unique_payment_methods_24h",
        "payment_method_age_days",
        "is_new_payment_method",
    ),
    by_device=(
        FrameDistinct("device_unique_users_24h", "user_id", DAY),
        FrameDistinct("device_unique_payment_methods_24h", "payment_id", DAY),
    ),
    derived=lambda: {
        "payment_method_age_days": age_days(F.col(TIME), F.col(PAYMENT_TIME)),
        "is_new_payment_method": below_flag(age_days(F.col(TIME), F.col(PAYMENT_TIME)), 1),
    },
)

ALL_GROUPS = (VELOCITY, AMOUNT, BEHAVIOR, DEVICE)
FEATURES = tuple(name for group in ALL_GROUPS for name in group.outputs)


def with_merchant_category(df: DataFrame, merchants: DataFrame) -> DataFrame:
    """Left lookup of the merchant's category, unless the rows carry it already.

    No hint: Spark broadcasts the merchants only if their size is known to be small, and otherwise
    sorts and merges, splitting a merchant that holds too many rows.
    """
    if "merchant_category" in df.columns:
        return df
    return df.join(merchants.select("merchant_id", "merchant_category"), "merchant_id", "left")


def with_payment_created(df: DataFrame, payment_methods: DataFrame) -> DataFrame:
    """Left lookup of the payment method's creation time, in epoch seconds."""
    created = payment_methods.select(
        F.col("payment_method_id").alias("payment_id"),
        epoch_seconds("created_at").alias(PAYMENT_TIME),
    )
    return df.join(created, "payment_id", "left")


def _compute(
    df: DataFrame,
    groups: Sequence[FeatureGroup],
    merchants: DataFrame | None = None,
    payment_methods: DataFrame | None = None,
    heavy_rows: int = HEAVY_KEY_ROWS,
    counted: int | None = None,
    approx: bool = False,
) -> DataFrame:
    by_user = [m for g in groups for m in g.by_user]
    by_device = [m for g in groups for m in g.by_device]
    estimated: dict[str, list[FrameApproxDistinct]] = {"user_id": [], "device_id": []}
    if approx:
        for key, measures in (("user_id", by_user), ("device_id", by_device)):
            exact = [m for m in measures if isinstance(m, FrameDistinct)]
            estimated[key] = [FrameApproxDistinct(m.name, m.column, m.seconds) for m in exact]
            measures[:] = [m for m in measures if m not in exact]
    # Counted on the plain input, so that finding heavy keys reads one column only.
    keys = [k for k, measures in (("user_id", by_user), ("device_id", by_device)) if measures]
    # Where all rows together are no more than a heavy key's, none is heavy.
    if counted is not None and counted <= heavy_rows:
        heavy = dict.fromkeys(keys)
    else:
        heavy = heavy_keys(df, *keys, min_rows=heavy_rows)

    rows = df.withColumn(TIME, epoch_seconds("transaction_timestamp"))
    if merchants is not None:
        rows = with_merchant_category(rows, merchants)
    source = rows
    if payment_methods is not None:
        rows = with_payment_created(rows, payment_methods)
    kept = [c for c in rows.columns if c not in (TIME, PAYMENT_TIME)]
    if by_user:
        rows = sliding(rows, "user_id", TIME, ROW_ID, by_user, heavy, source=source)
    if by_device:
        if by_user and heavy["device_id"] is not None:
            rows = materialize(rows)  # read for the heavy and for the other devices
        rows = sliding(rows, "device_id", TIME, ROW_ID, by_device, heavy, source=source)
    for key, measures in estimated.items():
        if measures:
            rows = approximate_distincts(rows, key, TIME, measures)

    derived = {name: column for g in groups for name, column in g.derived().items()}
    outputs = [name for g in groups for name in g.outputs]
    return rows.select(
        *kept, *[derived[n].alias(n) if n in derived else F.col(n) for n in outputs]
    )


def velocity_features(
    df: DataFrame, heavy_rows: int = HEAVY_KEY_ROWS, approx: bool = False
) -> DataFrame:
    """Counts, declines and distinct payment methods over 5 minutes and 1 hour."""
    return _compute(df, [VELOCITY], heavy_rows=heavy_rows, approx=approx)


def amount_features(df: DataFrame, heavy_rows: int = HEAVY_KEY_ROWS) -> DataFrame:
    """Mean, spread and ratio of the amount over 24 hours and 7 days."""
    return _compute(df, [AMOUNT], heavy_rows=heavy_rows)


def behavioral_features(
    df: DataFrame, merchants: DataFrame, heavy_rows: int = HEAVY_KEY_ROWS, approx: bool = False
) -> DataFrame:
    """Time since the last transaction, variety over 24 hours, category novelty over 30 days."""
    return _compute(df, [BEHAVIOR], merchants=merchants, heavy_rows=heavy_rows, approx=approx)


def device_features(
    df: DataFrame, payment_methods: DataFrame, heavy_rows: int = HEAVY_KEY_ROWS, approx: bool = False
) -> DataFrame:
    """Users and payment methods per device over 24 hours, age of the payment method."""
    return _compute(
        df, [DEVICE], payment_methods=payment_methods, heavy_rows=heavy_rows, approx=approx
    )


def all_features(
    transactions: DataFrame,
    merchants: DataFrame,
    payment_methods: DataFrame,
    heavy_rows: int = HEAVY_KEY_ROWS,
    counted: int | None = None,
    approx: bool = False,
) -> DataFrame:
    """The input columns, the merchant category and all 20 features.

    ``counted`` is the number of transactions where the caller knows it, which may save counting keys.
    ``approx`` estimates the distinct counts from sketches, here as in each group.
    """
    return _compute(
        transactions, ALL_GROUPS, merchants, payment_methods, heavy_rows, counted, approx
    )
