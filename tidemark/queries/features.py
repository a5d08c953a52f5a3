"""Window features, one query per column, and the complete feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import features as P
from tidemark.queries.registry import query

# Frames of the comparison SQL
_U = "over (partition by user_id order by t range between {} preceding and current row)"
_D = "over (partition by device_id order by t range between {} preceding and current row)"

COUNT_1H = f"count(*) {_U.format(3600)}"
DECLINES_1H = f"sum(case when status = 'Declined' then 1 else 0 end) {_U.format(3600)}"


def _mean(seconds: int) -> str:
    frame = _U.format(seconds)
    return f"(cast(sum(usd) {frame} as double) / count(usd) {frame})"


def _ratio(seconds: int) -> str:
    return f"cast(usd as double) / nullif({_mean(seconds)}, 0)"


AGE = "(t - created) / 86400.0::double"
SEEN = (
    "max(t) over (partition by user_id, category order by t"
    " range between 2592000 preceding and 1 preceding)"
)
NEW_CATEGORY = f"case when category is not null and {SEEN} is not null then 0 else 1 end"

VELOCITY = {
    "user_transaction_count_1h": COUNT_1H,
    "user_decline_count_1h": f"cast({DECLINES_1H} as bigint)",
    "user_decline_rate_1h": f"cast({DECLINES_1H} as double) / {COUNT_1H}",
    "user_unique_payment_methods_1h": f"count(distinct payment_id) {_U.format(3600)}",
    "user_transaction_count_5min": f"count(*) {_U.format(300)}",
    "device_transaction_count_5min": f"count(*) {_D.format(300)}",
}
AMOUNT = {
    "user_avg_amount_24h": f"{_mean(86400)}",
    "user_stddev_amount_24h": f"round(stddev_samp(cast(usd as double)) {_U.format(86400)}, 4)",
    "user_amount_ratio_24h": f"{_ratio(86400)}",
    "user_avg_amount_7d": f"{_mean(604800)}",
    "user_amount_ratio_7d": f"{_ratio(604800)}",
}
BEHAVIOR = {
    "seconds_since_last_transaction": (
        "t - lag(t) over (partition by user_id order by t, transaction_id)"
    ),
    "user_unique_merchants_24h": f"count(distinct merchant_id) {_U.format(86400)}",
    "user_unique_countries_24h": f"count(distinct country) {_U.format(86400)}",
    "user_unique_merchant_categories_24h": f"count(distinct category) {_U.format(86400)}",
    "is_new_merchant_category": f"cast({NEW_CATEGORY} as integer)",
}
DEVICE = {
    "device_unique_users_24h": f"count(distinct user_id) {_D.format(86400)}",
    "device_unique_payment_methods_24h": f"count(distinct payment_id) {_D.format(86400)}",
    "payment_method_age_days": f"{AGE}",
    "is_new_payment_method": f"cast(case when {AGE} < 1 then 1 else 0 end as integer)",
}
SQL = {**VELOCITY, **AMOUNT, **BEHAVIOR, **DEVICE}

# Digits kept where the two engines may differ in the last binary place
ROUNDED = {"user_stddev_amount_24h": 4}

ENRICHED = (
    "(select txm.*, pm.created from txm left join pm on txm.payment_id = pm.payment_method_id)"
)


def feature_column(name: str):
    return F.round(name, ROUNDED[name]).alias(name) if name in ROUNDED else F.col(name)


def _sql(columns: dict[str, str]) -> str:
    body = ",\n".join(f"{expr} as {name}" for name, expr in columns.items())
    return f"select transaction_id,\n{body}\nfrom {ENRICHED}"


def _compute(fx, group: P.FeatureGroup):
    return {
        P.VELOCITY: lambda: P.velocity_features(fx.transactions()),
        P.AMOUNT: lambda: P.amount_features(fx.transactions()),
        P.BEHAVIOR: lambda: P.behavioral_features(fx.transactions(), fx.merchants()),
        P.DEVICE: lambda: P.device_features(fx.transactions(), fx.payment_methods()),
    }[group]()


def _register_column(key: str, name: str, group: P.FeatureGroup) -> None:
    @query(key, _sql({name: SQL[name]}), "txm pm")
    def _(fx):
        return _compute(fx, group).select("transaction_id", feature_column(name))


for _key, _name, _group in (
    ("w01_user_tx_count_1h", "user_transaction_count_1h", P.VELOCITY),
    ("w02_user_decline_count_1h", "user_decline_count_1h", P.VELOCITY),
    ("w03_user_decline_rate_1h", "user_decline_rate_1h", P.VELOCITY),
    ("w04_user_unique_payments_1h", "user_unique_payment_methods_1h", P.VELOCITY),
    ("w05_user_tx_count_5min", "user_transaction_count_5min", P.VELOCITY),
    ("w06_device_tx_count_5min", "device_transaction_count_5min", P.VELOCITY),
    ("w07_user_avg_amount_24h", "user_avg_amount_24h", P.AMOUNT),
    ("w08_user_stddev_amount_24h", "user_stddev_amount_24h", P.AMOUNT),
    ("w09_user_amount_ratio_24h", "user_amount_ratio_24h", P.AMOUNT),
    ("w10_user_avg_amount_7d", "user_avg_amount_7d", P.AMOUNT),
    ("w11_user_amount_ratio_7d", "user_amount_ratio_7d", P.AMOUNT),
    ("w12_seconds_since_last", "seconds_since_last_transaction", P.BEHAVIOR),
    ("w13_user_unique_merchants_24h", "user_unique_merchants_24h", P.BEHAVIOR),
    ("w14_user_unique_countries_24h", "user_unique_countries_24h", P.BEHAVIOR),
    ("w15_user_unique_categories_24h", "user_unique_merchant_categories_24h", P.BEHAVIOR),
    ("w17_is_new_category", "is_new_merchant_category", P.BEHAVIOR),
    ("w18_device_unique_users_24h", "device_unique_users_24h", P.DEVICE),
    ("w19_device_unique_payments_24h", "device_unique_payment_methods_24h", P.DEVICE),
    ("w20_payment_age_days", "payment_method_age_days", P.DEVICE),
    ("w21_is_new_payment", "is_new_payment_method", P.DEVICE),
):
    _register_column(_key, _name, _group)


@query(
    "w16_category_seen_30d",
    f"""select transaction_id, case when category is not null and {SEEN} is not null
        then 1 else 0 end as category_seen from txm""",
    "txm",
)
def _(fx):
    """Whether the category occurred in the 30 days before the second of the transaction."""
    rows = P.behavioral_features(fx.transactions(), fx.merchants())
    return rows.select(
        "transaction_id", (1 - F.col("is_new_merchant_category")).alias("category_seen")
    )


def _register_group(key: str, columns: dict[str, str], group: P.FeatureGroup) -> None:
    @query(key, _sql(columns), "txm pm")
    def _(fx):
        return _compute(fx, group).select(
            "transaction_id", *[feature_column(n) for n in group.outputs]
        )


for _key, _columns, _group in (
    ("features_velocity", VELOCITY, P.VELOCITY),
    ("features_amount", AMOUNT, P.AMOUNT),
    ("features_behavioral", BEHAVIOR, P.BEHAVIOR),
    ("features_device", DEVICE, P.DEVICE),
):
    _register_group(_key, _columns, _group)


ALL_SQL = (
    "select transaction_id, cast(is_fraudulent as integer) as is_fraudulent,"
    " category as merchant_category,\n"
    + ",\n".join(f"{expr} as {name}" for name, expr in SQL.items())
    + f"\nfrom {ENRICHED}"
)


def all_feature_columns(df):
    return df.select(
        "transaction_id",
        "is_fraudulent",
        "merchant_category",
        *[feature_column(n) for n in P.FEATURES],
    )


@query("features_batch", ALL_SQL, "txm pm")
def features_batch(fx):
    return all_feature_columns(
        P.all_features(fx.transactions(), fx.merchants(), fx.payment_methods())
    )


@query("features_batch_sliced", ALL_SQL, "txm pm")
def features_batch_sliced(fx):
    """The same table with every key treated as a heavy one."""
    return all_feature_columns(
        P.all_features(fx.transactions(), fx.merchants(), fx.payment_methods(), heavy_rows=0)
    )


DISTINCTS = [n for n in P.FEATURES if "_unique_" in n]


@query(
    "d01_approximate_distincts",
    "select transaction_id, "
    + ", ".join(f"{SQL[n]} as {n}, true as {n}_is_near" for n in DISTINCTS)
    + f" from {ENRICHED}",
    "txm pm",
)
def approximate_distincts(fx):
    """The exact distinct counts, and whether the estimates are near them: within four standard errors,
    or off by two."""
    tables = (fx.transactions(), fx.merchants(), fx.payment_methods())
    exact = P.all_features(*tables).select("transaction_id", *DISTINCTS)
    rough = P.all_features(*tables, approx=True)
    rough = rough.select("transaction_id", *[F.col(n).alias(f"{n}_rough") for n in DISTINCTS])
    columns = []
    for n in DISTINCTS:
        off = F.abs(F.col(n) - F.col(f"{n}_rough"))
        columns += [n, (off <= F.greatest(F.lit(2.0), F.col(n) * 0.092)).alias(f"{n}_is_near")]
    return exact.join(rough, "transaction_id").select("transaction_id", *columns)
