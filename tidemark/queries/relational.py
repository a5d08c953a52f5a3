"""Scalars, filters, joins, aggregates, checks and updates, one query per operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import encode as E
from tidemark.functions import scalars as X
from tidemark.operators import access as A
from tidemark.operators import quality as Q
from tidemark.operators import updates as U
from tidemark.plans import dataset as D
from tidemark.plans import features as P
from tidemark.queries.features import ENRICHED, SQL
from tidemark.queries.registry import query
from tidemark.session import shared_folder
from tidemark.sources import manifests
from tidemark.sources import messages as M

ID = "transaction_id"
AS_OF = "2024-01-20 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def enriched(fx):
    return P.with_merchant_category(fx.transactions(), fx.merchants())


def big_spenders(fx):
    """A set of touched users, as a micro-batch would name them."""
    large = fx.transactions().filter(F.col("transaction_amount_usd") > 200)
    return large.select("user_id").distinct()


BIG_SPENDERS = "(select distinct user_id from tx where usd > 200)"


def local_amounts(fx):
    return A.with_rate(fx.transactions(), fx.fx_rates()).withColumn(
        "transaction_amount_local", X.local_amount(F.col("rate"), F.col("transaction_amount_usd"))
    )


def usd(scale: int = 1):
    return (F.col("transaction_amount_usd") * scale).cast("double").alias("usd")


# ------------------------------------------------------------------------------------ scalars


@query("s04_read_table", "select transaction_id, cast(usd as double) as usd from tx", "tx")
def _(fx):
    return fx.transactions().select(ID, usd())


@query("p01_epoch_seconds", "select transaction_id, t from tx", "tx")
def _(fx):
    return fx.transactions().select(ID, X.epoch_seconds("transaction_timestamp").alias("t"))


def broken_messages(fx):
    """Messages of all transactions, those of declined ones cut off in the middle."""
    messages = M.to_messages(local_amounts(fx), fx.payment_methods())
    cut = F.col("value").contains(f'"transaction_status":"{S.DECLINED}"')
    return messages.withColumn(
        "value", F.when(cut, F.substring("value", 1, 60)).otherwise(F.col("value"))
    )


@query(
    "p02_parse_messages",
    """select cast(transaction_id as varchar) as transaction_id, user_id, payment_id,
              cast(usd as double) as usd, channel as transaction_channel, t, created
       from tx join (select payment_method_id, created from pm) pm
            on tx.payment_id = pm.payment_method_id where status = 'Approved'""",
    "tx pm",
)
def _(fx):
    return M.valid(M.parse(broken_messages(fx))).select(
        ID,
        "user_id",
        "payment_id",
        usd(),
        "transaction_channel",
        X.epoch_seconds("transaction_timestamp").alias("t"),
        X.epoch_seconds("payment_created_at").alias("created"),
    )


@query(
    "p02_quarantine",
    "select 'malformed' as problems, count(*) as messages from tx where status = 'Declined'",
    "tx",
)
def _(fx):
    bad = M.rejected(M.parse(broken_messages(fx)))
    return bad.groupBy("problems").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "p03_guarded_ratio",
    "select transaction_id, cast(usd as double) / nullif(cast(merchant_id as double), 0) as ratio"
    " from tx",
    "tx",
)
def _(fx):
    return fx.transactions().select(
        ID, X.guarded_ratio(F.col("transaction_amount_usd"), F.col("merchant_id")).alias("ratio")
    )


@query(
    "p04_decline_rate",
    """select device_id, cast(count(*) filter (status = 'Declined') as double) / count(*)
       as decline_rate from tx group by device_id""",
    "tx",
)
def _(fx):
    declined = F.count_if(F.col("transaction_status") == S.DECLINED)
    return (
        fx.transactions()
        .groupBy("device_id")
        .agg((declined / F.count(F.lit(1))).alias("decline_rate"))
    )


def aged(fx):
    rows = P.with_payment_created(fx.transactions(), fx.payment_methods())
    return rows.withColumn(
        "age", X.age_days(X.epoch_seconds("transaction_timestamp"), F.col(P.PAYMENT_TIME))
    )


AGES = """tx join (select payment_method_id, payment_method, provider, active, created from pm) pm
  on tx.payment_id = pm.payment_method_id"""


@query("p05_age_days", f"select transaction_id, (t - created) / 86400.0::double as age from {AGES}", "tx pm")
def _(fx):
    return aged(fx).select(ID, "age")


@query(
    "p06_threshold_flag",
    f"select transaction_id, case when (t - created) < 86400 then 1 else 0 end as is_new from {AGES}",
    "tx pm",
)
def _(fx):
    return aged(fx).select(ID, X.below_flag(F.col("age"), 1).alias("is_new"))


@query(
    "p07_array_membership",
    """select transaction_id,
              case when category in ('Groceries', 'Travel') then 0 else 1 end as unseen from txm""",
    "txm",
)
def _(fx):
    seen = F.array(F.lit("Groceries"), F.lit("Travel"))
    return enriched(fx).select(ID, X.unseen_flag(seen, F.col("merchant_category")).alias("unseen"))


@query(
    "p08_one_hot_fixed",
    "select transaction_id, "
    + ", ".join(
        f"case when category = '{c}' then 1 else 0 end as \"merchant_category_{c}\""
        for c in S.MERCHANT_CATEGORIES
    )
    + " from txm",
    "txm",
)
def _(fx):
    rows = enriched(fx).select(ID, "merchant_category")
    return E.one_hot(rows, "merchant_category", S.MERCHANT_CATEGORIES)


@query(
    "p09_one_hot_found",
    "select transaction_id, "
    + ", ".join(
        f'case when country = \'{c}\' then 1 else 0 end as "transaction_country_{c}"'
        for c in sorted(S.COUNTRY_CURRENCY)
    )
    + " from tx",
    "tx",
)
def _(fx):
    rows = fx.transactions().select(ID, "transaction_country")
    return E.one_hot_found(rows, "transaction_country")


@query(
    "p10_binary_encode",
    """select transaction_id, case channel when 'Online' then 1 when 'Local' then 0 end
       as transaction_channel from tx""",
    "tx",
)
def _(fx):
    code = E.binary(F.col("transaction_channel"), {S.ONLINE: 1, S.LOCAL: 0})
    return fx.transactions().select(ID, code.alias("transaction_channel"))


@query(
    "p11_online_flag",
    "select transaction_id, case when channel = 'Online' then 1 else 0 end as online from tx",
    "tx",
)
def _(fx):
    return fx.transactions().select(
        ID, E.is_value(F.col("transaction_channel"), S.ONLINE).alias("online")
    )


@query(
    "p12_fill_nulls",
    f"""select transaction_id,
          coalesce(cast({SQL["seconds_since_last_transaction"]} as double), 1e9)
            as seconds_since_last_transaction from {ENRICHED}""",
    "txm pm",
)
def _(fx):
    rows = P.behavioral_features(fx.transactions(), fx.merchants())
    name = "seconds_since_last_transaction"
    return E.fill(rows.select(ID, name), {name: D.FILLS[name]})


@query(
    "p13_drop_columns",
    """select cast(usd as double) as transaction_amount_usd, status as transaction_status,
              channel as transaction_channel, is_fraudulent from tx""",
    "tx",
)
def _(fx):
    kept = D.without_identifiers(fx.transactions())
    return kept.withColumn("transaction_amount_usd", F.col("transaction_amount_usd").cast("double"))


@query(
    "p14_include_status",
    """select transaction_id, case status when 'Approved' then 1 when 'Declined' then 0 end
       as transaction_status from tx""",
    "tx",
)
def _(fx):
    code = E.binary(F.col("transaction_status"), {S.APPROVED: 1, S.DECLINED: 0})
    return fx.transactions().select(ID, code.alias("transaction_status"))


@query(
    "p15_conform_message",
    """select user_id, device_id, cast(usd as double) as transaction_amount_usd,
              status as transaction_status, payment_id, epoch_us(transaction_timestamp) as micros,
              country as transaction_country, merchant_id, channel as transaction_channel,
              category as merchant_category from txm""",
    "txm",
)
def _(fx):
    parsed = M.valid(M.parse(M.to_messages(fx.transactions(), fx.payment_methods())))
    rows = M.conform(P.with_merchant_category(parsed, fx.merchants()))
    return rows.withColumns(
        {
            "transaction_amount_usd": F.col("transaction_amount_usd").cast("double"),
            "micros": F.unix_micros("transaction_timestamp"),
        }
    ).drop("transaction_timestamp")


@query(
    "p18_local_amount",
    """select transaction_id, cast(round(rate * usd, 2) as double) as local
       from tx join fx using (currency)""",
    "tx fx",
)
def _(fx):
    return local_amounts(fx).select(ID, F.col("transaction_amount_local").cast("double").alias("local"))


@query("p19_country_currency", "select transaction_id, currency from tx", "tx")
def _(fx):
    return fx.transactions().select(
        ID, X.country_currency(F.col("transaction_country")).alias("currency")
    )


@query(
    "p20_spending_band",
    """select transaction_id,
         case when usd * 100 >= 10001 then 'High Level Spending'
              when usd * 100 >= 101 then 'Mid Level Spending'
              when usd * 100 >= 11 then 'Low Level Spending'
              when usd * 100 >= 0.5 then 'Mini Level Spending' end as band from tx""",
    "tx",
)
def _(fx):
    cents = F.col("transaction_amount_usd") * 100
    return fx.transactions().select(ID, X.spending_band(cents).alias("band"))


@query(
    "p21_high_amount_status",
    f"""select transaction_id,
          case when usd * 100 >= 10001 then
            case when provider = 'Renowned' and payment_method in ('credit_card', 'debit_card')
                 then 'Approved' else 'Declined' end end as decision from {AGES}""",
    "tx pm",
)
def _(fx):
    rows = A.with_payment_method(fx.transactions(), fx.payment_methods())
    return rows.select(
        ID,
        X.high_amount_status(
            F.col("transaction_amount_usd") * 100,
            F.col("payment_service_provider"),
            F.col("payment_method"),
        ).alias("decision"),
    )


# ------------------------------------------------------------------------------------ filters


@query(
    "f01_rows_of_keys",
    f"select transaction_id, user_id from tx where user_id in {BIG_SPENDERS}",
    "tx",
)
def _(fx):
    return A.rows_of_keys(fx.transactions(), big_spenders(fx), "user_id").select(ID, "user_id")


@query(
    "f02_active_methods",
    f"select payment_method_id, user_id from pm where active = 1 and user_id in {BIG_SPENDERS}",
    "tx pm",
)
def _(fx):
    active = A.active_payment_methods(fx.payment_methods(), big_spenders(fx))
    return active.select("payment_method_id", "user_id")


@query(
    "f03_lookback",
    f"""select transaction_id from tx
        where transaction_timestamp >= timestamp '{AS_OF}' - interval 240 hours""",
    "tx",
)
def _(fx):
    return A.since(fx.transactions(), as_of(), 240).select(ID)


@query("f04_alert_threshold", "select transaction_id, score from scored where score >= 0.05", "scored")
def _(fx):
    return fx.scored().filter(F.col("score") >= 0.05).select(ID, "score")


@query(
    "f05_prediction",
    """select transaction_id, case when score >= 0.05 then 1 else 0 end as prediction
       from scored""",
    "scored",
)
def _(fx):
    from tidemark.plans.metrics import predictions

    return predictions(fx.scored(), 0.05).select(ID, "prediction")


@query(
    "f07_split_valid",
    """select transaction_id, 'merchant_category' as problems from txm where category is null""",
    "txm",
)
def _(fx):
    _, bad = Q.split_by_problems(enriched(fx), Q.missing_names(["merchant_category"]))
    return bad.select(ID, F.array_join("problems", ", ").alias("problems"))


@query(
    "f08_missing_fields",
    """select transaction_id,
         case when status = 'Declined' and category is null
                then 'transaction_status, merchant_category'
              when status = 'Declined' then 'transaction_status'
              else 'merchant_category' end as missing_fields
       from txm where status = 'Declined' or category is null""",
    "txm",
)
def _(fx):
    known = F.nullif(F.col("transaction_status"), F.lit(S.DECLINED))
    rows = enriched(fx).withColumn("transaction_status", known)
    required = ["transaction_status", "merchant_category", "user_id"]
    return Q.rows_with_missing(rows, required).select(ID, "missing_fields")


@query(
    "f09_not_null",
    """select 'transaction_id' as column_name, cast(0 as bigint) as null_rows
       union all select 'user_id', 0 union all select 'device_id', 0 union all select 'payment_id', 0
       union all select 'merchant_id', count(*) from txm where category is null""",
    "txm",
)
def _(fx):
    known = F.when(F.col("merchant_category").isNotNull(), F.col("merchant_id"))
    rows = enriched(fx).withColumn("merchant_id", known)
    return Q.null_report(rows, S.TRANSACTIONS)


# -------------------------------------------------------------------------------------- joins


@query("j01_merchant_left_join", "select transaction_id, category as merchant_category from txm", "txm")
def _(fx):
    return enriched(fx).select(ID, "merchant_category")


@query("j02_payment_left_join", f"select transaction_id, created from {AGES}", "tx pm")
def _(fx):
    rows = P.with_payment_created(fx.transactions(), fx.payment_methods())
    return rows.select(ID, F.col(P.PAYMENT_TIME).alias("created"))


@query(
    "j03_user_history",
    f"""select tx.transaction_id, tx.user_id, m.category as merchant_category
        from tx join m using (merchant_id)
        where tx.transaction_timestamp >= timestamp '{AS_OF}' - interval 240 hours
          and tx.user_id in {BIG_SPENDERS}""",
    "tx m",
)
def _(fx):
    rows = A.user_history(fx.transactions(), fx.merchants(), big_spenders(fx), as_of(), 240)
    return rows.select(ID, "user_id", "merchant_category")


@query(
    "j04_merchant_lookup",
    """select tx.transaction_id, m.merchant_name, m.rating, m.country as merchant_country
       from tx left join m using (merchant_id)""",
    "tx m",
)
def _(fx):
    rows = A.with_merchant(fx.transactions(), fx.merchants())
    return rows.select(ID, "merchant_name", "rating", "merchant_country")


@query(
    "j05_payment_lookup",
    f"""select transaction_id, payment_method, provider as payment_service_provider,
               active as payment_is_active from {AGES}""",
    "tx pm",
)
def _(fx):
    rows = A.with_payment_method(fx.transactions(), fx.payment_methods())
    return rows.select(ID, "payment_method", "payment_service_provider", "payment_is_active")


@query(
    "j06_fx_lookup",
    "select transaction_id, cast(rate as double) as rate from tx left join fx using (currency)",
    "tx fx",
)
def _(fx):
    rows = A.with_rate(fx.transactions(), fx.fx_rates())
    return rows.select(ID, F.col("rate").cast("double").alias("rate"))


@query(
    "j07_device_history",
    f"""select transaction_id, device_id from tx
        where transaction_timestamp >= timestamp '{AS_OF}' - interval 48 hours
          and device_id in (select device_id from tx where usd > 200)""",
    "tx",
)
def _(fx):
    large = fx.transactions().filter(F.col("transaction_amount_usd") > 200)
    devices = large.select("device_id").distinct()
    return A.device_history(fx.transactions(), devices, as_of(), 48).select(ID, "device_id")


def _orphans(child: str, column: str, source: str, fk: str, parent: str) -> str:
    return f"""select '{child}.{column}' as reference,
      cast(coalesce(sum(n), 0) as bigint) as orphan_rows, count(*) as orphan_values from
      (select {fk} as v, count(*) as n from {source} where {fk} not in (select {parent}) group by 1)"""


@query(
    "j08_orphan_report",
    " union all ".join(
        (
            _orphans("transactions", "user_id", "tx", "user_id", "user_id from usr"),
            _orphans("transactions", "merchant_id", "tx", "merchant_id", "merchant_id from m"),
            _orphans(
                "transactions", "payment_id", "tx", "payment_id", "payment_method_id from pm"
            ),
            _orphans("transactions", "device_id", "tx", "device_id", "device_id from dev"),
            _orphans("payment_methods", "user_id", "pm", "user_id", "user_id from usr"),
            _orphans("user_devices", "user_id", "dev", "user_id", "user_id from usr"),
        )
    ),
    "tx m pm usr dev",
)
def _(fx):
    return Q.orphan_report(
        {
            "transactions": fx.transactions(),
            "merchants": fx.merchants(),
            "payment_methods": fx.payment_methods(),
            "users": fx.users(),
            "user_devices": fx.user_devices(),
        }
    )


@query(
    "j09_duplicate_keys",
    "select transaction_id, cast(2 as bigint) as copies from tx where status = 'Declined'",
    "tx",
)
def _(fx):
    rows = fx.transactions()
    again = rows.filter(F.col("transaction_status") == S.DECLINED)
    return Q.duplicate_keys(rows.unionByName(again), ID)


# ------------------------------------------------------------------------------ sorts and picks


@query(
    "k01_earliest_active_method",
    """select user_id, payment_method_id, payment_method from
       (select *, row_number() over (partition by user_id order by created_at, payment_method_id) r
        from pm where active = 1) where r = 1""",
    "tx pm",
)
def _(fx):
    first = A.earliest_active_payment_method(fx.payment_methods())
    return first.select("user_id", "payment_method_id", "payment_method")


@query("k02_random_rows")
def _(fx):
    return A.random_rows(fx.users(), 5)


@query(
    "k03_random_row_per_key",
    """select user_id, payment_method_id from
       (select *, row_number() over (partition by user_id
          order by md5(concat(cast(payment_method_id as varchar), ':23')), payment_method_id) r
        from pm) where r = 1""",
    "tx pm",
)
def _(fx):
    drawn = A.random_row_per_key(fx.payment_methods(), "user_id", "payment_method_id")
    return drawn.select("user_id", "payment_method_id")


@query("k04_time_ordered", "select transaction_id, t from tx order by t, transaction_id", "tx")
def _(fx):
    ordered = A.time_ordered(fx.transactions())
    return ordered.select(ID, X.epoch_seconds("transaction_timestamp").alias("t"))


@query(
    "k05_rows_to_score",
    f"""select transaction_id, {SQL["user_transaction_count_1h"]} as user_transaction_count_1h
        from tx qualify transaction_timestamp >= timestamp '{AS_OF}'""",
    "tx",
)
def _(fx):
    """Features see the history, the outcome holds the incoming rows only."""
    incoming = fx.transactions().filter(F.col("transaction_timestamp") >= as_of())
    computed = P.velocity_features(fx.transactions())
    return A.rows_of_keys(computed, incoming, ID).select(ID, "user_transaction_count_1h")


@query("k09_merchant_ids", "select merchant_id from m", "m")
def _(fx):
    return A.merchant_ids(fx.merchants())


# -------------------------------------------------------------------------- sets and updates


def _older(fx):
    return fx.transactions().filter(F.col("transaction_timestamp") < as_of())


def _newer(fx):
    start = as_of() - F.expr("INTERVAL 24 HOURS")
    return fx.transactions().filter(F.col("transaction_timestamp") >= start)


@query(
    "u01_add_incoming",
    f"""select transaction_id from tx where transaction_timestamp < timestamp '{AS_OF}'
        union all select transaction_id from tx
        where transaction_timestamp >= timestamp '{AS_OF}' - interval 24 hours""",
    "tx",
)
def _(fx):
    return _older(fx).unionByName(_newer(fx)).select(ID)


@query("u02_history_with_incoming", "select transaction_id, cast(usd as double) as usd from tx", "tx")
def _(fx):
    return A.with_incoming(_older(fx), _newer(fx)).select(ID, usd())


@query(
    "u03_distinct_categories",
    "select distinct merchant_id, category as merchant_category from txm",
    "txm",
)
def _(fx):
    return A.merchant_categories(enriched(fx))


TO_DEACTIVATE = """(select payment_id from tx
  where status = 'Declined' and fraud_type <> 'Botting')"""


@query(
    "m01_deactivate",
    f"""select payment_method_id, user_id,
          case when payment_method_id in {TO_DEACTIVATE} then 0 else active end
            as payment_is_active from pm""",
    "tx pm",
)
def _(fx):
    after = U.deactivate(fx.payment_methods(), U.methods_to_deactivate(fx.transactions()))
    return after.select("payment_method_id", "user_id", "payment_is_active")


@query(
    "m01_deactivated_in_place",
    f"""select payment_method_id, user_id,
          case when payment_method_id in {TO_DEACTIVATE} then 0 else active end
            as payment_is_active from pm""",
    "tx pm",
)
def _(fx):
    """A table kept as a list of files, of which only those with a method to deactivate are replaced."""
    table = f"{shared_folder(fx.spark, 'methods')}/payment_methods"
    manifests.create_table(fx.payment_methods().repartitionByRange(8, "payment_method_id"), table)
    U.deactivate_in_place(fx.spark, table, U.methods_to_deactivate(fx.transactions()))
    after = manifests.read_table(fx.spark, table)
    return after.select("payment_method_id", "user_id", "payment_is_active")


@query(
    "m01_deactivated_rows",
    f"select payment_method_id from pm where payment_method_id in {TO_DEACTIVATE}",
    "tx pm",
)
def _(fx):
    methods = U.methods_to_deactivate(fx.transactions())
    return U.deactivated_rows(fx.payment_methods(), methods).select("payment_method_id")


@query(
    "m02_methods_to_deactivate",
    f"select distinct payment_id as payment_method_id from tx where payment_id in {TO_DEACTIVATE}",
    "tx",
)
def _(fx):
    return U.methods_to_deactivate(fx.transactions())


@query(
    "s07_messages",
    """select cast(user_id as varchar) as key,
         cast(transaction_id as varchar) as transaction_id, cast(usd as double) as usd,
         cast(round(rate * usd, 2) as double) as local, status,
         strftime(tx.transaction_timestamp, '%Y-%m-%d %H:%M:%S.%f') as at,
         strftime(pm.created_at, '%Y-%m-%d %H:%M:%S.%f') as created
       from tx join (select payment_method_id, created_at from pm) pm
            on tx.payment_id = pm.payment_method_id join fx using (currency)""",
    "tx pm fx",
)
def _(fx):
    messages = M.to_messages(local_amounts(fx), fx.payment_methods())
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return messages.select(
        "key",
        field("transaction_id").alias("transaction_id"),
        field("transaction_amount_usd").cast("double").alias("usd"),
        field("transaction_amount_local").cast("double").alias("local"),
        field("transaction_status").alias("status"),
        field("transaction_timestamp").alias("at"),
        field("payment_created_at").alias("created"),
    )


@query(
    "s11_append_with_keys",
    """select (select max(payment_method_id) from pm)
           + row_number() over (order by t, transaction_id) as payment_method_id,
         transaction_id, user_id from tx""",
    "tx pm",
)
def _(fx):
    new = fx.transactions().select(
        ID, "user_id", X.epoch_seconds("transaction_timestamp").alias("t")
    )
    keyed = U.append_with_keys(fx.payment_methods(), new, "payment_method_id", ["t", ID])
    return keyed.select("payment_method_id", ID, "user_id")


@query(
    "s12_generated_ids",
    "select count(*) as rows, count(*) as different_ids, true as stable from tx",
    "tx",
)
def _(fx):
    """Random ids for a batch differ; ids from a topic position come out the same again."""
    position = fx.transactions().select(
        F.lit("transactions").alias("topic"), F.lit(0).alias("partition"), F.col(ID).alias("offset")
    )
    ids = position.select(
        F.uuid().alias("random"), M.position_id().alias("first"), M.position_id().alias("again")
    )
    return ids.agg(
        F.count(F.lit(1)).alias("rows"),
        F.least(F.count_distinct("random"), F.count_distinct("first")).alias("different_ids"),
        F.every(F.col("first") == F.col("again")).alias("stable"),
    )


@query(
    "k02_random_pick_is_a_row",
    "select cast(5 as bigint) as picked, cast(5 as bigint) as known from usr limit 1",
    "usr",
)
def _(fx):
    """Random rows of the whole table are that many different rows of it."""
    picked = A.random_rows(fx.users().select("user_id"), 5).distinct()
    known = picked.join(fx.users().select("user_id", F.lit(1).alias("known")), "user_id", "left")
    return known.agg(F.count("user_id").alias("picked"), F.count("known").alias("known"))
