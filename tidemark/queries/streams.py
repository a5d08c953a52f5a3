"""The stream, replayed over the whole events table in time order."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.operators import updates as U
from tidemark.operators.access import since
from tidemark.plans import features as P
from tidemark.queries.features import ENRICHED, SQL, all_feature_columns
from tidemark.queries.registry import query
from tidemark.session import shared_folder
from tidemark.sources import messages as M
from tidemark.sources.tables import append_table, read_features, write_features
from tidemark.streaming import scoring as R

# Moments between which messages arrive together
ARRIVALS = (None, "2024-01-16", None)


def replay(fx, heavy_rows=None) -> tuple[R.Stores, str]:
    """Write the messages of each period one after the other and let the stream take each."""
    spark = fx.spark
    root = shared_folder(spark, "replay")
    stores = R.Stores(*[f"{root}/{n}" for n in ("history", "alerts", "bad", "state", "features")])
    inbox = f"{root}/inbox"
    rows = fx.transactions()
    extra = {} if heavy_rows is None else {"heavy_rows": heavy_rows}
    for start, end in zip(ARRIVALS, ARRIVALS[1:]):
        part = rows
        if start:
            part = part.filter(F.col("transaction_timestamp") >= F.lit(start).cast("timestamp"))
        if end:
            part = part.filter(F.col("transaction_timestamp") < F.lit(end).cast("timestamp"))
        messages = M.to_messages(part, fx.payment_methods())
        messages.select("value").write.mode("append").text(inbox)
        stream = M.file_stream(spark, inbox, files_per_batch=10_000)
        R.start_scoring(
            stream, stores, fx.merchants(), available_now=True, **extra
        ).awaitTermination()
    return stores, root


REPLAY_SQL = (
    "select cast(transaction_id as varchar) as transaction_id,"
    " cast(is_fraudulent as integer) as is_fraudulent, category as merchant_category,\n"
    + ",\n".join(f"{expr} as {name}" for name, expr in SQL.items())
    + f"\nfrom {ENRICHED}"
)


@query("r04_stream_replay", REPLAY_SQL, "txm pm")
def stream_replay(fx):
    """Micro-batch features of all transactions, which must equal the batch job's."""
    stores, _ = replay(fx)
    return all_feature_columns(fx.spark.read.parquet(stores.features))


@query(
    "s09_history_across_runs",
    "select cast(transaction_id as varchar) as transaction_id, user_id from tx",
    "tx",
)
def _(fx):
    """Two runs that both count from batch 0 keep all their transactions."""
    root = shared_folder(fx.spark, "runs")
    even = F.col("transaction_id") % 2 == 0
    for run, part in (("a", fx.transactions().filter(even)), ("b", fx.transactions().filter(~even))):
        parsed = R.parsed_messages(M.to_messages(part, fx.payment_methods()).select("value"))
        R.append_history(M.valid(parsed), f"{root}/history", 0, run)
    return fx.spark.read.parquet(f"{root}/history").select(R.ID, "user_id")


@query(
    "s09_history_compacted",
    "select cast(transaction_id as varchar) as transaction_id, user_id from tx",
    "tx",
)
def _(fx):
    """Ten batches of a run, of which all but the latest are merged date by date; no row is lost."""
    history = f"{shared_folder(fx.spark, 'compacted')}/history"
    parsed = R.parsed_messages(M.to_messages(fx.transactions(), fx.payment_methods()).select("value"))
    rows = M.valid(parsed).persist()
    for batch_id in range(10):
        R.append_history(rows.filter(F.pmod(F.xxhash64(R.ID), F.lit(10)) == batch_id), history, batch_id)
    rows.unpersist()
    R.compact_history(fx.spark, history, date(2100, 1, 1))
    return fx.spark.read.parquet(history).select(R.ID, "user_id")


@query(
    "p17_alert_records",
    """select transaction_id, user_id, score as fraud_probability, 'gbt' as model_name,
              true as is_dated
       from scored join (select transaction_id, user_id from tx) using (transaction_id)
       where score >= 0.05""",
    "tx scored",
)
def _(fx):
    """Alert records from whole-table scores; the moment of the alert only as being there."""
    rows = fx.scored().withColumnRenamed("score", "fraud_probability")
    scored = rows.join(fx.transactions().select("transaction_id", "user_id"), "transaction_id")
    found = R.alerts(scored, "gbt", 0.05)
    return found.withColumn("is_dated", F.col("alerted_at").isNotNull()).drop("alerted_at")


@query(
    "r03_touched_history",
    """+recent as (select * from tx
         where transaction_timestamp >= timestamp '2024-01-20' - interval 240 hours),
       touched as (select user_id, device_id from tx where usd > 250)
       select transaction_id, user_id, device_id from recent
       where user_id in (select user_id from touched)
          or device_id in (select device_id from touched)""",
    "tx",
)
def _(fx):
    incoming = fx.transactions().filter(F.col("transaction_amount_usd") > 250)
    recent = since(fx.transactions(), F.lit("2024-01-20").cast("timestamp"), 240)
    return R.touched_history(recent, incoming).select("transaction_id", "user_id", "device_id")


ALL_IDS = "select cast(transaction_id as varchar) as transaction_id, user_id from tx"


@query("f06_empty_batch", ALL_IDS, "tx")
def _(fx):
    """An empty batch before and after the whole table changes nothing in the stores."""
    root = shared_folder(fx.spark, "empty")
    stores = R.Stores(*[f"{root}/{n}" for n in ("history", "alerts", "bad", "state")])
    parsed = R.parsed_messages(M.to_messages(fx.transactions(), fx.payment_methods()).select("value"))
    empty = parsed.limit(0)
    for batch_id, batch in enumerate((empty, parsed, empty)):
        R.process_batch(batch, batch_id, stores, fx.merchants())
    return fx.spark.read.parquet(stores.history).select(R.ID, "user_id")


@query("r08_watermark", ALL_IDS, "tx")
def _(fx):
    """Every message twice in one stream; each transaction comes out once."""
    root = shared_folder(fx.spark, "watermark")
    values = M.to_messages(fx.transactions(), fx.payment_methods()).select("value")
    values.union(values).write.text(f"{root}/inbox")
    stream = M.file_stream(fx.spark, f"{root}/inbox", files_per_batch=10_000)
    once = R.without_repeats(R.parsed_messages(stream), "31 days").select(R.ID, "user_id")
    writer = once.writeStream.option("checkpointLocation", f"{root}/state")
    writer.trigger(availableNow=True).start(f"{root}/out", format="parquet").awaitTermination()
    return fx.spark.read.parquet(f"{root}/out")


@query(
    "s03_feature_table",
    f"""select transaction_id, {SQL["user_transaction_count_1h"]} as user_transaction_count_1h
        from {ENRICHED} qualify transaction_timestamp >= timestamp '2024-01-20'""",
    "txm pm",
)
def _(fx):
    """The written feature table, read from a date on; the folders of other dates are skipped."""
    path = f"{shared_folder(fx.spark, 'features')}/features"
    write_features(P.velocity_features(fx.transactions()), path)
    recent = read_features(fx.spark, path).filter(F.col("event_date") >= "2024-01-20")
    return recent.select(R.ID, "user_transaction_count_1h")


@query(
    "s11_appended_table",
    """select payment_method_id, user_id from pm union all
       select (select max(payment_method_id) from pm)
           + row_number() over (order by transaction_id) as payment_method_id, user_id from tx""",
    "tx pm",
)
def _(fx):
    """A table to which one new row per transaction has been appended, keys going on gapless."""
    path = f"{shared_folder(fx.spark, 'methods')}/payment_methods"
    append_table(fx.payment_methods().select("payment_method_id", "user_id"), path)
    stored = fx.spark.read.parquet(path)
    new = fx.transactions().select(R.ID, "user_id")
    keyed = U.append_with_keys(stored, new, "payment_method_id", [R.ID])
    append_table(keyed.select("payment_method_id", "user_id"), path)
    return fx.spark.read.parquet(path)
