"""Scoring a stream of transaction messages with the batch job's feature functions.

Each micro-batch stays a DataFrame from parsing to alerts. The history of past transactions is a
parquet table laid out by event date, run and batch; a batch rewrites its own partitions, so running
it again after a failure changes nothing. The run is kept with the checkpoint: a query that starts from
a new checkpoint counts its batches from 0 again, in folders of its own. Features of a new transaction
need its user's last 30 days and its device's last day only, so only those are kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.operators.access import HISTORY_COLUMNS
from tidemark.operators.skew import HEAVY_KEY_ROWS
from tidemark.operators.ordering import consecutive
from tidemark.plans.features import all_features, with_merchant_category
from tidemark.plans.models import alert_threshold, score
from tidemark.sources import files
from tidemark.sources import messages as M
from tidemark.streaming import history_index as X
from tidemark.streaming import leases, outbox

ID = "transaction_id"
_LATEST_FRAME_DAYS = S.LONGEST_LOOKBACK // S.DAY
_LONGEST_SUM_DAYS = 7
_DEVICE_DAYS = 1
FIRST_RUN = "first"
COMPACTED_FOLDERS = 8
_STORED = T.StructType(
    [
        *[T.StructField(f.name, f.dataType) for f in S.TRANSACTIONS.fields],
        T.StructField("event_date", T.DateType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Stores:
    """Folders the stream writes to; all on storage every executor reaches."""

    history: str
    alerts: str
    quarantine: str
    checkpoint: str
    features: str | None = None


def parsed_messages(raw: DataFrame) -> DataFrame:
    """Typed rows with their ``problems`` from a topic or from text files."""
    has_position = {"topic", "partition", "offset"} <= set(raw.columns)
    return M.parse(raw, M.position_id() if has_position else None)


def without_repeats(parsed: DataFrame, watermark: str) -> DataFrame:
    """Drop repeated ids before the batches are formed, with state bounded by the watermark.

    Rows later than the watermark are dropped by Spark as well, so this is for callers who want
    that; the batches themselves drop repeats against the history without losing late rows.
    """
    return parsed.withWatermark("transaction_timestamp", watermark).dropDuplicatesWithinWatermark(
        [ID]
    )


def _transactions(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.TRANSACTIONS.fields]
    )


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(context._jsc.hadoopConfiguration()), found


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to, made when the checkpoint is new."""
    files, path = _file_system(spark, f"{checkpoint}/tidemark-run")
    if files.exists(path):
        source = files.open(path)
        try:
            return source.readUTF()
        finally:
            source.close()
    run = uuid4().hex
    sink = files.create(path, False)
    try:
        sink.writeUTF(run)
    finally:
        sink.close()
    return run


def append_history(
    transactions: DataFrame, history: str, batch_id: int, run: str = FIRST_RUN
) -> None:
    """Store transactions under event date, run and batch, replacing what the batch wrote before."""
    (
        _transactions(transactions)
        .withColumns(
            {
                "event_date": F.to_date("transaction_timestamp"),
                "run": F.lit(run),
                "batch_id": F.lit(batch_id),
            }
        )
        .hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "batch_id", X.key_hash("user_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "run", "batch_id")
        .parquet(history)
    )


def index_batch(
    spark: SparkSession, history: str, dates: list[date], batch_id: int, run: str = FIRST_RUN
) -> None:
    """Summarise the files that a batch stored on ``dates``. Without it they are always read."""
    paths = [f"{history}/event_date={day}/run={run}/batch_id={batch_id}" for day in dates]
    stored = spark.read.schema(_STORED).option("basePath", history).parquet(*paths)
    X.write_summaries(stored, history)


def _days(spark: SparkSession, folder: str, first: date, last: date) -> list[str]:
    """The dates of a range that have a folder."""
    files, path = _file_system(spark, f"{folder}/event_date=*")
    names = [entry.getPath().getName() for entry in files.globStatus(path) or ()]
    days = sorted(n.partition("=")[2] for n in names)
    return [d for d in days if str(first) <= d <= str(last)]


def read_history(spark: SparkSession, history: str, first: date, last: date) -> DataFrame | None:
    """The stored transactions of a range of dates; of dates that exist only those are listed."""
    days = _days(spark, history, first, last)
    if not days:
        return None
    paths = [f"{history}/event_date={day}" for day in days]
    return spark.read.schema(_STORED).option("basePath", history).parquet(*paths)


def read_history_of(
    spark: SparkSession, history: str, first: date, last: date, incoming: DataFrame, device_from: date
) -> DataFrame | None:
    """``read_history`` without the files that can hold no user of ``incoming``, and none of its devices
    from ``device_from`` on. Rows of other keys that share a file with one of them are still there."""
    everything = read_history(spark, history, first, last)
    if everything is None:
        return None
    files = [f[f.rindex("/event_date=") + 1 :] for f in everything.inputFiles()]
    indexed = _days(spark, X.index_folder(history), first, last)
    wanted = X.files_with_keys(spark, history, files, indexed, incoming, str(device_from))
    if len(wanted) == len(files):
        return everything
    if not wanted:
        return None
    paths = [f"{history}/{name}" for name in wanted]
    return spark.read.schema(_STORED).option("basePath", history).parquet(*paths)


def compact_history(
    spark: SparkSession, history: str, before: date, folders: int = COMPACTED_FOLDERS
) -> list[str]:
    """Merge the folders of dates before ``before`` that hold at least ``folders`` batches of one run.

    A run's latest batch may still be run again, so it stays by itself; all earlier ones are done. The
    merged rows keep their run, get a negative batch and are sorted by user. They are in place before
    what they replace is deleted: a failure in between leaves rows twice, which readers of features
    drop by id and the next merge mends. Call it where nothing else reads the history, as the
    stream does between its batches. Returns the dates that were merged.
    """
    files, found = _file_system(spark, f"{history}/event_date=*/run=*/batch_id=*")
    stored: dict[tuple[str, str], list[int]] = {}
    latest: dict[str, int] = {}
    for entry in files.globStatus(found) or ():
        path = entry.getPath()
        day, run, batch = (
            p.getName().partition("=")[2] for p in (path.getParent().getParent(), path.getParent(), path)
        )
        stored.setdefault((day, run), []).append(int(batch))
        latest[run] = max(latest.get(run, -1), int(batch))
    merged = {}
    for (day, run), batches in stored.items():
        done = [b for b in batches if b != latest[run]]
        if len(done) >= folders and day[:1].isdigit() and day < str(before):
            merged[day, run] = done
    if not merged:
        return []
    paths = [
        f"{history}/event_date={day}/run={run}/batch_id={batch}"
        for (day, run), batches in merged.items()
        for batch in batches
    ]
    staging = f"{history}/_merging-{uuid4().hex}"
    number = -1 - max(abs(b) for batches in merged.values() for b in batches)
    (
        spark.read.schema(_STORED)
        .option("basePath", history)
        .parquet(*paths)
        .withColumn("batch_id", F.lit(number))
        .dropDuplicates(["event_date", "run", ID])
        # Files of a date hold ranges of user hashes, so that a user is in one of them.
        .repartitionByRange("event_date", X.key_hash("user_id"))
        .sortWithinPartitions("event_date", "run", X.key_hash("user_id"))
        .write.partitionBy("event_date", "run", "batch_id")
        .parquet(staging)
    )
    make_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for day, run in merged:
        folder = f"event_date={day}/run={run}/batch_id={number}"
        if not files.rename(make_path(f"{staging}/{folder}"), make_path(f"{history}/{folder}")):
            raise RuntimeError(f"could not put {folder} in place")
    for path in paths:
        files.delete(make_path(path), True)
        files.delete(make_path(path.replace(history, X.index_folder(history), 1)), True)
    files.delete(make_path(staging), True)
    placed = [f"{history}/event_date={day}/run={run}/batch_id={number}" for day, run in merged]
    merged_rows = spark.read.schema(_STORED).option("basePath", history).parquet(*placed)
    X.write_summaries(merged_rows, history)
    return sorted({day for day, _ in merged})


def _repeats(known: DataFrame, incoming: DataFrame, run: str, batch_id: int) -> DataFrame:
    """Ids of the batch that other batches and runs stored. The batch is the small side of this join, so
    what remains of the stored ids is small as well."""
    own = (F.col("run") == run) & (F.col("batch_id") == batch_id)
    earlier = known.filter(~own).select(ID)
    return earlier.join(incoming.select(ID), ID, "left_semi")


def touched_history(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored rows of the users and of the devices that occur in the batch, each once.

    Two semi joins and a union; a single join on either key would compare all pairs of rows.
    """
    by_user = history.join(incoming.select("user_id").distinct(), "user_id", "left_semi")
    by_device = history.join(incoming.select("device_id").distinct(), "device_id", "left_semi")
    return by_user.unionByName(by_device).dropDuplicates([ID])


def needed_history(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored rows that features of the batch depend on, each once.

    A user's rows are thinned up to the user's own earliest new transaction, so that a late row of
    one user does not bring back the history of all; a device's rows reach back one day only.
    """

    def earliest(key: str) -> DataFrame:
        return incoming.groupBy(key).agg(F.min("transaction_timestamp").alias("_earliest"))

    mine = history.join(earliest("user_id"), "user_id")
    by_user = thinned(mine, F.col("_earliest")).drop("_earliest")
    since = F.col("_earliest") - F.expr(f"INTERVAL {_DEVICE_DAYS} DAYS 1 SECOND")
    by_device = (
        history.join(earliest("device_id"), "device_id")
        .filter(F.col("transaction_timestamp") >= since)
        .drop("_earliest")
    )
    return by_user.unionByName(by_device).dropDuplicates([ID])


def thinned(history: DataFrame, earliest: Column) -> DataFrame:
    """Only the rows that can matter to transactions from ``earliest`` on, one moment or one per user.

    Sums and distinct counts look back seven days at most. Of what is older, only the time since
    the last transaction and the 30-day novelty of a category depend, and for both the latest old
    row per user and category is enough; it is found with map-side combine.
    """
    border = earliest - F.expr(f"INTERVAL {_LONGEST_SUM_DAYS} DAYS 1 SECOND")
    is_recent = F.col("transaction_timestamp") >= border
    latest_old = (
        history.filter(~is_recent)
        .groupBy("user_id", "merchant_category")
        .agg(
            F.max_by(
                F.struct(*[c for c in history.columns if c not in ("user_id", "merchant_category")]),
                "transaction_timestamp",
            ).alias("row")
        )
        .select("user_id", "merchant_category", "row.*")
    )
    return history.filter(is_recent).unionByName(latest_old)


def batch_rows(history: DataFrame, incoming: DataFrame, merchants: DataFrame) -> DataFrame:
    """The stored rows that features of the batch are computed from, with merchant categories.

    Old rows are read and shuffled in the few columns that features need; what else a transaction
    carries comes from the batch itself.
    """
    stored = with_merchant_category(history.select(ID, *HISTORY_COLUMNS), merchants)
    return needed_history(stored, incoming)


def batch_features(
    rows: DataFrame,
    incoming: DataFrame,
    merchants: DataFrame,
    heavy_rows: int = HEAVY_KEY_ROWS,
    counted: int | None = None,
) -> DataFrame:
    """Features of the incoming transactions, which the ``batch_rows`` already contain.

    Rows fetched through a device lack some of their own users' rows, but only incoming
    transactions are kept, and for those both keys are complete.
    """
    created = (
        incoming.filter(F.col("payment_created_at").isNotNull())
        .groupBy(F.col("payment_id").alias("payment_method_id"))
        .agg(F.min("payment_created_at").alias("created_at"))
    )
    computed = all_features(rows, merchants, created, heavy_rows, counted)
    rest = _transactions(incoming).drop(*HISTORY_COLUMNS)
    return computed.join(rest, ID)


def alerts(
    scored: DataFrame, model_name: str, threshold: float = S.ALERT_THRESHOLD
) -> DataFrame:
    """Alert records of the transactions at or above the threshold."""
    return scored.filter(F.col("fraud_probability") >= threshold).select(
        ID,
        "user_id",
        "fraud_probability",
        F.lit(model_name).alias("model_name"),
        F.current_timestamp().alias("alerted_at"),
    )


def process_batch(
    batch: DataFrame,
    batch_id: int,
    stores: Stores,
    merchants: DataFrame,
    model: PipelineModel | None = None,
    model_name: str = "gbt",
    publish: Callable[[DataFrame], None] | None = None,
    heavy_rows: int = HEAVY_KEY_ROWS,
    run: str = FIRST_RUN,
) -> None:
    """Quarantine, store, compute features, score, alert. Safe to repeat for the same run and batch.

    An id that was stored before is known again if its time is up to 30 days from the stored one.
    """
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        if batch.isEmpty():
            return
        M.rejected(batch).write.mode("overwrite").parquet(
            f"{stores.quarantine}/run={run}/batch_id={batch_id}"
        )
        usable = M.valid(batch).dropDuplicates([ID])
        span = usable.agg(
            F.to_date(F.min("transaction_timestamp")).alias("first"),
            F.to_date(F.max("transaction_timestamp")).alias("last"),
        ).first()
        if span["first"] is None:
            return
        reach = timedelta(days=_LATEST_FRAME_DAYS)
        start = span["first"] - reach
        latest = span["last"] + min(reach, date.max - span["last"])
        known = read_history(spark, stores.history, start, latest)
        if known is not None:
            usable = usable.join(_repeats(known, usable, run, batch_id), ID, "left_anti")
        usable = usable.persist()
        try:
            if usable.isEmpty():
                return
            append_history(usable, stores.history, batch_id, run)
            days = usable.select(F.to_date("transaction_timestamp").alias("day")).distinct()
            index_batch(spark, stores.history, [r["day"] for r in days.collect()], batch_id, run)
            device_from = span["first"] - timedelta(days=_DEVICE_DAYS + 1)
            history = read_history_of(
                spark, stores.history, start, span["last"], usable, device_from
            )
            # Held while it is counted and used: the history is read and joined once.
            rows = batch_rows(history, usable, merchants).persist()
            try:
                features = batch_features(rows, usable, merchants, heavy_rows, rows.count())
                emit(features, stores, model, model_name, publish, run, batch_id)
            finally:
                rows.unpersist()
        finally:
            usable.unpersist()
    finally:
        batch.unpersist()


def stored_alerts(spark: SparkSession, alerts: str) -> DataFrame | None:
    """The alert table with the run and batch of each alert; None before the first."""
    files, path = _file_system(spark, f"{alerts}/run=*/batch_id=*/_SUCCESS")
    if not files.globStatus(path):
        return None
    schema = T.StructType(
        [
            *S.FRAUD_ALERTS.fields,
            T.StructField("run", T.StringType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )
    return spark.read.schema(schema).parquet(alerts)


def with_alert_ids(found: DataFrame, alerts: str, run: str, batch_id: int) -> DataFrame:
    """Alert records with consecutive ids that no other batch or run has, however many write at once;
    a batch that is run again gives the same ids to as many alerts.

    Ids are leased; only the first lease of a table looks at what is stored already.
    """
    spark = found.sparkSession
    found = found.persist()
    try:
        count = found.count()
        start = 1
        if not files.names_in(spark, f"{alerts}/_ids/ranges"):
            known = stored_alerts(spark, alerts)
            if known is not None:
                others = (F.col("run") != run) | (F.col("batch_id") != batch_id)
                start = (known.filter(others).agg(F.max("alert_id")).first()[0] or 0) + 1
        first = leases.lease(spark, f"{alerts}/_ids", f"{run}-{batch_id}", count, start) if count else 1
        numbered = consecutive(found, "alert_id", [ID], start=first)
    finally:
        found.unpersist()
    return numbered.select(*[F.col(f.name).cast(f.dataType) for f in S.FRAUD_ALERTS.fields])


def emit(
    features: DataFrame,
    stores: Stores,
    model: PipelineModel | None,
    model_name: str = "gbt",
    publish: Callable[[DataFrame], None] | None = None,
    run: str = FIRST_RUN,
    batch_id: int = 0,
) -> None:
    """Store the features of a batch, score them, store the alerts and hand them to ``publish``, which is
    not called again for a batch that was handed over before."""
    folder = f"run={run}/batch_id={batch_id}"
    if stores.features:
        path = f"{stores.features}/{folder}"
        features.write.mode("overwrite").parquet(path)
        # Read back what was written, so that scoring does not compute the features again.
        features = features.sparkSession.read.schema(features.schema).parquet(path)
    if model is None:
        return
    found = alerts(score(model, features), model_name, alert_threshold(model))
    found = with_alert_ids(found, stores.alerts, run, batch_id)
    path = f"{stores.alerts}/{folder}"
    found.write.mode("overwrite").parquet(path)
    if publish is not None:
        stored = found.sparkSession.read.schema(found.schema).parquet(path)
        outbox.publish_once(stored, stores.alerts, run, batch_id, publish)


def start_scoring(
    raw: DataFrame,
    stores: Stores,
    merchants: DataFrame,
    model: PipelineModel | None = None,
    model_name: str = "gbt",
    publish: Callable[[DataFrame], None] | None = None,
    watermark: str | None = None,
    available_now: bool = False,
    heavy_rows: int = HEAVY_KEY_ROWS,
    compact_every: int | None = None,
):
    """Start the scoring query over raw messages; wait on the returned query to keep it running.

    ``compact_every``: before each so manieth batch, dates before today's are compacted. Only for a
    history that no other stream uses.
    """
    parsed = parsed_messages(raw)
    run = run_of(raw.sparkSession, stores.checkpoint)
    if watermark:
        parsed = without_repeats(parsed, watermark)

    def take(df: DataFrame, batch_id: int) -> None:
        if compact_every and batch_id and batch_id % compact_every == 0:
            folders = min(COMPACTED_FOLDERS, compact_every)
            compact_history(df.sparkSession, stores.history, date.today(), folders)
        process_batch(df, batch_id, stores, merchants, model, model_name, publish, heavy_rows, run)

    writer = parsed.writeStream.option("checkpointLocation", stores.checkpoint).foreachBatch(take)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
