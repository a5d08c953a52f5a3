"""Publishing what is stored, each batch once.

The stored alerts are the outbox; a mark per run and batch says that they were handed over. A batch that is run
again finds its mark and sends nothing. If a run ends between storing and publishing, the batch has no mark and
is sent when it is run again, or by ``publish_pending``. Only a failure while publishing itself, or before its
mark is set, repeats a batch, with the ids it had, by which receivers can tell.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import files

Publish = Callable[[DataFrame], None]


def _mark(alerts: str, run: str, batch_id: int) -> str:
    return f"{alerts}/_sent/{run}/{batch_id}"


def is_sent(spark: SparkSession, alerts: str, run: str, batch_id: int) -> bool:
    return files.read_text(spark, _mark(alerts, run, batch_id)) is not None


def publish_once(stored: DataFrame, alerts: str, run: str, batch_id: int, publish: Publish) -> bool:
    """Hand the stored alerts of a batch to ``publish`` unless that was done; True if it was done now."""
    spark = stored.sparkSession
    if is_sent(spark, alerts, run, batch_id):
        return False
    publish(stored)
    files.create_text(spark, _mark(alerts, run, batch_id), "sent")
    return True


def pending(spark: SparkSession, alerts: str) -> list[tuple[str, int]]:
    """Runs and batches that are stored completely but not marked as sent."""
    found = []
    for run in (n.partition("=")[2] for n in files.names_in(spark, alerts, "run=*")):
        sent = set(files.names_in(spark, f"{alerts}/_sent/{run}"))
        for name in files.names_in(spark, f"{alerts}/run={run}", "batch_id=*"):
            batch = name.partition("=")[2]
            if batch not in sent and files.names_in(spark, f"{alerts}/run={run}/{name}", "_SUCCESS"):
                found.append((run, int(batch)))
    return sorted(found)


def publish_pending(spark: SparkSession, alerts: str, publish: Publish) -> list[tuple[str, int]]:
    """Send what earlier runs stored and did not send."""
    left = pending(spark, alerts)
    for run, batch_id in left:
        stored = spark.read.parquet(f"{alerts}/run={run}/batch_id={batch_id}")
        publish_once(stored, alerts, run, batch_id, publish)
    return left
