"""Session construction."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def create_session(
    app_name: str = "tidemark",
    master: str | None = None,
    packages: Sequence[str] = (),
    conf: Mapping[str, str] | None = None,
    log_level: str = "WARN",
) -> SparkSession:
    """A UTC session with adaptive execution on.

    ``packages`` are connector coordinates (JDBC driver, Kafka source) to resolve at start-up.
    Sizes (shuffle partitions, memory) are the cluster's business and come in through ``conf``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if packages:
        settings["spark.jars.packages"] = ",".join(packages)
    settings.update(conf or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset a local master gets a fresh folder; on a cluster a folder of the driver's
    machine would be out of the executors' reach, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder for master {master}")
        root = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one every executor reaches."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage and cut its lineage there."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)
