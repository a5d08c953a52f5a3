"""Key summaries of history files: what a batch opens, and that it misses nothing."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.streaming import history_index as X
from tidemark.streaming import scoring as R

FIRST, DAYS, PARTS = date(2024, 1, 1), 6, 10


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """Six days of ten batches; a user is in the batches of its last digit, users below 50 only on
    the first two days. Device d is used by user d, but device 7 by user 3000 as well."""
    path = str(tmp_path_factory.mktemp("history") / "table")
    for batch in range(PARTS):
        rows = spark.range(DAYS * 300).select(
            (F.col("id") % 300 * 10 + batch).alias("user_id"), (F.col("id") / 300).cast("int").alias("day")
        )
        rows = rows.filter((F.col("user_id") >= 50) | (F.col("day") < 2))
        rows = rows.select(
            F.concat_ws("-", "user_id", "day").alias(R.ID),
            "user_id",
            F.when((F.col("user_id") == 2990) & (F.col("day") == 5), 7).otherwise(F.col("user_id")).alias("device_id"),
            F.date_add(F.lit(FIRST), F.col("day")).cast("timestamp").alias("transaction_timestamp"),
        )
        missing = [f.name for f in R._STORED.fields if f.name not in (*rows.columns, *X._PARTS)]
        full = rows.select("*", *[F.lit(None).alias(c) for c in missing])
        R.append_history(full, path, batch)
        R.index_batch(spark, path, [FIRST + timedelta(days=d) for d in range(DAYS)], batch)
    return path


def incoming(spark, *users):
    rows = [(u, u) for u in users]
    return spark.createDataFrame(rows, "user_id bigint, device_id bigint")


def opened(spark, history, batch, device_from=FIRST + timedelta(days=DAYS)):
    found = R.read_history_of(spark, history, FIRST, FIRST + timedelta(days=DAYS), batch, device_from)
    return (0, []) if found is None else (len(found.inputFiles()), found.filter("user_id % 10 = 3").collect())


def test_ten_users_open_their_files_only(spark, history):
    everything = R.read_history(spark, history, FIRST, FIRST + timedelta(days=DAYS))
    assert len(everything.inputFiles()) == DAYS * PARTS
    users = [100 + 10 * i + 3 for i in range(10)]
    files, rows = opened(spark, history, incoming(spark, *users))
    assert DAYS <= files <= DAYS + 4  # ten keys, 60 filters, about one false hit in 400 files
    assert {r[R.ID] for r in rows} >= {f"{u}-{d}" for u in users for d in range(DAYS)}
    # users that were last seen on the second day open no file of later days, however many there are
    files, _ = opened(spark, history, incoming(spark, 3, 13, 23, 33, 43))
    assert 2 <= files <= 4
    assert opened(spark, history, incoming(spark, 5_000_003))[0] <= 2


def test_devices_count_from_their_date_on(spark, history):
    batch = spark.createDataFrame([(9_999_999, 7)], "user_id bigint, device_id bigint")
    last = FIRST + timedelta(days=DAYS - 1)
    found = R.read_history_of(spark, history, FIRST, last, batch, last)
    assert found.filter("device_id = 7").count() == 2 - 1 + 0  # user 7 was not seen that day
    assert all(f"event_date={last}" in f for f in found.inputFiles())


def test_files_without_a_summary_are_read(spark, history, tmp_path):
    path = str(tmp_path / "table")
    rows = R.read_history(spark, history, FIRST, FIRST).drop(*X._PARTS)
    R.append_history(rows.filter("user_id % 2 = 0"), path, 0)
    R.index_batch(spark, path, [FIRST], 0)
    R.append_history(rows.filter("user_id % 2 = 1"), path, 0)  # replaced, the summary is of other files
    R.append_history(rows.filter("user_id % 3 = 1"), path, 1)
    batch = incoming(spark, 103)
    found = R.read_history_of(spark, path, FIRST, FIRST, batch, FIRST)
    assert len(found.inputFiles()) == 2 and found.filter("user_id = 103").count() == 2
    assert R.read_history_of(spark, str(tmp_path / "none"), FIRST, FIRST, batch, FIRST) is None


def test_compaction_moves_the_summaries(spark, tmp_path, history):
    path = str(tmp_path / "table")
    rows = R.read_history(spark, history, FIRST, FIRST).drop(*X._PARTS)
    for batch in range(4):
        R.append_history(rows.filter(F.col("user_id") % 4 == batch), path, batch)
        R.index_batch(spark, path, [FIRST], batch)
    assert R.compact_history(spark, path, date(2024, 2, 1), 3) == [str(FIRST)]
    found = R.read_history_of(spark, path, FIRST, FIRST, incoming(spark, 103), FIRST)
    assert found.filter("user_id = 103").count() == 1
    assert opened_names(found) <= {-3, 3}
    files, _ = opened(spark, path, incoming(spark, 5_000_003), FIRST)
    assert files == 0


def opened_names(found):
    return {int(f.split("batch_id=")[1].split("/")[0]) for f in found.inputFiles()}


def test_filters_have_no_false_negatives_and_few_false_hits(spark):
    rng = np.random.default_rng(0)
    known = rng.integers(-(2**62), 2**62, 3000)
    other = rng.integers(-(2**62), 2**62, 3000)
    df = spark.createDataFrame(
        [(int(k), "known") for k in known] + [(int(k), "other") for k in other], "user_id bigint, side string"
    ).select("side", X.key_hash("user_id").alias("key"), X._block_hash("user_id").alias("spread"))
    rows = df.toPandas()
    bits = (
        df.filter("side = 'known'")
        .withColumn("block", F.col("spread").bitwiseAND(1))
        .withColumn("position", F.explode(X._positions(F.col("key"))))
        .groupBy("block")
        .agg(F.bitmap_construct_agg("position").alias("bits"))
        .withColumns({"blocks": F.lit(2), "least": F.lit(-(2**63)), "most": F.lit(2**63 - 1)})
    )
    blocks = list(bits.toPandas().itertuples(index=False))

    def share(side):
        own = rows[rows.side == side]
        keys, spread = own.key.to_numpy(), own.spread.to_numpy()
        return np.mean([any(X._holds(b, keys[[i]], spread[[i]]) for b in blocks) for i in range(len(own))])

    assert share("known") == 1 and share("other") < 0.01


def test_summaries_are_made_by_many_tasks_and_hold_each_key_of_their_file(spark, history, tmp_path):
    """The bits are those of the file's keys, and no single task makes or writes the summaries of all files."""
    stored = spark.read.schema(R._STORED).parquet(history)
    found = {(r["file"], r["batch_id"], str(r["event_date"]), r["kind"]): r for r in X.summaries(stored).collect()}
    keyed = stored.select(
        F.col("_metadata.file_name").alias("file"), "event_date", "batch_id", X.key_hash("user_id").alias("key")
    ).toPandas()
    assert len(found) == 2 * len(spark.read.schema(R._STORED).parquet(history).inputFiles())
    for (file, day, batch), rows in keyed.groupby(["file", "event_date", "batch_id"]):
        row = found[file, batch, str(day), "user"]
        wanted = np.zeros(X.BLOCK_BITS, np.uint8)
        for i in range(X.HASHES):
            wanted[(rows.key.to_numpy() >> (15 * i)) & (X.BLOCK_BITS - 1)] = 1
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        assert row["blocks"] == 1 and (bits == wanted).all()
        assert (row["least"], row["most"]) == (rows.key.min(), rows.key.max())

    context, setting = spark.sparkContext, "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    context.setJobGroup("summaries", "")
    try:
        X.write_summaries(stored, str(tmp_path / "other"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset(setting)
    tracker = context.statusTracker()
    stages = [i for job in tracker.getJobIdsForGroup("summaries") for i in tracker.getJobInfo(job).stageIds]
    assert tracker.getStageInfo(max(stages)).numTasks > 1
