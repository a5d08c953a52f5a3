"""Stream behaviour: bad messages, repeats, retries, late rows, alerts."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.queries.learning import feature_table
from tidemark.plans import models as L
from tidemark.sources import messages as M
from tidemark.sources.fixture import Fixture
from tidemark.streaming import scoring as R


def message(i, t, user=1, **other):
    return json.dumps(
        {
            "transaction_id": str(i),
            "user_id": user,
            "device_id": 1,
            "merchant_id": 1,
            "payment_id": 1,
            "transaction_amount_usd": 12.345,
            "transaction_status": "Approved",
            "transaction_channel": "Online",
            "transaction_country": "US",
            "transaction_timestamp": t,
            "payment_created_at": "2024-01-01T00:00:00",
            **other,
        }
    )


def raw(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.fixture
def merchants(spark):
    return spark.createDataFrame([(1, "Travel")], "merchant_id bigint, merchant_category string")


@pytest.fixture
def stores(tmp_path):
    return R.Stores(*[str(tmp_path / n) for n in ("history", "alerts", "bad", "state", "features")])


def run(spark, stores, merchants, batch_id, *values, **options):
    R.process_batch(R.parsed_messages(raw(spark, *values)), batch_id, stores, merchants, **options)


def features(spark, stores):
    return {r["transaction_id"]: r for r in spark.read.parquet(stores.features).collect()}


def test_parsing(spark):
    parsed = R.parsed_messages(
        raw(
            spark,
            message(1, "2024-01-02 00:00:00.5"),
            '{"transaction_id": ',
            "not json",
            None,
            message(2, "2024-01-02", transaction_channel="Fax"),
            message(3, "soon"),
            message(4, "2024-01-02", user_id=None),
        )
    ).persist()
    good = M.valid(parsed).collect()
    assert [r["transaction_id"] for r in good] == ["1"]
    assert str(good[0]["transaction_amount_usd"]) == "12.35"  # cents, half up
    problems = sorted(r["problems"] for r in M.rejected(parsed).collect())
    assert problems == sorted(
        ["malformed"] * 3 + ["transaction_channel", "transaction_timestamp", "user_id"]
    )


def test_missing_id_comes_from_the_position(spark):
    value = message(1, "2024-01-02", transaction_id=None)
    df = raw(spark, value).withColumns(
        {"topic": F.lit("t"), "partition": F.lit(0), "offset": F.lit(7)}
    )
    ids = [M.valid(R.parsed_messages(df)).first()["transaction_id"] for _ in range(2)]
    assert ids[0] == ids[1] and len(ids[0]) == 64


def test_repeats_retries_and_late_rows(spark, stores, merchants):
    first = [message(1, "2024-01-02 10:00:00"), message(1, "2024-01-02 10:00:00"), "junk"]
    run(spark, stores, merchants, 0, *first)
    run(spark, stores, merchants, 1, message(2, "2024-01-02 10:30:00"), first[0])
    run(spark, stores, merchants, 1, message(2, "2024-01-02 10:30:00"), first[0])  # retry
    assert spark.read.parquet(stores.history).count() == 2
    assert spark.read.parquet(stores.quarantine).count() == 1
    # a late row is computed at its own time, earlier results stay as they are
    run(spark, stores, merchants, 2, message(3, "2024-01-02 10:15:00"))
    got = features(spark, stores)
    counts = {i: r["user_transaction_count_1h"] for i, r in got.items()}
    assert counts == {"1": 1, "2": 2, "3": 2}
    assert got["2"]["seconds_since_last_transaction"] == 1800
    run(spark, stores, merchants, 3)  # an empty batch does nothing
    run(spark, stores, merchants, 4, "junk")  # nor does one without a usable row


def test_a_new_checkpoint_overwrites_nothing(spark, stores, merchants):
    """Batch 0 of a second run leaves batch 0 of the first as it is, and counts on it."""
    run(spark, stores, merchants, 0, *[message(i, f"2024-01-02 10:0{i}:00") for i in (1, 2)], run="a")
    run(spark, stores, merchants, 0, message(3, "2024-01-02 10:30:00"), run="b")
    run(spark, stores, merchants, 0, message(1, "2024-01-05 10:00:00"), run="c")  # known by its id
    assert spark.read.parquet(stores.history).count() == 3
    got = features(spark, stores)
    assert sorted(got) == ["1", "2", "3"] and got["3"]["user_transaction_count_1h"] == 3


def test_the_run_is_kept_with_the_checkpoint(spark, tmp_path):
    first = R.run_of(spark, str(tmp_path / "state"))
    assert R.run_of(spark, str(tmp_path / "state")) == first
    assert R.run_of(spark, str(tmp_path / "other")) != first


def test_a_far_date_lists_no_folders(spark, stores, merchants):
    run(spark, stores, merchants, 0, message(1, "2024-01-02 10:00:00"), message(2, "9999-12-30"))
    assert sorted(features(spark, stores)) == ["1", "2"]


def test_compaction_changes_no_feature(spark, stores, merchants):
    """Merged folders hold the rows of all batches but the latest, which may still be run again."""
    for i in range(4):
        run(spark, stores, merchants, i, message(i, f"2024-01-02 10:0{i}:00"), message(f"x{i}", "2024-01-09"))
    assert R.compact_history(spark, stores.history, date(2024, 1, 5), 5) == []
    assert R.compact_history(spark, stores.history, date(2024, 1, 5), 3) == ["2024-01-02"]

    def batches():
        stored = spark.read.parquet(stores.history).groupBy("event_date", "batch_id").count().collect()
        return sorted((str(r[0]), r[1], r[2]) for r in stored)

    assert batches() == sorted(
        [("2024-01-02", -3, 3), ("2024-01-02", 3, 1), *[("2024-01-09", i, 1) for i in range(4)]]
    )
    run(spark, stores, merchants, 3, message(3, "2024-01-02 10:03:00"), message("x3", "2024-01-09"))  # retry
    run(spark, stores, merchants, 4, message(4, "2024-01-02 10:04:00"), message(1, "2024-01-02 10:01:00"))
    assert features(spark, stores)["3"]["user_transaction_count_1h"] == 4
    assert features(spark, stores)["4"]["user_transaction_count_1h"] == 5
    # what is merged already is merged again with what came since, and a doubled row goes
    R.append_history(spark.read.parquet(stores.history).filter("transaction_id = '0'"), stores.history, 2)
    assert R.compact_history(spark, stores.history, date(2024, 1, 5), 3) == ["2024-01-02"]
    assert [b for b in batches() if b[0] == "2024-01-02"] == [("2024-01-02", -4, 4), ("2024-01-02", 4, 1)]


def test_stream_compacts_between_batches(spark, stores, merchants, tmp_path):
    inbox = str(tmp_path / "inbox")
    for i in range(5):
        raw(spark, message(i, f"2024-01-02 10:{i:02d}:00")).coalesce(1).write.mode("append").text(inbox)
    stream = M.file_stream(spark, inbox, 1)
    R.start_scoring(stream, stores, merchants, available_now=True, compact_every=2).awaitTermination()
    stored = spark.read.parquet(stores.history)
    assert stored.count() == 5 and stored.select("batch_id").distinct().count() == 3
    assert sorted(features(spark, stores)) == ["0", "1", "2", "3", "4"]


def test_other_users_of_the_device_count(spark, stores, merchants):
    run(spark, stores, merchants, 0, message(1, "2024-01-02 10:00:00", user=1))
    run(spark, stores, merchants, 1, message(2, "2024-01-02 11:00:00", user=2), heavy_rows=0)
    assert features(spark, stores)["2"]["device_unique_users_24h"] == 2
    assert features(spark, stores)["2"]["user_transaction_count_1h"] == 1


def test_old_history_is_thinned_without_effect(spark, stores, merchants):
    """Novelty looks back 30 days, the gap further; both survive the thinning."""
    old = [message(i, f"2024-01-{i:02d} 00:00:00", merchant_id=1 + i % 2) for i in range(1, 15)]
    run(spark, stores, merchants, 0, *old)
    run(spark, stores, merchants, 1, message("late", "2024-02-01 00:00:00", merchant_id=1))
    run(spark, stores, merchants, 2, message("later", "2024-03-01 00:00:00", merchant_id=1))
    got = features(spark, stores)
    assert got["late"]["seconds_since_last_transaction"] == 18 * 86400
    assert got["late"]["is_new_merchant_category"] == 0
    assert got["late"]["user_unique_merchants_24h"] == 1
    assert got["later"]["seconds_since_last_transaction"] == 29 * 86400
    assert got["later"]["is_new_merchant_category"] == 0
    history = spark.read.parquet(stores.history).withColumn("merchant_category", F.lit("x"))
    border = F.lit("2024-02-01").cast("timestamp")
    assert R.thinned(history, border).count() == 3


def test_alerts_are_written_and_published(spark, stores, merchants):
    fx = Fixture(spark, "/root/testdata/sf0.001")
    model = L.train(feature_table(fx), "rf", settings={"numTrees": 3, "maxDepth": 3})
    model = L.with_threshold(model, 0.0)
    sent = []
    run(
        spark,
        stores,
        merchants,
        0,
        message(1, "2024-01-02 10:00:00"),
        model=model,
        model_name="rf",
        publish=lambda df: sent.extend(df.collect()),
    )
    written = spark.read.parquet(stores.alerts).collect()
    assert [r["transaction_id"] for r in written] == ["1"] == [r["transaction_id"] for r in sent]
    assert written[0]["model_name"] == "rf" and 0 <= written[0]["fraud_probability"] <= 1
    # ids go on from batch to batch, and a batch that is run again gives the same ones
    second = [message(i, f"2024-01-02 11:0{i}:00") for i in (2, 3)]
    for _ in range(2):
        run(spark, stores, merchants, 1, *second, model=model, model_name="rf")
    ids = {r["transaction_id"]: r["alert_id"] for r in R.stored_alerts(spark, stores.alerts).collect()}
    assert ids == {"1": 1, "2": 2, "3": 3}


def test_a_score_at_the_threshold_alerts(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.5), ("b", 1, 0.4999)],
        "transaction_id string, user_id bigint, fraud_probability double",
    )
    assert [r["transaction_id"] for r in R.alerts(df, "gbt").collect()] == ["a"]


def test_stream_with_watermark(spark, stores, merchants, tmp_path):
    inbox = str(tmp_path / "inbox")
    values = [message(i, f"2024-01-02 10:0{i % 5}:00") for i in range(5)]
    raw(spark, *values, *values).write.text(inbox)
    stream = M.file_stream(spark, inbox, 100)
    R.start_scoring(
        stream, stores, merchants, watermark="30 minutes", available_now=True
    ).awaitTermination()
    assert sorted(features(spark, stores)) == ["0", "1", "2", "3", "4"]
