"""Ids for several writers, publishing once, tables that change file by file, balanced reads."""

import threading
from datetime import datetime
from unittest import mock

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import updates as U
from tidemark.plans import metrics as M
from tidemark.sources import files, manifests, tables
from tidemark.streaming import leases, outbox


def test_a_file_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/deep/er/file"
    assert files.read_text(spark, path) is None
    assert files.create_text(spark, path, "first ä\n") and not files.create_text(spark, path, "second")
    assert files.read_text(spark, path) == "first ä\n"
    assert files.names_in(spark, f"{tmp_path}/deep/er") == ["file"]
    assert files.names_in(spark, f"{tmp_path}/nothing") == []


def test_writers_at_once_get_ranges_of_their_own(spark, tmp_path):
    folder, given = str(tmp_path / "ids"), {}

    def write(writer):
        for batch in range(8):
            count = 1 + (writer * 7 + batch) % 5
            given[writer, batch] = (leases.lease(spark, folder, f"{writer}-{batch}", count, 100), count)

    threads = [threading.Thread(target=write, args=(w,)) for w in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    ids = [i for first, count in given.values() for i in range(first, first + count)]
    assert len(given) == 32 and len(set(ids)) == len(ids)
    assert (min(ids), max(ids)) == (100, 99 + len(ids))  # gapless, as no one failed
    for (writer, batch), (first, count) in given.items():
        assert leases.lease(spark, folder, f"{writer}-{batch}", count) == first
    assert leases.lease(spark, folder, "0-0", 9) == 100 + len(ids)  # more than before: other ids


def test_ranges_go_on_in_the_next_folder(spark, tmp_path):
    folder = str(tmp_path)
    files.create_text(spark, leases._path(folder, 999), "41\n9\nsomeone")
    assert leases.lease(spark, folder, "a", 3) == 50 and leases.lease(spark, folder, "b", 1) == 53
    assert files.names_in(spark, f"{folder}/ranges") == ["000000000", "000000001"]


def stored_batch(spark, alerts, batch):
    df = spark.createDataFrame([(batch, f"t{batch}")], "alert_id bigint, transaction_id string")
    df.write.mode("overwrite").parquet(f"{alerts}/run=r/batch_id={batch}")
    return spark.read.parquet(f"{alerts}/run=r/batch_id={batch}")


def test_a_batch_is_published_once(spark, tmp_path):
    alerts, sent = str(tmp_path / "alerts"), str(tmp_path / "sent")

    def publish(df):
        df.write.mode("append").parquet(sent)

    def fail(df):
        raise OSError("no connection")

    for _ in range(2):  # run again after it was sent
        outbox.publish_once(stored_batch(spark, alerts, 0), alerts, "r", 0, publish)
    for _ in range(2):  # stored, then the receiver is away
        with pytest.raises(OSError):
            outbox.publish_once(stored_batch(spark, alerts, 1), alerts, "r", 1, fail)
    stored_batch(spark, alerts, 2)  # ended between storing and publishing
    assert outbox.pending(spark, alerts) == [("r", 1), ("r", 2)]
    assert outbox.publish_pending(spark, alerts, publish) == [("r", 1), ("r", 2)]
    assert outbox.publish_pending(spark, alerts, publish) == []
    assert not outbox.publish_once(stored_batch(spark, alerts, 2), alerts, "r", 2, fail)
    assert sorted(r[0] for r in spark.read.parquet(sent).collect()) == [0, 1, 2]
    assert spark.read.parquet(alerts).count() == 3  # marks are no rows


@pytest.fixture
def methods(spark, tmp_path):
    table = str(tmp_path / "methods")
    rows = spark.range(800).select(
        F.col("id").alias("payment_method_id"), (F.col("id") % 10 != 0).cast("int").alias("payment_is_active")
    )
    manifests.create_table(rows.repartitionByRange(8, "payment_method_id"), table)
    return table


def test_only_files_with_hits_are_rewritten(spark, methods):
    before = manifests.data_files(spark, methods)
    assert len(before) == 8
    listed = spark.createDataFrame([(5,), (7,), (20,), (9_999,)], "payment_method_id bigint")
    assert U.deactivate_in_place(spark, methods, listed) == 2
    after = manifests.data_files(spark, methods)
    assert len(set(before) & set(after)) == 7
    rows = manifests.read_table(spark, methods)
    assert rows.columns == ["payment_method_id", "payment_is_active"] and rows.count() == 800
    inactive = {r[0] for r in rows.filter("payment_is_active = 0").collect()}
    assert inactive == {5, 7, *range(0, 800, 10)}
    assert U.deactivate_in_place(spark, methods, listed) == 0  # nothing changes any more
    assert manifests.data_files(spark, methods) == after
    gone = manifests.vacuum(spark, methods)
    assert set(gone) == set(before) - set(after) and manifests.read_table(spark, methods).count() == 800


def test_of_two_changes_at_once_one_fails(spark, methods):
    def slow(rows):
        U.deactivate_in_place(spark, methods, spark.createDataFrame([(1,)], "payment_method_id bigint"))
        return rows

    with pytest.raises(manifests.ConcurrentChange):
        manifests.update(spark, methods, lambda r: r.filter("payment_method_id = 2"), slow)
    assert manifests.read_table(spark, methods).filter("payment_is_active = 0").count() == 81
    with pytest.raises(FileNotFoundError):
        manifests.read_table(spark, methods + "-none")


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "varchar"])
def test_balanced_ranges_of_a_skewed_column(kind):
    """The source's own quantiles, tried on another engine: every row is in one range, and no range
    is much larger than the others."""
    con = duckdb.connect()
    value = {
        "bigint": "v",
        "timestamp": "timestamp '2024-01-01' + to_seconds(v)",
        "varchar": "'it''s ' || lpad(v::varchar, 12, '0')",
    }[kind]
    con.sql(
        f"create table t as select i, case when i % 50 = 0 then null else {value} end as key from"
        " (select i, (exp(i / 500.0))::bigint as v from range(10000) r(i))"
    )
    query = tables.quantile_query("t", "key", 8)
    borders = sorted(r[1] for r in con.sql(f"select * from {query}").fetchall())[:-1]
    assert borders == sorted(borders) and (kind != "timestamp" or isinstance(borders[0], datetime))
    predicates = tables.range_predicates("key", borders)
    counts = [con.sql(f"select count(*) from t where {p}").fetchall()[0][0] for p in predicates]
    assert sum(counts) == 10_000 and len(counts) == 8
    assert max(counts) < 2 * 10_000 / 8


def test_balanced_reads_pass_their_ranges_on(spark):
    assert tables.range_predicates("k", []) == ["1 = 1"]
    assert tables.range_predicates("k", [3, None, 3]) == ["k <= 3 OR k IS NULL", "k > 3"]
    reader = mock.Mock()
    reader.read.jdbc.return_value.collect.return_value = [{"border": b} for b in (9, 1, 4)]
    tables.read_jdbc_balanced(reader, "jdbc:x", "tx", "user_id", 3, {"user": "u"})
    (_, query), named = reader.read.jdbc.call_args_list[0]
    assert "NTILE(3) OVER (ORDER BY user_id)" in query and named == {"properties": {"user": "u"}}
    assert reader.read.jdbc.call_args_list[1].kwargs["predicates"] == [
        "user_id <= 1 OR user_id IS NULL",
        "user_id > 1 AND user_id <= 4",
        "user_id > 4",
    ]


@pytest.mark.parametrize("bins", [1, 7, 64, 4096])
def test_bounds_of_binned_scores_hold(spark, bins):
    rng = np.random.default_rng(bins)
    for shape in (0.3, 2.0):
        label = (rng.random(800) < 0.1).astype(int)
        score = np.clip(rng.beta(shape, 2, 800) + 0.2 * label, 0, 1)
        rows = spark.createDataFrame(list(zip(label.tolist(), score.tolist())), "label int, score double")
        exact = M.ranking_scores(M.precision_recall_curve(rows)).first()
        found = M.ranking_bounds(M.binned_curve(rows, bins)).first()
        assert found["roc_auc_low"] - 1e-12 <= exact["roc_auc"] <= found["roc_auc_high"] + 1e-12
        assert found["avg_precision_low"] - 1e-12 <= exact["avg_precision"] <= found["avg_precision_high"] + 1e-12
        if bins == 4096:
            assert found["roc_auc_high"] - found["roc_auc_low"] < 0.002
