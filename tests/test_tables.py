"""Tables in and out: files, local rows, JDBC options, rates, keys."""

import json
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import access as A
from tidemark.operators import quality as Q
from tidemark.operators import updates as U
from tidemark.sources import tables as T


def test_feature_table_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 1), ("b", 90000)], "transaction_id string, t bigint"
    ).withColumn("transaction_timestamp", F.timestamp_seconds("t"))
    path = str(tmp_path / "features")
    T.write_features(df, path)
    T.write_features(df, path)
    back = T.read_features(spark, path)
    assert back.count() == 2
    assert sorted(str(r["event_date"]) for r in back.collect()) == ["1970-01-01", "1970-01-02"]


def test_local_rows_have_the_given_schema(spark):
    df = T.local_rows(spark, [{"merchant_id": 1}], S.MERCHANTS)
    assert df.schema == S.MERCHANTS and df.first()["merchant_name"] is None
    assert T.as_table(df.select("merchant_id"), "merchants").columns == S.MERCHANTS.names


def test_jdbc_options():
    """Arguments only: no database is started for a test."""
    spark = MagicMock()
    T.read_jdbc(spark, "jdbc:x", "transactions", {"user": "u"})
    spark.read.jdbc.assert_called_with("jdbc:x", "transactions", properties={"user": "u"})
    T.read_jdbc(spark, "jdbc:x", "transactions", None, "user_id", (0, 100), 8)
    spark.read.jdbc.assert_called_with(
        "jdbc:x",
        "transactions",
        column="user_id",
        lowerBound=0,
        upperBound=100,
        numPartitions=8,
        properties={},
    )
    df = MagicMock()
    T.write_jdbc(df, "jdbc:x", "transactions", "append")
    df.write.jdbc.assert_called_with("jdbc:x", "transactions", mode="append", properties={})


def test_rates_nested_and_flat(spark, tmp_path):
    rates = {"EUR": 0.92, "JPY": 147}
    for name, document in (
        ("flat", rates),
        ("nested", {"result": "ok", "time": 5, "conversion_rates": rates}),
    ):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(document, indent=1))
        got = {r["currency"]: float(r["rate"]) for r in A.read_rates(spark, str(path)).collect()}
        assert got == {"EUR": 0.92, "JPY": 147.0}


def test_orphans_duplicates_and_nulls(spark):
    users = spark.createDataFrame([(1,), (2,)], "user_id bigint")
    methods = spark.createDataFrame(
        [(1, 1), (2, 9), (2, 9), (3, None)], "payment_method_id bigint, user_id bigint"
    )
    tables = {"users": users, "payment_methods": methods}
    report = Q.orphan_report(tables).collect()
    assert [tuple(r) for r in report] == [("payment_methods.user_id", 2, 1)]
    assert [tuple(r) for r in Q.duplicate_keys(methods, "payment_method_id").collect()] == [(2, 2)]
    nulls = {r["column_name"]: r["null_rows"] for r in Q.null_report(methods, S.PAYMENT_METHODS).collect()}
    assert nulls == {"payment_method_id": 0, "user_id": 1}


def test_first_keys_start_at_one(spark):
    empty = spark.createDataFrame([], "user_id bigint, name string")
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    got = U.append_with_keys(empty, new, "user_id", ["name"]).collect()
    assert sorted(tuple(r) for r in got) == [(1, "a"), (2, "b")]


def test_nothing_to_deactivate(spark):
    methods = spark.createDataFrame(
        [(1, 1)], "payment_method_id bigint, payment_is_active int"
    )
    none = spark.createDataFrame([], "payment_method_id bigint")
    assert U.deactivated_rows(methods, none).isEmpty()
    assert U.deactivate(methods, none).first()["payment_is_active"] == 1


def test_snapshots_leave_the_last_complete_one(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        T.read_snapshot(spark, root, "t")
    T.write_snapshot(root, "t", spark.range(3))
    T.write_snapshot(root, "t", T.read_snapshot(spark, root, "t").filter("id > 0"))
    (tmp_path / "t" / "version=3").mkdir()  # a write that failed
    assert sorted(r[0] for r in T.read_snapshot(spark, root, "t").collect()) == [1, 2]
    assert T.write_snapshot(root, "t", spark.range(1)).endswith("version=4")
