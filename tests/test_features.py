"""Feature columns on special cases, and the shape of the plan."""

from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ordering import consecutive, running_sums
from tidemark.plans import features as P
from tidemark.sources.fixture import Fixture


def at(seconds):
    return datetime.fromtimestamp(seconds, timezone.utc)


def transactions(spark, rows):
    schema = (
        "transaction_id string, user_id bigint, device_id bigint, payment_id bigint,"
        " merchant_id bigint, transaction_amount_usd decimal(15,2), transaction_status string,"
        " transaction_country string, transaction_timestamp timestamp"
    )
    return spark.createDataFrame(rows, schema)


def row(i, t, amount="1.00", payment=1, merchant=1, user=1):
    return (str(i), user, 1, payment, merchant, Decimal(amount), "Approved", "US", at(t))


@pytest.mark.parametrize("heavy_rows", [10**9, 0])
def test_special_cases(spark, heavy_rows):
    day = 86400
    tx = transactions(
        spark,
        [
            row(1, 0, amount="0.00"),
            row(2, 40 * day, payment=2, merchant=9),
            row(3, 80 * day, payment=3),
            row(4, 120 * day, payment=4),
        ],
    )
    merchants = spark.createDataFrame([(1, "Travel")], "merchant_id bigint, merchant_category string")
    methods = spark.createDataFrame(
        [(1, at(-day)), (3, at(80 * day + 3600)), (4, at(119 * day))],
        "payment_method_id bigint, created_at timestamp",
    )
    out = {
        r["transaction_id"]: r
        for r in P.all_features(tx, merchants, methods, heavy_rows=heavy_rows).collect()
    }
    assert out["1"]["user_amount_ratio_24h"] is None and out["1"]["user_avg_amount_24h"] == 0
    assert out["1"]["user_stddev_amount_24h"] is None
    assert out["1"]["seconds_since_last_transaction"] is None
    # unknown merchant and unknown payment method
    assert out["2"]["merchant_category"] is None and out["2"]["is_new_merchant_category"] == 1
    assert out["2"]["user_unique_merchant_categories_24h"] == 0
    assert out["2"]["payment_method_age_days"] is None and out["2"]["is_new_payment_method"] == 0
    # method created after the transaction, then exactly one day before
    assert out["3"]["payment_method_age_days"] < 0 and out["3"]["is_new_payment_method"] == 1
    assert out["4"]["payment_method_age_days"] == 1 and out["4"]["is_new_payment_method"] == 0


def test_category_is_not_joined_twice(spark):
    tx = transactions(spark, [row(1, 0)]).withColumn("merchant_category", F.lit("Own"))
    merchants = spark.createDataFrame([(1, "Other")], "merchant_id bigint, merchant_category string")
    assert P.behavioral_features(tx, merchants).first()["merchant_category"] == "Own"


def test_large_amounts_keep_their_spread(spark):
    tx = transactions(spark, [row(i, i, amount=f"{9_999_999_999 + i}.25") for i in range(4)])
    last = {r["transaction_id"]: r for r in P.amount_features(tx).collect()}["3"]
    assert abs(last["user_stddev_amount_24h"] - (5 / 3) ** 0.5) < 1e-9


def test_one_exchange_per_key(spark):
    fx = Fixture(spark, "/root/testdata/sf0.001")
    df = P.all_features(fx.transactions(), fx.merchants(), fx.payment_methods())
    plan = df._jdf.queryExecution().executedPlan().toString()
    # by user: one sort per value column, one by time; by device: two value columns, one by time
    assert plan.count("Sort [user_id") == 5 and plan.count("Sort [device_id") == 3
    assert plan.count("Exchange hashpartitioning(user_id") == 1
    assert plan.count("Exchange hashpartitioning(device_id") == 1
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan


def test_numbers_and_running_sums_across_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
        numbered = consecutive(df, "n", [F.desc("id")], start=11).collect()
        assert all(r["n"] == 11 + 999 - r["id"] for r in numbered)
        summed = running_sums(df, ["id"], ["v"]).collect()
        assert all(r["running_v"] == sum(i % 7 for i in range(r["id"] + 1)) for r in summed)
        assert {r["total_v"] for r in summed} == {sum(i % 7 for i in range(1000))}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_heavy_keys_read_the_input_a_fixed_number_of_times(spark):
    """Two counts of keys, one narrow copy per key column, one reading each for heavy and other users."""
    reads = spark.sparkContext.accumulator(0)

    def counted(r):
        reads.add(1)
        return r

    plain = transactions(spark, [row(i, i * 5000, payment=i % 3, user=i % 2) for i in range(40)])
    tx = spark.createDataFrame(plain.rdd.map(counted), plain.schema)
    merchants = spark.createDataFrame([(1, "Travel")], "merchant_id bigint, merchant_category string")
    methods = spark.createDataFrame([(1, at(0))], "payment_method_id bigint, created_at timestamp")
    reads.value = 0
    rows = P.all_features(tx, merchants, methods, heavy_rows=0).collect()
    assert len(rows) == 40 and reads.value <= 6 * 40
