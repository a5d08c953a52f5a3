"""From tables to a metrics report."""

from functools import partial

from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.plans import dataset as D
from tidemark.plans import models as L
from tidemark.sources import tables as T
from tidemark.sources.fixture import Fixture


def test_features_training_and_report(spark, tmp_path):
    fx = Fixture(spark, "/root/testdata/sf0.001")
    features, models = str(tmp_path / "features"), str(tmp_path / "models")
    jobs.build_features(lambda name: getattr(fx, name)(), features)
    small = {"rf": {"numTrees": 3, "maxDepth": 3}, "gbt": {"maxIter": 2, "maxDepth": 2}}
    jobs.train_models(spark, features, models, ["rf", "gbt"], settings=small)
    report = jobs.evaluate_saved(spark, features, models, str(tmp_path / "report"), ["rf", "gbt"])
    rows = {(r["model"], r["kind"]): r for r in report.collect()}
    assert set(rows) == {(m, k) for m in ("rf", "gbt") for k in ("default", "best")}
    for model in ("rf", "gbt"):
        assert rows[model, "best"]["f1"] >= rows[model, "default"]["f1"]


def test_exact_split_through_the_jobs(spark, tmp_path):
    """Training and evaluation use the options stored with the model: disjoint, exact per class."""
    fx = Fixture(spark, "/root/testdata/sf0.001")
    path, models = str(tmp_path / "features"), str(tmp_path / "models")
    jobs.build_features(lambda name: getattr(fx, name)(), path)
    options = D.Options(split="exact", fraction=0.3, drop=("user_avg_amount_7d",))
    small = {"rf": {"numTrees": 3, "maxDepth": 3}}
    jobs.train_models(
        spark, path, models, ["rf"], options=options, found_categories=True, settings=small
    )
    stored = L.load_options(spark, models, "rf")
    features = T.read_features(spark, path)
    assert stored == options.with_found_categories(features)
    assert "user_avg_amount_7d" not in L.input_names(stored)
    prepared = D.prepare(features, stored)
    train, test = (
        {r[0]: r[1] for r in df.select("transaction_id", "is_fraudulent").collect()}
        for df in (prepared.train, prepared.test)
    )
    assert not train.keys() & test.keys() and len(train) + len(test) == 1000
    for c in (0, 1):
        n = sum(v == c for v in test.values())
        assert n == int((n + sum(v == c for v in train.values())) * 0.3 + 0.5)
    report = jobs.evaluate_saved(spark, path, models, str(tmp_path / "report"), ["rf"]).first()
    assert report["tp"] + report["fp"] + report["tn"] + report["fn"] == len(test)


def test_split_by_time_tests_on_the_future(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], "transaction_id int, t string"
    ).withColumn("transaction_timestamp", F.col("t").cast("timestamp"))
    options = D.Options(split="time", border="2024-01-02")
    got = {r["transaction_id"]: r["is_test"] for r in D.with_split(df, options).collect()}
    assert got == {1: False, 2: True, 3: False}


def test_methods_are_deactivated_in_a_new_snapshot(spark, tmp_path):
    root = str(tmp_path)
    T.write_snapshot(
        root,
        "payment_methods",
        spark.createDataFrame([(1, 1), (2, 1)], "payment_method_id int, payment_is_active int"),
    )
    declined = spark.createDataFrame(
        [(1, "Declined", "Card Probing"), (2, "Declined", "Botting")],
        "payment_id int, transaction_status string, fraud_type string",
    )
    jobs.deactivate_methods(
        declined, partial(T.read_snapshot, spark, root), partial(T.write_snapshot, root)
    )
    after = T.read_snapshot(spark, root, "payment_methods").collect()
    assert {tuple(r) for r in after} == {(1, 0), (2, 1)}
