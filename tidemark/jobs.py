"""The jobs end to end: feature table, training, evaluation, publishing, updates, live scoring.

Each takes a session and where to read and write; tables come from whatever reader is passed, for
instance ``functools.partial(read_jdbc, spark, url, properties=...)``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import updates as U
from tidemark.plans import evaluate as V
from tidemark.plans import models as L
from tidemark.plans.dataset import Options
from tidemark.plans.features import all_features
from tidemark.sources import messages as M
from tidemark.sources.tables import read_features, write_features, write_metrics
from tidemark.streaming import scoring as R


def build_features(read_table: Callable[[str], DataFrame], path: str) -> None:
    """Transactions with their lookups to the feature table."""
    features = all_features(
        read_table("transactions"), read_table("merchants"), read_table("payment_methods")
    )
    write_features(features, path)


def train_models(
    spark: SparkSession,
    features_path: str,
    model_dir: str,
    names: Sequence[str] = tuple(L.MODELS),
    smote: bool = False,
    options: Options = Options(),
    found_categories: bool = False,
    settings: Mapping[str, Mapping] | None = None,
) -> None:
    """Fit and save the named models, each with the threshold of its best F1 and its options."""
    features = read_features(spark, features_path)
    if found_categories:
        options = options.with_found_categories(features)
    for name in names:
        model = L.train(features, name, options, smote, (settings or {}).get(name))
        model = L.with_threshold(model, V.best_threshold_of(model, features, options))
        L.save(model, model_dir, name, options)


def evaluate_saved(
    spark: SparkSession,
    features_path: str,
    model_dir: str,
    report_path: str,
    names: Sequence[str] = tuple(L.MODELS),
) -> DataFrame:
    """Metrics of saved models, each on the rows it was not trained on, also written as CSV."""
    features = read_features(spark, features_path)
    models = {name: L.load(spark, model_dir, name) for name in names}
    options = {name: L.load_options(spark, model_dir, name) for name in names}
    write_metrics(V.evaluate_models(models, features, options=options), report_path)
    return spark.read.option("header", True).option("inferSchema", True).csv(report_path)


def publish_transactions(
    transactions: DataFrame, payment_methods: DataFrame, servers: str, topic: str = "transactions"
) -> None:
    """Send transactions as messages to the topic that scoring reads."""
    M.to_topic(M.to_messages(transactions, payment_methods), servers, topic)


def deactivate_methods(transactions: DataFrame, read_table: Callable, write_table: Callable) -> None:
    """Set the methods that declined transactions name inactive and write the new table.

    ``write_table`` takes a name and a frame; it must not overwrite what ``read_table`` reads, so
    give it ``functools.partial(write_snapshot, root)`` or a table of its own.
    """
    methods = U.methods_to_deactivate(transactions)
    write_table("payment_methods", U.deactivate(read_table("payment_methods"), methods))


def score_topic(
    spark: SparkSession,
    servers: str,
    stores: R.Stores,
    merchants: DataFrame,
    model_dir: str,
    model_name: str = "gbt",
    alert_topic: str = "fraud_alerts",
    alert_table: Callable[[DataFrame], None] | None = None,
):
    """Score the transactions topic and publish alerts; returns the running query.

    ``alert_table`` also receives the alerts of each batch, for instance to append them to a
    database table; like the topic it may see a batch again after a failure, with equal ids.
    """

    def publish(found: DataFrame) -> None:
        M.to_topic(found, servers, alert_topic)
        if alert_table is not None:
            alert_table(found)

    return R.start_scoring(
        M.kafka_stream(spark, servers),
        stores,
        merchants,
        L.load(spark, model_dir, model_name),
        model_name,
        publish=publish,
    )
