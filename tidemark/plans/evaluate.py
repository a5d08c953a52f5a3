"""Evaluation of scored rows: metrics at 0.5 and at the best F1, one row per model."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.plans import metrics as M
from tidemark.plans.dataset import Options, test_rows
from tidemark.plans.models import score
from tidemark.session import materialize

# The header of the report.
COLUMNS = (
    "roc_auc",
    "avg_precision",
    "f1",
    "precision",
    "recall",
    "fpr",
    "threshold",
    "tp",
    "fp",
    "tn",
    "fn",
)


def metrics_at(curve: DataFrame, threshold: DataFrame) -> DataFrame:
    """All metrics at a threshold given as a one-row frame with column ``threshold``."""
    chosen = F.broadcast(threshold.select(F.col("threshold").alias("_at"), F.lit(1).alias("_one")))
    marked = curve.withColumn("_one", F.lit(1)).join(chosen, "_one", "left")
    said = F.col("threshold") >= F.col("_at")
    counts = marked.agg(
        *[
            F.coalesce(F.sum(F.when(hit, F.col(n))), F.lit(0)).alias(c)
            for c, n, hit in (
                ("tn", "neg", ~said),
                ("fp", "neg", said),
                ("fn", "pos", ~said),
                ("tp", "pos", said),
            )
        ],
        F.max("_at").alias("threshold"),
        F.lit(1).alias("_one"),
    )
    ranked = M.ranking_scores(curve).withColumn("_one", F.lit(1))
    # Both sides are a single row.
    return M.with_rates(counts).join(F.broadcast(ranked), "_one").select(*COLUMNS)


def evaluate(
    scored: DataFrame, label: str = S.LABEL, probability: str = "fraud_probability"
) -> DataFrame:
    """Two rows, ``default`` at 0.5 and ``best`` at the threshold of the highest F1.

    The scored rows are read once; everything else works on one row per distinct score.
    """
    curve = materialize(M.precision_recall_curve(scored, label, probability))
    half = scored.sparkSession.createDataFrame([(S.ALERT_THRESHOLD,)], "threshold double")
    rows = {"default": half, "best": M.best_threshold(curve)}
    return reduce(
        DataFrame.unionByName,
        [
            metrics_at(curve, t).select(F.lit(kind).alias("kind"), *COLUMNS)
            for kind, t in rows.items()
        ],
    )


def compare(scored: Mapping[str, DataFrame], label: str, probability: str) -> DataFrame:
    """One report over several models' scored rows."""
    return reduce(
        DataFrame.unionByName,
        [
            evaluate(rows, label, probability).select(F.lit(name).alias("model"), "*")
            for name, rows in scored.items()
        ],
    )


def evaluate_models(
    models: Mapping[str, PipelineModel],
    features: DataFrame,
    test_only: bool = True,
    options: Mapping[str, Options] | None = None,
) -> DataFrame:
    """The metrics of each model on the test part of a feature table, as its options split it."""

    def rows(name: str) -> DataFrame:
        return test_rows(features, (options or {}).get(name, Options())) if test_only else features

    scored = {name: score(model, rows(name)) for name, model in models.items()}
    return compare(scored, S.LABEL, "fraud_probability")


def best_threshold_of(
    pipeline: PipelineModel, features: DataFrame, options: Options = Options()
) -> float:
    """The threshold to store with a model: the best F1 on the test part."""
    scored = score(pipeline, test_rows(features, options))
    curve = M.precision_recall_curve(scored, S.LABEL, "fraud_probability")
    return M.best_threshold(curve).first()["threshold"]
