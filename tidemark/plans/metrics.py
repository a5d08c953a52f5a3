"""Quality of a binary classifier as DataFrame queries over (label, score) rows.

Everything starts from one row per distinct score with its positives and negatives, combined
before the shuffle; running totals over the scores are formed without a single-task window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import running_sums


def score_counts(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score."""
    return scored.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
    )


def precision_recall_curve(
    scored: DataFrame, label: str = "label", score: str = "score"
) -> DataFrame:
    """One point per distinct score, used as threshold: counts, precision, recall and F1."""
    counts = score_counts(scored, label, score)
    summed = running_sums(counts, [F.desc("threshold")], ["pos", "neg"])
    return with_rates(
        summed.select(
            "threshold",
            "pos",
            "neg",
            F.col("running_pos").alias("tp"),
            F.col("running_neg").alias("fp"),
            (F.col("total_pos") - F.col("running_pos")).alias("fn"),
            (F.col("total_neg") - F.col("running_neg")).alias("tn"),
        )
    )


def binned_curve(
    scored: DataFrame, bins: int = 65_536, label: str = "label", score: str = "score"
) -> DataFrame:
    """The curve over at most ``bins`` thresholds, the lower ends of equal parts of [0, 1].

    For so many different scores that a row per score is not less than a row per row. Scores outside
    are taken to the nearest end. ``ranking_bounds`` says how far its scores may be off.
    """
    part = F.least(F.greatest(F.floor(F.col(score) * bins), F.lit(0)), F.lit(bins - 1))
    rows = scored.select(F.col(label).alias("label"), (part / bins).alias("score"))
    return precision_recall_curve(rows.filter(F.col("score").isNotNull()), "label", "score")


def ranking_bounds(curve: DataFrame) -> DataFrame:
    """ROC-AUC and average precision of a binned curve, and between which values those of the
    scores themselves lie: ``roc_auc, roc_auc_low, roc_auc_high, avg_precision_low, avg_precision_high``.

    Nothing is known about the order within a bin. With all its positives ahead of its negatives the
    area is greater by half its pairs, and the other way round it is less by as much. Precision within a
    bin is at most that after its positives came first, and at least that of the first positive after
    all its negatives.
    """
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    positives, negatives = F.sum(pos), F.sum(neg)
    pairs = F.nullif(positives * negatives, F.lit(0.0))
    middle, open_pairs = F.sum((tp - pos / 2) * neg) / pairs, F.sum(pos * neg) / 2 / pairs
    found = F.nullif(positives, F.lit(0.0))
    least = (tp - pos + 1) / (tp - pos + 1 + fp)
    most = F.when(pos > 0, tp / F.nullif(tp + fp - neg, F.lit(0.0)))
    return curve.agg(
        middle.alias("roc_auc"),
        (middle - open_pairs).alias("roc_auc_low"),
        (middle + open_pairs).alias("roc_auc_high"),
        (F.sum(pos * least) / found).alias("avg_precision_low"),
        (F.sum(pos * most) / found).alias("avg_precision_high"),
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def with_rates(counts: DataFrame) -> DataFrame:
    """Add precision, recall, F1 and false-positive rate to confusion counts; 0 over 0 is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "precision": _share(tp, tp + fp),
            "recall": _share(tp, tp + fn),
            "f1": _share(2 * tp, 2 * tp + fp + fn),
            "fpr": _share(fp, fp + tn),
        }
    )


def predictions(scored: DataFrame, threshold: float = 0.5, score: str = "score") -> DataFrame:
    """Add the 0/1 prediction at a threshold, which itself counts as positive."""
    return scored.withColumn("prediction", F.when(F.col(score) >= threshold, 1).otherwise(0))


def confusion(
    scored: DataFrame, threshold: float = 0.5, label: str = "label", score: str = "score"
) -> DataFrame:
    """One row with tn, fp, fn, tp."""
    said, is_pos = F.col(score) >= threshold, F.col(label) == 1
    return scored.agg(
        F.count_if(~said & ~is_pos).alias("tn"),
        F.count_if(said & ~is_pos).alias("fp"),
        F.count_if(~said & is_pos).alias("fn"),
        F.count_if(said & is_pos).alias("tp"),
    )


def ranking_scores(curve: DataFrame) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step sum), one row.

    The pair count is kept in exact integers; both are NULL where one class is absent.
    """
    wide = "decimal(38,0)"
    pairs = F.sum((2 * F.col("tp") - F.col("pos")).cast("decimal(19,0)") * F.col("neg")).cast(wide)
    positives, negatives = F.sum("pos"), F.sum("neg")
    possible = positives.cast("decimal(19,0)") * negatives
    return curve.agg(
        (pairs.cast("double") / F.nullif(2 * possible.cast("double"), F.lit(0.0))).alias(
            "roc_auc"
        ),
        (
            F.sum(F.col("pos") * F.col("precision"))
            / F.nullif(positives.cast("double"), F.lit(0.0))
        ).alias("avg_precision"),
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """The point of the highest F1, the lowest threshold among equals."""
    return curve.select("threshold", "f1").orderBy(F.desc("f1"), "threshold").limit(1)


def nearest_point(curve: DataFrame, threshold: float) -> DataFrame:
    """The curve point closest to a threshold, the lower one among equals."""
    distance = F.abs(F.col("threshold") - threshold)
    return curve.orderBy(distance, "threshold").limit(1)


def base_rate(scored: DataFrame, label: str = "label") -> DataFrame:
    return scored.agg(F.avg(label).alias("base_rate"))
