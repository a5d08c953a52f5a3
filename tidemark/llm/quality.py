"""Quality by positive-unlabelled learning with the non-negative risk.

Trusted positives are the rows of the learning fold marked 1; all rows of that fold are the unlabelled
text. Rows marked 0 teach nothing. The class prior is estimated as the least ratio of the two score
tails, over every document of the fold, and the linear model then minimises

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])

on features of the whole text. The text is read once; features are kept in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, keep, map_with_id

FEATURES = (
    "upper lower digit high newline stop_comma exclaim question bar bracket other_symbol"
    " symbol_runs repeated_next distinct_words distinct_lines top_word upper_words symbol_words"
    " word_length long_words log_words"
).split()
BINS = 400
#: Texts of fewer words have their features weighed down.
FULL_WORDS = 20


@dataclass(frozen=True)
class Settings:
    """``sample``: expected most rows of either kind that the weights are fitted on (a rate by the
    hash of the id, so it is the same share of every source). Counts behind the prior cover all."""

    accept: float = 0.7
    sample: int = 20_000
    steps: int = 600
    rate: float = 0.05
    decay: float = 1e-3
    decay_rows: float = 3.0
    clip: float = 8.0
    least_tail: float = 0.8


def features_of(text: str | None) -> np.ndarray:
    """Shares of characters and words, each between 0 and about 1, of the whole text."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    words = text.split()
    n, m = max(len(data), 1), max(len(words), 1)
    count = np.bincount(data, minlength=256)
    upper, lower, digit = count[65:91].sum(), count[97:123].sum(), count[48:58].sum()
    comma = count[46] + count[44]
    bracket = count[[40, 41, 60, 62, 91, 93, 123, 125]].sum()
    symbols = count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()
    other = symbols - comma - count[33] - count[63] - count[124] - bracket
    symbol = ((data > 32) & (data < 128) & ~_LETTER_OR_DIGIT[data]).astype(np.int8)
    runs = int((symbol[1:] & symbol[:-1]).sum())
    tally: dict[str, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    lines = text.split("\n")
    repeated = sum(map(str.__eq__, words[1:], words))
    top = max(tally.values(), default=0) if len(words) > 20 else 0
    distinct = len(tally) / m if len(words) > 20 else 1.0
    shouting = sum(k for w, k in tally.items() if len(w) > 2 and w.isupper())
    marked = sum(k for w, k in tally.items() if not w[-1].isalnum() and w[-1] not in ".,;:)\"'")
    lengths = sum(k * len(w) for w, k in tally.items())
    long_words = sum(k for w, k in tally.items() if len(w) > 30)
    return np.array(
        [
            *(x / n for x in (upper, lower, digit, count[128:].sum(), count[10])),
            *(x / m for x in (comma, count[33], count[63], count[124], bracket, other, runs)),
            repeated / m,
            distinct,
            len(set(lines)) / len(lines),
            top / m,
            shouting / m,
            marked / m,
            min(lengths / m, 40) / 40,
            long_words / m,
            np.log1p(len(words)) / 10,
        ],
        np.float32,
    )


_LETTER_OR_DIGIT = np.zeros(256, bool)
_LETTER_OR_DIGIT[48:58] = _LETTER_OR_DIGIT[65:91] = _LETTER_OR_DIGIT[97:123] = True


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame(
            {
                "doc_id": batch["doc_id"],
                "held_out": batch["held_out"],
                "features": [features_of(t) for t in batch["text"]],
            }
        )


def described(docs: DataFrame) -> DataFrame:
    return map_with_id(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
        ),
        _describe,
        "doc_id long, held_out boolean, features array<float>",
    )


@dataclass(frozen=True)
class Model:
    """Linear margin over clipped standard features; ``weights`` None gives score 1 to all."""

    middle: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    prior: float = 1.0
    clip: float = 8.0
    losses: list = field(default_factory=list)

    def inputs(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.middle) / self.scale, -self.clip, self.clip)
        # Shares of a few words say little: they count less.
        z *= np.sqrt(np.minimum(np.expm1(10 * features[:, -1:]) / FULL_WORDS, 1.0))
        return np.hstack([z, np.abs(z), np.ones((len(z), 1))])

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(features))
        return _sigmoid(self.inputs(features) @ self.weights)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _descend(gradient, size: int, rows: int, settings: Settings) -> np.ndarray:
    """Adam on the whole sample; few rows are held back more."""
    decay = settings.decay + settings.decay_rows / rows
    weights, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, settings.steps + 1):
        g = gradient(weights) + decay * np.append(weights[:-1], 0)  # the bias is free
        mean = 0.9 * mean + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        rate = settings.rate * min(1.0, 2 * (1 - step / (settings.steps + 1)))
        weights = weights - rate * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.999**step)) + 1e-9
        )
    return weights


def fit_contrast(positive: np.ndarray, unlabelled: np.ndarray, settings: Settings) -> Model:
    """Logistic contrast of positives with unlabelled rows, whose score orders rows for the prior."""
    middle = np.median(positive, axis=0)
    scale = positive.std(axis=0) + 1e-3
    model = Model(middle, scale, None, 1.0, settings.clip)
    p, u = model.inputs(positive), model.inputs(unlabelled)

    def gradient(w):
        return (p.T @ (_sigmoid(p @ w) - 1)) / len(p) + (u.T @ _sigmoid(u @ w)) / len(u)

    weights = _descend(gradient, p.shape[1], len(p), settings)
    return Model(middle, scale, weights, 1.0, settings.clip)


def prior_from_tails(positive: np.ndarray, unlabelled: np.ndarray, least_tail: float) -> float:
    """Least ratio of the unlabelled to the positive upper tail, over tails that are not thin."""
    tail_p = np.cumsum(positive[::-1]) / max(positive.sum(), 1)
    tail_u = np.cumsum(unlabelled[::-1]) / max(unlabelled.sum(), 1)
    ratios = tail_u[tail_p >= least_tail] / tail_p[tail_p >= least_tail]
    return float(np.clip(ratios.min(), 0.01, 1.0)) if len(ratios) else 1.0


def fit_non_negative(
    contrast: Model, positive: np.ndarray, unlabelled: np.ndarray, prior: float, settings: Settings
) -> Model:
    p, u = contrast.inputs(positive), contrast.inputs(unlabelled)

    def gradient(w):
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        good = prior * (p.T @ (sp - 1)) / len(p)
        risk = -np.log(1 - su + 1e-12).mean() + prior * np.log(1 - sp + 1e-12).mean()
        bad = (u.T @ su) / len(u) - prior * (p.T @ sp) / len(p)
        # Below zero the negative part of the risk is no evidence: step back from it instead.
        return good + bad if risk >= 0 else -bad

    weights = _descend(gradient, p.shape[1], len(p), settings)
    return Model(contrast.middle, contrast.scale, weights, prior, contrast.clip)


def train(rows: DataFrame, settings: Settings = Settings()) -> Model:
    """``rows``: features, trusted (boolean), doc_id of the learning fold."""
    total, trusted = rows.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.col("trusted").cast("int")), F.lit(0))
    ).first()
    if not trusted:
        return Model()
    place = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    share_p, share_u = settings.sample / trusted, settings.sample / total
    sample = (
        rows.withColumn("in_p", F.col("trusted") & (place < share_p))
        .withColumn("in_u", place < share_u)
        .where("in_p or in_u")
        .select("in_p", "in_u", "features")
        .toPandas()
    )
    values = np.stack(sample["features"].to_numpy()).astype(float)
    positive = values[sample["in_p"].to_numpy(bool)]
    unlabelled = values[sample["in_u"].to_numpy(bool)]
    contrast = fit_contrast(positive, unlabelled, settings)
    counts = (
        rows.select("trusted", _scorer(contrast)("features").alias("score"))
        .groupBy(F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("u"), F.sum(F.col("trusted").cast("int")).alias("p"))
        .toPandas()  # one row per bin
    )
    tally = np.zeros((2, BINS))
    tally[0, counts["bin"].astype(int)], tally[1, counts["bin"].astype(int)] = counts["p"], counts["u"]
    prior = prior_from_tails(tally[0], tally[1], settings.least_tail)
    return fit_non_negative(contrast, positive, unlabelled, prior, settings)


def _scorer(model: Model):
    @F.pandas_udf("double")
    def score(features: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(features.to_numpy()).astype(float)))

    return score


def quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (doc_id, text, ...).

    ``labels`` holds doc_id and quality; an id marked both 0 and 1 is not trusted. Null and empty
    texts are described by zero counts and scored like others. A row with a null doc_id is scored
    but neither held out nor trusted. Without trusted rows nothing is known against any text and
    every score is 1. Repeated rows come back repeated. Other columns are ignored.
    """
    rows = keep(described(docs))
    model = _fitted(rows, labels, settings)
    return rows.select("doc_id", "held_out", _scorer(model)("features").alias("score")).withColumn(
        "predicted", (F.col("score") >= settings.accept).cast("int")
    )


def fitted(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """The classifier that ``quality`` scores by."""
    return _fitted(keep(described(docs)), labels, settings)


def score_of_text(model: Model):
    """A function of a column of whole texts: their scores."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack([features_of(t) for t in texts]).astype(float)))

    return score


def _fitted(rows: DataFrame, labels: DataFrame, settings: Settings) -> Model:
    trusted = (
        labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("least"))
        .where("least = 1")
        .select("doc_id", F.lit(True).alias("trusted"))
    )
    learning = (
        rows.where(~F.col("held_out"))
        .join(trusted, "doc_id", "left")
        .select("doc_id", F.coalesce("trusted", F.lit(False)).alias("trusted"), "features")
    )
    return train(keep(learning), settings)
