"""Language by hierarchical discrimination: the family first, then its members one against one.

Linear support vector machines (squared hinge) on hashed byte sequences of the lower-cased letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, map_with_id

UNDETERMINED = "und"
#: Language codes by family. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv".split(),
    "romance": "ca es fr gl it la oc pt ro".split(),
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk".split(),
    "celtic": "br cy ga gd".split(),
    "baltic": "lt lv".split(),
    "uralic": "et fi hu".split(),
    "turkic": "az kk tr uz".split(),
    "indic": "bn gu hi mr ne pa ur".split(),
}
_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 32, np.uint32)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Settings:
    """``per_language``: expected most rows of a language that the machines are fitted on, taken at
    a rate by the hash of the id."""

    dims: int = 4096
    lengths: tuple[int, ...] = (1, 2, 3, 4)
    per_language: int = 1000
    steps: int = 300
    decay: float = 1e-4
    sharpness: float = 4.0


def family_of(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang in codes), f"={lang}")


def profile(text: str, settings: Settings) -> np.ndarray:
    """Unit vector of root counts of hashed byte sequences of the whole text."""
    data = _FOLD[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    data = data[np.append(True, (data[1:] != 32) | (data[:-1] != 32))]  # one space in a row
    counts = np.zeros(settings.dims)
    for length in settings.lengths:
        if len(data) < length:
            break
        codes = np.full(len(data) - length + 1, length, np.uint32)
        for i in range(length):
            codes = codes * np.uint32(0x01000193) + data[i : i + len(codes)]
        codes = (codes * np.uint32(0x9E3779B1)) >> np.uint32(8)
        counts += np.bincount(codes % np.uint32(settings.dims), minlength=settings.dims)
    root = np.sqrt(counts)
    return (root / max(np.linalg.norm(root), 1e-9)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


@dataclass(frozen=True)
class Machines:
    """One-versus-rest margins ``x @ weights + bias`` for ``names``, which tell families apart."""

    names: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray

    def shares(self, x: np.ndarray, sharpness: float) -> np.ndarray:
        if len(self.names) == 1:
            return np.ones((len(x), 1))
        margins = sharpness * (x @ self.weights + self.bias)
        exp = np.exp(margins - margins.max(axis=1, keepdims=True))
        return exp / exp.sum(axis=1, keepdims=True)


def fit_machines(x: np.ndarray, labels: np.ndarray, settings: Settings) -> Machines:
    """Squared hinge with a ridge, all machines at once, by accelerated gradient steps."""
    names = tuple(sorted(set(labels.tolist())))
    sign = np.where(labels[:, None] == np.array(names), 1.0, -1.0).astype(np.float32)
    # Every class of a machine weighs half, however many rows it has.
    share = np.where(sign > 0, 0.5 / (sign > 0).sum(0), 0.5 / np.maximum((sign < 0).sum(0), 1))
    weights = np.zeros((x.shape[1], len(names)), np.float32)
    bias = np.zeros(len(names), np.float32)
    ahead, ahead_bias = weights, bias
    for step in range(settings.steps):
        slack = np.maximum(0, 1 - sign * (x @ ahead + ahead_bias)) * sign * share
        new = ahead + 0.5 * (2 * x.T @ slack.astype(np.float32) - settings.decay * ahead)
        new_bias = ahead_bias + slack.sum(0).astype(np.float32)
        momentum = step / (step + 3)
        ahead = new + momentum * (new - weights)
        ahead_bias = new_bias + momentum * (new_bias - bias)
        weights, bias = new, new_bias
    return Machines(names, weights, bias)


@dataclass(frozen=True)
class Pairs:
    """A machine for each two of ``names``; a positive margin is a vote for the first of the two."""

    names: tuple[str, ...]
    pairs: tuple[tuple[int, int], ...]
    weights: np.ndarray
    bias: np.ndarray

    def chosen(self, x: np.ndarray, sharpness: float) -> tuple[np.ndarray, np.ndarray]:
        """The name with the most votes, ties by summed margins, then by order; and its share of the
        summed margins, between 0 and 1."""
        if len(self.names) == 1:
            return np.zeros(len(x), int), np.ones(len(x))
        margins = x @ self.weights + self.bias
        votes = np.zeros((len(x), len(self.names)))
        sums = np.zeros_like(votes)
        for k, (a, b) in enumerate(self.pairs):
            votes[:, a] += margins[:, k] >= 0
            votes[:, b] += margins[:, k] < 0
            sums[:, a] += margins[:, k]
            sums[:, b] -= margins[:, k]
        ahead = np.where(votes == votes.max(axis=1, keepdims=True), sums, -np.inf)
        best = ahead.argmax(axis=1)
        exp = np.exp(sharpness * (sums - sums.max(axis=1, keepdims=True)) / (len(self.names) - 1))
        return best, exp[np.arange(len(x)), best] / exp.sum(axis=1)


def fit_pairs(x: np.ndarray, labels: np.ndarray, settings: Settings) -> Pairs:
    """One against one: each machine sees the rows of its two languages only."""
    names = tuple(sorted(set(labels.tolist())))
    pairs = tuple((a, b) for b in range(len(names)) for a in range(b))
    weights = np.zeros((x.shape[1], len(pairs)), np.float32)
    bias = np.zeros(len(pairs), np.float32)
    for k, (a, b) in enumerate(pairs):
        own = (labels == names[a]) | (labels == names[b])
        machine = fit_machines(x[own], labels[own], settings)  # its first column is for names[a]
        weights[:, k], bias[k] = machine.weights[:, 0], machine.bias[0]
    return Pairs(names, pairs, weights, bias)


@dataclass(frozen=True)
class Model:
    families: Machines | None
    members: dict[str, Pairs]
    settings: Settings

    def predict(self, texts) -> tuple[list[str], list[float]]:
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.families else []
        for start in range(0, len(known), 512):
            rows = known[start : start + 512]
            x = np.stack([profile(texts[i], self.settings) for i in rows])
            shares = self.families.shares(x, self.settings.sharpness)
            best = shares.argmax(axis=1)
            for k, family in enumerate(self.families.names):
                inside = np.flatnonzero(best == k)
                if not len(inside):
                    continue
                machines = self.members[family]
                picks, within = machines.chosen(x[inside], self.settings.sharpness)
                for r, pick, share in zip(inside, picks, within):
                    names[rows[r]] = machines.names[pick]
                    scores[rows[r]] = float(shares[r, k] * share)
        return names, scores


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on rows of ``docs`` (doc_id, text, lang) outside the held-out fold with a lang."""
    rows = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    counts = rows.groupBy("lang").count().collect()  # one row per language
    if not counts:
        return Model(None, {}, settings)
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(
        *[F.lit(v) for r in counts for v in (r["lang"], settings.per_language / r["count"])]
    )

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[[has_letter(t) for t in batch["text"]]]
            vectors = [profile(t, settings).astype(np.float16).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "vector": vectors})

    sample = (
        rows.where(place < share[F.col("lang")])
        .select("lang", "text")
        .mapInPandas(describe, "lang string, vector binary")
        .toPandas()
    )
    if not len(sample):
        return Model(None, {}, settings)
    x = np.stack([np.frombuffer(v, np.float16) for v in sample["vector"]]).astype(np.float32)
    langs = sample["lang"].to_numpy()
    families = np.array([family_of(x) for x in langs])
    members = {
        name: fit_pairs(x[families == name], langs[families == name], settings)
        for name in sorted(set(families.tolist()))
    }
    return Model(fit_machines(x, families, settings), members, settings)


def apply(model: Model, docs: DataFrame) -> DataFrame:
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, scores = model.predict(batch["text"].to_numpy())
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "lang_pred": names,
                    "score": scores,
                }
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    return map_with_id(rows, predict, "doc_id long, held_out boolean, lang_pred string, score double")


def language_of_text(model: Model):
    """A function of a column of whole texts: their languages."""

    @F.pandas_udf("string")
    def predict(texts: pd.Series) -> pd.Series:
        return pd.Series(model.predict(texts.to_numpy())[0], dtype=object)

    return predict


def languages(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs`` (doc_id, text, lang, ...).

    Null texts and texts without any letter are ``und`` with score 0, as is every text if no row
    could be learned from. With one language learned every other text gets it with score 1. A row
    with a null doc_id counts as not held out. Other columns are ignored.
    """
    return apply(train(docs, settings), docs)
