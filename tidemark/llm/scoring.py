"""Documents scored by masked pseudo-likelihood of a bidirectional window network.

Every word is predicted from the words on both sides; a document's score is the sum of the log
probabilities. The vocabulary comes from counts over all documents: the commonest words have tokens of
their own, others share a token by their first byte and are then spelled, byte by byte, so that every
word has a probability of its own and those of all words sum to 1. A token is predicted in two steps, its
class and its place in it.

The network is trained in numpy inside tasks, on every word of every document once: a round takes the
documents that their digests deal to it, dealt again to learners of about equally many words. Each learner
improves the same weights, and the weights are averaged, block by block, weighted by positions. Who learns
what, and in which order, follows from ids and texts alone, not from how rows lie in partitions.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, keep, map_with_id
from tidemark.llm.shingles import words_of


@dataclass(frozen=True)
class Settings:
    """``classes`` x ``places`` tokens, of which ``shared`` are for words without their own.
    ``share``: about so many words make one learner's part of a round; ``partitions``: most tasks of one.
    ``smoothing``: weight of the shorter context in spelling, in counts."""

    classes: int = 32
    places: int = 32
    shared: int = 64
    sides: int = 2
    width: int = 24
    rounds: int = 3
    batch: int = 4096
    rate: float = 0.05
    block: int = 1024
    share: int = 1_000_000
    partitions: int = 20_000
    smoothing: float = 4.0
    positions: int = 100_000
    seed: int = 23

    @property
    def tokens(self) -> int:
        return self.classes * self.places


# --- vocabulary ---------------------------------------------------------------------------------


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial counts; they leave the task whenever they have grown."""
    counts: Counter = Counter()

    def taken():
        frame = pd.DataFrame({"word": list(counts), "count": list(counts.values())})
        counts.clear()
        return frame

    for batch in batches:
        for text in batch["text"]:
            counts.update(words_of(text))
            if len(counts) > 300_000:
                yield taken()
    yield taken()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, count`` over all documents."""
    return (
        docs.select("text")
        .mapInPandas(_count_words, "word binary, count long")
        .groupBy("word")
        .agg(F.sum("count").alias("count"))
    )


class Spelling:
    """Probability of a word without a token of its own, given the token it shares.

    The first byte is drawn from those of the token, each further one given the byte before and the five
    low bits of the one before that; a space ends the word. Contexts back off to the byte before, and that
    to equal chances. What the words with tokens of their own would take is dealt to the others.
    """

    CONTEXTS = 32
    CELLS = 256 * CONTEXTS * 256
    SPACE = 32

    def __init__(self, counts: np.ndarray, own: list[bytes], settings: Settings):
        self.shared = settings.shared
        counts = np.asarray(counts, np.float64).reshape(256, self.CONTEXTS, 256)
        equal = np.ones(256)
        equal[9:14] = 0  # the other white space is in no word
        short = counts.sum(axis=1)
        self.firsts = short[self.SPACE]
        first = self.firsts + settings.smoothing * equal / equal.sum()
        first[self.SPACE] = 0
        token = np.arange(256) % self.shared
        short = _backed_off(short, equal / equal.sum(), settings.smoothing)
        steps = _backed_off(counts, short[:, None, :], settings.smoothing)
        with np.errstate(divide="ignore"):
            self.steps = np.log(steps).astype(np.float32).ravel()
            self.first = np.log(first / np.bincount(token, first, self.shared)[token])
        self.left = np.zeros(self.shared)
        if own:
            taken = np.bincount([w[0] % self.shared for w in own], np.exp(self.logs_of(own)), self.shared)
            self.left = np.log1p(-np.minimum(taken, 1 - 1e-9))

    @classmethod
    def cells(cls, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each byte of the words and the space after each: its context and itself as one number.
        Also where words begin."""
        codes = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.int32)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        starts = np.cumsum(lengths) - lengths
        context = codes[:-1] * cls.CONTEXTS
        context[1:] += codes[:-2] % cls.CONTEXTS
        context[starts] = cls.SPACE * cls.CONTEXTS
        return context * 256 + codes[1:], starts

    def logs_of(self, words: list[bytes]) -> np.ndarray:
        cells, starts = self.cells(words)
        logs = self.steps[cells].astype(np.float64)
        first = cells[starts] % 256
        logs[starts] = self.first[first]
        return np.add.reduceat(logs, starts) - self.left[first % self.shared]


def _backed_off(counts: np.ndarray, shorter: np.ndarray, smoothing: float) -> np.ndarray:
    return (counts + smoothing * shorter) / (counts.sum(axis=-1, keepdims=True) + smoothing)


def _count_steps(own: dict[bytes, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally = np.zeros(Spelling.CELLS, np.int64)
        for batch in batches:
            rare = [(w, n) for w, n in zip(batch["word"], batch["count"]) if w not in own]
            if rare:
                words, times = zip(*rare)
                cells, starts = Spelling.cells(words)
                np.add.at(tally, cells, np.repeat(times, np.diff(np.append(starts, len(cells)))))
        used = np.flatnonzero(tally)
        yield pd.DataFrame({"cell": used, "count": tally[used]})

    return run


def spelling_of(counts: DataFrame, own: dict[bytes, int], settings: Settings) -> Spelling:
    """From the bytes of all words without tokens of their own, each as often as it occurs."""
    steps = counts.mapInPandas(_count_steps(own), "cell int, count long").groupBy("cell")
    found = steps.agg(F.sum("count").alias("count")).toPandas()  # at most ``CELLS`` rows
    tally = np.zeros(Spelling.CELLS)
    tally[found["cell"].to_numpy(int)] = found["count"]
    return Spelling(tally, list(own), settings)


class Vocabulary:
    """Tokens of words and the log probabilities of their spelling; remembers words until it has grown."""

    LIMIT = 400_000

    def __init__(self, own: dict[bytes, int], spelling: Spelling, settings: Settings):
        self.own, self.spelling = own, spelling
        self.first = settings.tokens - settings.shared
        self._forget(0)

    def _forget(self, room: int) -> None:
        size = len(self.own) + max(self.LIMIT, room)
        self.place = dict(self.own)
        self.token, self.spelled = np.zeros(size, np.uint16), np.zeros(size)
        self.token[: len(self.own)] = np.arange(len(self.own))

    def read(self, texts: list[list[bytes]]) -> tuple[list[bytes], list[float]]:
        """Per text its tokens, and the summed log probability of how its words are spelled."""
        words = set().union(*texts)
        if len(self.place) + len(words) > len(self.token):
            self._forget(len(words))
        new = [w for w in words if w not in self.place]
        if new:
            start, end = len(self.place), len(self.place) + len(new)
            self.place.update(zip(new, range(start, end)))
            self.token[start:end] = [self.first + w[0] % self.spelling.shared for w in new]
            self.spelled[start:end] = self.spelling.logs_of(new)
        places = [np.fromiter(map(self.place.__getitem__, t), np.int32, len(t)) for t in texts]
        return (
            [self.token[p].tobytes() for p in places],
            [float(self.spelled[p].sum()) for p in places],
        )


#: Texts whose words are looked up together.
TOGETHER = 64


def _tokenised(docs: DataFrame, own: dict[bytes, int], spelling: Spelling, settings: Settings) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary(own, spelling, settings)
        for batch in batches:
            tokens, spelled = [], []
            for start in range(0, len(batch), TOGETHER):
                part = batch["text"].iloc[start : start + TOGETHER]
                more = vocabulary.read(list(map(words_of, part)))
                tokens += more[0]
                spelled += more[1]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "tokens": tokens, "spelled": spelled})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_with_id(rows, run, "doc_id long, tokens binary, spelled double")


# --- network ------------------------------------------------------------------------------------


class Network:
    """Embeddings per side, one hidden layer, a class and a place output, each with a bias."""

    NAMES = ("sides", "hidden_bias", "classes", "class_bias", "places", "place_bias")

    def __init__(self, settings: Settings, weights: np.ndarray):
        s = settings
        self.settings = s
        shapes = (
            (2 * s.sides, s.tokens + 1, s.width),
            (s.width,),
            (s.width, s.classes),
            (s.classes,),
            (s.classes, s.width, s.places),
            (s.classes, s.places),
        )
        self.flat = np.array(weights, np.float32)
        self.parts, at = {}, 0
        for name, shape in zip(self.NAMES, shapes):
            size = int(np.prod(shape))
            self.parts[name] = self.flat[at : at + size].reshape(shape)
            at += size

    @staticmethod
    def size(s: Settings) -> int:
        return (
            2 * s.sides * (s.tokens + 1) * s.width
            + s.width
            + (s.width + 1) * s.classes
            + s.classes * (s.width + 1) * s.places
        )

    @classmethod
    def begun(cls, settings: Settings, counts: np.ndarray) -> "Network":
        """Small random weights; the biases give every token its frequency."""
        random = np.random.default_rng(settings.seed)
        network = cls(settings, random.normal(0, 0.1, cls.size(settings)))
        share = (counts + 1.0).reshape(settings.classes, settings.places)
        network.parts["hidden_bias"][:] = 0
        network.parts["class_bias"][:] = np.log(share.sum(1) / share.sum())
        network.parts["place_bias"][:] = np.log(share / share.sum(1, keepdims=True))
        return network

    def windows(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Tokens around positions of a padded sequence, a column for each side and distance."""
        s = self.settings.sides
        return np.stack([padded[at + d] for d in (*range(-s, 0), *range(1, s + 1))]).T

    def hidden(self, windows: np.ndarray) -> np.ndarray:
        sides = self.parts["sides"]
        total = sides[0][windows[:, 0]] + self.parts["hidden_bias"]
        for side in range(1, windows.shape[1]):
            total += sides[side][windows[:, side]]
        return np.tanh(total)

    def _place_outputs(self, hidden: np.ndarray, classes: np.ndarray):
        """Rows in the order of their classes: that order, the slice of each class, and the outputs."""
        p = self.parts
        used, order, starts = _sorted_groups(classes)
        parts = [(c, slice(a, b)) for c, a, b in zip(used, starts, np.append(starts[1:], len(order)))]
        sorted_hidden = hidden[order]
        out = p["place_bias"][classes[order]]
        for c, rows in parts:
            out[rows] += sorted_hidden[rows] @ p["places"][c]
        return order, parts, out

    def log_probabilities(self, windows: np.ndarray, targets: np.ndarray) -> np.ndarray:
        p, places = self.parts, self.settings.places
        hidden = self.hidden(windows)
        classes, place = targets // places, targets % places
        out = hidden @ p["classes"] + p["class_bias"]
        result = out[np.arange(len(out)), classes] - _log_sum(out)
        order, _, out = self._place_outputs(hidden, classes)
        result[order] += out[np.arange(len(out)), place[order]] - _log_sum(out)
        return result.astype(np.float64)

    def learn(self, windows: np.ndarray, targets: np.ndarray, squares: "Network") -> None:
        """One step down the mean negative log probability, scaled by past squares."""
        p, s = self.parts, self.settings
        hidden = self.hidden(windows)
        classes, place = targets // s.places, targets % s.places
        rows = np.arange(len(targets))
        out = _softmax(hidden @ p["classes"] + p["class_bias"])
        out[rows, classes] -= 1
        out /= len(targets)
        back = out @ p["classes"].T
        steps = {"classes": hidden.T @ out, "class_bias": out.sum(0)}
        places, place_bias = np.zeros_like(p["places"]), np.zeros_like(p["place_bias"])
        order, parts, inner = self._place_outputs(hidden, classes)
        inner = _softmax(inner)
        inner[rows, place[order]] -= 1
        inner /= len(targets)
        sorted_hidden, sorted_back = hidden[order], np.empty_like(back)
        for c, mine in parts:
            places[c], place_bias[c] = sorted_hidden[mine].T @ inner[mine], inner[mine].sum(0)
            sorted_back[mine] = inner[mine] @ p["places"][c].T
        back[order] += sorted_back
        steps |= {"places": places, "place_bias": place_bias}
        back *= 1 - hidden * hidden
        steps["hidden_bias"] = back.sum(0)
        for name, step in steps.items():
            squares.parts[name] += step * step
            p[name] -= s.rate * step / (np.sqrt(squares.parts[name]) + 1e-6)
        for side in range(windows.shape[1]):
            used, order, starts = _sorted_groups(windows[:, side])
            step = np.add.reduceat(back[order], starts, axis=0)
            square = squares.parts["sides"][side]
            square[used] += step * step
            p["sides"][side][used] -= s.rate * step / (np.sqrt(square[used]) + 1e-6)


def _sorted_groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values below 65,536, the order that sorts them, and where each begins in it."""
    order = np.argsort(values.astype(np.uint16), kind="stable")
    ordered = values[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    return ordered[starts], order, starts


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    return np.log(np.exp(x - top[:, None]).sum(axis=1)) + top


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


# --- work over documents ------------------------------------------------------------------------


def _joined(parts: list[np.ndarray], settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents with padding between: number of words of each, the padded sequence, places of words."""
    gap = settings.sides
    lengths = np.array([len(p) for p in parts])
    starts = gap + np.cumsum(lengths + gap) - lengths - gap
    padded = np.full(int(lengths.sum()) + gap * (len(parts) + 1), settings.tokens, np.int32)
    for start, part in zip(starts, parts):
        padded[start : start + len(part)] = part
    return lengths, padded, np.flatnonzero(padded != settings.tokens)


class Learner:
    """Improves weights on documents that it is given one by one, in a shuffled order of positions."""

    def __init__(self, number: int, turn: int, weights: np.ndarray, settings: Settings):
        self.number, self.settings = number, settings
        self.network = Network(settings, weights)
        self.squares = Network(settings, np.full(len(weights), 1e-4))
        self.random = np.random.default_rng([settings.seed, turn, number])
        self.parts, self.size, self.seen = [], 0, 0

    def add(self, tokens: bytes) -> None:
        self.parts.append(np.frombuffer(tokens, np.uint16))
        self.size += len(self.parts[-1])
        if self.size >= self.settings.positions:
            self.learn()

    def learn(self) -> None:
        _, padded, at = _joined(self.parts, self.settings)
        at = self.random.permutation(at)
        for start in range(0, len(at), self.settings.batch):
            part = at[start : start + self.settings.batch]
            self.network.learn(self.network.windows(padded, part), padded[part], self.squares)
        self.seen += len(at)
        self.parts, self.size = [], 0

    def blocks(self, salts: int) -> pd.DataFrame:
        """The weights times the positions learned from, by blocks."""
        if self.size:
            self.learn()
        flat, block = self.network.flat, self.settings.block
        starts = range(0, len(flat), block) if self.seen else ()
        return pd.DataFrame(
            {
                "block": np.arange(len(starts)),
                "salt": self.number % salts,
                "learner": self.number,
                "weight": float(self.seen),
                "values": [(flat[b : b + block] * np.float64(self.seen)).tobytes() for b in starts],
            }
        )


def _improved(tokens: DataFrame, weights: np.ndarray, turn: int, learners: int, settings: Settings) -> DataFrame:
    """``block, salt, learner, weight, values``: what every learner makes of the weights, by blocks."""
    salts = _salts(learners)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at_work = None
        for batch in batches:
            for number, words in zip(batch["learner"].tolist(), batch["tokens"]):
                if at_work is None or at_work.number != number:
                    if at_work:
                        yield at_work.blocks(salts)
                    at_work = Learner(number, turn, weights, settings)
                at_work.add(words)
        if at_work:
            yield at_work.blocks(salts)

    # Rows without an id may be a great many with one text: those are dealt by their place instead.
    place = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    dealt = tokens.select("doc_id", "tokens", F.xxhash64("doc_id", "tokens", place).alias("digest"))
    tasks = min(learners, settings.partitions)
    learner = F.pmod(F.shiftright("digest", 8), F.lit(learners))
    return (
        dealt.where(F.pmod("digest", F.lit(settings.rounds)) == turn)
        .withColumn("learner", learner)
        .repartitionById(tasks, F.pmod("learner", F.lit(tasks)).cast("int"))
        .sortWithinPartitions("learner", "digest", "doc_id")
        .select("learner", "tokens")
        .mapInPandas(run, "block int, salt int, learner long, weight double, values binary")
    )


def _salts(learners: int) -> int:
    """Parts that each block is added up in, of at most 256 learners each."""
    return -(-learners // 256)


def _summed(keys: list[str], by: str):
    """Sums in the order of ``by``, so that they are the same to the last bit."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(by)
        total = sum(np.frombuffer(v) for v in rows["values"])
        first = {k: rows[k].iloc[:1] for k in keys}
        return pd.DataFrame({**first, "weight": rows["weight"].sum(), "values": [total.tobytes()]})

    return add


def _averaged(improved: DataFrame) -> np.ndarray | None:
    """Mean over learners, added up in two steps so that no task meets all learners."""
    partial = improved.groupBy("block", "salt").applyInPandas(
        _summed(["block", "salt"], "learner"), "block int, salt int, weight double, values binary"
    )
    whole = partial.groupBy("block").applyInPandas(
        _summed(["block"], "salt"), "block int, weight double, values binary"
    )
    rows = sorted(whole.collect(), key=lambda r: r["block"])  # the size of the network
    if not rows:
        return None
    return np.concatenate([np.frombuffer(r["values"]) / r["weight"] for r in rows])


def train(docs: DataFrame, settings: Settings = Settings()) -> tuple[Network, DataFrame]:
    """The network, and the token table of all rows in the shared folder."""
    counts = keep(word_counts(docs))
    common = (
        counts.orderBy(F.col("count").desc(), "word").limit(settings.tokens - settings.shared).collect()
    )
    own = {bytes(r["word"]): i for i, r in enumerate(common)}
    spelling = spelling_of(counts, own, settings)
    tally = np.zeros(settings.tokens)
    tally[: len(common)] = [r["count"] for r in common]
    tally[settings.tokens - settings.shared :] = np.bincount(
        np.arange(256) % settings.shared, spelling.firsts, settings.shared
    )
    tokens = keep(_tokenised(docs, own, spelling, settings))
    network = Network.begun(settings, tally)
    learners = max(1, math.ceil(tally.sum() / settings.rounds / settings.share))
    for turn in range(settings.rounds):
        weights = _averaged(_improved(tokens, network.flat, turn, learners, settings))
        if weights is not None:
            network = Network(settings, weights)
    discard(counts)
    return network, tokens


def apply(network: Network, tokens: DataFrame) -> DataFrame:
    settings = network.settings

    def score(rows: list[tuple]) -> pd.DataFrame:
        lengths, padded, at = _joined([np.frombuffer(r[1], np.uint16) for r in rows], settings)
        sums = np.array([r[2] for r in rows])
        owner = np.repeat(np.arange(len(rows)), lengths)
        for start in range(0, len(at), 16_384):
            part = at[start : start + 16_384]
            logs = network.log_probabilities(network.windows(padded, part), padded[part])
            sums += np.bincount(owner[start : start + 16_384], logs, len(rows))
        return pd.DataFrame({"doc_id": [r[0] for r in rows], "n_tokens": lengths, "log_prob": sums})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(batch["doc_id"], batch["tokens"], batch["spelled"]):
                rows.append(row)
                size += len(row[1]) // 2
                if size >= settings.positions:
                    yield score(rows)
                    rows, size = [], 0
        if rows:
            yield score(rows)

    scored = map_with_id(tokens, run, "doc_id long, n_tokens long, log_prob double")
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return scored.withColumn("mean_log_prob", mean).withColumn("perplexity", F.exp(-mean))


def scored(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_tokens, log_prob, mean_log_prob, perplexity`` for every row of ``docs``.

    All words of the whole text are predicted, and all are trained on. Null, empty and blank texts have
    no words, log_prob 0 and null mean and perplexity. Rows with a null id are scored too, repeated rows
    come back repeated, other columns are ignored. Scores don't depend on the layout of ``docs``, unless
    rows lack an id: those are dealt to learners by their place.
    """
    network, tokens = train(docs, settings)
    return apply(network, tokens)
