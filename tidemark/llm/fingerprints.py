"""Document fingerprints by locally consistent parsing.

Each level cuts the sequence of names into phrases of two or three by deterministic coin tossing: a
name is compared with its left neighbour, what remains is a small number at most four rounds later, and
local maxima of these numbers begin phrases. Runs of one name are one phrase. A phrase's name follows
from its content alone, so equal substrings get equal names inside, wherever they stand.

A fingerprint is the smallest hashes of the phrase names of the upper levels; the level below weighs
little, so that it rules only where a text has few phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keep, map_with_id
from tidemark.llm.shingles import mix


@dataclass(frozen=True)
class Settings:
    """``levels`` of phrases, of which those from ``first_level`` on are used (about 12 characters
    and more); of the level below, one name in ``below`` counts as much and the others come after all of
    these; ``kept`` smallest hashes; ``rows`` documents that make one stretch of neighbours; ``characters``
    parsed together."""

    levels: int = 5
    first_level: int = 3
    kept: int = 128
    tosses: int = 4
    rows: int = 2000
    below: int = 16
    characters: int = 400_000


_RUN = np.uint64(0xA0761D6478BD642F)
_STEP = np.uint64(0xE7037ED1A0B428DB)
_REPEAT = np.uint64(0x8EBC6AF09C88C6E3)


def _toss_table() -> np.ndarray:
    """2 * place + bit of the lowest bit in which a label differs from its left neighbour."""
    left, own = np.arange(128, dtype=np.uint8)[:, None], np.arange(128, dtype=np.uint8)[None, :]
    differ = left ^ own
    place = np.bitwise_count((differ & -differ) - np.uint8(1)) % 8
    return (2 * place + ((own >> place) & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table()


def _collapse_runs(names: np.ndarray, heads: np.ndarray, begins: np.ndarray):
    """Runs of an equal name become one name; their length shows in the characters they cover."""
    starts = np.append(True, names[1:] != names[:-1])
    starts[heads] = True
    starts = np.flatnonzero(starts)
    if len(starts) == len(names):
        return names, heads, begins
    lengths = np.diff(np.append(starts, len(names)))
    single = names[starts]
    runs = np.flatnonzero(lengths > 1)
    single[runs] = mix(single[runs] * _STEP + _RUN)
    return single, np.searchsorted(starts, heads), begins[starts]


def _cuts(names: np.ndarray, heads: np.ndarray, tosses: int) -> np.ndarray:
    """Starts of the phrases; no two neighbours of a text are equal."""
    differ = names[1:] ^ names[:-1]
    # Equal names meet only where one text ends and the next begins; those labels are not used.
    place = np.minimum(np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)), 63)
    labels = np.zeros(len(names), np.uint8)
    labels[1:] = 2 * place + ((names[1:] >> place.astype(np.uint64)).astype(np.uint8) & 1)
    second = heads[:-1][np.diff(heads) > 1] if len(heads) > 1 else heads[:0]
    if heads[-1] + 1 < len(names):
        second = np.append(second, heads[-1])
    for toss in range(tosses):
        labels[second] = labels[second + 1] ^ 1  # the first has no left neighbour
        if toss < tosses - 1:
            labels[1:] = _TOSS[(labels[:-1].astype(np.uint16) << 7) | labels[1:]]
    cut = np.zeros(len(labels), bool)
    cut[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    cut[second + 1] = False
    cut[heads[1:] - 1] = False
    cut[heads] = True
    return np.flatnonzero(cut)


def _name_phrases(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One name for each phrase, folded from left to right over its members."""
    lengths = np.diff(np.append(starts, len(names)))
    folded = names[starts] + _RUN
    for i in range(1, int(lengths.max())):
        long = np.flatnonzero(lengths > i)
        folded[long] = (folded[long] ^ (folded[long] >> np.uint64(29))) * _STEP + names[starts[long] + i]
    return mix(folded)


def phrases(texts: list[str], settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every level the names of all phrases of whole non-empty texts, and where texts begin.

    A phrase over a run covers many characters; its name is given once for each usual length.
    """
    lengths = np.array([len(t) for t in texts])
    codes = "".join(texts).encode("utf-32-le", "surrogatepass")
    names = np.frombuffer(codes, np.uint32).astype(np.uint64)
    heads = np.cumsum(lengths) - lengths
    begins = np.arange(len(names))
    end = len(names)
    found = []
    for level in range(settings.levels):
        names, heads, begins = _collapse_runs(names, heads, begins)
        starts = _cuts(names, heads, settings.tosses) if len(names) > 1 else np.zeros(1, int)
        names, heads = _name_phrases(names, starts), np.searchsorted(starts, heads)
        begins = begins[starts]
        copies = np.maximum(np.diff(np.append(begins, end)) // (10 << level), 1)
        if copies.max() == 1:
            found.append((names, heads))
        else:
            found.append((np.repeat(names, copies), (np.cumsum(copies) - copies)[heads]))
    return found


def signatures(texts: list[str | None], settings: Settings) -> list[np.ndarray]:
    """For each text the smallest 32-bit hashes of its phrase names; a name that comes again counts
    again, by its number. All texts use the same levels. Null and empty texts have none."""
    out = [np.empty(0, np.uint32)] * len(texts)
    filled = [i for i, t in enumerate(texts) if t]
    for group in _groups([len(texts[i]) for i in filled], settings.characters):
        rows = filled[group]
        levels = phrases([texts[i] for i in rows], settings)
        hashed = [(mix(names ^ _RUN), np.append(heads, len(names))) for names, heads in levels]
        for k, i in enumerate(rows):
            own = [names[heads[k] : heads[k + 1]] for names, heads in hashed[settings.first_level - 2 :]]
            out[i] = _smallest(np.concatenate(own[1:]), own[0], settings)
    return out


def _groups(lengths: list[int], most: int) -> Iterator[slice]:
    """Consecutive texts of about ``most`` characters, one at least."""
    start = size = 0
    for i, length in enumerate(lengths):
        if size and size + length > most:
            yield slice(start, i)
            start, size = i, 0
        size += length
    if size:
        yield slice(start, len(lengths))


def _counted(names: np.ndarray) -> np.ndarray:
    """Names in order, those that come again as names of their own."""
    names = np.sort(names)
    starts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
    if len(starts) < len(names):
        number = np.arange(len(names)) - np.repeat(starts, np.diff(np.append(starts, len(names))))
        again = np.flatnonzero(number)
        names[again] = mix(names[again] + number[again].astype(np.uint64) * _REPEAT)
    return names


def _smallest(upper: np.ndarray, lower: np.ndarray, settings: Settings) -> np.ndarray:
    """The smallest hashes; a name's lower half decides which of the level below come late."""
    upper, lower = _counted(upper), _counted(lower)
    late = (lower % np.uint64(settings.below) != 0).astype(np.uint32) << np.uint32(31)
    hashes = np.append(upper >> np.uint64(33), lower >> np.uint64(33)).astype(np.uint32)
    hashes[len(upper) :] |= late
    if len(hashes) > 4 * settings.kept:
        hashes = np.partition(hashes, 2 * settings.kept)[: 2 * settings.kept]
    return np.unique(hashes)[: settings.kept]


def written(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, kept: int) -> float:
    """Share of common hashes among the smallest of both; two empty texts are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    least = np.union1d(a, b)[:kept]
    return float(np.isin(least, a, assume_unique=True).astype(int) @ np.isin(least, b, assume_unique=True)) / len(least)


def edited(text: str, following: str) -> str:
    """The last third gives way to as many characters, or all, of the start of what follows."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, fingerprint`` for every row of ``docs`` (doc_id, text, ...); null is as empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            marks = [written(m) for m in signatures(list(batch["text"]), settings)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fingerprint": marks})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_with_id(rows, run, "doc_id long, fingerprint string")


CELLS = 512


def _stretches(docs: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    """Rows with their stretch by descending id, and the number of stretches in a cell.

    Quantiles bound at most ``CELLS`` cells; each is cut into equal spans of ids. A stretch holds
    about ``rows`` rows if ids lie evenly inside cells; if not it is longer, and is streamed anyway.
    """
    ids = docs.select("doc_id").where("doc_id is not null")
    count = ids.count()
    wanted = max(1, -(-count // settings.rows))
    cells = min(CELLS, wanted)
    spans = -(-wanted // cells)
    points = [i / cells for i in range(cells + 1)]
    bounds = sorted({int(b) for b in ids.approxQuantile("doc_id", points, 0.2 / cells)}) if count else []
    if len(bounds) < 2:
        bounds = [bounds[0], bounds[0] + 1] if bounds else [0, 1]
    inner = F.array(*[F.lit(b).cast("long") for b in bounds[1:-1]]).cast("array<bigint>")
    lows = F.array(*[F.lit(b).cast("long") for b in bounds[:-1]])
    highs = F.array(*[F.lit(b).cast("long") for b in bounds[1:]])
    cell = F.size(F.filter(inner, lambda b: b <= F.col("doc_id")))
    placed = docs.withColumn("cell", cell)
    low, high = F.get(lows, F.col("cell")), F.get(highs, F.col("cell"))
    span = (F.col("doc_id") - low).cast("double") * spans / F.greatest(high - low, F.lit(1))
    span = F.greatest(F.least(F.floor(span), F.lit(spans - 1)), F.lit(0))
    rising = F.col("cell").cast("long") * spans + span
    last = (len(bounds) - 1) * spans
    return placed.select(
        "doc_id",
        "text",
        # Null ids come last, in a stretch of their own.
        F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(last - 1 - rising).cast("long").alias("stretch"),
    ), spans


def compared(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to it and the next text.

    Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The next document is by descending id, after the last the first; ids that repeat
    are in the order of their texts, null ids come last, null texts are as empty. A single row is
    its own next. Other columns are ignored.
    """
    rows, spans = _stretches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")),
        settings,
    )
    heads = keep(_heads(rows, spans))
    guests = (
        rows.join(heads, rows["stretch"].eqNullSafe(heads["head_of"]) & rows["doc_id"].eqNullSafe(heads["head_id"]))
        .select("doc_id", "text", F.col("host").alias("stretch"), F.lit(1).alias("guest"))
    )
    placed = rows.withColumn("guest", F.lit(0)).unionByName(guests)
    order = ["stretch", "guest", F.col("doc_id").desc_nulls_last(), "text"]
    together = placed.repartition("stretch").sortWithinPartitions(*order)
    return map_with_id(
        together,
        _compare(settings),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    )


def _heads(rows: DataFrame, spans: int) -> DataFrame:
    """``head_of, head_id, host``: the largest id of each stretch and the stretch before it."""
    largest = (
        rows.groupBy("stretch")
        .agg(F.max("doc_id").alias("head_id"))
        .withColumn("cell", F.floor(F.col("stretch") / spans))
    )
    # One row per cell, of which there are at most CELLS and one.
    cells = largest.groupBy("cell").agg(F.max("stretch").alias("last"))
    around = Window.orderBy("cell")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = cells.select(
        "cell", F.coalesce(F.lag("last").over(around), F.last("last").over(whole)).alias("earlier")
    )
    inside = F.lag("stretch").over(Window.partitionBy("cell").orderBy("stretch"))
    return largest.join(F.broadcast(before), "cell").select(
        F.col("stretch").alias("head_of"), "head_id", F.coalesce(inside, "earlier").alias("host")
    )


def _compare(settings: Settings):
    columns = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next"

    def pairs(batches):
        """Rows whose next row has been seen, a batch at a time, with that next row's text at the end."""
        held, served = None, None
        for batch in batches:
            rows = [] if held is None else [held]
            for row in zip(batch["doc_id"], batch["text"], batch["stretch"], batch["guest"]):
                if row[3] and served == row[2]:
                    continue  # repeated ids make more than one guest; the first is next
                served = row[2] if row[3] else served
                rows.append(row)
            held = None
            if rows and not rows[-1][3]:
                held = rows[-1]
            if rows:
                yield rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in pairs(batches):
            at = [i for i in range(len(rows) - 1) if not rows[i][3]]
            if not at:
                continue
            texts = [r[1] for r in rows]
            changed = [edited(texts[i], texts[i + 1]) for i in at]
            own, other = signatures(texts, settings), signatures(changed, settings)
            out = pd.DataFrame(
                [
                    (
                        rows[i][0],
                        len(texts[i]),
                        hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest(),
                        written(own[i]),
                        written(o),
                        likeness(own[i], o, settings.kept),
                        likeness(own[i], own[i + 1], settings.kept),
                    )
                    for i, c, o in zip(at, changed, other)
                ],
                columns=columns.split(),
            )
            yield out

    return run
