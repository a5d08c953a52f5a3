"""Approximate distinct counts over event-time frames, from sketches merged along the frame.

Every second with values becomes a small HyperLogLog sketch. A frame's sketch is the merge of its seconds,
kept by two stacks: new seconds are merged into the sum of the back stack; when the front stack runs out, the
back one is turned over and merged from its newest second to its oldest once. So a second is merged twice,
however long the frame is, and what is held is one sketch per second of the frame at most.

Where frames are small, those of many keys are worked out at once from the values they hold, which gives the
same numbers: a sketch is a list of its registers, and of these only counts by rank matter.

The work is split by key and day; a day also gets what its frames reach back to. Values are made distinct per
key and second before the shuffle, so a key of any size is many bounded groups.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import DAY

SLICE_SECONDS = DAY
# Values looked at for each row of a group, on average, above which its frames are moved second by second.
_FRAME_VALUES = 1024
_CARRIED = 16_384  # rows of a group that are held until its end is known
_AT_ONCE = 1 << 20  # values looked at together


@dataclass(frozen=True)
class FrameApproxDistinct:
    """Number of different non-NULL values of a column in ``[t - seconds, t]``, estimated.

    The relative standard error is 1.04 over the root of ``registers``, a power of two.
    """

    name: str
    column: str
    seconds: int
    registers: int = 2048


def observed(hashes: np.ndarray, registers: int) -> tuple[np.ndarray, np.ndarray]:
    """The register of each 64-bit hash and the rank it offers, as (registers, ranks)."""
    hashes = hashes.astype(np.int64).view(np.uint64)
    index_bits = registers.bit_length() - 1
    where = (hashes >> np.uint64(64 - index_bits)).astype(np.int64)
    rest = (hashes << np.uint64(index_bits)) >> np.uint64(index_bits)
    # Leading zeros among the remaining bits, plus one; halves are exact as doubles.
    upper = np.frexp((rest >> np.uint64(32)).astype(float))[1]
    lower = np.frexp((rest & np.uint64(0xFFFFFFFF)).astype(float))[1]
    length = np.where(upper > 0, upper + 32, lower)
    return where, (64 - index_bits - length + 1).astype(np.uint8)


@lru_cache(1 << 14)  # of a count of registers
def _sigma(x: float) -> float:
    if x == 1.0:
        return np.inf
    y, z = 1.0, x
    while True:
        x *= x
        before = z
        z += x * y
        y += y
        if z == before:
            return z


@lru_cache(1 << 14)
def _tau(x: float) -> float:
    if x in (0.0, 1.0):
        return 0.0
    y, z = 1.0, 1 - x
    while True:
        x = np.sqrt(x)
        before = z
        y *= 0.5
        z -= (1 - x) ** 2 * y
        if z == before:
            return z / 3


def estimate(sketch: np.ndarray) -> float:
    """Distinct values seen by a sketch, by the estimator that is unbiased over the whole range."""
    registers = len(sketch)
    top = 64 - (registers.bit_length() - 1)
    counts = np.bincount(sketch, minlength=top + 2).tolist()
    z = registers * _tau(1 - counts[top + 1] / registers)
    for rank in range(top, 0, -1):
        z = 0.5 * (z + counts[rank])
    z += registers * _sigma(counts[0] / registers)
    return registers * registers / (2 * np.log(2) * z)


def estimates(counts: np.ndarray, registers: int) -> np.ndarray:
    """``estimate`` of sketches given by how many registers hold each rank, one in a row."""
    top = 64 - (registers.bit_length() - 1)
    last, where = np.unique(counts[:, top + 1], return_inverse=True)
    z = registers * np.array([_tau(1 - c / registers) for c in last.tolist()])[where]
    for rank in range(top, 0, -1):
        z = 0.5 * (z + counts[:, rank])
    empty, where = np.unique(counts[:, 0], return_inverse=True)
    z += registers * np.array([_sigma(c / registers) for c in empty.tolist()])[where]
    return registers * registers / (2 * np.log(2) * z)


class Frame:
    """The sketch of the seconds in ``[t - seconds, t]`` while ``t`` moves on."""

    def __init__(self, seconds: int, registers: int):
        self.seconds, self.registers = seconds, registers
        self.front: list[tuple[int, np.ndarray]] = []  # merged with all newer ones of the front
        self.back: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.newer = np.zeros(registers, np.uint8)

    def add(self, second: int, hashes: np.ndarray) -> None:
        where, rank = observed(hashes, self.registers)
        self.back.append((second, where, rank))
        np.maximum.at(self.newer, where, rank)

    def at(self, second: int) -> int:
        oldest = second - self.seconds
        while True:
            while self.front and self.front[-1][0] < oldest:
                self.front.pop()
            if self.front or not self.back or self.back[0][0] >= oldest:
                break
            merged = np.zeros(self.registers, np.uint8)
            for moment, where, rank in reversed(self.back):
                if moment < oldest:
                    break
                merged = merged.copy()
                np.maximum.at(merged, where, rank)
                self.front.append((moment, merged))
            self.back, self.newer = [], np.zeros(self.registers, np.uint8)
        whole = np.maximum(self.front[-1][1], self.newer) if self.front else self.newer
        return round(estimate(whole)) if whole.any() else 0


class _Moving:
    """Frames of groups moved second by second, over rows that come in pieces."""

    def __init__(self, measures: Sequence[FrameApproxDistinct]):
        self.measures = measures
        self.group = self.second = self.frame = None
        self.own, self.hashes, self.out = False, [], []

    def finish(self) -> None:
        """The rows of the second are all there."""
        if self.second is None:
            return
        if self.hashes:
            self.frame.add(self.second, np.array(self.hashes, np.int64))
        if self.own:
            self.out.append((*self.group[:2], self.second, self.frame.at(self.second)))
        self.second = None

    def add(self, rows: _Rows) -> None:
        """Rows of one group."""
        group = (rows.key[0], int(rows.measure[0]), int(rows.slice[0]))
        if group != self.group:
            self.finish()
            self.group, measure = group, self.measures[group[1]]
            self.frame = Frame(measure.seconds, measure.registers)
        for second, own, present, value in zip(
            rows.second.tolist(), rows.own.tolist(), rows.present.tolist(), rows.value.tolist()
        ):
            if second != self.second:
                self.finish()
                self.second, self.own, self.hashes = second, own, []
            if present:
                self.hashes.append(value)

    def taken(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


class _Rows:
    """Columns of rows sorted by key, measure, slice and second."""

    names = ("key", "measure", "slice", "second", "own", "present", "value")

    def __init__(self, *columns: np.ndarray):
        self.columns = columns
        self.key, self.measure, self.slice, self.second, self.own, self.present, self.value = columns

    def __len__(self) -> int:
        return len(self.second)

    def __getitem__(self, part) -> _Rows:
        return _Rows(*[c[part] for c in self.columns])

    def then(self, more: _Rows) -> _Rows:
        return _Rows(*[np.concatenate(pair) for pair in zip(self.columns, more.columns)])

    def starts(self) -> np.ndarray:
        """Where groups begin."""
        changed = np.ones(len(self), bool)
        changed[1:] = False
        for c in (self.key, self.measure, self.slice):
            changed[1:] |= np.asarray(c[1:] != c[:-1], bool)
        return np.flatnonzero(changed)


def _small_frames(rows: _Rows, seconds: np.ndarray, registers: int) -> tuple[_Rows, np.ndarray, np.ndarray]:
    """For rows of whole groups whose measures have ``registers``: the first row of every own second, its
    estimate, and by row how many values the frame holds; estimates of groups with too large frames are -1.
    ``seconds`` are the frames' lengths by row."""
    starts = rows.starts()
    sizes = np.diff(np.append(starts, len(rows)))
    group = np.repeat(np.arange(len(starts)), sizes)
    # One axis on which no frame reaches from one group into another.
    since = rows.second - np.repeat(rows.second[starts], sizes)
    moment = group * (int(since.max()) + int(seconds.max()) + 1) + since
    first = np.append(True, moment[1:] != moment[:-1]) & rows.own
    asked, held = moment[first], moment[rows.present]
    low = np.searchsorted(held, asked - seconds[first])
    many = np.searchsorted(held, asked, side="right") - low
    effort = np.bincount(group[first], many, len(starts))
    few = (effort <= _FRAME_VALUES * sizes)[group[first]]
    where, rank = observed(rows.value[rows.present], registers)
    code, ranks = where * 64 + rank, 64 - (registers.bit_length() - 1) + 2
    counted = np.full(len(asked), -1, np.int64)
    chosen = np.flatnonzero(few)
    ends = np.cumsum(many[chosen])
    begin = 0
    while begin < len(chosen):
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] - many[chosen[begin]] + _AT_ONCE, side="right")))
        part = chosen[begin:end]
        sums = np.cumsum(many[part]) - many[part]
        frame = np.repeat(np.arange(len(part)), many[part])
        at = np.arange(len(frame)) - np.repeat(sums - low[part], many[part])
        # Of a register in a frame the highest rank stays.
        codes = np.sort(frame * (registers * 64) + code[at])
        codes = codes[np.append(codes[1:] >> 6 != codes[:-1] >> 6, True)[: len(codes)]]
        tally = np.bincount(codes // (registers * 64) * ranks + codes % 64, minlength=len(part) * ranks)
        tally = tally.reshape(len(part), ranks)
        tally[:, 0] = registers - tally.sum(axis=1)
        counted[part] = np.round(estimates(tally, registers)).astype(np.int64)
        begin = end
    return rows[first], counted, group[first]


def _estimator(measures: Sequence[FrameApproxDistinct], names: list[str]):
    """Rows sorted by key, measure, slice and second, in batches that may cut anything."""
    lengths = np.array([m.seconds for m in measures], np.int64)
    registers = np.array([m.registers for m in measures], np.int64)

    def whole(rows: _Rows, moving: _Moving) -> Iterator[pd.DataFrame]:
        """Rows of whole groups."""
        for kind in sorted(set(registers[rows.measure].tolist())):
            own = rows[registers[rows.measure] == kind]
            asked, counted, group = _small_frames(own, lengths[own.measure], kind)
            known = counted >= 0
            if known.any():
                columns = (asked.key[known], asked.measure[known], asked.second[known], counted[known])
                yield pd.DataFrame(dict(zip(names, columns)))
            if not known.all():
                bounds = np.append(own.starts(), len(own))
                for g in np.unique(group[~known]):
                    moving.add(own[bounds[g] : bounds[g + 1]])
                    moving.finish()
                    moving.group = None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest, moving = None, _Moving(measures)
        for batch in batches:
            if not len(batch):
                continue
            rows = _Rows(*[batch[c].to_numpy() for c in _Rows.names])
            rows = rows if rest is None else rest.then(rows)
            starts = rows.starts()
            if moving.group is not None:  # its rows go on, or have ended
                if moving.group == (rows.key[0], int(rows.measure[0]), int(rows.slice[0])):
                    end = int(starts[1]) if len(starts) > 1 else len(rows)
                    moving.add(rows[:end])
                    rows = rows[end:]
                    starts = starts[1:] - end
                if len(rows):
                    moving.finish()
                    moving.group = None
            rest = None
            if len(rows):
                last = int(starts[-1])
                if last:
                    yield from whole(rows[:last], moving)
                rest = rows[last:]
                if len(rest) > _CARRIED:
                    moving.add(rest)
                    rest = None
            if out := moving.taken():
                yield pd.DataFrame(out, columns=names)
        if rest is not None:
            yield from whole(rest, moving)
        moving.finish()
        if out := moving.taken():
            yield pd.DataFrame(out, columns=names)

    return run


def approximate_distincts(
    df: DataFrame, key: str, time: str, measures: Sequence[FrameApproxDistinct]
) -> DataFrame:
    """Append one bigint column per measure; 0 for rows without a key or a second."""
    kind = df.schema[key].dataType.simpleString()
    framed = F.col(key).isNotNull() & F.col(time).isNotNull()
    values = F.array(
        *[
            F.struct(
                F.lit(i).alias("measure"),
                F.lit(m.seconds).cast("bigint").alias("seconds"),
                F.col(m.column).isNotNull().alias("present"),
                F.xxhash64(m.column).alias("value"),
            )
            for i, m in enumerate(measures)
        ]
    )
    first = F.floor(F.col("second") / SLICE_SECONDS)
    last = F.floor((F.col("second") + F.col("seconds")) / SLICE_SECONDS)
    columns = ["key", "measure", "slice", "second", "own", "present", "value"]
    rows = (
        df.filter(framed)
        .select(F.col(key).alias("key"), F.col(time).cast("bigint").alias("second"), F.inline(values))
        .distinct()
        .withColumn("first", first)
        # What has no value is only asked for; what has one is seen by later days as well.
        .withColumn("slice", F.explode(F.sequence("first", F.when(F.col("present"), last).otherwise(first))))
        .withColumn("own", F.col("slice") == F.col("first"))
        .select(*columns)
        .repartition("key", "measure", "slice")
        .sortWithinPartitions("key", "measure", "slice", "second")
    )
    names = ["key", "measure", "second", "count"]
    counted = rows.mapInPandas(
        _estimator(measures, names), f"key {kind}, measure int, second bigint, count bigint"
    )
    per_second = counted.groupBy("key", "second").agg(
        *[F.max(F.when(F.col("measure") == i, F.col("count"))).alias(m.name) for i, m in enumerate(measures)]
    )
    joined = df.join(
        per_second.withColumnsRenamed({"key": key, "second": time}), [key, time], "left"
    )
    filled = [F.coalesce(m.name, F.lit(0)).cast("bigint").alias(m.name) for m in measures]
    return joined.select(*df.columns, *filled)
