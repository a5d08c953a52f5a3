"""Aggregates over event-time frames ``[t - seconds, t]`` per key, inclusive at both ends.

A frame sum is the difference of two running sums: everything up to ``t`` less everything up to
``t - seconds - 1``. Both are growing frames, which Spark evaluates in one pass, so the cost per
row does not depend on how many rows a frame holds. Distinct counts use the same device: the
frames in which a value occurs form stretches, a stretch opens at an occurrence that has none
within ``seconds`` before it and closes ``seconds + 1`` after an occurrence that has none within
``seconds`` after it, and the number of distinct values is stretches opened less stretches closed.

Two physical forms give the same answer:

* ``_windowed``: one hash exchange by key, then only in-partition sorts. For ordinary keys.
* ``_sliced``: rows are first combined to one row per key and second, and every group is one key
  and week, with the seconds before it that its frames reach back to: at most 604,800 seconds and as
  many as the longest frame has seconds, however many transactions the key has. For heavy keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import HEAVY_KEY_ROWS, heavy_keys, split_heavy
from tidemark.schemas import DAY
from tidemark.session import materialize

SLICE_SECONDS = 7 * DAY


@dataclass(frozen=True)
class FrameSum:
    """Sum of a SQL expression over the frame; 0 when every value in it is NULL."""

    name: str
    expression: str
    seconds: int


@dataclass(frozen=True)
class FrameDistinct:
    """Exact number of different non-NULL values of a column in the frame."""

    name: str
    column: str
    seconds: int


@dataclass(frozen=True)
class Gap:
    """Seconds since the key's previous row, ordered by time and then by row id."""

    name: str


@dataclass(frozen=True)
class Novelty:
    """0 if the value occurred in ``[t - seconds, t - 1]``, else 1; a NULL value is always new."""

    name: str
    column: str
    seconds: int


Measure = FrameSum | FrameDistinct | Gap | Novelty


def sliding(
    df: DataFrame,
    key: str,
    time: str,
    row_id: str,
    measures: Sequence[Measure],
    heavy: dict[str, DataFrame | None] | None = None,
    heavy_rows: int = HEAVY_KEY_ROWS,
    source: DataFrame | None = None,
) -> DataFrame:
    """Append one column per measure. ``time`` is a column of whole seconds.

    A row without a time or without a key stands alone: it changes no other row, its sums and
    distinct counts are 0, its gap is NULL and its value is new. Rows of one second that share an id
    are ordered among each other, so only one of them has the gap to the second before.

    ``heavy`` holds the keys to process in slices; by default they are looked up in ``df``.
    ``source`` may name a cheaper frame of the same rows to read heavy keys' measures from, when
    ``df`` is itself the outcome of other work.
    """
    source = df if source is None else source
    if heavy is None:
        heavy = heavy_keys(source, key, min_rows=heavy_rows)
    listed = heavy[key]
    if listed is None:
        return _windowed(df, key, time, row_id, measures)
    light, dense = split_heavy(df, key, listed)
    _, dense_source = split_heavy(source, key, listed)
    return _windowed(light, key, time, row_id, measures).unionByName(
        _sliced(dense, dense_source, key, time, row_id, measures)
    )


def _framed(key: str, time: str) -> F.Column:
    return F.col(key).isNotNull() & F.col(time).isNotNull()


def _alone(key: str, time: str, measures: Sequence[Measure]) -> dict[str, F.Column]:
    """The measures as they are for rows with a frame, and what stands for them without one."""
    without = {
        m.name: F.lit(None) if isinstance(m, Gap) else F.lit(1 if isinstance(m, Novelty) else 0)
        for m in measures
    }
    return {n: F.when(_framed(key, time), F.col(n)).otherwise(v) for n, v in without.items()}


def _of(measures: Sequence[Measure], kind: type) -> list:
    return [m for m in measures if isinstance(m, kind)]


def _value_columns(measures: Sequence[Measure]) -> list[str]:
    found = [m.column for m in measures if isinstance(m, (FrameDistinct, Novelty))]
    return list(dict.fromkeys(found))


def _opens(time: str, previous: str, seconds: int) -> F.Column:
    return F.col(previous).isNull() | (F.col(time) - F.col(previous) > seconds)


def _closes(time: str, following: str, seconds: int) -> F.Column:
    return F.col(following).isNull() | (F.col(following) - F.col(time) > seconds)


# ------------------------------------------------------------------------------ ordinary keys


def _windowed(
    df: DataFrame, key: str, time: str, row_id: str, measures: Sequence[Measure]
) -> DataFrame:
    columns = df.columns
    # Rows without a frame are groups of their own, which also spreads rows without a key. Hash
    # partitioning by key and this serves every window by (key, value): no further exchange.
    df = df.withColumn("_odd", F.when(~_framed(key, time), F.col(row_id)))
    df = df.repartition(F.col(key), F.col("_odd"))

    before = Window.unboundedPreceding
    beside = {}
    for i, column in enumerate(_value_columns(measures)):
        w = Window.partitionBy(key, "_odd", column).orderBy(time)
        if any(m.column == column for m in _of(measures, FrameDistinct)):
            beside[f"_prev{i}"] = F.lag(time).over(w)
            beside[f"_next{i}"] = F.lead(time).over(w)
        if any(m.column == column for m in _of(measures, Novelty)):
            beside[f"_seen{i}"] = F.max(time).over(w.rangeBetween(before, -1))
    df = df.withColumns(beside)
    if _of(measures, Gap):
        # Sorted by time and id, which serves the frames over time below as well.
        same = Window.partitionBy(key, "_odd", time).orderBy(row_id)
        df = df.withColumn("_nth", F.row_number().over(same))

    w = Window.partitionBy(key, "_odd").orderBy(time)
    index = {c: i for i, c in enumerate(_value_columns(measures))}
    running: dict[str, F.Column] = {}
    result: dict[str, F.Column] = {}

    opened: dict[str, str] = {}
    for m in measures:
        if isinstance(m, FrameSum):
            total = opened.setdefault(m.expression, f"_sum{len(opened)}")
            value = F.sum(F.expr(m.expression))
            left = f"{total}_{m.seconds}"
            running[total] = value.over(w.rangeBetween(before, 0))
            running[left] = value.over(w.rangeBetween(before, -(m.seconds + 1)))
        elif isinstance(m, FrameDistinct):
            i = index[m.column]
            present = F.col(m.column).isNotNull()
            total, left = f"_open_{m.name}", f"_close_{m.name}"
            running[total] = F.count_if(present & _opens(time, f"_prev{i}", m.seconds)).over(
                w.rangeBetween(before, 0)
            )
            running[left] = F.count_if(present & _closes(time, f"_next{i}", m.seconds)).over(
                w.rangeBetween(before, -(m.seconds + 1))
            )
        elif isinstance(m, Gap):
            running["_before"] = F.max(time).over(w.rangeBetween(before, -1))
            is_first = F.col("_nth") == 1
            result[m.name] = F.when(is_first, F.col(time) - F.col("_before")).otherwise(0)
            continue
        else:
            seen = F.col(f"_seen{index[m.column]}")
            known = F.col(m.column).isNotNull() & (F.col(time) - seen <= m.seconds)
            result[m.name] = F.when(known, 0).otherwise(1)
            continue
        result[m.name] = F.coalesce(F.col(total), F.lit(0)) - F.coalesce(F.col(left), F.lit(0))

    return (
        df.withColumns(running)
        .withColumns(result)
        .withColumns(_alone(key, time, measures))
        .select(*columns, *result)
    )


# --------------------------------------------------------------------------------- heavy keys


def _slice(time: str, later: int = 0) -> F.Column:
    return F.floor((F.col(time) + later) / SLICE_SECONDS)


def _reached(time: str, seconds: int) -> F.Column:
    """One row per slice with a frame of that length that can hold the second: its own, and the next
    ones if the second is near enough."""
    return F.explode(F.sequence(_slice(time), _slice(time, seconds)))


def _last_before(seconds: DataFrame, group: list[str], time: str) -> DataFrame:
    """Per group and slice the group's last second before the slice, where it has one."""
    across = Window.partitionBy(*group).orderBy("_slice")
    return (
        seconds.groupBy(*group, _slice(time).alias("_slice"))
        .agg(F.max(time).alias("_last"))
        .select(*group, "_slice", F.lag("_last").over(across).alias(time))
        .filter(F.col(time).isNotNull())
    )


def _marks(
    occurrences: DataFrame, key: str, time: str, distincts: list[FrameDistinct], index: dict[str, int]
) -> DataFrame:
    """Per key, slice and second the stretches that open and that have their last occurrence there."""
    reach = max(m.seconds for m in distincts)
    w = Window.partitionBy(key, "_column", "_value", "_slice").orderBy(time)
    counts = []
    for m in distincts:
        mine = F.col("_column") == index[m.column]
        counts += [
            F.count_if(mine & _opens(time, "_prev", m.seconds)).alias(f"_open_{m.name}"),
            F.count_if(mine & _closes(time, "_next", m.seconds)).alias(f"_close_{m.name}"),
        ]
    return (
        occurrences.withColumn("_slice", _reached(time, reach))
        .withColumns({"_prev": F.lag(time).over(w), "_next": F.lead(time).over(w)})
        .groupBy(key, "_slice", time)
        .agg(*counts)
    )


def _sliced(
    df: DataFrame,
    source: DataFrame,
    key: str,
    time: str,
    row_id: str,
    measures: Sequence[Measure],
) -> DataFrame:
    columns = df.columns
    sums, distincts = _of(measures, FrameSum), _of(measures, FrameDistinct)
    gaps, novelties = _of(measures, Gap), _of(measures, Novelty)
    added = {e: f"_sum{i}" for i, e in enumerate(dict.fromkeys(m.expression for m in sums))}
    index = {c: i for i, c in enumerate(_value_columns(measures))}
    values = {c: f"_value{i}" for c, i in index.items()}

    # Read several times below, so the lookups and the choice of keys are done once.
    source = materialize(
        source.filter(_framed(key, time)).select(
            key,
            time,
            *[F.expr(e).alias(n) for e, n in added.items()],
            *[F.col(c).cast("string").alias(n) for c, n in values.items()],
        )
    )
    own = F.col("_slice") == _slice(time)

    # One row per key and second, combined before the shuffle.
    ledger = source.groupBy(key, time).agg(
        *[F.sum(n).alias(n) for n in added.values()], F.lit(True).alias("_any")
    )
    types = {f.name: f.dataType for f in ledger.schema.fields}
    parts = [ledger.withColumn("_slice", _reached(time, max([m.seconds for m in sums], default=0)))]
    if gaps:
        parts.append(_last_before(source, [key], time).withColumn("_any", F.lit(True)))
    if distincts:
        counted = dict.fromkeys(m.column for m in distincts)
        pair = [F.struct(F.lit(index[c]).alias("_column"), F.col(values[c]).alias("_value")) for c in counted]
        occurrences = (
            source.select(key, time, F.inline(F.array(*pair)))
            .filter(F.col("_value").isNotNull())
            .distinct()
        )
        parts.append(_marks(occurrences, key, time, distincts, index))

    # A slice holds all that its frames reach back to, so no total has to come from another one.
    w = Window.partitionBy(key, "_slice").orderBy(time)
    before = Window.unboundedPreceding

    running: dict[str, F.Column] = {}

    def difference(total: str, left: str, seconds: int) -> F.Column:
        entered, passed = f"_in{total}", f"_out{left}_{seconds}"
        running[entered] = F.sum(total).over(w.rangeBetween(before, 0))
        running[passed] = F.sum(left).over(w.rangeBetween(before, -(seconds + 1)))
        return F.coalesce(F.col(entered), F.lit(0)) - F.coalesce(F.col(passed), F.lit(0))

    framed = {}
    for m in sums:
        total = added[m.expression]
        framed[m.name] = difference(total, total, m.seconds).cast(types[total])
    for m in distincts:
        framed[m.name] = difference(f"_open_{m.name}", f"_close_{m.name}", m.seconds)
    if gaps:
        running["_prev"] = F.max(F.when(F.col("_any"), F.col(time))).over(w.rangeBetween(before, -1))
        framed["_prev"] = F.col("_prev")
    totals = (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        .withColumns(running)
        .filter(F.col("_any") & own)
        .select(key, time, *[c.alias(n) for n, c in framed.items()])
    )
    result = df.join(totals, [key, time], "left")
    for m in gaps:
        same = Window.partitionBy(key, time).orderBy(row_id)
        result = result.withColumn("_nth", F.row_number().over(same)).withColumn(
            m.name, F.when(F.col("_nth") == 1, F.col(time) - F.col("_prev")).otherwise(0)
        )
    for m in novelties:
        seen = (
            source.select(key, F.col(values[m.column]).alias("_known_value"), time)
            .filter(F.col("_known_value").isNotNull())
            .distinct()
        )
        w = Window.partitionBy(key, "_known_value", "_slice").orderBy(time)
        known = (
            seen.withColumn("_slice", _slice(time))
            .unionByName(_last_before(seen, [key, "_known_value"], time))
            .withColumn("_prev", F.lag(time).over(w))
            .filter(own & (F.col(time) - F.col("_prev") <= m.seconds))
            .select(key, "_known_value", time, F.lit(True).alias("_known"))
        )
        result = (
            result.withColumn("_known_value", F.col(m.column).cast("string"))
            .join(known, [key, "_known_value", time], "left")
            .withColumn(m.name, F.when(F.col("_known"), 0).otherwise(1))
            .drop("_known", "_known_value")
        )
    return result.withColumns(_alone(key, time, measures)).select(
        *columns, *[m.name for m in measures]
    )
