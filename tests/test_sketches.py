"""Sketched distinct counts: error bounds, the moving frame, keys of any size."""

import random
import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import sketches as K

RNG = np.random.default_rng(0)


def hashes(n):
    return RNG.integers(-(2**63), 2**63, n, dtype=np.int64)


def sketch(values, registers=512):
    found = np.zeros(registers, np.uint8)
    where, rank = K.observed(values, registers)
    np.maximum.at(found, where, rank)
    return found


def test_ranks_are_leading_zeros():
    for registers in (16, 512, 4096):
        bits = registers.bit_length() - 1
        values = np.concatenate([hashes(500), np.array([0, 1, -1, 2**62, -(2**63), 2**54 - 1, 2**53], np.int64)])
        where, rank = K.observed(values, registers)
        for v, w, r in zip(values.tolist(), where.tolist(), rank.tolist()):
            text = format(v % 2**64, "064b")
            rest = text[bits:]
            assert w == int(text[:bits], 2)
            assert r == len(rest) - len(rest.lstrip("0")) + 1


def test_error_over_the_whole_range():
    """Three standard errors, at sizes from nothing to two hundred times the registers."""
    assert K.estimate(np.zeros(512, np.uint8)) == 0
    for n in (1, 3, 10, 100, 1_000, 1_500, 5_000, 100_000):
        found = np.array([K.estimate(sketch(hashes(n))) for _ in range(40)])
        assert abs(found.mean() / n - 1) < 3 * 1.04 / np.sqrt(512 * 40)
        assert np.sqrt(((found / n - 1) ** 2).mean()) < 1.3 * 1.04 / np.sqrt(512)


def test_frame_against_sketches_made_anew():
    rng = random.Random(1)
    frame, seen, t = K.Frame(50, 64), [], 0
    for _ in range(600):
        t += rng.choice((1, 1, 2, 7, 90))
        values = hashes(rng.randrange(4))
        if len(values):
            frame.add(t, values)
            seen.append((t, values))
        if rng.random() < 0.7:
            inside = [v for at, v in seen if at >= t - 50]
            want = round(K.estimate(sketch(np.concatenate(inside), 64))) if inside else 0
            assert frame.at(t) == want


def frame_rows(spark, n, span):
    """One key, ``n`` rows spread over ``span`` seconds, values that mostly differ."""
    return spark.range(n).select(
        F.lit("hot").alias("k"),
        (F.col("id") * span / n).cast("bigint").alias("t"),
        F.concat(F.lit("v"), (F.xxhash64("id") % (n // 2)).cast("string")).alias("value"),
    )


def test_bound_on_a_key_with_100_000_rows(spark):
    df = frame_rows(spark, 100_000, 3 * 86_400)
    measures = [K.FrameApproxDistinct("short", "value", 300), K.FrameApproxDistinct("long", "value", 86_400)]
    rows = K.approximate_distincts(df, "k", "t", measures).select("t", "value", "short", "long").toPandas()
    assert len(rows) == 100_000
    rows = rows.sort_values("t").reset_index(drop=True)
    for at in range(0, 100_000, 997):
        t = rows["t"][at]
        for name, seconds in (("short", 300), ("long", 86_400)):
            inside = rows[(rows["t"] >= t - seconds) & (rows["t"] <= t)]
            exact = inside["value"].nunique()
            assert abs(rows[name][at] - exact) <= max(2, 4 * 1.04 / np.sqrt(2048) * exact)


def test_cost_does_not_follow_the_frame():
    def seconds(length):
        frame, begun = K.Frame(length, 512), time.perf_counter()
        for t in range(20_000):
            frame.add(t, hashes(1))
            frame.at(t)
        return time.perf_counter() - begun

    assert seconds(10_000) < 3 * seconds(100)


def test_odd_rows_and_day_borders(spark):
    rows = [("a", 86_399, "x"), ("a", 86_400, "y"), ("a", 86_400, None), ("a", 86_401, "x"), ("a", 172_801, "z")]
    rows += [("a", None, "x"), (None, 5, "x"), ("b", 10, None), ("b", -5, "q"), ("a", 86_400, "y")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, k string, t bigint, value string")
    measures = [K.FrameApproxDistinct("day", "value", 86_400), K.FrameApproxDistinct("now", "value", 0)]
    got = {r["id"]: (r["day"], r["now"]) for r in K.approximate_distincts(df, "k", "t", measures).collect()}
    assert got == {
        0: (1, 1), 1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (2, 1), 5: (0, 0), 6: (0, 0), 7: (1, 0), 8: (1, 1), 9: (2, 1)
    }
    assert K.approximate_distincts(df.limit(0), "k", "t", measures).count() == 0


def test_small_frames_of_many_keys_are_counted_together(monkeypatch):
    """Equal to sketches made anew, without a frame being moved; a large group still moves one."""
    rng = random.Random(5)
    measures = [K.FrameApproxDistinct("a", "v", 50, 64), K.FrameApproxDistinct("b", "v", 400, 512)]

    def made(key, measure, n, span):
        seconds = sorted(1_000 + rng.randrange(span) for _ in range(n))
        values = hashes(n).tolist()
        return [(key, measure, 0, s, s > 1_200, rng.random() < 0.8, v) for s, v in zip(seconds, values)]

    def run(rows, size):
        table = pd.DataFrame(rows, columns=K._Rows.names)
        batches = (table.iloc[i : i + size] for i in range(0, len(table), size))
        out = pd.concat(list(K._estimator(measures, ["key", "measure", "second", "count"])(batches)))
        return {(k, m, s): c for k, m, s, c in out.itertuples(index=False)}

    def expected(rows):
        want = {}
        for key, measure, _, second, own, _, _ in rows:
            if own:
                length, registers = measures[measure].seconds, measures[measure].registers
                inside = [r[6] for r in rows if r[:2] == (key, measure) and r[5] and second - length <= r[3] <= second]
                found = sketch(np.array(inside, np.int64), registers) if inside else np.zeros(registers, np.uint8)
                want[key, measure, second] = round(K.estimate(found))
        return want

    moved = []
    monkeypatch.setattr(K.Frame, "at", lambda self, second, at=K.Frame.at: (moved.append(second), at(self, second))[1])
    rows = [r for key in range(30) for measure in (0, 1) for r in made(key, measure, rng.randrange(1, 30), 900)]
    for size in (7, 100, len(rows)):
        assert run(rows, size) == expected(rows)
    assert not moved
    monkeypatch.setattr(K, "_CARRIED", 100)
    monkeypatch.setattr(K, "_FRAME_VALUES", 5)
    rows = [*made(1, 0, 20, 900), *made(1, 1, 300, 900), *made(2, 0, 90, 300), *made(2, 1, 3, 900)]
    for size in (7, 64, len(rows)):
        assert run(rows, size) == expected(rows)
    assert moved
