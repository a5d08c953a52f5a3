"""Frame semantics on hand-made rows, and the two physical forms against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.skew import heavy_keys
from tidemark.operators.sliding import FrameDistinct, FrameSum, Gap, Novelty, sliding

DAY = 86400
MEASURES = [
    FrameSum("count_1h", "1", 3600),
    FrameSum("count_24h", "1", DAY),
    FrameSum("amount_24h", "amount", DAY),
    FrameDistinct("values_1h", "value", 3600),
    FrameDistinct("values_24h", "value", DAY),
    Gap("gap"),
    Novelty("is_new", "value", 30 * DAY),
]


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "id bigint, k bigint, t bigint, value string, amount decimal(15,2)"
    )


def computed(spark, rows, heavy_rows):
    df = sliding(frame(spark, rows), "k", "t", "id", MEASURES, heavy_rows=heavy_rows)
    return {r["id"]: r.asDict() for r in df.collect()}


def brute_force(rows):
    out = {}
    for i, k, t, value, amount in rows:
        same = [r for r in rows if r[1] == k]
        hour = [r for r in same if t - 3600 <= r[2] <= t]
        day = [r for r in same if t - DAY <= r[2] <= t]
        before = [r[2] for r in same if (r[2], r[0]) < (t, i)]
        seen = {r[3] for r in same if t - 30 * DAY <= r[2] <= t - 1}
        out[i] = {
            "count_1h": len(hour),
            "count_24h": len(day),
            "amount_24h": sum(r[4] for r in day if r[4] is not None),
            "values_1h": len({r[3] for r in hour if r[3] is not None}),
            "values_24h": len({r[3] for r in day if r[3] is not None}),
            "gap": t - max(before) if before else None,
            "is_new": 0 if value is not None and value in seen else 1,
        }
    return out


EDGE = [
    (1, 1, 0, "A"),
    (2, 1, 3600, "A"),
    (3, 1, 7201, "B"),
    (4, 1, 7201, "B"),
    (5, 1, 93601, None),
    (6, 2, 0, "A"),
]
EXPECTED = {  # id: count 1h, count 24h, gap, new
    1: (1, 1, None, 1),
    2: (2, 2, 3600, 0),
    3: (2, 4, 3601, 1),
    4: (2, 4, 0, 1),
    5: (1, 3, 86400, 1),
    6: (1, 1, None, 1),
}


@pytest.mark.parametrize("heavy_rows", [10**9, 0])
def test_edge_rows(spark, heavy_rows):
    from decimal import Decimal

    rows = [(*r, Decimal("1.00")) for r in EDGE]
    got = computed(spark, rows, heavy_rows)
    for i, expected in EXPECTED.items():
        r = got[i]
        assert (r["count_1h"], r["count_24h"], r["gap"], r["is_new"]) == expected


@pytest.mark.parametrize("heavy_rows", [10**9, 150, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, heavy_rows, seed):
    """Key 0 holds most rows, with many ties; spans days, months and times before 1970."""
    from decimal import Decimal

    rng = random.Random(seed)
    rows = []
    for i in range(420):
        key = 0 if rng.random() < 0.5 else rng.randrange(1, 5)
        span = rng.choice([600, 2 * DAY, 70 * DAY])
        t = rng.randrange(-span, span) // rng.choice([1, 1, 60]) * 1
        value = rng.choice(["a", "b", "c", "d", None])
        amount = None if rng.random() < 0.05 else Decimal(rng.randrange(1, 10**6)) / 100
        rows.append((i, key, t, value, amount))
    got = computed(spark, rows, heavy_rows)
    for i, expected in brute_force(rows).items():
        assert {n: got[i][n] for n in expected} == expected, (i, rows[i])


def test_rows_are_order_independent_and_never_lost(spark):
    from decimal import Decimal

    rows = [(i, i % 3, (i * 7919) % 5000, "ab"[i % 2], Decimal(i)) for i in range(200)]
    forward, backward = computed(spark, rows, 10**9), computed(spark, rows[::-1], 50)
    assert len(forward) == 200 and forward == backward


def test_later_rows_change_nothing(spark):
    from decimal import Decimal

    rows = [(i, 0, i * 100, "abc"[i % 3], Decimal(1)) for i in range(60)]
    early = computed(spark, rows[:40], 10**9)
    late = computed(spark, rows, 10**9)
    assert all(late[i] == early[i] for i in range(40))


def test_heavy_keys(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), (F.col("id") % 2).alias("j"))
    found = heavy_keys(df, "k", "j", min_rows=50)
    assert found["k"].count() == 10
    assert sorted(r[0] for r in found["j"].collect()) == [0, 1]
    assert heavy_keys(df, "k", min_rows=100)["k"] is None


@pytest.mark.parametrize("heavy_rows", [10**9, 150, 0])
def test_rows_without_time_or_key_stand_alone(spark, heavy_rows):
    """They change no other row and get fixed results, the same in both forms."""
    from decimal import Decimal

    rng = random.Random(5)
    rows = [
        (i, i % 3 and 1, rng.randrange(3 * DAY), rng.choice(["a", "b", None]), Decimal(1))
        for i in range(300)
    ]
    odd = [
        (1000 + i, rng.choice([0, 1, None]), None, rng.choice(["a", "b", None]), Decimal(1))
        for i in range(40)
    ]
    odd += [(2000 + i, None, rng.randrange(3 * DAY), "a", Decimal(1)) for i in range(20)]
    got = computed(spark, rows + odd, heavy_rows)
    for i, expected in brute_force(rows).items():
        assert {n: got[i][n] for n in expected} == expected, i
    for row in odd:
        r = got[row[0]]
        assert (r["count_1h"], r["amount_24h"], r["values_24h"]) == (0, 0, 0)
        assert r["gap"] is None and r["is_new"] == 1


@pytest.mark.parametrize("heavy_rows", [10**9, 0])
def test_equal_ids_of_one_second(spark, heavy_rows):
    from decimal import Decimal

    rows = [(1, 1, 0, "a", Decimal(1)), (2, 1, 600, "a", Decimal(1)), (2, 1, 600, "a", Decimal(1))]
    df = sliding(frame(spark, rows), "k", "t", "id", MEASURES, heavy_rows=heavy_rows)
    assert sorted(r["gap"] for r in df.filter("id = 2").collect()) == [0, 600]
