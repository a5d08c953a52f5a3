"""Nearest neighbours and hard negatives against brute force, and their results for odd rows."""

import math

import numpy as np
import pytest

from tests.compare import connect, difference
from tidemark.llm import negatives, neighbours
from tidemark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"
BIG = 2**53 + 1
SCHEMA = "vec_id long, embedding array<double>, label int, score string, rank string, name string, at int"


def odd_vectors(spark):
    """Clusters, copies of one vector as a third of all rows, ties, odd vectors, clashing columns."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(i, list(map(float, centres[i % 6] + rng.normal(size=8) * 0.2)), i % 4) for i in range(200)]
    rows += [(1000 + i, [1.0, -2.0, 0.5, 0.0, 1.0, 2.0, 1.5, -0.0], 1) for i in range(101)]
    rows += [rows[100], rows[100], (100, rows[7][1], 3), (300, rows[7][1], None), (None, rows[7][1], 1)]
    rows += [(400, None, 1), (500, [], 1), (600, [0.0] * 8, 2), (700, [math.nan] + [1.0] * 7, 2)]
    rows += [(800, [math.inf] + [1.0] * 7, 2), (900, [None] + [1.0] * 7, 2), (2000, [1.0, 2.0], 0)]
    rows += [(BIG, rows[0][1], 0), (2100, [1e300] * 8, 3), (2200, [5e-324] * 8, 3), (-100, rows[3][1], 2)]
    return spark.createDataFrame([(*r, "s", "r", "n", 1) for r in rows], SCHEMA)


def brute_neighbours(rows, k=10):
    kept = []
    for r in rows:
        v = r["embedding"]
        if r["vec_id"] is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if any(v) and (r["vec_id"], tuple(v)) not in kept:
            kept.append((r["vec_id"], tuple(v)))
    out = []
    for q in kept:
        if q[0] % 100:
            continue
        with np.errstate(over="ignore"):
            near = sorted(
                (float(np.sqrt(((np.array(o[1]) - np.array(q[1])) ** 2).sum())), o[0])
                for o in kept
                if o != q and len(o[1]) == len(q[1])
            )
        out += [(q[0], i + 1, o, d) for i, (d, o) in enumerate(near[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [16_384, 20])
def test_neighbours_of_odd_rows(spark, block):
    """With certainty instead of confidence the search is exact, whatever the blocks."""
    df = odd_vectors(spark)
    sure = neighbours.Settings(confidence=1 - 1e-12, block=block, part=2, leaf=4)
    got = sorted(map(tuple, neighbours.nearest(df, sure).collect()))
    assert got == brute_neighbours(df.collect())
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_recall_of_neighbours(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = {r[:3:2] for r in brute_neighbours(df.collect())}
    for settings in (neighbours.Settings(), neighbours.Settings(block=64, cells=16)):
        got = neighbours.nearest(df, settings).collect()
        assert len(got) == len(want)
        assert len({(r["query_id"], r["vec_id"]) for r in got} & want) >= 0.9 * len(want)


def test_search_stops_early_and_misses_as_few_as_it_says():
    rng = np.random.default_rng(2)
    s = neighbours.Settings(confidence=0.95)
    centres = rng.normal(size=(40, 32))
    x = np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 32)) * 0.2
    low = x @ neighbours.directions(32, s)
    tree = neighbours.Tree(x, low, s.leaf)
    assert sorted(tree.order) == list(range(4000))
    hits = seen = 0
    for q in range(0, 4000, 80):
        found, distance, verified = tree.search(x[q], low[q], 10, math.inf, neighbours.stop_factor(s))
        exact = np.argsort(((x - x[q]) ** 2).sum(axis=1))[:10]
        hits, seen = hits + len(set(exact) & set(found)), seen + verified
    assert hits >= 0.95 * 500 and seen < 0.1 * 50 * 4000


def test_chi_square():
    rng = np.random.default_rng(3)
    drawn = (rng.normal(size=(200_000, 6)) ** 2).sum(axis=1)
    for x in (1.0, 4.0, 9.0):
        assert abs((drawn <= x).mean() - neighbours.chi_square(x, 6)) < 0.005
    s = neighbours.Settings()
    assert abs(neighbours.chi_square(neighbours.stop_factor(s) ** 2, s.directions) - s.confidence) < 1e-9


def brute_negatives(rows):
    kept = []
    for r in rows:
        v, label = r["embedding"], r["label"]
        if None in (r["vec_id"], v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(math.floor(256 * x) for x in v)
        label = (label + 1) % 10 if r["vec_id"] % 7 == 0 else label
        if sum(x * x for x in whole) < 2**62 and (r["vec_id"], label, whole) not in kept:
            kept.append((r["vec_id"], label, whole))
    out = []
    for a in kept:
        if a[0] % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1])
            for b in kept
            if b != a and len(b[2]) == len(a[2])
        ]
        for p, pid, label in sorted(s for s in scored if s[2] == a[1])[:5]:
            inside = sorted(s for s in scored if s[2] != a[1] and 80 * -p <= 100 * -s[0] <= 100 * -p)
            out += [(a[0], pid, i + 1, s[1], -p, -s[0]) for i, s in enumerate(inside[:5])]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 12])
def test_negatives_of_odd_rows(spark, block):
    df = odd_vectors(spark)
    got = negatives.hard_negatives(df, negatives.Settings(block=block, part=2, leaf=3)).collect()
    want = brute_negatives(df.collect())
    assert sorted(map(tuple, got)) == want and len(want) > 20
    assert negatives.hard_negatives(df.limit(0)).count() == 0


def test_negatives_against_sql(spark):
    assert difference(QUERIES["op12_negatives"](spark, SF), connect(SF), SQL["op12_negatives"]) is None


@pytest.mark.parametrize("scale", [10, 1000, 2**28])
def test_cover_tree(scale):
    """The radii cover, every point hangs below the root once, and windows hold what all scores say;
    the last scale is beyond exact doubles."""
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(300, 6)) * scale).astype(np.int64)
    x = np.concatenate([x, x[:20], x[:3] // 2])
    ids = rng.permutation(len(x))
    tree = negatives.CoverTree(x, 4, 0.7)

    def below(node):
        parts = [tree.members[node], *[below(c) for c in tree.children[node]]]
        found = np.concatenate(parts)
        apart = np.sqrt(((tree.lifted[found] - tree.lifted[tree.centre[node]]) ** 2).sum(axis=1))
        assert apart.max() <= tree.radius[node] * (1 + 1e-6) + 2 * math.sqrt(tree.slack)
        return found

    assert sorted(below(0)) == list(range(len(x)))
    for q in x[::37]:
        exact = [sum(int(a) * int(b) for a, b in zip(row, q)) for row in x]
        highs = np.array(sorted(exact)[-12::3], np.int64)
        lows = highs - highs // 5
        for low, high, (positions, scores) in zip(lows, highs, tree.search(q, lows, highs, 5, ids)):
            want = sorted((-s, ids[i], i) for i, s in enumerate(exact) if low <= s <= high)[:5]
            assert [(-s, ids[i], i) for i, s in zip(positions, scores)] == want
