"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A vector is turned by three rounds of random signs and the fast Hadamard transform; the nearest signed
axis is its hash, a few of them together its bucket. It also probes the buckets of the next nearest axes.
Vectors that meet in a bucket are compared in blocks by their true cosine in double precision. Each block
hands on link counts per vector and a spanning forest, never its pairs. Equal vectors are one class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    components,
    discard,
    group_bounds,
    keep,
    map_with_id,
    whole_groups,
)
from tidemark.llm.shingles import mix

_BLOCK_KEYS = ["bucket", "i", "j"]


@dataclass(frozen=True)
class Settings:
    """``axes`` hashes make a bucket (0: as many as keep about ``bucket_rows`` vectors apart, two at
    least); each further one adds tables. Recall at the threshold is tested to be over 0.99."""

    cosine: float = 0.95
    axes: int = 0
    tables: int = 8
    probes: int = 4
    bucket_rows: int = 64
    block: int = 1024
    seed: int = 3

    def sized(self, count: int, dims: int) -> "Settings":
        if self.axes:
            return self
        wanted = math.log(max(count / self.bucket_rows, 1)) / math.log(2 * max(dims, 2))
        axes = max(2, math.ceil(wanted))
        return Settings(
            self.cosine, axes, self.tables * 2 ** (axes - 2), self.probes, self.bucket_rows, self.block, self.seed
        )


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row; the width is a power of two."""
    rows, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(rows, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        step *= 2
    return x.reshape(rows, width) / math.sqrt(width)


def buckets(vectors: np.ndarray, settings: Settings) -> np.ndarray:
    """For each row, table and probe a bucket name; probe 0 is the vector's own bucket."""
    rows, dims = vectors.shape
    width = max(2, 1 << max(dims - 1, 1).bit_length())
    padded = np.zeros((rows, width))
    padded[:, :dims] = vectors
    signs = np.random.default_rng(settings.seed).choice(
        [-1.0, 1.0], (settings.tables, settings.axes, 3, width)
    )
    ranks = min(4, width)
    names = np.empty((rows, settings.tables, settings.probes + 1), np.uint64)
    for table in range(settings.tables):
        best = np.empty((rows, settings.axes, ranks), np.uint64)
        loss = np.empty((rows, settings.axes, ranks))
        for axis in range(settings.axes):
            x = padded
            for sign in signs[table, axis]:
                x = hadamard(x * sign)
            size = np.abs(x)
            order = np.argsort(-size, axis=1, kind="stable")[:, :ranks]
            value = np.take_along_axis(x, order, axis=1)
            best[:, axis] = order.astype(np.uint64) * np.uint64(2) + (value < 0)
            loss[:, axis] = np.abs(value[:, :1]) - np.abs(value)
        # Cheapest single changes: one axis replaced by a later one.
        options = loss[:, :, 1:].reshape(rows, -1)
        cheapest = np.argsort(options, axis=1, kind="stable")[:, : settings.probes]
        for probe in range(settings.probes + 1):
            chosen = best[:, :, 0].copy()
            if probe:
                pick = cheapest[:, min(probe, cheapest.shape[1]) - 1]
                axis, rank = pick // (ranks - 1), pick % (ranks - 1) + 1
                chosen[np.arange(rows), axis] = best[np.arange(rows), axis, rank]
            name = np.full(rows, table * 1_000_003 + dims, np.uint64)
            for axis in range(settings.axes):
                name = mix(name * np.uint64(2 * width + 1) + chosen[:, axis])
            names[:, table, probe] = name
    return names


def _valid(vector) -> bool:
    if vector is None or not len(vector):
        return False
    values = np.asarray(vector, float)
    return bool(np.isfinite(values).all() and values.any())


def _describer(settings: Settings):
    """Every row, those that link with nothing without a class."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            valid = batch["vec_id"].notna().to_numpy() & np.array(
                [_valid(v) for v in batch["embedding"]], bool
            )
            other = batch.loc[~valid, ["vec_id"]]
            if len(other):
                yield other.assign(**{"class": None, "vector": None, "names": None})
            good = batch[valid]
            lengths = good["embedding"].map(len)
            for dims in sorted(lengths.unique()):
                for start in range(0, int((lengths == dims).sum()), 2048):
                    part = good[(lengths == dims).to_numpy()].iloc[start : start + 2048]
                    vectors = np.stack([np.asarray(v, float) for v in part["embedding"]])
                    # Scaled by the largest component, so that neither tiny nor huge ones are lost.
                    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
                    names = buckets(scaled / np.linalg.norm(scaled, axis=1, keepdims=True), settings)
                    yield pd.DataFrame(
                        {
                            "vec_id": part["vec_id"].to_numpy(),
                            "class": [xxhash.xxh3_128_digest((v + 0.0).tobytes()) for v in vectors],
                            "vector": [v.tobytes() for v in scaled],
                            "names": [n.view(np.int64).ravel() for n in names],
                        }
                    )

    return describe


class _Block:
    """Links of one pair of blocks of a bucket that this bucket is to answer for."""

    def __init__(self, rows: pd.DataFrame, settings: Settings):
        self.ids = rows["node"].to_numpy()
        self.sizes = rows["copies"].to_numpy()
        vectors = np.frombuffer(b"".join(rows["vector"])).reshape(len(rows), -1)
        norms = np.linalg.norm(vectors, axis=1)
        names = np.stack(rows["names"].to_numpy()).reshape(len(rows), settings.tables, -1)
        side = rows["side"].to_numpy()
        i, j, bucket = rows["i"].iloc[0], rows["j"].iloc[0], rows["bucket"].iloc[0]
        left = np.flatnonzero(side == i)
        right = left if i == j else np.flatnonzero(side == j)
        cosine = (vectors[left] @ vectors[right].T) / (norms[left, None] * norms[None, right])
        near = cosine >= settings.cosine
        if i == j:
            near = np.triu(near, 1)
        a, b = np.nonzero(near)
        a, b = left[a], right[b]
        mine = np.zeros(len(a), bool)
        for start in range(0, len(a), 50_000):
            part = slice(start, start + 50_000)
            mine[part] = _first_meeting(names[a[part]], names[b[part]]) == bucket
        self.a, self.b = a[mine], b[mine]


def _first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The one bucket that answers for each pair: of the first table in which one of the two lies
    where the other lies or looks, the smallest such name."""
    found = np.zeros(len(a), np.int64)
    open_pairs = np.arange(len(a))
    for table in range(a.shape[1]):
        x, y = a[open_pairs, table], b[open_pairs, table]
        none = np.iinfo(np.int64).max
        in_y = np.where((x[:, :1] == y).any(axis=1), x[:, 0], none)
        in_x = np.where((y[:, :1] == x).any(axis=1), y[:, 0], none)
        least = np.minimum(in_x, in_y)
        met = least != none
        found[open_pairs[met]] = least[met]
        open_pairs = open_pairs[~met]
        if not len(open_pairs):
            break
    return found


def _linker(settings: Settings):
    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, _BLOCK_KEYS):
            bounds = group_bounds(rows, _BLOCK_KEYS)
            out = []
            for start, end in zip(bounds[:-1], bounds[1:]):
                if end - start < 2:
                    continue
                block = _Block(rows.iloc[start:end], settings)
                if not len(block.a):
                    continue
                count = np.bincount(block.a, block.sizes[block.b], end - start)
                count += np.bincount(block.b, block.sizes[block.a], end - start)
                other = _forest(block.a, block.b, end - start)
                linked = np.flatnonzero(count)
                out.append(
                    pd.DataFrame(
                        {
                            "a": block.ids[linked],
                            "b": block.ids[other[linked]],
                            "links": count[linked].astype(np.int64),
                        }
                    )
                )
            if out:
                yield pd.concat(out, ignore_index=True)

    return link


def _forest(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """For each member one it is linked with, or itself: together as connected as all pairs."""
    root = np.arange(count)
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            return root


def near_vectors(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (vec_id, embedding, ...).

    Vectors are linked when their cosine is at least ``cosine``, in double precision. Null, empty and
    zero vectors and those with a null, NaN or infinite component link with nothing, as do vectors of
    different length among each other. Rows with a null vec_id link with nothing, have a null
    component and are kept. Rows that share a vec_id are one vector if they are equal; if they are
    not, each has links of its own and all are of one component. All come back as often as they were
    given. Other columns, labels among them, are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    count, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    settings = settings.sized(count, dims or 2)
    # A row's number, written with it, stands for its class where it comes first.
    described = keep(
        map_with_id(
            rows, _describer(settings), "vec_id long, class binary, vector binary, names array<long>", "vec_id"
        ).withColumn("node", F.monotonically_increasing_id())
    )
    known = described.where(F.col("class").isNotNull())
    classes = keep(
        known.groupBy("class", "vec_id")
        .agg(F.min("node").alias("node"))
        .groupBy("class")
        .agg(F.min(F.struct("vec_id", "node")).alias("first"), F.count(F.lit(1)).alias("copies"))
        .select("class", "first.vec_id", "first.node", "copies")
    )
    singles = keep(
        known.select("node", "vector", "names").join(classes.select("node", "copies"), "node")
    )
    members = keep(
        described.select("vec_id", "class").join(
            classes.select("class", F.col("node").alias("first_node"), "copies"), "class", "left"
        )
    )
    linked = keep(_linked(singles, settings))
    own = linked.groupBy(F.col("a").alias("first_node")).agg(F.sum("links").alias("others"))
    # Different vectors of one id are of one component.
    one_id = (
        members.where("first_node is not null")
        .groupBy("vec_id")
        .agg(F.min("first_node").alias("a"), F.max("first_node").alias("z"))
        .where("a < z")
        .select("vec_id", "a")
    )
    same = members.join(one_id, "vec_id").select("a", F.col("first_node").alias("b")).where("a <> b")
    reached = keep(components(linked.select("a", "b").unionByName(same)))
    smallest = (
        classes.select("node", "vec_id")
        .join(reached, "node")
        .groupBy("component")
        .agg(F.min("vec_id").alias("component_id"))
    )
    named = (
        classes.select("node", "vec_id")
        .join(reached.join(smallest, "component").select("node", "component_id"), "node", "left")
        .select(F.col("node").alias("first_node"), F.coalesce("component_id", "vec_id").alias("class_id"))
        .join(own, "first_node", "left")
    )
    result = members.join(named, "first_node", "left").select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("class_id", "vec_id").alias("component_id"),
    )
    discard(described, singles)
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linked(singles: DataFrame, settings: Settings) -> DataFrame:
    """``a, b, links``: for a block and vector a, the rows it is linked with there and one tie."""
    places = singles.select("node", F.posexplode("names").alias("at", "bucket")).select(
        "node", "bucket", (F.col("at") % (settings.probes + 1) == 0).alias("own")
    )
    places = places.groupBy("node", "bucket").agg(F.max("own").alias("own"))
    shared = (
        places.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("size"), F.max("own").alias("any_own"))
        .where("size > 1 and any_own")
        .select("bucket", F.ceil(F.col("size") / settings.block).cast("int").alias("blocks"))
    )
    blocks = (
        places.join(shared, "bucket")
        .withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("side", "other"))
        .withColumn("j", F.greatest("side", "other"))
        .select("bucket", "i", "j", "side", "node")
        .join(singles, "node")
        .repartition(*_BLOCK_KEYS)
        .sortWithinPartitions(*_BLOCK_KEYS)
    )
    return blocks.mapInPandas(_linker(settings), "a long, b long, links long")
