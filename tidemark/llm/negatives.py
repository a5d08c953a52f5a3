"""Hard negatives by cover trees over norm-augmented candidates.

With one more coordinate that lifts every candidate to the greatest norm, and none for the anchor, a larger
inner product is a smaller distance. A node of a cover tree holds what lies within its covering radius, so
its distance to an anchor bounds the inner products of all below it from both sides. A search goes best
first: nodes whose bounds lie outside the wanted window of scores, or below the k-th found, are skipped
with all that hangs from them; what is left is verified by its exact integer score.

Candidates of a label are cut into blocks around a bounded number of centres. A task holds one block with
its tree and a bounded part of the anchors; it hands on the first few per anchor and window.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keep

#: Squared norms above this could give scores beyond a long; above the other, doubles are not exact.
LARGEST, EXACT = 2.0**62, 2.0**53
_POINT = "name string, dims int, label int, ids array<long>, vector array<long>"
_FOUND = "anchor string, low long, high long, score long, name string, ids array<long>"


@dataclass(frozen=True)
class Settings:
    """``positives`` and ``negatives`` first rows each; a negative has ``percent`` of the positive's
    score at least. Centres are at most ``centres`` per label, picked by digest."""

    every: int = 100
    relabelled: int = 7
    labels: int = 10
    scale: int = 256
    positives: int = 5
    negatives: int = 5
    percent: int = 80
    centres: int = 256
    block: int = 4_096
    part: int = 16_384
    leaf: int = 32
    ratio: float = 0.7


def usable(vectors: DataFrame, settings: Settings) -> DataFrame:
    """``vec_id, dims, label, vector`` of the rows that take part, each once, in integers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    moved = F.pmod(F.col("label") + 1, F.lit(settings.labels))
    whole = F.transform("embedding", lambda x: F.floor(x * float(settings.scale)))
    square = F.aggregate(
        F.transform("embedding", lambda x: x * float(settings.scale)),
        F.lit(0.0),
        lambda total, x: total + (F.abs(x) + 1) * (F.abs(x) + 1),
    )
    return (
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("embedding"),
            F.col("label").cast("int").alias("label"),
        )
        .where("vec_id is not null and label is not null and embedding is not null")
        .where(finite)
        .where(square < LARGEST)
        .select(
            "vec_id",
            F.size("embedding").alias("dims"),
            F.when(F.col("vec_id") % settings.relabelled == 0, moved).otherwise(F.col("label")).alias("label"),
            whole.cast("array<long>").alias("vector"),
        )
        .distinct()
    )


def _name(label: Column, vector: Column) -> Column:
    return F.md5(F.concat_ws(",", label.cast("string"), vector.cast("array<string>")).cast("binary"))


def points(rows: DataFrame, count: int) -> DataFrame:
    """A row per distinct label and vector with the ``count`` smallest ids that have them."""
    first = Window.partitionBy("label", "vector").orderBy("vec_id")
    return (
        rows.withColumn("at", F.row_number().over(first))
        .where(F.col("at") <= count)
        .groupBy("label", "vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("dims").alias("dims"))
        .select(_name(F.col("label"), F.col("vector")).alias("name"), "dims", "label", "ids", "vector")
    )


class CoverTree:
    """Cover tree of integer vectors lifted to one norm.

    A node is a point with the radius that covers all below it; its children are a net of that set at
    ``ratio`` times the level's scale, the node's own point among them. Sets of ``leaf`` points or
    fewer, and sets of equal lifted points, are leaves.
    """

    def __init__(self, vectors: np.ndarray, leaf: int, ratio: float):
        self.whole = vectors
        floats = vectors.astype(float)
        norms = (floats**2).sum(axis=1)
        self.top = float(norms.max())
        self.lifted = np.column_stack([floats, np.sqrt(np.maximum(self.top - norms, 0))])
        self.squares = (self.lifted**2).sum(axis=1)
        # exact as doubles, or else in integers
        self.values = floats if self.top < EXACT else vectors
        self.slack = 1e-9 * (self.top + 1)
        self.centre: list[int] = []
        self.radius: list[float] = []
        # of a node: the points verified at it, and the nodes it leads to
        self.members: list[np.ndarray] = []
        self.children: list[np.ndarray] = []
        start = np.arange(len(vectors))
        waiting = [(self._node(0, self._from(0, start)), start)]
        while waiting:
            node, members = waiting.pop()
            if len(members) <= leaf or self.radius[node] == 0:
                self.members[node] = members
                continue
            alone, nodes = [], []
            for centre, part, far in self._net(self.centre[node], members, self.radius[node] * ratio):
                if len(part) == 1:  # a child without children is verified with its parent
                    alone.append(part[0])
                    continue
                nodes.append(self._node(centre, far))
                waiting.append((nodes[-1], part))
            self.members[node], self.children[node] = np.array(alone, int), np.array(nodes, int)
        self.centres, self.radii = np.array(self.centre), np.array(self.radius)

    def _node(self, centre: int, distances: np.ndarray) -> int:
        self.centre.append(centre)
        self.radius.append(float(distances.max()))
        self.members.append(np.empty(0, int))
        self.children.append(np.empty(0, int))
        return len(self.centre) - 1

    def _from(self, centre: int, members: np.ndarray) -> np.ndarray:
        found = self.lifted[members] - self.lifted[centre]
        return np.sqrt(np.einsum("ij,ij->i", found, found))

    def _net(self, own: int, members: np.ndarray, scale: float):
        """Centres over ``scale`` apart that cover the members: the node's own point first, then the
        first member that no centre covers yet. Distances are found for many at a time."""
        distance = self._from(own, members)
        near = distance <= scale
        parts = [(own, members[near], distance[near])]
        rest = members[~near]
        while len(rest):
            head = rest[:64]
            between = self._between(head, rest)
            taken = np.zeros(len(rest), bool)
            for i in range(len(head)):
                if taken[i]:
                    continue
                covered = (between[i] <= scale) & ~taken
                covered[i] = True
                parts.append((int(head[i]), rest[covered], between[i, covered]))
                taken |= covered
            rest = rest[~taken]
        return parts

    def _between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        square = self.squares[a, None] + self.squares[None, b] - 2 * self.lifted[a] @ self.lifted[b].T
        return np.sqrt(np.maximum(square, 0)) + math.sqrt(self.slack)

    def bounds(self, anchor: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product with anything below the nodes."""
        square = float(anchor @ anchor)
        centres, radius = self.centres[nodes], self.radii[nodes]
        products = self.lifted[centres, :-1] @ anchor
        apart = np.sqrt(np.maximum(square + self.squares[centres] - 2 * products, 0))
        base = square + self.top
        slack = 1e-9 * (base + 1) + (radius + apart) * math.sqrt(self.slack)
        least = (base - (apart + radius) ** 2) / 2 - slack
        most = (base - np.maximum(apart - radius, 0) ** 2) / 2 + slack
        return least, most

    def scores(self, anchor: np.ndarray, members: np.ndarray) -> np.ndarray:
        if self.values.dtype == float:
            own = anchor.astype(float)
            if float(own @ own) < EXACT:
                return (self.values[members] @ own).astype(np.int64)
        return self.whole[members] @ anchor

    def search(self, anchor: np.ndarray, lows, highs, k: int, ids: np.ndarray):
        """Per window ``low..high`` the positions and scores of its first ``k``: higher scores first,
        then smaller ids. One descent for all windows, best first; a node is skipped if it can hold
        nothing that belongs to a window, or nothing as high as the k-th found in each."""
        own = anchor.astype(float)
        lows, highs = np.asarray(lows, np.int64), np.asarray(highs, np.int64)
        least_wanted = lows.copy()
        best = [(np.empty(0, int), np.empty(0, np.int64)) for _ in lows]
        queue: list[tuple[float, float, int]] = []

        def wanted(bottom, top):
            return ((top[:, None] >= least_wanted) & (bottom[:, None] <= highs)).any(axis=1)

        def offer(nodes: np.ndarray) -> None:
            bottom, top = self.bounds(own, nodes)
            for i in np.flatnonzero(wanted(bottom, top)):
                heapq.heappush(queue, (-top[i], bottom[i], int(nodes[i])))

        offer(np.zeros(1, int))
        width = 1
        while queue and -queue[0][0] >= least_wanted.min():
            # The best nodes are taken in bundles that double, and verified together.
            taken = [heapq.heappop(queue) for _ in range(min(width, len(queue)))]
            width *= 2
            bottom, top = np.array([b for _, b, _ in taken]), -np.array([t for t, _, _ in taken])
            nodes = [taken[i][2] for i in np.flatnonzero(wanted(bottom, top))]
            if not nodes:
                continue
            members = np.concatenate([self.members[n] for n in nodes])
            scores = self.scores(anchor, members)
            for w, (positions, found) in enumerate(best):
                inside = np.flatnonzero((scores >= least_wanted[w]) & (scores <= highs[w]))
                if not len(inside):
                    continue
                if len(inside) > 8 * k:
                    # Whatever lies below the k-th score of these is out; ties stay.
                    border = np.partition(scores[inside], len(inside) - k)[len(inside) - k]
                    inside = inside[scores[inside] >= border]
                positions = np.concatenate([positions, members[inside]])
                found = np.concatenate([found, scores[inside]])
                first = np.lexsort((ids[positions], -found))[:k]
                best[w] = positions[first], found[first]
                if len(first) == k:
                    least_wanted[w] = max(lows[w], found[first[-1]])
            offer(np.concatenate([self.children[n] for n in nodes]))
        return best


def _searcher(settings: Settings, k: int):
    """One part of the anchors that come to a block, against the block's tree."""

    def search(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(block):
            tree = CoverTree(np.stack(block["vector"]), settings.leaf, settings.ratio)
            names, lists = block["name"].to_numpy(), block["ids"].to_numpy()
            first = np.array([ids[0] for ids in lists])
            for anchor in asked.itertuples(index=False):
                vector = np.asarray(anchor.vector)
                best = tree.search(vector, anchor.lows, anchor.highs, k, first)
                for low, high, (positions, scores) in zip(anchor.lows, anchor.highs, best):
                    for position, score in zip(positions, scores):
                        out.append((anchor.name, low, high, score, names[position], lists[position]))
        return pd.DataFrame(out, columns=["anchor", "low", "high", "score", "name", "ids"], dtype=object)

    return search


def _blocks(classes: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Kept candidates with their ``cell, block``, and per block what bounds its products.

    Large labels get centres, at most ``centres``: the points of the smallest digests. A candidate goes
    to the nearest of its label; a cell larger than a block is cut by digest.
    """
    sizes = classes.groupBy("dims", "label").agg(F.count(F.lit(1)).alias("size"))
    wanted = F.least(F.ceil(F.col("size") / settings.block), F.lit(settings.centres)).cast("int")
    by_digest = Window.partitionBy("dims", "label").orderBy("name")
    large = sizes.withColumn("wanted", wanted).where("wanted > 1").drop("size")
    centres = keep(
        classes.join(large, ["dims", "label"])
        .withColumn("cell", F.row_number().over(by_digest))
        .where((F.col("cell") <= settings.centres) & (F.col("cell") <= F.col("wanted")))
        .groupBy("dims", "label")
        .agg(F.sort_array(F.collect_list(F.struct("cell", "vector"))).alias("found"))
        .select("dims", "label", F.col("found.vector").alias("centres"))
    )

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = np.zeros(len(batch), int)
            for (_, _), rows in batch.reset_index(drop=True).groupby(["dims", "label"]):
                if rows["centres"].iloc[0] is not None:
                    middles = np.stack(rows["centres"].iloc[0]).astype(float)
                    own = np.stack(rows["vector"]).astype(float)
                    cells[rows.index] = (own @ middles.T - (middles**2).sum(axis=1) / 2).argmax(axis=1)
            yield batch.drop(columns="centres").assign(cell=cells)

    if centres.isEmpty():
        placed = classes.withColumn("cell", F.lit(0))
    else:
        placed = classes.join(centres, ["dims", "label"], "left").mapInPandas(nearest, f"{_POINT}, cell int")
    placed = keep(placed)
    counts = placed.groupBy("dims", "label", "cell").agg(F.count(F.lit(1)).alias("rows"))
    counts = counts.withColumn("blocks", F.ceil(F.col("rows") / settings.block).cast("int")).drop("rows")
    placed = keep(
        placed.join(counts, ["dims", "label", "cell"])
        .withColumn("block", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
        .drop("blocks")
    )

    def root(block: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(block["vector"]).astype(float)
        middle = vectors.mean(axis=0)
        apart = np.sqrt(((vectors - middle) ** 2).sum(axis=1))
        return pd.DataFrame(
            {
                **{c: [int(block[c].iloc[0])] for c in ("dims", "label", "cell", "block")},
                "middle": [middle],
                "radius": [float(apart.max())],
            }
        )

    roots = placed.groupBy("dims", "label", "cell", "block").applyInPandas(
        root, "dims int, label int, cell int, block int, middle array<double>, radius double"
    )
    return placed, keep(roots)


def _asked(anchors: DataFrame, roots: DataFrame, same: bool, parts: int) -> DataFrame:
    """Anchors with the blocks whose products may lie in one of their windows."""
    label = F.col("own") == F.col("label") if same else F.col("own") != F.col("label")
    product = F.aggregate(
        F.zip_with(F.col("vector").cast("array<double>"), "middle", lambda x, y: x * y),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    norm = F.sqrt(
        F.aggregate(F.col("vector").cast("array<double>"), F.lit(0.0), lambda total, x: total + x * x)
    )
    reach = F.col("norm") * F.col("radius") * (1 + 1e-9) + F.abs(F.col("product")) * 1e-9 + 1
    meets = F.exists(
        F.arrays_zip("lows", "highs"),
        lambda w: (w["lows"] <= F.col("product") + reach) & (w["highs"] >= F.col("product") - reach),
    )
    return (
        anchors.withColumnRenamed("label", "own")
        .join(roots, "dims")
        .where(label)
        .withColumns({"product": product, "norm": norm})
        .where(meets)
        .withColumn("part", F.pmod(F.xxhash64("name"), F.lit(parts)).cast("int"))
        .select("name", "vector", "lows", "highs", "dims", "label", "cell", "block", "part")
    )


def _searched(asked: DataFrame, placed: DataFrame, settings: Settings, k: int) -> DataFrame:
    """The first ``k`` rows per anchor and window, over all blocks: ``vec_id, name, score, at``."""
    asked = keep(asked)
    block = ["dims", "label", "cell", "block"]
    key = [*block, "part"]
    meetings = asked.select(*key).distinct().select(*[F.col(c).alias(c) for c in key])
    found = (
        asked.groupBy(*key)
        .cogroup(placed.join(meetings, block).groupBy(*key))
        .applyInPandas(_searcher(settings, k), _FOUND)
    )
    window = Window.partitionBy("anchor", "low", "high")
    classes = found.withColumn(
        "at", F.row_number().over(window.orderBy(F.desc("score"), F.col("ids")[0], "name"))
    ).where(F.col("at") <= k)
    rows = classes.select("anchor", "low", "high", "score", "name", F.explode("ids").alias("vec_id"))
    ordered = window.orderBy(F.desc("score"), "vec_id", "name")
    return keep(rows.withColumn("at", F.row_number().over(ordered)).where(F.col("at") <= k))


def hard_negatives(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor.

    Rows with a null id, label or vector or with a null, NaN or infinite component take no part, nor
    do those whose scores might not fit a long. A label is ``(label + 1) % labels`` where the id is
    divisible by ``relabelled``; components are floor(scale * x). Anchors are rows whose id is
    divisible by ``every``. An anchor's positives are the first ``positives`` other rows of its label by
    inner product, ties by smaller id. A positive's negatives are the first ``negatives`` rows of other
    labels with at least ``percent`` of its score and no more than it. Vectors of different length are
    not compared. Repeated rows count once; rows that share an id but not the vector or the label are
    rows of their own. Anchors without a positive, and positives without a negative, give no row.
    Other columns are ignored.
    """
    rows = keep(usable(vectors, settings))
    size = max(settings.positives + 1, settings.negatives)
    classes = keep(points(rows, size))
    placed, roots = _blocks(classes, settings)
    mine = keep(
        rows.where(F.col("vec_id") % settings.every == 0).select(
            F.col("vec_id").alias("anchor_id"), _name(F.col("label"), F.col("vector")).alias("anchor")
        )
    )
    anchors = keep(
        classes.drop("ids").join(mine.select(F.col("anchor").alias("name")).distinct(), "name", "left_semi")
    )
    parts = max(1, -(-anchors.count() // settings.part))
    lowest, highest = F.lit(-(2**62)), F.lit(2**62)
    everything = anchors.withColumns({"lows": F.array(lowest), "highs": F.array(highest)})
    # One row at most of these is the anchor itself.
    positives = _searched(
        _asked(everything, roots, True, parts), placed, settings, settings.positives + 1
    )
    # 80 p <= 100 n in integers: n from the ceiling of p * percent / 100 on.
    scaled = F.col("score").cast("decimal(38,0)") * settings.percent
    windows = (
        positives.select(F.col("anchor").alias("name"), "score")
        .distinct()
        .withColumn("low", F.ceil(scaled / 100).cast("long"))
        .where(F.col("low") <= F.col("score"))
        .groupBy("name")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("score").alias("high"), "low"))).alias("windows"))
        .select("name", F.col("windows.low").alias("lows"), F.col("windows.high").alias("highs"))
    )
    negatives = _searched(
        _asked(anchors.join(windows, "name"), roots, False, parts), placed, settings, settings.negatives
    ).select(
        "anchor",
        F.col("high").alias("positive_score"),
        F.col("at").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    order = Window.partitionBy("anchor_id", "anchor").orderBy("at")
    chosen = (
        positives.join(mine, "anchor")
        .where((F.col("vec_id") != F.col("anchor_id")) | (F.col("name") != F.col("anchor")))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= settings.positives)
        .select(
            "anchor_id", "anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
    )
    return chosen.join(negatives, ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def oracle_sql() -> str:
    s = Settings()
    return f"""
with kept as (
    select distinct vec_id, case when vec_id % {s.relabelled} = 0 then (label + 1) % {s.labels} else label end as label,
           list_transform(embedding, lambda x: floor({s.scale} * x::double)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select a.vec_id as anchor_id, b.vec_id, a.label as own, b.label,
           list_inner_product(a.v, b.v)::bigint as score
    from kept a join kept b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where a.vec_id % {s.every} = 0),
positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where label = own
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {s.positives})
select p.anchor_id, p.positive_id, n.vec_id as negative_id, p.positive_score, n.score as negative_score,
       row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id)::integer as rank
from positives p join scored n
  on n.anchor_id = p.anchor_id and n.label <> n.own
 and {s.percent} * p.positive_score <= 100 * n.score and 100 * n.score <= 100 * p.positive_score
qualify rank <= {s.negatives}"""
