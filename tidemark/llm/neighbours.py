"""Approximate nearest neighbours by stable projections in kd-trees.

Vectors are projected on a few random directions with normal (2-stable) coefficients. A squared projected
distance over the squared true one then has a chi-square distribution, whatever the data. Neighbours are
visited in the order of projected distance and verified on the original vectors; a search stops when the
distribution says that a vector as near as the k-th found would hardly lie so far out.

The top of the kd-tree cuts the projected space into cells, fitted on a bounded sample; every row is in the
index. Cells are cut into blocks of bounded size, each with a kd-tree of its own in a task. A query searches
a block of its own cell first, which bounds its k-th distance; it then goes to the cells that the stopping
test does not rule out. Queries that meet a block are cut into parts of bounded size as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keep

_FOUND = "name string, ids array<long>, distance double, query string"


@dataclass(frozen=True)
class Settings:
    """``directions`` (even) projections; ``confidence`` is the chance at least with which a true
    neighbour is visited before the test stops a search. Cells are fitted on at most ``sample``
    points and are at most ``cells``; blocks hold about ``block`` points, parts ``part`` queries."""

    k: int = 10
    every: int = 100
    directions: int = 16
    confidence: float = 0.97
    sample: int = 16_384
    cells: int = 1_024
    block: int = 16_384
    part: int = 32_768
    leaf: int = 64
    seed: int = 29


def chi_square(x: float, freedom: int) -> float:
    """Distribution function of the chi-square distribution for an even number of freedoms."""
    half, term, total = x / 2, 1.0, 0.0
    for i in range(freedom // 2):
        total += term
        term *= half / (i + 1)
    return 1 - math.exp(-half) * total


def stop_factor(settings: Settings) -> float:
    """Projected distance over the k-th true one beyond which the stopping test ends a search."""
    low, high = 0.0, 100.0 * settings.directions
    for _ in range(100):
        middle = (low + high) / 2
        if chi_square(middle, settings.directions) < settings.confidence:
            low = middle
        else:
            high = middle
    return math.sqrt(high)


def directions(dims: int, settings: Settings) -> np.ndarray:
    return np.random.default_rng([settings.seed, dims]).normal(size=(dims, settings.directions))


def _projector(settings: Settings):
    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            low = []
            for vector in batch["vector"]:
                if len(vector) not in known:
                    known[len(vector)] = directions(len(vector), settings)
                with np.errstate(over="ignore"):
                    low.append(np.nan_to_num(np.asarray(vector, float) @ known[len(vector)]))
            yield batch.assign(low=low)

    return project


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that can be compared, each once."""
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return (
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("vector"),
        )
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .where(finite & F.exists("vector", lambda x: x != 0))
    )


def points(rows: DataFrame, settings: Settings) -> DataFrame:
    """``name, ids, vector``: a row per distinct vector with the ``k + 1`` smallest ids that have it.

    No list of a query can hold more of a group of copies. Spark keeps that many per task before the
    shuffle, so a group of any size costs no task more than others.
    """
    first = Window.partitionBy("vector").orderBy("vec_id")
    return (
        rows.distinct()
        .withColumn("at", F.row_number().over(first))
        .where(F.col("at") <= settings.k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(_name(F.col("vector")).alias("name"), "ids", "vector")
    )


def _name(vector: Column) -> Column:
    """A digest that equal vectors share."""
    return F.md5(F.concat_ws(",", F.transform(vector, lambda x: (x + F.lit(0.0)).cast("string"))).cast("binary"))


class Splits:
    """The top of the kd-tree: a complete tree of medians, one direction per level by turns of spread."""

    def __init__(self, low: np.ndarray, levels: int):
        self.levels = levels
        self.axis = np.zeros(2**levels, int)
        self.value = np.zeros(2**levels)
        groups = [np.arange(len(low))]
        for level in range(levels):
            following = []
            for i, group in enumerate(groups):
                node = 2**level + i
                axis = int(np.argmax(low[group].std(axis=0))) if len(group) else 0
                self.axis[node] = axis
                self.value[node] = np.median(low[group, axis]) if len(group) else 0.0
                right = low[group, axis] > self.value[node]
                following += [group[~right], group[right]]
            groups = following

    def cells(self, low: np.ndarray) -> np.ndarray:
        node = np.ones(len(low), int)
        for _ in range(self.levels):
            node = 2 * node + (low[np.arange(len(low)), self.axis[node]] > self.value[node])
        return node - 2**self.levels


class Tree:
    """A kd-tree over the points of one block; leaves are runs of an order of the points."""

    def __init__(self, vectors: np.ndarray, low: np.ndarray, leaf: int):
        pieces = [np.arange(len(low))]
        while max(map(len, pieces)) > leaf:
            halves = []
            for piece in pieces:
                if len(piece) <= leaf:
                    halves.append(piece)
                    continue
                axis = int(np.argmax(low[piece].max(axis=0) - low[piece].min(axis=0)))
                order = np.argpartition(low[piece, axis], len(piece) // 2)
                halves += [piece[order[: len(piece) // 2]], piece[order[len(piece) // 2 :]]]
            pieces = halves
        self.order = np.concatenate(pieces)
        self.ends = np.cumsum([len(p) for p in pieces])
        self.starts = self.ends - [len(p) for p in pieces]
        self.least = np.array([low[p].min(axis=0) for p in pieces])
        self.most = np.array([low[p].max(axis=0) for p in pieces])
        self.vectors, self.low = vectors[self.order], low[self.order]

    def search(self, vector, low, k: int, bound: float, factor: float):
        """Positions, distances of the ``k`` nearest within ``bound``, and how many were verified."""
        apart = np.maximum(np.maximum(self.least - low, low - self.most), 0)
        ahead = np.sqrt((apart**2).sum(axis=1))
        positions, distances = np.empty(0, int), np.empty(0)
        verified = 0
        # Leaves come nearest first, in bundles that double.
        order, at, width = np.argsort(ahead, kind="stable"), 0, 2
        while at < len(order) and ahead[order[at]] <= bound * factor:
            bundle = order[at : at + width]
            at, width = at + width, width * 2
            rows = np.concatenate([np.arange(self.starts[i], self.ends[i]) for i in bundle])
            projected = np.sqrt(((self.low[rows] - low) ** 2).sum(axis=1))
            inside = projected <= bound * factor
            rows, projected = rows[inside], projected[inside]
            incremental = np.argsort(projected, kind="stable")
            done = 0
            while done < len(rows) and projected[incremental[done]] <= bound * factor:
                some = rows[incremental[done : done + 256]]
                done += 256
                verified += len(some)
                exact = np.sqrt(((self.vectors[some] - vector) ** 2).sum(axis=1))
                near = exact <= bound
                positions = np.concatenate([positions, some[near]])
                distances = np.concatenate([distances, exact[near]])
                if len(distances) > k:
                    # Ties at the border stay; ids decide between them later.
                    border = np.partition(distances, k - 1)[k - 1]
                    near = distances <= border
                    positions, distances = positions[near], distances[near]
                if len(distances) >= k:
                    bound = min(bound, float(distances.max()))
        return self.order[positions], distances, verified


def _searcher(settings: Settings):
    """Pairs one part of the queries that come to a block with the block's points."""
    factor = stop_factor(settings)
    k = settings.k + 1

    def search(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return pd.DataFrame(columns=["name", "ids", "distance", "query"], dtype=object)
        out = []
        sizes = block["vector"].map(len).to_numpy()
        wanted = queries["vector"].map(len).to_numpy()
        for dims in np.unique(wanted):
            own = block[sizes == dims]
            if not len(own):
                continue
            tree = Tree(np.stack(own["vector"]), np.stack(own["low"]), settings.leaf)
            names, ids = own["name"].to_numpy(), own["ids"].to_numpy()
            for q in queries[wanted == dims].itertuples(index=False):
                with np.errstate(over="ignore", invalid="ignore"):
                    found, distance, _ = tree.search(np.asarray(q.vector), np.asarray(q.low), k, q.bound, factor)
                # Of equal distances the smallest ids come first.
                order = np.lexsort(([ids[i][0] for i in found], distance))[:k]
                if len(order):
                    out.append((names[found[order]], ids[found[order]], distance[order], [q.name] * len(order)))
        if not out:
            return pd.DataFrame(columns=["name", "ids", "distance", "query"], dtype=object)
        columns = (np.concatenate(c) for c in zip(*out))
        return pd.DataFrame(dict(zip(("name", "ids", "distance", "query"), columns)))

    return search


def _best(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("query").orderBy("distance", F.col("ids")[0], "name")
    return found.withColumn("at", F.row_number().over(nearest)).where(F.col("at") <= k).drop("at")


def indexed(rows: DataFrame, settings: Settings) -> tuple[DataFrame, Splits, dict]:
    """The kept index ``name, ids, vector, low, cell, block``, the top of its tree and its cells."""
    projected = keep(
        points(rows, settings).mapInPandas(
            _projector(settings), "name string, ids array<long>, vector array<double>, low array<double>"
        )
    )
    count = projected.count()
    levels = min(
        max(0, math.ceil(math.log2(max(count / settings.block, 1)))), int(math.log2(settings.cells))
    )
    picked = projected.orderBy("name").limit(settings.sample if levels else 0).select("low").collect()
    splits = Splits(np.array([r["low"] for r in picked]).reshape(len(picked), settings.directions), levels)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=splits.cells(np.stack(batch["low"])))

    placed = projected.mapInPandas(
        place, "name string, ids array<long>, vector array<double>, low array<double>, cell int"
    )
    # At most ``cells`` rows, each with its box in the projected space.
    axes = range(settings.directions)
    cells = {
        r["cell"]: r
        for r in placed.groupBy("cell")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.min(F.col("low")[i]) for i in axes]).alias("least"),
            F.array(*[F.max(F.col("low")[i]) for i in axes]).alias("most"),
        )
        .collect()
    }
    blocks = {c: max(1, -(-r["n"] // settings.block)) for c, r in cells.items()}
    count_of = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]) if blocks else None
    in_block = F.pmod(F.xxhash64("name"), count_of[F.col("cell")]) if blocks else F.lit(0)
    return placed.withColumn("block", in_block.cast("int")), splits, cells


def nearest(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows of every query row of ``vectors`` (vec_id,
    embedding, ...), by Euclidean distance in double precision, nearest first, ties to smaller ids.

    Queries are the rows whose id is divisible by ``every``, candidates all other rows. Rows with a
    null id take no part, nor do null, empty and zero vectors and those with a null, NaN or infinite
    component; vectors of different length are no candidates of each other. Repeated rows count
    once; rows that share an id but not the vector are rows of their own, with a list each. With
    fewer than ``k`` candidates a list has all that were found. Other columns are ignored.
    """
    rows = keep(usable(vectors))
    index, splits, cells = indexed(rows, settings)
    index = keep(index)
    mine = keep(_queried(rows, settings))
    queries = keep(
        index.select("name", "vector", "low", "cell").join(
            mine.select(F.col("query").alias("name")).distinct(), "name", "left_semi"
        )
    )
    parts = max(1, -(-queries.count() // settings.part))
    numbers = np.array(sorted(cells), int)
    blocks = {c: max(1, -(-cells[c]["n"] // settings.block)) for c in cells}
    least = np.array([cells[c]["least"] for c in numbers]).reshape(len(numbers), settings.directions)
    most = np.array([cells[c]["most"] for c in numbers]).reshape(len(numbers), settings.directions)
    factor = stop_factor(settings)
    search = _searcher(settings)

    def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            block = [int(name[:8], 16) % blocks[c] for name, c in zip(batch["name"], batch["cell"])]
            yield batch.assign(bound=np.inf, block=np.array(block, int), part=0)

    task = "name string, vector array<double>, low array<double>, cell int, bound double, block int, part int"
    at_home = queries.mapInPandas(home, task)
    key = ["cell", "block"]
    found_home = keep(
        at_home.groupBy(*key).cogroup(index.groupBy(*key)).applyInPandas(search, _FOUND)
    )
    # The k-th nearest row, counted with copies, bounds what the other cells are searched for.
    reach = Window.partitionBy("query").orderBy("distance")
    bounds = (
        found_home.withColumn("rows", F.sum(F.size("ids")).over(reach))
        .where(F.col("rows") > settings.k)
        .groupBy(F.col("query").alias("name"))
        .agg(F.min("distance").alias("bound"))
    )

    def elsewhere(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            low = np.stack(batch["low"]) if len(batch) else np.empty((0, settings.directions))
            bound = batch["bound"].fillna(np.inf).to_numpy()
            for i, (name, own) in enumerate(zip(batch["name"], batch["cell"])):
                apart = np.maximum(np.maximum(least - low[i], low[i] - most), 0)
                with np.errstate(over="ignore"):
                    reached = numbers[np.sqrt((apart**2).sum(axis=1)) <= bound[i] * factor]
                all_blocks = [(c, b) for c in reached.tolist() for b in range(blocks[c])]
                mine = (own, int(name[:8], 16) % blocks[own])
                goals = [x for x in all_blocks if x != mine]
                if not goals:
                    continue
                yield pd.DataFrame(
                    {
                        "name": name,
                        "vector": [batch["vector"].iloc[i]] * len(goals),
                        "low": [batch["low"].iloc[i]] * len(goals),
                        "cell": [c for c, _ in goals],
                        "bound": bound[i],
                        "block": [b for _, b in goals],
                        "part": int(name[8:16], 16) % parts,
                    }
                )

    searching = keep(queries.join(bounds, "name", "left").mapInPandas(elsewhere, task))
    key = ["cell", "block", "part"]
    wanted = index.join(
        searching.select(*key).distinct().select(*[F.col(c).alias(c) for c in key]), ["cell", "block"]
    )
    found = searching.groupBy(*key).cogroup(wanted.groupBy(*key)).applyInPandas(search, _FOUND)
    best = _best(found_home.unionByName(found), settings.k + 1)

    # One row at most of a query's k + 1 nearest is its own.
    rows_of = Window.partitionBy("query").orderBy("score", "vec_id", "name")
    listed = (
        best.select("query", "name", F.col("distance").alias("score"), F.explode("ids").alias("vec_id"))
        .withColumn("at", F.row_number().over(rows_of))
        .where(F.col("at") <= settings.k + 1)
    )
    order = Window.partitionBy("query_id", "query").orderBy("at")
    return (
        listed.join(mine, "query")
        .where((F.col("vec_id") != F.col("query_id")) | (F.col("name") != F.col("query")))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= settings.k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _queried(rows: DataFrame, settings: Settings) -> DataFrame:
    return (
        rows.where(F.col("vec_id") % settings.every == 0)
        .select(F.col("vec_id").alias("query_id"), _name(F.col("vector")).alias("query"))
        .distinct()
    )

