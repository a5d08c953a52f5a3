"""What the operators share: tables kept in the shared folder, folds, components, whole groups."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root

#: Held-out fold: rows whose crc32 of the id as text has this remainder.
FOLDS, HELD_OUT = 4, 2


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def run_folder(spark: SparkSession) -> str:
    """The folder of the shared one that holds what this application keeps; it goes when it ends."""
    folder = f"{checkpoint_root(spark).rstrip('/')}/llm-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lost executors cost no recomputation.

    Frames that were returned may still read the tables; they are deleted when the application ends.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._kept_path = path
    return kept


def map_with_id(rows: DataFrame, run, schema: str, name: str = "doc_id") -> DataFrame:
    """``rows.mapInPandas(run, schema)`` with the long column ``name`` as text inside: beside a null,
    pandas would turn it into doubles, which don't hold large ids."""
    found = rows.withColumn(name, F.col(name).cast("string")).mapInPandas(
        run, schema.replace(f"{name} long", f"{name} string", 1)
    )
    return found.select(
        *[F.col(c).cast("long").alias(c) if c == name else F.col(c) for c in found.columns]
    )


def discard(*kept: DataFrame) -> None:
    """Delete tables written by ``keep`` that no returned frame reads any more."""
    for df in kept:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._kept_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: Ids that are sent to every task at most; beyond that the join shuffles both sides. Spark's table of them
#: takes about 80 bytes each, and twice that just after it has grown (203,235 ids: 16.8 MB).
BROADCAST_IDS = 500_000


def sent_ids(ids: DataFrame) -> DataFrame:
    """A kept one-column table of ids to join texts by, broadcast where its counted size allows it."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def held_out(doc_id: Column) -> Column:
    """True for the fold that models never learn from; false where the id is null."""
    return F.coalesce(
        F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False)
    )


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``node, component``: for every node of an edge the smallest node reachable from it.

    Alternates the large-star and small-star steps until the edges stay as they are. Minima are
    combined before the shuffle and the joins may be split at hot nodes.
    """
    current = keep(
        edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m"))
        .where(F.col("v") != F.col("m"))
        .distinct()
    )
    state = _state(current)
    for _ in range(rounds):
        following = keep(_small_star(_large_star(current)))
        discard(current)
        current, before, state = following, state, _state(following)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return current.select(F.col("v").alias("node"), F.col("m").alias("component")).union(
        current.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    digest = F.xxhash64("v", "m").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(digest)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("v").alias("u"), F.col("m").alias("w")).union(
        edges.select(F.col("m").alias("u"), F.col("v").alias("w"))
    )
    least = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("m"))
    return (
        both.where(F.col("w") > F.col("u")).join(least, "u").select(F.col("w").alias("v"), "m")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("v").agg(F.min("m").alias("least"))
    moved = edges.join(least, "v").select(F.col("m").alias("v"), F.col("least").alias("m"))
    return (
        moved.where(F.col("v") != F.col("m"))
        .union(least.select("v", F.col("least").alias("m")))
        .distinct()
    )


def whole_groups(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Regroup batches of rows sorted by ``keys`` so that no group is cut; groups must be bounded.

    Yields frames of one or more whole groups.
    """
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        last = np.ones(len(rows), bool)
        for key in keys:
            values = rows[key].to_numpy()
            last &= values == values[-1]
        if last.all():
            rest = rows
            continue
        first = int(np.flatnonzero(~last)[-1]) + 1
        yield rows.iloc[:first]
        rest = rows.iloc[first:]
    if rest is not None:
        yield rest


def group_bounds(rows: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """Start of every group in sorted rows, and the end."""
    changed = np.zeros(len(rows), bool)
    changed[0] = True
    for key in keys:
        values = rows[key].to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(changed), len(rows))
