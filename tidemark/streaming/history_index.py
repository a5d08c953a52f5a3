"""Which files of the history can hold rows of given users or devices.

Beside the history lies a summary per file and kind of key: the least and greatest key hash, and a Bloom
filter of the keys in blocks of Spark's bitmaps, as many as the file's number of keys asks for. A micro-batch
holds its own keys against the summaries and opens only the files that may have one of them. The summaries
say which files need not be read, never which rows exist: a file without a summary is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = {"user": "user_id", "device": "device_id"}
BLOCK_BITS = 32_768  # of one bitmap of bitmap_construct_agg
BITS_PER_KEY = 16
HASHES = 4  # positions of a key in its block, 15 bits of its hash each
#: With more keys in a batch nearly every file has one of them, so the summaries are not asked.
MOST_KEYS = 200_000
_PARTS = ["event_date", "run", "batch_id"]


def index_folder(history: str) -> str:
    """Hidden from readers of the history."""
    return f"{history}/_index"


def key_hash(column: str) -> Column:
    return F.xxhash64(F.col(column))


def _block_hash(column: str) -> Column:
    return F.xxhash64(F.col(column), F.lit(1))


def _pieces(key: Column) -> list[Column]:
    return [F.shiftright(key, 15 * i).bitwiseAND(BLOCK_BITS - 1) for i in range(HASHES)]


def _positions(key: Column) -> Column:
    return F.array_distinct(F.array(*_pieces(key)))


def summaries(rows: DataFrame) -> DataFrame:
    """Per file, kind and block of the filter one row, from history rows with ``_metadata``.

    Keys are made distinct per file first. They travel with a hash of their file's name only; were two files
    to share it, each would get the keys of both, and none would be missing. A key sets all its bits in one
    row of its block, so no row is multiplied before the shuffle that brings blocks together.
    """
    name = ["file", *_PARTS]
    named = rows.withColumn("file", F.col("_metadata.file_name"))
    place = F.xxhash64(*name).alias("place")
    keys = None
    for kind, column in KINDS.items():
        some = named.filter(F.col(column).isNotNull()).select(
            place, F.lit(kind).alias("kind"), key_hash(column).alias("key"), _block_hash(column).alias("spread")
        )
        keys = some if keys is None else keys.unionByName(some)
    keys = keys.distinct()
    wanted = F.greatest(F.lit(1.0), F.count(F.lit(1)) * BITS_PER_KEY / F.lit(BLOCK_BITS))
    sizes = keys.groupBy("place", "kind").agg(
        F.pow(F.lit(2), F.ceil(F.log2(wanted))).cast("bigint").alias("blocks"),
        F.min("key").alias("least"),
        F.max("key").alias("most"),
    )
    spread = keys.join(F.broadcast(sizes.select("place", "kind", "blocks")), ["place", "kind"]).select(
        "place", "kind", F.col("spread").bitwiseAND(F.col("blocks") - 1).alias("block"), "key"
    )
    maps = [F.bitmap_construct_agg(p).alias(f"bits_{i}") for i, p in enumerate(_pieces(F.col("key")))]
    bits = (
        spread.repartition("place", "kind", "block")
        .groupBy("place", "kind", "block")
        .agg(*maps)
        .select("place", "kind", "block", F.explode(F.array(*[f"bits_{i}" for i in range(HASHES)])).alias("bits"))
        .groupBy("place", "kind", "block")
        .agg(F.bitmap_or_agg("bits").alias("bits"))
    )
    # One row per file, and one per file and kind: the driver lists the files as well.
    files = named.select(place, *name).distinct()
    described = F.broadcast(files.join(sizes, "place"))
    return bits.join(described, ["place", "kind"]).select(
        *name, "kind", "blocks", "least", "most", "block", "bits"
    )


def write_summaries(stored: DataFrame, history: str) -> None:
    """Summarise the files that ``stored`` reads, replacing what their batches had before."""
    (
        summaries(stored)
        # Few files per batch, written by as many tasks as the size asks for.
        .hint("rebalance", *_PARTS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_PARTS)
        .parquet(index_folder(history))
    )


def _holds(row, keys: np.ndarray, spread: np.ndarray) -> bool:
    """Whether one of the keys may be in a block of a file's filter."""
    mine = (spread & (row.blocks - 1)) == row.block
    mine &= (keys >= row.least) & (keys <= row.most)
    keys = keys[mine]
    if not len(keys):
        return False
    bits = np.frombuffer(row.bits, np.uint8)
    hit = np.ones(len(keys), bool)
    for i in range(HASHES):
        at = (keys >> (15 * i)) & (BLOCK_BITS - 1)
        hit &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return bool(hit.any())


def _keys_of(incoming: DataFrame, kind: str) -> tuple[np.ndarray, np.ndarray] | None:
    """The batch's keys as hashes, at most ``MOST_KEYS``; None if there are more."""
    column = KINDS[kind]
    found = (
        incoming.filter(F.col(column).isNotNull())
        .select(key_hash(column).alias("key"), _block_hash(column).alias("spread"))
        .distinct()
        .limit(MOST_KEYS + 1)
        .toPandas()
    )
    if len(found) > MOST_KEYS:
        return None
    return found["key"].to_numpy(np.int64), found["spread"].to_numpy(np.int64)


def files_with_keys(
    spark: SparkSession,
    history: str,
    files: Sequence[str],
    indexed_days: Sequence[str],
    incoming: DataFrame,
    device_from: str,
) -> list[str]:
    """Those of ``files`` that may hold a user of ``incoming``, or on dates from ``device_from`` on a
    device; files are named from their date folder on. All files if the batch has very many keys."""
    keys = {kind: _keys_of(incoming, kind) for kind in KINDS}
    if None in keys.values() or not indexed_days:
        return list(files)
    paths = [f"{index_folder(history)}/event_date={day}" for day in indexed_days]
    index = (
        spark.read.schema(
            "file string, kind string, blocks bigint, least bigint, most bigint, block bigint, bits binary,"
            " event_date string, run string, batch_id string"
        )
        .option("basePath", index_folder(history))
        .parquet(*paths)
    )

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hits = [
                (row.kind == "user" or row.event_date >= device_from) and _holds(row, *keys[row.kind])
                for row in batch.itertuples(index=False)
            ]
            place = [
                f"event_date={r.event_date}/run={r.run}/batch_id={r.batch_id}/{r.file}"
                for r in batch.itertuples(index=False)
            ]
            yield pd.DataFrame({"file": place, "hit": hits})

    # One narrow row per file comes back; Spark's reader lists the files on the driver as well.
    asked = dict(
        index.mapInPandas(ask, "file string, hit boolean").groupBy("file").agg(F.max("hit")).collect()
    )
    return [f for f in files if asked.get(f, True)]
