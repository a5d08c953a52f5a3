"""Near duplicates by b-bit MinHash: banded candidates, bit-count estimates, exact confirmation.

Every document gets K minima. Bands of full minima make candidate buckets; what is carried on is only
the low two bits of each minimum, packed, from which bit counts estimate the similarity of a candidate
pair, corrected for chance collisions. Pairs that may reach the threshold are confirmed on full sets.

Copies are one class before anything is compared. A bucket is worked on in pairs of blocks of bounded
size, and a block hands on documents and a spanning forest of confirmed links, never its pairs.
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
    sent_ids,
    whole_groups,
)
from tidemark.llm.shingles import WordNames, hash_keys, minima, mix, shingle_names, words_of

BITS = 2
_PAIR_LOW = np.uint64(0x5555555555555555)
_BLOCK_KEYS = ["bucket", "i", "j"]


@dataclass(frozen=True)
class Settings:
    """``rows_in_band`` x ``bands`` minima. A pair at 0.8 misses all bands with 3 in a million;
    ``sigmas`` standard errors below the threshold the estimate misses as few."""

    width: int = 4
    percent: int = 80
    rows_in_band: int = 5
    bands: int = 32
    sigmas: float = 4.5
    block: int = 512
    seed: int = 11

    @property
    def hashes(self) -> int:
        return self.rows_in_band * self.bands

    @property
    def least_matches(self) -> int:
        """Equal low-bit fields below which a pair is given up."""
        chance = 2.0**-BITS
        rate = self.percent / 100 * (1 - chance) + chance
        error = math.sqrt(rate * (1 - rate) / self.hashes)
        return math.ceil((rate - self.sigmas * error) * self.hashes)


def packed_low_bits(least: np.ndarray) -> np.ndarray:
    """Low two bits of every minimum, 32 to a 64-bit word."""
    low = least & np.uint64(3)
    low = np.concatenate([low, np.zeros(-len(low) % 32, np.uint64)]).reshape(-1, 32)
    return (low << (np.arange(32, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def equal_fields(a: np.ndarray, b: np.ndarray, hashes: int) -> np.ndarray:
    """Matrix of how many of the packed fields of each row of ``a`` and of ``b`` are equal."""
    unequal = np.zeros((len(a), len(b)), np.uint16)
    for word in range(a.shape[1]):
        x = a[:, word, None] ^ b[None, :, word]
        unequal += np.bitwise_count((x | (x >> np.uint64(1))) & _PAIR_LOW)
    return hashes - unequal.astype(np.int32)


def estimated(matches: np.ndarray, hashes: int) -> np.ndarray:
    """Similarity from equal fields, less the share that is equal by chance."""
    chance = 2.0**-BITS
    return np.clip((matches / hashes - chance) / (1 - chance), 0, 1)


def _signer(settings: Settings):
    keys = hash_keys(settings.hashes, settings.seed)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = WordNames()
        for batch in batches:
            sizes, classes, bands, signatures = [], [], [], []
            for text in batch["text"]:
                words = words_of(text)
                shingles = shingle_names(words, settings.width, names)
                sizes.append(len(shingles))
                if not words:
                    classes.append(None), bands.append(None), signatures.append(None)
                    continue
                least = minima(shingles, keys)
                band = np.arange(settings.bands, dtype=np.uint64)
                for part in least.reshape(settings.bands, settings.rows_in_band).T:
                    band = mix(band + part)
                classes.append(xxhash.xxh3_128_digest(b" ".join(words)))
                bands.append(band.view(np.int64))
                signatures.append(packed_low_bits(least).tobytes())
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_shingles": sizes,
                    "class": classes,
                    "bands": bands,
                    "signature": signatures,
                }
            )

    return sign


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    return map_with_id(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        _signer(settings),
        "doc_id long, n_shingles long, class binary, bands array<long>, signature binary",
    )


def _with_class(docs: DataFrame) -> DataFrame:
    """``class, text`` as ``signatures`` names classes."""

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            classes = [xxhash.xxh3_128_digest(b" ".join(words_of(t))) for t in batch["text"]]
            yield pd.DataFrame({"class": classes, "text": batch["text"]})

    return docs.select("text").mapInPandas(name, "class binary, text string")


class _Block:
    """The members of one pair of blocks and the candidate pairs this bucket is to answer for."""

    def __init__(self, rows: pd.DataFrame, settings: Settings):
        self.ids = rows["node"].to_numpy()
        sizes = rows["n_shingles"].to_numpy()
        signature = np.frombuffer(b"".join(rows["signature"]), np.uint64).reshape(len(rows), -1)
        bands = np.stack(rows["bands"].to_numpy())
        side = rows["side"].to_numpy()
        i, j, bucket = rows["i"].iloc[0], rows["j"].iloc[0], rows["bucket"].iloc[0]
        left = np.flatnonzero(side == i)
        right = left if i == j else np.flatnonzero(side == j)
        matches = equal_fields(signature[left], signature[right], settings.hashes)
        small = np.minimum(sizes[left, None], sizes[None, right]) * 100
        large = np.maximum(sizes[left, None], sizes[None, right]) * settings.percent
        fits = (matches >= settings.least_matches) & (small >= large)
        if i == j:
            fits = np.triu(fits, 1)
        a, b = np.nonzero(fits)
        matches = matches[a, b]
        a, b = left[a], right[b]
        # A pair may meet in many buckets; the first band in which it is equal answers for it.
        # In slices, as there may be a quarter of a million pairs.
        mine = np.zeros(len(a), bool)
        for start in range(0, len(a), 20_000):
            part = slice(start, start + 20_000)
            first = np.argmax(bands[a[part]] == bands[b[part]], axis=1)
            mine[part] = bands[a[part], first] == bucket
        order = np.argsort(-matches[mine], kind="stable")
        self.a, self.b = a[mine][order], b[mine][order]


def _participants(settings: Settings):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, _BLOCK_KEYS):
            rows = rows.reset_index(drop=True)
            bounds = group_bounds(rows, _BLOCK_KEYS)
            chosen = []
            for start, end in zip(bounds[:-1], bounds[1:]):
                if end - start > 1:
                    block = _Block(rows.iloc[start:end], settings)
                    chosen.append(start + np.union1d(block.a, block.b))
            if chosen:
                yield rows.iloc[np.concatenate(chosen).astype(int)]

    return find


def _confirmed(settings: Settings):
    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = WordNames()
        for rows in whole_groups(batches, _BLOCK_KEYS):
            rows = rows.reset_index(drop=True)
            bounds = group_bounds(rows, _BLOCK_KEYS)
            links = []
            for start, end in zip(bounds[:-1], bounds[1:]):
                part = rows.iloc[start:end]
                block = _Block(part, settings)
                texts = part["text"].to_numpy()
                links += _forest(block, texts, settings, names)
            if links:
                yield pd.DataFrame(links, columns=["a", "b"])

    return confirm


def _forest(block: _Block, texts, settings: Settings, names: WordNames) -> list[tuple[int, int]]:
    """Confirmed links, likeliest first, leaving out those between already connected members."""
    root = list(range(len(texts)))
    sets: dict[int, set] = {}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def shingles(x: int) -> set:
        if x not in sets:
            sets[x] = set(shingle_names(words_of(texts[x]), settings.width, names).tolist())
        return sets[x]

    links = []
    for a, b in zip(block.a.tolist(), block.b.tolist()):
        ta, tb = top(a), top(b)
        if ta == tb:
            continue
        sa, sb = shingles(a), shingles(b)
        shared = len(sa & sb)
        if 100 * shared >= settings.percent * (len(sa) + len(sb) - shared):
            root[tb] = ta
            links.append((int(block.ids[a]), int(block.ids[b])))
    return links


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text, ...).

    Documents are linked when 100 * |A n B| >= percent * |A u B| for their sets of word shingles;
    ``component_id`` is the smallest id reachable by links and ``kept`` marks that document.
    Texts that are null, empty or blank have no shingles and link with nothing. Other rows that share
    a doc_id are one document, linked by whatever one of their texts is linked to, and come back as
    often as they were given. A null doc_id has no identity: such a row links with nothing, its
    component is null, and it is kept. Other columns are ignored. Sets are compared by 64-bit
    shingle names.
    """
    # A row's number, written with it, stands for its class where it comes first.
    signed = keep(signatures(docs, settings).withColumn("node", F.monotonically_increasing_id()))
    known = signed.where(F.col("class").isNotNull() & F.col("doc_id").isNotNull())
    first = F.min(F.struct("doc_id", "node")).alias("first")
    # Kept by itself, so that the join may split the rows of a large class.
    classes = keep(
        known.groupBy("class")
        .agg(first, F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("class", F.col("first.node").alias("first_node"))
    )
    members = keep(
        signed.select("doc_id", "n_shingles", "class", "node")
        .join(classes, "class", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(
                F.col("doc_id").isNotNull() & F.col("class").isNotNull(), F.coalesce("first_node", "node")
            ).alias("first_node"),
        )
    )
    singles = known.join(
        members.select(F.col("first_node").alias("node")).where("node is not null").distinct(), "node", "left_semi"
    )
    narrow = keep(singles.select("node", "doc_id", "class", "n_shingles", "bands", "signature"))
    discard(signed)  # nothing below reads it
    # Different texts of one id are one document.
    one_id = (
        members.where("first_node is not null")
        .groupBy("doc_id")
        .agg(F.min("first_node").alias("a"), F.max("first_node").alias("z"))
        .where("a < z")
        .select("doc_id", "a")
    )
    same = members.join(one_id, "doc_id").select("a", F.col("first_node").alias("b")).where("a <> b")
    linked = keep(components(_links(docs, narrow, settings).unionByName(same)))
    # The smallest id of every component that links more than one class.
    smallest = (
        narrow.select(F.col("node"), "doc_id")
        .join(linked, "node")
        .groupBy("component")
        .agg(F.min("doc_id").alias("component_id"))
    )
    reached = linked.join(smallest, "component").select("node", "component_id")
    named = narrow.join(reached, "node", "left").select(
        F.col("node").alias("first_node"), F.coalesce("component_id", "doc_id").alias("class_id")
    )
    result = members.join(named, "first_node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("component_id"),
    )
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _links(docs: DataFrame, singles: DataFrame, settings: Settings) -> DataFrame:
    """Confirmed links between classes: a spanning forest of every block."""
    # Spark takes an explode to add no rows and would broadcast the places of up to 300,000 texts: 32 rows each.
    places = singles.select("node", F.explode("bands").alias("bucket")).hint("merge")
    shared = (
        places.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("size"))
        .where("size > 1")
        .withColumn("blocks", F.ceil(F.col("size") / settings.block).cast("int"))
        .drop("size")
    )
    side = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    blocks = (
        places.join(shared, "bucket")
        .withColumn("side", side)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("side", "other"))
        .withColumn("j", F.greatest("side", "other"))
        .select("bucket", "i", "j", "side", "node")
        .join(singles, "node")
        .select("bucket", "i", "j", "side", "node", "n_shingles", "signature", "bands")
    )
    sorted_blocks = blocks.repartition(*_BLOCK_KEYS).sortWithinPartitions(*_BLOCK_KEYS)
    taking_part = keep(sorted_blocks.mapInPandas(_participants(settings), sorted_blocks.schema))
    # Texts are fetched by id, and told apart by class where an id has several.
    wanted = keep(
        singles.select("node", "doc_id", "class").join(
            taking_part.select("node").distinct(), "node", "left_semi"
        )
    )
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        sent_ids(keep(wanted.select("doc_id").distinct())), "doc_id", "left_semi"
    )
    texts = keep(
        _with_class(found)
        .join(wanted.select("node", "class"), "class")
        .select("node", "text")
        .dropDuplicates(["node"])
    )
    with_text = (
        taking_part.join(texts, "node")
        .repartition(*_BLOCK_KEYS)
        .sortWithinPartitions(*_BLOCK_KEYS, "node")
    )
    return with_text.mapInPandas(_confirmed(settings), "a long, b long")
