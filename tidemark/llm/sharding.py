"""Shards of equal row counts by balanced label propagation, in DataFrame operations only.

Documents of equal text are linked. They start in a shard by hash; in every round each group asks to come
together in the shard that holds most of it, and requests are granted in order while the shard's quota
lasts. Rows that have not come together yield: a shard's quota is all that settled groups leave of it, so
full shards exchange rows, and a group none of whose shards has room asks for one that has. Larger groups
come first. A group is cut only where it exceeds a shard, into parts that fill one. What found no shard, and
what is linked to nothing, fills the shards up, which makes the counts exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, keep
from tidemark.llm.numbering import CHUNKS, numbered

OVERHEAD = 16
#: Groups over 1/2, 1/4 and 1/8 of a shard settle before smaller ones.
SIZE_CLASSES = (2, 4, 8)


@dataclass(frozen=True)
class Settings:
    """``rounds`` of propagation per size class at most; they end as soon as no group can move."""

    shards: int = 40
    rounds: int = 24
    seed: int = 17


def _array(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _described(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text, F.lit(1)).alias("group"),
    )


def sharded(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    Law ``rows``: row counts of shards differ by one at most, lower shards being the larger ones;
    ``grown_shard`` is null. ``size`` is the UTF-8 length of the text plus 16; null texts are as
    empty, and all of them are one group. Repeated rows and null ids get a slot each. With no rows
    there is none. Other columns are ignored.
    """
    # The row number is written once, so that later rounds see the same rows.
    rows = keep(_described(docs).withColumn("row", F.monotonically_increasing_id()))
    total = rows.count()
    caps = [total // settings.shards + (s < total % settings.shards) for s in range(settings.shards)]
    limit = max(1, min(caps))
    placed, groups = _linked(rows, limit)
    homes, loads, tables = _propagated(placed, caps, limit, settings)
    columns = ["doc_id", "size", "text_crc32", "row"]
    at_home = keep(placed.join(homes, "hub", "left").select(*columns, "hub", "home"))
    settled = at_home.where("home is not null").select(*columns, F.col("home").alias("shard"))
    free, ends = 0, []
    for cap, load in zip(caps, loads):
        free += cap - load
        ends.append(free)
    # Linked rows come first and near each other, so that few shards share a group without a home.
    half, side = CHUNKS // 2, 16
    near = F.pmod(F.xxhash64("hub"), F.lit(half // side)) * side + F.pmod(F.xxhash64("row"), F.lit(side))
    loose = numbered(
        at_home.where("home is null"),
        "place",
        [],
        F.when(F.col("hub").isNull(), half + F.pmod(F.xxhash64("row"), F.lit(half))).otherwise(near),
        ["hub", "row"],
    )
    filled = loose.select(
        *columns, F.size(F.filter(_array(ends), lambda end: end <= F.col("place"))).alias("shard")
    )
    everything = keep(settled.unionByName(filled))
    result = numbered(
        everything, "slot", ["shard"], F.pmod(F.xxhash64("row"), F.lit(CHUNKS)), ["row"]
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
    discard(rows, groups, placed, at_home, *tables)
    return result


def _linked(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the ``hub`` that links them, null where nothing does; and the table of groups.

    Groups of more than ``limit`` rows are cut into parts of ``limit``, the last one smaller.
    """
    key = ["group", "size", "text_crc32"]
    groups = keep(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).where("members > 1"))
    hub = F.when(F.col("members") > 1, F.xxhash64(*key))
    large = groups.where(F.col("members") > limit).select(*key)
    if not large.head(1):
        return keep(rows.join(groups, key, "left").withColumn("hub", hub).drop("members")), groups
    sent = F.broadcast(large)  # at most a group per shard and its remainder
    cut = numbered(
        rows.join(sent, key), "place", key, F.pmod(F.xxhash64("row"), F.lit(CHUNKS)), ["row"]
    ).withColumn("hub", F.xxhash64(*key, F.floor(F.col("place") / limit)))
    whole = rows.join(sent, key, "left_anti").join(groups, key, "left").withColumn("hub", hub)
    return keep(whole.drop("members").unionByName(cut.drop("place"))), groups


def _propagated(
    placed: DataFrame, caps: list[int], limit: int, settings: Settings
) -> tuple[DataFrame, list[int], list[DataFrame]]:
    """``hub, home``: the shard in which each group came together; the rows that each shard holds of
    them; and the tables used for it."""
    at_first = F.pmod(F.xxhash64("row", F.lit(settings.seed)), F.lit(settings.shards)).cast("int")
    size_class = F.size(
        F.filter(_array([limit // c for c in SIZE_CLASSES]), lambda bound: F.col("members") <= bound)
    )
    everyone = keep(
        placed.where("hub is not null")
        .groupBy("hub", at_first.alias("shard"))
        .agg(F.count(F.lit(1)).alias("here"))
        .groupBy("hub")
        .agg(
            F.sum("here").alias("members"),
            F.collect_list(F.struct("here", "shard")).alias("places"),  # one per shard at most
        )
        .withColumn("size_class", size_class)
    )
    tables = [everyone]
    loads = [0] * settings.shards
    homes = placed.sparkSession.createDataFrame([], "hub long, home int")
    for found in sorted(r[0] for r in everyone.select("size_class").distinct().collect()):
        waiting = everyone.where(F.col("size_class") == found)
        for _ in range(settings.rounds):
            room = _array([c - n for c, n in zip(caps, loads)])
            accepted = keep(_within_quota(_asked(waiting, room, settings), room))
            tables.append(accepted)
            taken = accepted.groupBy("home").agg(F.sum("members")).collect()  # a row per shard
            if not taken:
                break
            for home, members in taken:
                loads[home] += members
            homes = homes.unionByName(accepted.select("hub", "home"))
            waiting = keep(waiting.join(accepted.select("hub"), "hub", "left_anti"))
            tables.append(waiting)
    return homes, loads, tables


def _asked(waiting: DataFrame, room: Column, settings: Settings) -> DataFrame:
    """``hub, members, home``: the shard with room that holds most of a group, else any with room."""
    fits = F.filter("places", lambda p: F.col("members") <= F.get(room, p["shard"]))
    # Ties are broken by hash, so that groups that lie alike ask for different shards.
    mostly = F.array_max(
        F.transform(
            fits,
            lambda p: F.struct(p["here"].alias("here"), F.xxhash64("hub", p["shard"]).alias("tie"), p["shard"]),
        )
    )["shard"]
    others = F.filter(
        F.sequence(F.lit(0), F.lit(settings.shards - 1)), lambda s: F.col("members") <= F.get(room, s)
    )
    other = F.array_max(
        F.transform(others, lambda s: F.struct(F.xxhash64("hub", s).alias("tie"), s.alias("shard")))
    )["shard"]
    return waiting.select("hub", "members", F.coalesce(mostly, other).alias("home")).where("home is not null")


def _within_quota(asked: DataFrame, room: Column) -> DataFrame:
    """Requests granted in order of chunks while the room of the shard lasts."""
    placed = asked.withColumn("chunk", F.pmod(F.xxhash64("hub"), F.lit(CHUNKS)))
    chunks = placed.groupBy("home", "chunk").agg(F.sum("members").alias("sum"))
    order = Window.partitionBy("home").orderBy("chunk")
    offsets = chunks.select(
        "home", "chunk", (F.sum("sum").over(order) - F.col("sum")).alias("before")
    )
    inside = (
        Window.partitionBy("home", "chunk")
        .orderBy(F.desc("members"), "hub")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.join(F.broadcast(offsets), ["home", "chunk"])
        .withColumn("until", F.col("before") + F.sum("members").over(inside))
        .where(F.col("until") <= F.get(room, F.col("home")))
        .select("hub", F.col("home").cast("int").alias("home"), "members")
    )
