"""Merkle manifest of a dataset, stored in blocks of van Emde Boas layout.

Leaves are numbered within their language and cut into aligned subtrees of ``height`` levels. A task holds
one such block: it computes the digests level by level and stores them in one array whose addresses come
from splitting the subtree at half its height again and again, top part first. Block roots are the leaves
of the next level of blocks, up to one root per language; those are the leaves of one more tree.

Siblings come from the same addresses, from the top blocks down: each block hands its children the siblings
on their way to the root, so that a leaf needs its own block and one short list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keep

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_BYTES = 32
_POSITION_BITS = 33  # of monotonically_increasing_id(), below the partition number
_BLOCKS = "run string, block long, n long, height int, nodes binary, root string"
_PATHS = "run string, block long, path array<string>"
_WAYS = "run string, pos long, path array<string>"
_PROOFS = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string,"
    " verified boolean"
)


@dataclass(frozen=True)
class Settings:
    """A block has 2 ** ``height`` leaves; every ``tampering``-th document by checksum is tampered."""

    height: int = 10
    tampering: int = 7


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Addresses of the nodes ``index`` at ``depth`` of a complete tree with so many ``levels``.

    The upper half of the levels lies first, then the subtrees hanging from it, left to right, each
    laid out in the same way.
    """
    at = np.zeros(len(index), np.int64)
    index = index.astype(np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth -= top
        below = levels - top
        at += (1 << top) - 1 + (index >> depth) * ((1 << below) - 1)
        index = index & ((1 << depth) - 1)
        levels = below
    return at


class Block:
    """The digests of one aligned subtree; the lowest level holds ``n`` of 2 ** height leaves.

    Nodes without a leaf below them are not there. A node with one child is the digest of that child.
    """

    def __init__(self, n: int, height: int, nodes: np.ndarray):
        self.n, self.height, self.nodes = n, height, nodes

    def present(self, depth: int) -> int:
        return -(-self.n >> (self.height - depth)) if depth < self.height else self.n

    def at(self, depth: int, index: np.ndarray) -> np.ndarray:
        return address(self.height + 1, depth, index)

    @classmethod
    def built(cls, leaves: list[str], height: int) -> "Block":
        block = cls(len(leaves), height, np.zeros((2 ** (height + 1) - 1, _BYTES), np.uint8))
        current = leaves
        for depth in range(height, -1, -1):
            raw = np.frombuffer(bytes.fromhex("".join(current)), np.uint8)
            block.nodes[block.at(depth, np.arange(len(current)))] = raw.reshape(-1, _BYTES)
            current = [digest("".join(current[i : i + 2])) for i in range(0, len(current), 2)]
        return block

    def level(self, depth: int) -> list[str]:
        """The digests of a level from left to right."""
        found = self.nodes[self.at(depth, np.arange(self.present(depth)))].tobytes().hex()
        return [found[i : i + 2 * _BYTES] for i in range(0, len(found), 2 * _BYTES)]

    def paths(self) -> list[list[str]]:
        """For each leaf its siblings up to the root of the block: the side they are on and their
        digest, or an empty string where there is none."""
        above: list[list[str]] = [[]]
        for depth in range(1, self.height + 1):
            count = self.present(depth)
            other = np.arange(count) ^ 1
            there = other < count
            raw = np.zeros((count, _BYTES), np.uint8)
            raw[there] = self.nodes[self.at(depth, other[there])]
            found = raw.tobytes().hex()
            above = [
                [
                    ("L" if i & 1 else "R") + found[64 * i : 64 * i + 64] if there[i] else "",
                    *above[i >> 1],
                ]
                for i in range(count)
            ]
        return above


def folded(leaf: str, path: list[str]) -> str:
    """The root that follows from a leaf and its siblings."""
    for step in path:
        if not step:
            leaf = digest(leaf)
        elif step[0] == "L":
            leaf = digest(step[1:] + leaf)
        else:
            leaf = digest(leaf + step[1:])
    return leaf


def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def _leaf(n_chars: Column) -> Column:
    columns = [n_chars if name == "n_chars" else F.col(name) for name in FIELDS]
    return F.sha2(F.concat(*map(_field, columns)), 256)


def leaves(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, run, leaf, tampered`` of every document; texts are read once and go no further.

    ``run`` names the language so that null comes first and others follow by their bytes.
    """
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("+"), "lang")).alias("run"),
        _leaf(F.col("n_chars")).alias("leaf"),
        F.when(checksum % settings.tampering == 0, _leaf(more)).alias("tampered"),
    ).withColumn("tampered", F.coalesce("tampered", "leaf"))


def positions(rows: DataFrame, *order: str) -> DataFrame:
    """Kept ``rows`` with ``pos``: 0, 1, ... within ``run`` by ``order``.

    Rows are dealt out by ranges of run and order, so that a run of any size is spread; equal rows
    may swap. What a part adds to another is one row per run and part.
    """
    placed = keep(rows.orderBy("run", *order).withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", _POSITION_BITS)
    counts = placed.groupBy("run", part.alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("place").alias("first")
    )
    before = Window.partitionBy("run").orderBy("part")
    offsets = counts.select(
        "run", "part", "first", (F.sum("rows").over(before) - F.col("rows")).alias("before")
    )
    return (
        placed.withColumn("part", part)
        .join(offsets, ["run", "part"])
        .withColumn("pos", F.col("before") + F.col("place") - F.col("first"))
        .drop("part", "place", "first", "before")
    )


def _height(n: int, only: bool, height: int) -> int:
    """Levels above the leaves of a block: all of them unless it is the only one of its run."""
    return (n - 1).bit_length() if only else height


def _level(nodes: DataFrame, settings: Settings) -> DataFrame:
    """The kept blocks over nodes ``run, pos, total, digest``."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        first, size = rows.iloc[0], 2**settings.height
        height = _height(len(rows), int(first["total"]) <= size, settings.height)
        block = Block.built(rows.sort_values("pos")["digest"].tolist(), height)
        return pd.DataFrame(
            {
                "run": [first["run"]],
                "block": [int(first["block"])],
                "n": [len(rows)],
                "height": [height],
                "nodes": [block.nodes.tobytes()],
                "root": block.level(0),
            }
        )

    block = F.shiftright("pos", settings.height)
    return keep(nodes.withColumn("block", block).groupBy("run", "block").applyInPandas(build, _BLOCKS))


def tree(nodes: DataFrame, settings: Settings) -> list[DataFrame]:
    """Levels of blocks over kept nodes ``run, pos, total, digest``, the lowest first.

    The last level has one block per run, whose root is the run's.
    """
    size = 2**settings.height
    most = nodes.agg(F.max("total")).first()[0] or 0
    levels = [_level(nodes, settings)]
    while most > size:
        most = -(-most // size)
        shrunk = F.ceil(F.col("total") / size).cast("long")
        totals = nodes.select("run", "total").distinct().withColumn("total", shrunk)
        # Runs that are one block already have their root; they take part again as a lone leaf.
        nodes = levels[-1].select("run", F.col("block").alias("pos"), F.col("root").alias("digest"))
        nodes = keep(nodes.join(totals, "run"))
        levels.append(_level(nodes, settings))
    return levels


def _stored(row) -> Block:
    nodes = np.frombuffer(row.nodes, np.uint8).reshape(-1, _BYTES)
    return Block(int(row.n), int(row.height), nodes)


def _children(height: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                paths = _stored(row).paths()
                yield pd.DataFrame(
                    {
                        "run": row.run,
                        "pos": (int(row.block) << height) + np.arange(len(paths)),
                        "path": [p + list(row.path) for p in paths],
                    }
                )

    return run


def ways(levels: list[DataFrame], top: DataFrame, settings: Settings) -> DataFrame:
    """``run, block, path``: for every block of the lowest level the siblings from its root up.

    ``top`` has what lies above each run's root.
    """
    above = top.select("run", F.lit(0).cast("long").alias("block"), "path")
    for level in reversed(levels[1:]):
        joined = level.drop("root").join(above, ["run", "block"])
        above = keep(
            joined.mapInPandas(_children(settings.height), _WAYS).withColumnRenamed("pos", "block")
        )
    return above


def manifest(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The Merkle tree over ``docs`` (doc_id, source, lang, n_chars, text, ...) and a proof per row.

    ``doc_id, leaf, subroot, root, proof_sha256`` of the documents as they are, and ``folded_root,
    verified`` from the tampered leaf where the document is chosen for tampering. A null field is
    written ``-``; null languages are one run of their own. Within a run rows ascend by doc_id, null
    ids first, rows of one id by their leaf; repeated rows are leaves each. Rows without id or
    n_chars are never changed. No rows give none. Other columns are ignored.
    """
    numbered = positions(leaves(docs, settings), "doc_id", "leaf")
    totals = numbered.groupBy("run").agg(F.count(F.lit(1)).alias("total"))
    rows = keep(numbered.join(totals, "run"))
    levels = tree(rows.select("run", "pos", "total", F.col("leaf").alias("digest")), settings)
    subroots = keep(levels[-1].select("run", F.col("root").alias("subroot")))

    # The runs' roots are the leaves of a tree in a run of its own.
    named = positions(
        subroots.select(F.lit("").alias("run"), F.col("run").alias("of"), F.col("subroot").alias("digest")),
        "of",
    )
    named = keep(named.withColumn("total", F.lit(subroots.count()).cast("long")))
    upper = tree(named.select("run", "pos", "total", "digest"), settings)
    # A single digest; there is none if there are no rows.
    root = (upper[-1].select("root").first() or [None])[0]
    over = ways(upper, upper[-1].select("run", F.array().cast("array<string>").alias("path")), settings)
    beside = keep(upper[0].drop("root").join(over, ["run", "block"]).mapInPandas(_children(settings.height), _WAYS))
    top = named.select("pos", F.col("of").alias("run")).join(beside.select("pos", "path"), "pos")

    known = top.join(subroots, "run").withColumn("root", F.lit(root).cast("string"))
    known = keep(known.select("run", "subroot", "root", "path"))
    blocks = (
        levels[0]
        .drop("root")
        .join(ways(levels, known, settings), ["run", "block"])
        .join(known.select("run", "subroot", "root"), "run")
    )
    rows = rows.withColumn("block", F.shiftright("pos", settings.height))

    def prove(own: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = next(block.itertuples(index=False))
        paths, above = _stored(found).paths(), list(found.path)
        own = own.sort_values("pos")
        original = _stored(found).level(found.height)
        proofs, results = [], []
        for path, leaf in zip(paths, own["tampered"]):
            path = path + above
            proofs.append(digest("".join(step[1:] for step in path)))
            results.append(folded(leaf, path))
        return pd.DataFrame(
            {
                "doc_id": own["doc_id"],
                "leaf": original,
                "subroot": found.subroot,
                "root": found.root,
                "proof_sha256": proofs,
                "folded_root": results,
                "verified": [r == found.root for r in results],
            }
        )

    proofs = (
        rows.select("run", "block", "pos", F.col("doc_id").cast("string").alias("doc_id"), "tampered")
        .groupBy("run", "block")
        .cogroup(blocks.groupBy("run", "block"))
        .applyInPandas(prove, _PROOFS.replace("doc_id long", "doc_id string"))
    )
    return proofs.withColumn("doc_id", F.col("doc_id").cast("long"))


_SQL_FIELD = "case when {0} is null then '-' else strlen({0}::varchar) || ':' || ({0}::varchar) end"
_SQL_CRC = """
    xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(doc_id::varchar, ''),
        lambda c: ascii(c)::ubigint)), lambda crc, b: list_reduce(
        list_prepend(xor(crc, b), range(8)::ubigint[]),
        lambda x, i: xor(x >> 1, 3988292384::ubigint * (x & 1)))), 4294967295::ubigint)"""


def oracle_sql() -> str:
    def leaf(n_chars: str) -> str:
        named = [n_chars if f == "n_chars" else f for f in FIELDS]
        return "sha256(" + " || ".join(_SQL_FIELD.format(f"({n})") for n in named) + ")"

    return f"""
with recursive leaves as (
    select doc_id, lang, {leaf("n_chars")} as leaf,
           case when {_SQL_CRC} % {Settings().tampering} = 0 then {leaf("n_chars + 1")}
                else {leaf("n_chars")} end as changed
    from documents),
placed as (
    select *, row_number() over () as rid, count(*) over (partition by lang) as n,
           row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos
    from leaves),
tree as (
    select lang, 0 as lvl, pos, leaf as h, n from placed
    union all
    select lang, lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), max((n + 1) // 2)
    from tree where n > 1 group by lang, lvl, pos // 2),
subroots as (select lang, lvl, h as subroot from tree where n = 1),
upper_leaves as (
    select *, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n
    from subroots),
above as (
    select 0 as lvl, pos, subroot as h, n from upper_leaves
    union all
    select lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), max((n + 1) // 2)
    from above where n > 1 group by lvl, pos // 2),
walk as (
    select rid, lang, pos, n, 0 as lvl, '' as proof, changed as h from placed
    union all
    select w.rid, w.lang, w.pos // 2, (w.n + 1) // 2, w.lvl + 1, w.proof || coalesce(t.h, ''),
           sha256(case when w.pos % 2 = 1 then t.h || w.h else w.h || coalesce(t.h, '') end)
    from walk w left join tree t
      on t.lang is not distinct from w.lang and t.lvl = w.lvl and t.pos = xor(w.pos, 1)
    where w.n > 1),
climb as (
    select w.rid, u.pos, u.n, 0 as lvl, w.proof, w.h
    from walk w join upper_leaves u on u.lang is not distinct from w.lang where w.n = 1
    union all
    select c.rid, c.pos // 2, (c.n + 1) // 2, c.lvl + 1, c.proof || coalesce(a.h, ''),
           sha256(case when c.pos % 2 = 1 then a.h || c.h else c.h || coalesce(a.h, '') end)
    from climb c left join above a on a.lvl = c.lvl and a.pos = xor(c.pos, 1)
    where c.n > 1)
select p.doc_id, p.leaf, s.subroot, r.h as root, sha256(c.proof) as proof_sha256,
       c.h as folded_root, c.h = r.h as verified
from placed p
join subroots s on s.lang is not distinct from p.lang
join climb c on c.rid = p.rid and c.n = 1
cross join (select h from above where n = 1) r"""
