"""Token-budget batches in length buckets whose bounds make the padding least.

The histogram of lengths of all pieces decides: dynamic programming over it finds the bucket bounds with
the least total padding. Pieces are numbered inside their bucket and cut into batches of equal shape.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.numbering import CHUNKS, numbered

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    """A document of more than ``longest`` words goes in pieces of that length, which bounds the
    histogram; ``budget`` is the most padded words of a batch."""

    longest: int = 2048
    buckets: int = 8
    budget: int = 65_536


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Bounds with least padding; of equal ones the fewest, then the earliest starts.

    ``lengths`` ascend. A bucket over lengths s+1..e pads its pieces to the length e.
    """
    size = len(lengths)
    if not size:
        return []
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    before = np.concatenate([[0], np.cumsum(counts)])
    words = np.concatenate([[0], np.cumsum(counts * lengths)])
    cost = lengths * before[1:] - words[1:]
    starts = []
    best = (int(cost[-1]), 1)
    for used in range(2, min(buckets, size) + 1):
        following, start = np.zeros_like(cost), np.zeros(size, int)
        for end in range(used - 1, size):
            begins = np.arange(used - 2, end)
            padding = (
                cost[begins]
                + lengths[end] * (before[end + 1] - before[begins + 1])
                - (words[end + 1] - words[begins + 1])
            )
            pick = int(np.argmin(padding))
            following[end], start[end] = padding[pick], begins[pick]
        starts.append(start)
        cost = following
        best = min(best, (int(cost[-1]), used))
    end, bounds = size - 1, [int(lengths[-1])]
    for start in reversed(starts[: best[1] - 1]):
        end = start[end]
        bounds.append(int(lengths[end]))
    return bounds[::-1]


def pieces(docs: DataFrame, settings: Settings) -> DataFrame:
    longest = settings.longest
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("words"),
    )
    last = F.greatest(F.ceil(F.col("words") / longest), F.lit(1)) - 1
    start = F.col("piece") * F.lit(longest).cast("long")
    return words.withColumn("piece", F.explode(F.sequence(F.lit(0), last.cast("int")))).select(
        "doc_id",
        "piece",
        start.alias("start"),
        F.least(F.col("words") - start, F.lit(longest)).alias("n_tokens"),
    )


def packed(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A row for every piece of every document: ``doc_id, piece, start, n_tokens, bucket,
    bucket_length, batch, slot``.

    Words are ``[^\\x20\\x09-\\x0D]+``. Null, empty and blank texts are one piece without words.
    Batches are numbered in their bucket, slots in their batch; all batches of a bucket but the last
    are full. The order inside a bucket is by the id's remainder, id, piece and length, so repeated
    rows take neighbouring slots; null ids come first. With no rows there is none.
    """
    parts = pieces(docs, settings)
    # One row per length, of which there are at most ``longest`` and one.
    histogram = parts.groupBy("n_tokens").count().orderBy("n_tokens").collect()
    bounds = best_bounds(
        np.array([r[0] for r in histogram]), np.array([r[1] for r in histogram]), settings.buckets
    ) or [0]
    array = F.array(*[F.lit(b).cast("long") for b in bounds])
    bucket = F.size(F.filter(array, lambda b: b < F.col("n_tokens")))
    placed = parts.withColumn("bucket", bucket).withColumn(
        "bucket_length", F.get(array, F.col("bucket"))
    )
    chunk = F.coalesce(F.pmod("doc_id", F.lit(CHUNKS)), F.lit(0))
    rows = numbered(placed, "place", ["bucket"], chunk, ["doc_id", "piece", "n_tokens"])
    per_batch = F.greatest(
        F.floor(F.lit(settings.budget) / F.greatest("bucket_length", F.lit(1))), F.lit(1)
    )
    return rows.select(
        "doc_id",
        "piece",
        "start",
        "n_tokens",
        "bucket",
        "bucket_length",
        F.floor(F.col("place") / per_batch).cast("long").alias("batch"),
        (F.col("place") % per_batch).cast("long").alias("slot"),
    )


def oracle_sql(source: str = "documents", settings: Settings = Settings()) -> str:
    """The same rows by one pass of SQL for every further bucket."""
    n = settings.longest
    steps = ["f1 as (select i as e, cast(l * cc - ss as bigint) as cost, [l] as path from h)"]
    for k in range(2, settings.buckets + 1):
        cost = "f.cost + h.l * (h.cc - p.cc) - (h.ss - p.ss)"
        steps.append(
            f"f{k} as (select e, min(cost) as cost, list_append(arg_min(path, cost * 10000 + s), any_value(l)) as path"
            f" from (select h.i as e, h.l as l, f.e as s, cast({cost} as bigint) as cost, f.path as path"
            f" from h join f{k - 1} f on f.e < h.i join h p on p.i = f.e) group by e)"
        )
    finals = " union all ".join(
        f"select {k} as k, cost, path from f{k} where e = (select max(i) from h)"
        for k in range(1, settings.buckets + 1)
    )
    return f"""
with words as (
  select cast(doc_id as bigint) as doc_id,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as n
  from {source}),
pieces as (
  select doc_id, cast(piece as integer) as piece, piece * {n} as start,
    least(n - piece * {n}, {n}) as n_tokens
  from (select doc_id, n, unnest(range(greatest(1, (n + {n - 1}) // {n}))) as piece from words)),
hist as (select n_tokens as l, count(*) as c from pieces group by 1),
h as (
  select row_number() over (order by l) as i, l,
    cast(sum(c) over (order by l) as bigint) as cc, cast(sum(c * l) over (order by l) as bigint) as ss
  from hist),
{", ".join(steps)},
best as (select path from ({finals}) order by cost, k limit 1),
placed as (
  select p.*, len([x for x in b.path if x < n_tokens]) as bucket, b.path as path
  from pieces p, best b),
ranked as (
  select doc_id, piece, start, n_tokens, cast(bucket as integer) as bucket,
    path[bucket + 1] as bucket_length,
    row_number() over (partition by bucket
      order by ((doc_id % {CHUNKS}) + {CHUNKS}) % {CHUNKS}, doc_id, piece, n_tokens) - 1 as place
  from placed)
select doc_id, piece, start, n_tokens, bucket, bucket_length,
  place // greatest({settings.budget} // greatest(bucket_length, 1), 1) as batch,
  place % greatest({settings.budget} // greatest(bucket_length, 1), 1) as slot
from ranked"""
