"""Ranges of ids for several writers at once, each handed out by creating one small file.

Ranges are numbered; a range starts where the one before it ends. A writer reads the last one and creates
the next, which fails if another writer was faster, and then tries again. What an owner was given is noted
under its name, so that a batch that is run again gets the same ids. Files are kept in folders of a thousand.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.sources import files

_PER_FOLDER = 1_000


def _path(folder: str, number: int) -> str:
    return f"{folder}/ranges/{number // _PER_FOLDER:09d}/{number:012d}"


def _last(spark: SparkSession, folder: str) -> tuple[int, int]:
    """The number of the last range, -1 if there is none, and the id after it."""
    groups = files.names_in(spark, f"{folder}/ranges")
    if not groups:
        return -1, 0
    number = max(int(n) for n in files.names_in(spark, f"{folder}/ranges/{groups[-1]}") if n.isdigit())
    first, count, _ = files.read_text(spark, _path(folder, number)).split("\n")
    return number, int(first) + int(count)


def lease(spark: SparkSession, folder: str, owner: str, count: int, start: int = 1, attempts: int = 1_000) -> int:
    """The first of ``count`` consecutive ids that no other owner gets. ``start`` is the first id of
    all; the same owner asking for as many again is given the same ones."""
    note = f"{folder}/owners/{owner}"
    known = files.read_text(spark, note)
    if known is not None:
        first, held = map(int, known.split("\n")[:2])
        if held == count:
            return first
    for _ in range(attempts):
        number, first = _last(spark, folder)
        first = max(first, start)
        if files.create_text(spark, _path(folder, number + 1), f"{first}\n{count}\n{owner}"):
            files.write_text(spark, note, f"{first}\n{count}")
            return first
    raise RuntimeError(f"no range of ids in {folder} after {attempts} attempts")
