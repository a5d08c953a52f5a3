"""Tables as lists of files, so that a change rewrites only the files it touches.

A version of a table is a small text file that names its data files. A new version is created only if no one
else has created it; readers take the latest. Data files are never changed; those of older versions stay until
``vacuum``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files


class ConcurrentChange(RuntimeError):
    """Another writer made a version in the meantime."""


def _versions(spark: SparkSession, table: str) -> list[int]:
    return [int(n) for n in files.names_in(spark, f"{table}/versions") if n.isdigit()]


def _names(spark: SparkSession, table: str, version: int) -> list[str]:
    return [n for n in files.read_text(spark, f"{table}/versions/{version:012d}").split("\n") if n]


def data_files(spark: SparkSession, table: str) -> list[str]:
    """The names of the latest version's data files."""
    versions = _versions(spark, table)
    if not versions:
        raise FileNotFoundError(f"no version of a table at {table}")
    return _names(spark, table, max(versions))


def _commit(spark: SparkSession, table: str, version: int, names: list[str]) -> None:
    if not files.create_text(spark, f"{table}/versions/{version:012d}", "\n".join(sorted(names))):
        raise ConcurrentChange(f"version {version} of {table} exists already")


def _written(df: DataFrame, table: str) -> list[str]:
    """Write data files; their names."""
    before = set(files.names_in(df.sparkSession, f"{table}/data", "part-*"))
    df.write.mode("append").parquet(f"{table}/data")
    return [n for n in files.names_in(df.sparkSession, f"{table}/data", "part-*") if n not in before]


def create_table(df: DataFrame, table: str) -> None:
    _commit(df.sparkSession, table, 1, _written(df, table))


def _read(spark: SparkSession, table: str, names: list[str]) -> DataFrame:
    if names:
        return spark.read.parquet(*[f"{table}/data/{n}" for n in names])
    return spark.read.parquet(f"{table}/data").limit(0)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return _read(spark, table, data_files(spark, table))


def update(
    spark: SparkSession,
    table: str,
    hit: Callable[[DataFrame], DataFrame],
    change: Callable[[DataFrame], DataFrame],
) -> int:
    """Make a new version in which the files with a row that ``hit`` keeps are replaced by what ``change``
    makes of all their rows; the others stay as they are. Returns how many rows were hit.

    Files with hits are found in one narrow scan. Raises ``ConcurrentChange`` if another version was
    made meanwhile; nothing of this one is then seen, and it may be tried again.
    """
    version = max(_versions(spark, table), default=0)
    names = data_files(spark, table)
    rows = _read(spark, table, names).withColumn("_file", F.col("_metadata.file_name"))
    # A row per file that is to be replaced.
    touched = {
        r["_file"]: r["rows"]
        for r in hit(rows).groupBy("_file").agg(F.count(F.lit(1)).alias("rows")).collect()
    }
    if not touched:
        return 0
    made = _written(change(_read(spark, table, sorted(touched))), table)
    _commit(spark, table, version + 1, [n for n in names if n not in touched] + made)
    return sum(touched.values())


def vacuum(spark: SparkSession, table: str, keep: int = 1) -> list[str]:
    """Delete versions but the latest ``keep``, and data files that no version left names.

    Only where nothing else writes the table: a file of a version still to come has no name yet.
    """
    versions = sorted(_versions(spark, table))
    kept = versions[-keep:]
    named = {n for v in kept for n in _names(spark, table, v)}
    gone = [n for n in files.names_in(spark, f"{table}/data", "part-*") if n not in named]
    for path in [f"{table}/versions/{v:012d}" for v in versions[:-keep]] + [f"{table}/data/{n}" for n in gone]:
        system, found = files._of(spark, path)
        system.delete(found, False)
    return gone
