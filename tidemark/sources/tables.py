"""Reading and writing tables: JDBC, parquet, local rows, CSV."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    column: str | None = None,
    bounds: tuple | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A database table. With ``column``, ``bounds`` and ``partitions`` it is read by that many
    tasks, each with its own range of the column; rows outside the bounds are read as well."""
    properties = dict(properties or {})
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    lower, upper = bounds
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties,
    )


def _literal(value) -> str:
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    text = str(value).replace("'", "''")
    return f"TIMESTAMP '{text}'" if isinstance(value, datetime) else f"'{text}'"


def range_predicates(column: str, borders: Sequence) -> list[str]:
    """Conditions that together hold for every row once: up to each border, beyond the last, NULLs first."""
    borders = sorted(set(b for b in borders if b is not None))
    if not borders:
        return ["1 = 1"]
    first, *rest = map(_literal, borders)
    ranges = [f"{column} <= {first} OR {column} IS NULL"]
    for low, high in zip([first, *rest], rest):
        ranges.append(f"{column} > {low} AND {column} <= {high}")
    return [*ranges, f"{column} > {[first, *rest][-1]}"]


def quantile_query(table: str, column: str, partitions: int) -> str:
    """A subquery for the source: the greatest value of each of so many equally filled parts."""
    parts = f"SELECT {column} AS v, NTILE({partitions}) OVER (ORDER BY {column}) AS part"
    return (
        f"(SELECT part, MAX(v) AS border FROM ({parts} FROM {table} WHERE {column} IS NOT NULL) ranked"
        " GROUP BY part) borders"
    )


def read_jdbc_balanced(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table read by up to ``partitions`` tasks of about as many rows each, however unevenly
    the column's values lie: the ranges end at the source's own quantiles. Rows of one value stay
    together, so a value with more rows than a share makes fewer, larger parts.
    """
    if partitions < 2:
        return read_jdbc(spark, url, table, properties)
    query = quantile_query(table, column, partitions)
    found = spark.read.jdbc(url, query, properties=dict(properties or {})).collect()  # a row per part
    # The last part's greatest value is no border: what is added meanwhile belongs to it.
    borders = sorted(r["border"] for r in found)[:-1]
    return spark.read.jdbc(
        url, table, predicates=range_predicates(column, borders), properties=dict(properties or {})
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    properties: Mapping[str, str] | None = None,
) -> None:
    df.write.jdbc(url, table, mode=mode, properties=dict(properties or {}))


def write_features(df: DataFrame, path: str, time: str = "transaction_timestamp") -> None:
    """Replace the feature table, laid out by event date so that readers can skip days.

    Without a shuffle each task would open a file per day it holds; with one by day alone a busy
    day would be one task. Rebalancing splits large days and merges small ones.
    """
    dated = df.withColumn("event_date", F.to_date(time))
    dated.hint("rebalance", "event_date").write.mode("overwrite").partitionBy(
        "event_date"
    ).parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_snapshot(root: str, name: str, df: DataFrame) -> str:
    """Write a table anew beside its earlier snapshots, which may be what ``df`` reads.

    A snapshot counts once Spark has marked it complete; a failed write leaves the last one valid.
    """
    spark = df.sparkSession
    version = max(_versions(spark, root, name, complete=False), default=0) + 1
    path = f"{root}/{name}/version={version}"
    df.write.parquet(path)
    return path


def read_snapshot(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The latest complete snapshot of a table."""
    versions = _versions(spark, root, name, complete=True)
    if not versions:
        raise FileNotFoundError(f"no complete snapshot of {name} below {root}")
    return spark.read.parquet(f"{root}/{name}/version={max(versions)}")


def _versions(spark: SparkSession, root: str, name: str, complete: bool) -> list[int]:
    context = spark.sparkContext
    pattern = f"{root}/{name}/version=*" + ("/_SUCCESS" if complete else "")
    path = context._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    found = [entry.getPath() for entry in files.globStatus(path) or ()]
    folders = [p.getParent() if complete else p for p in found]
    return [int(f.getName().partition("=")[2]) for f in folders]


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def local_rows(spark: SparkSession, rows: Sequence[Mapping], schema: T.StructType) -> DataFrame:
    """Dictionaries as a DataFrame with a fixed schema; absent fields are NULL."""
    ordered = [tuple(row.get(f.name) for f in schema.fields) for row in rows]
    return spark.createDataFrame(ordered, schema)


def as_table(df: DataFrame, table: str) -> DataFrame:
    """Cast to the stored types of a table; columns it lacks are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in S.TABLES[table].fields
        ]
    )


def write_metrics(df: DataFrame, path: str) -> None:
    """One CSV file with a header; metrics have one row per model."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
