"""Checks on keys, references and required fields, and the split into valid and rejected rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S


def missing_names(columns: Sequence[str]) -> Column:
    """Array of the names of those columns that are NULL in the row."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))


def rows_with_missing(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows lacking required fields, with ``missing_fields`` as a comma-separated list."""
    missing = missing_names(required)
    return df.filter(F.size(missing) > 0).withColumn(
        "missing_fields", F.array_join(missing, ", ")
    )


def null_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per NOT NULL column of the schema the number of rows violating it."""
    required = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "column_name", "null_rows")


def orphan_report(
    tables: Mapping[str, DataFrame], foreign_keys: Sequence[tuple] = S.FOREIGN_KEYS
) -> DataFrame:
    """Per foreign key the number of child rows, and of key values, without a parent.

    Children are first counted per key value, so a value holding many rows travels as one.
    """
    reports = []
    for child, column, parent, target in foreign_keys:
        if child not in tables or parent not in tables:
            continue
        values = (
            tables[child]
            .filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        parents = tables[parent].select(F.col(target).alias("value"))
        reports.append(
            values.join(parents, "value", "left_anti").agg(
                F.lit(f"{child}.{column}").alias("reference"),
                F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
                F.count(F.lit(1)).alias("orphan_values"),
            )
        )
    return reduce(DataFrame.unionByName, reports)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def split_by_problems(df: DataFrame, problems: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the array ``problems``)."""
    marked = df.withColumn("problems", problems)
    valid = marked.filter(F.size("problems") == 0).drop("problems")
    return valid, marked.filter(F.size("problems") > 0)
