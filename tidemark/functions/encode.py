"""Encoding of categorical columns and filling of gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values up to which a one-hot encoding is a column each; beyond, one sparse vector holds them.
ONE_HOT_COLUMNS = 1_000


def check_binary_map(values: Mapping[str, int]) -> None:
    if len(values) != 2:
        raise ValueError(f"a binary map needs exactly two keys, this one has {len(values)}")
    if set(values.values()) != {0, 1}:
        raise ValueError(f"a binary map needs the values 0 and 1, not {sorted(values.values())}")


def binary(column: Column, values: Mapping[str, int]) -> Column:
    """0 or 1 by the map, NULL for values outside it."""
    check_binary_map(values)
    chain = None
    for key, code in values.items():
        hit = column == F.lit(key)
        chain = F.when(hit, code) if chain is None else chain.when(hit, code)
    return chain


def is_value(column: Column, value: str) -> Column:
    """1 for the value, 0 for anything else including NULL."""
    return F.when(column == F.lit(value), 1).otherwise(0)


def one_hot(df: DataFrame, column: str, values: Sequence[str], keep: bool = False) -> DataFrame:
    """One 0/1 column ``<column>_<value>`` per listed value, all 0 for NULL or unlisted ones."""
    kept = [c for c in df.columns if keep or c != column]
    flags = [is_value(F.col(column), v).alias(f"{column}_{v}") for v in values]
    return df.select(*[F.col(f"`{c}`") for c in kept], *flags)


def found_values(df: DataFrame, column: str) -> list[str]:
    """The sorted values of a categorical column, which are to become columns or names."""
    distinct = df.filter(F.col(column).isNotNull()).select(column).distinct()
    return sorted(row[0] for row in distinct.collect())


def one_hot_found(df: DataFrame, column: str, most_columns: int = ONE_HOT_COLUMNS) -> DataFrame:
    """One-hot encoding for whatever values the data hold.

    Up to ``most_columns`` values give a 0/1 column each. More give one sparse vector column
    ``<column>_vector`` with an entry per value in alphabetical order, all 0 for NULL.
    """
    known = df.filter(F.col(column).isNotNull())
    width = known.select(column).distinct().limit(most_columns + 1).count()
    if width <= most_columns:
        return one_hot(df, column, found_values(df, column))
    index, vector = f"_{column}_index", f"{column}_vector"
    indexer = StringIndexer(
        inputCol=column, outputCol=index, stringOrderType="alphabetAsc", handleInvalid="keep"
    ).fit(known)
    # NULL takes the index after the last value, the one entry that dropLast leaves out.
    encoder = OneHotEncoder(inputCol=index, outputCol=vector, dropLast=True)
    indexed = indexer.transform(df)
    return encoder.fit(indexed).transform(indexed).drop(index, column)


def fill(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Replace NULLs per column; the filled columns become doubles."""
    return df.withColumns({c: F.col(c).cast("double") for c in values}).na.fill(dict(values))
