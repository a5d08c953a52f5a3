"""From the feature table to model inputs: encoding, splitting, scaling, class weights."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.encode import found_values
from tidemark.plans.features import FEATURES, ROW_ID

# A single transaction in its frame has no spread; a first transaction has no gap, so it gets a
# very long one. Fixed values.
FILLS = {"user_stddev_amount_24h": 0.0, "seconds_since_last_transaction": 1e9}

SPLITS = ("hash", "exact", "time")


@dataclass(frozen=True)
class Options:
    """How a dataset is made; stored with each model, so that its evaluation uses the same rows.

    ``split``: ``hash`` decides by the id alone; ``exact`` takes exactly ``fraction`` of each class;
    ``time`` tests on what happened at or after ``border``. ``drop`` names model inputs to leave out.
    """

    include_status: bool = False
    split: str = "hash"
    fraction: float = S.TEST_FRACTION
    border: str | None = None
    drop: tuple[str, ...] = ()
    categories: tuple[str, ...] = tuple(S.MERCHANT_CATEGORIES)

    def __post_init__(self):
        if self.split not in SPLITS:
            raise ValueError(f"unknown split {self.split!r}, expected one of {', '.join(SPLITS)}")
        if self.split == "time" and self.border is None:
            raise ValueError("a split by time needs a border")
        unknown = set(self.drop) - set(input_expressions(self.include_status, self.categories))
        if unknown:
            raise ValueError(f"no such inputs: {', '.join(sorted(unknown))}")

    def with_found_categories(self, features: DataFrame) -> Options:
        """The same with the categories that the data hold."""
        return replace(self, categories=tuple(categories_found(features)))

    def inputs(self) -> dict[str, str]:
        """Model input name -> SQL, without those to drop."""
        every = input_expressions(self.include_status, self.categories)
        return {name: sql for name, sql in every.items() if name not in self.drop}


def input_expressions(
    include_status: bool = False, categories: Sequence[str] = S.MERCHANT_CATEGORIES
) -> dict[str, str]:
    """Model input name -> SQL over the feature table, in the order of the input vector."""
    inputs = {
        "transaction_amount_usd": "CAST(transaction_amount_usd AS DOUBLE)",
        "transaction_channel": f"CASE transaction_channel WHEN '{S.ONLINE}' THEN 1.0D"
        f" WHEN '{S.LOCAL}' THEN 0.0D END",
    }
    if include_status:
        inputs["transaction_status"] = (
            f"CASE transaction_status WHEN '{S.APPROVED}' THEN 1.0D"
            f" WHEN '{S.DECLINED}' THEN 0.0D END"
        )
    for name in FEATURES:
        value = f"CAST({name} AS DOUBLE)"
        inputs[name] = f"COALESCE({value}, {FILLS[name]!r}D)" if name in FILLS else value
    for category in categories:
        text = category.replace("\\", "\\\\").replace("'", "\\'")
        inputs[f"merchant_category_{category}"] = (
            f"CASE WHEN merchant_category = '{text}' THEN 1.0D ELSE 0.0D END"
        )
    return inputs


def categories_found(features: DataFrame) -> list[str]:
    """The categories present, for a one-hot encoding by what the data hold."""
    return found_values(features, "merchant_category")


def without_identifiers(
    features: DataFrame, drop: Sequence[str] = S.NON_FEATURE_COLUMNS
) -> DataFrame:
    return features.drop(*drop)


def encode(features: DataFrame, options: Options = Options(), keep: Sequence[str] = ()) -> DataFrame:
    """Row id, numeric inputs, label and the columns to keep."""
    inputs = [F.expr(sql).alias(name) for name, sql in options.inputs().items()]
    return features.select(ROW_ID, *inputs, S.LABEL, *keep)


# ------------------------------------------------------------------------------------ splitting


def _digest(row_id: str) -> Column:
    return F.md5(F.col(row_id).cast("string"))


def hash_split_flag(row_id: str = ROW_ID, fraction: float = S.TEST_FRACTION) -> Column:
    """True for test rows: decided by the id alone, so without a shuffle and the same every time."""
    bucket = F.conv(F.substring(_digest(row_id), 1, 8), 16, 10).cast("bigint") % 100
    return bucket < round(fraction * 100)


def stratified_split_flag(
    df: DataFrame,
    row_id: str = ROW_ID,
    label: str = S.LABEL,
    fraction: float = S.TEST_FRACTION,
) -> DataFrame:
    """Add ``is_test``: exactly the given share of each class, the smallest digests of the ids.

    Rows are counted per class and leading digest digits, 1,048,576 groups per class. Whole groups
    fall to one side; only the one group per class that the border runs through is ranked.
    """
    digits = 5
    placed = df.withColumns(
        {"_digest": _digest(row_id), "_group": F.substring(_digest(row_id), 1, digits)}
    )
    counts = placed.groupBy(label, "_group").agg(F.count(F.lit(1)).alias("_n"))
    by_group = Window.partitionBy(label).orderBy("_group")
    upto = by_group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(label)
    borders = (
        counts.withColumns(
            {
                "_upto": F.sum("_n").over(upto),
                "_wanted": F.floor(F.sum("_n").over(whole) * fraction + 0.5),
            }
        )
        .filter(F.col("_wanted").between(F.col("_upto") - F.col("_n") + 1, F.col("_upto")))
        .select(
            label,
            F.col("_group").alias("_border"),
            (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_take"),
        )
    )
    # One row per class at most. A class whose share rounds to no row at all has none.
    placed = placed.join(F.broadcast(borders), label, "left")
    ranked = Window.partitionBy(label).orderBy("_digest", row_id)
    at_border = F.coalesce(F.col("_group") == F.col("_border"), F.lit(False))
    clear = placed.filter(~at_border).withColumn(
        "is_test", F.coalesce(F.col("_group") < F.col("_border"), F.lit(False))
    )
    border = placed.filter(at_border).withColumn(
        "is_test", F.row_number().over(ranked) <= F.col("_take")
    )
    return clear.unionByName(border).drop("_digest", "_group", "_border", "_take")


def time_split_flag(time: str, border: Column) -> Column:
    """True for rows at or after a moment: testing on the future only; false without a time."""
    return F.coalesce(F.col(time) >= border, F.lit(False))


def with_split(features: DataFrame, options: Options = Options()) -> DataFrame:
    """Add ``is_test`` to the rows of a feature table."""
    if options.split == "exact":
        return stratified_split_flag(features, fraction=options.fraction)
    if options.split == "time":
        flag = time_split_flag("transaction_timestamp", F.lit(options.border).cast("timestamp"))
    else:
        flag = hash_split_flag(fraction=options.fraction)
    return features.withColumn("is_test", flag)


def test_rows(features: DataFrame, options: Options = Options()) -> DataFrame:
    return with_split(features, options).filter("is_test").drop("is_test")


# -------------------------------------------------------------------------------------- scaling


@dataclass(frozen=True)
class Scaling:
    """Mean and population deviation per column; a constant column is only centred."""

    mean: dict[str, float]
    deviation: dict[str, float]

    def sql(self, column: str) -> str:
        return f"(`{column}` - {self.mean[column]!r}D) / {self.deviation[column]!r}D"

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.expr(self.sql(c)) for c in self.mean})


def fit_scaling(train: DataFrame, columns: Sequence[str]) -> Scaling:
    """One pass over the training rows; one row of numbers comes back."""
    row = train.agg(
        *[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return Scaling(
        {c: row[f"m{i}"] or 0.0 for i, c in enumerate(columns)},
        {c: row[f"s{i}"] or 1.0 for i, c in enumerate(columns)},
    )


# -------------------------------------------------------------------------------- class balance


def class_counts(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Normal rows, fraud rows and their ratio (1 without fraud), one row."""
    fraud, normal = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(normal.alias("n_normal"), fraud.alias("n_fraud")).withColumn(
        "ratio",
        F.when(F.col("n_fraud") > 0, F.col("n_normal") / F.col("n_fraud")).otherwise(F.lit(1.0)),
    )


def weight_column(counts: Row, balanced: bool, label: str = S.LABEL) -> Column:
    """Per-row training weight.

    ``balanced``: n / (2 * class size) for both classes. Otherwise 1 for normal rows and the
    class ratio for fraud rows.
    """
    if balanced:
        n = counts["n_normal"] + counts["n_fraud"]
        fraud = n / (2 * counts["n_fraud"]) if counts["n_fraud"] else 1.0
        normal = n / (2 * counts["n_normal"]) if counts["n_normal"] else 1.0
    else:
        fraud, normal = counts["ratio"], 1.0
    return F.when(F.col(label) == 1, F.lit(fraud)).otherwise(F.lit(normal))


# ------------------------------------------------------------------------------------- together


@dataclass(frozen=True)
class Prepared:
    train: DataFrame
    test: DataFrame
    inputs: list[str]
    scaling: Scaling


def prepare(features: DataFrame, options: Options = Options()) -> Prepared:
    """Split, encode and scale; the scaling is learned from the training rows only."""
    flagged = encode(with_split(features, options), options, ["is_test"])
    inputs = list(options.inputs())
    train = flagged.filter(~F.col("is_test")).drop("is_test")
    test = flagged.filter("is_test").drop("is_test")
    scaling = fit_scaling(train, inputs)
    return Prepared(scaling.apply(train), scaling.apply(test), inputs, scaling)
