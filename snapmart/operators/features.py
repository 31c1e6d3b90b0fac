"""Vocabulary, one-hot indicators and token counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.functions.tokens import count_token, list_tokens, loose_tokens, safe_name
from snapmart.schemas import LEAKAGE_COLUMNS, ONE_HOT_COLUMNS, TOKEN_COLUMN, TOKEN_KIND


@dataclass(frozen=True)
class Vocabulary:
    """Sorted values per kind; it fixes the columns of the engineered table."""

    values: Mapping[str, tuple[str, ...]]

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (kind, value, position)
            for kind, values in self.values.items()
            for position, value in enumerate(values)
        ]
        return spark.createDataFrame(rows, "kind string, value string, position int")


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`column`, `value`: the distinct non-null values of every column, sorted, from one scan."""
    return (
        df.select(*columns)
        .unpivot([], list(columns), "column", "value")
        .where("value is not null")
        .distinct()
        .orderBy("column", "value")
    )


def distinct_tokens(df: DataFrame, column: str = TOKEN_COLUMN) -> DataFrame:
    """`token`: the distinct tokens of a list column, sorted, without the empty one."""
    tokens = df.select(F.explode(list_tokens(F.col(column))).alias("token"))
    return tokens.where("token != ''").distinct().orderBy("token")


def token_value_counts(df: DataFrame, column: str = TOKEN_COLUMN) -> DataFrame:
    """`token`, `count` of the loose tokens, most frequent first; rows without a list are skipped."""
    tokens = df.select(F.explode(loose_tokens(F.col(column))).alias("token"))
    return tokens.groupBy("token").count().orderBy(F.desc("count"), "token")


def vocabulary_values(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`by`, `kind`, `value`: distinct categories and tokens of the customer table, from one scan."""
    categories = [F.array(F.col(column)) for column in ONE_HOT_COLUMNS.values()]
    tokens = F.array_remove(list_tokens(F.col(TOKEN_COLUMN)), "")
    kinds = [*ONE_HOT_COLUMNS, TOKEN_KIND]
    entries = [
        F.struct(F.lit(kind).alias("kind"), values.alias("found"))
        for kind, values in zip(kinds, [*categories, tokens])
    ]
    return (
        df.select(*by, F.inline(F.array(*entries)))
        .select(*by, "kind", F.explode("found").alias("value"))
        .where("value is not null")
        .distinct()
    )


def vocabulary_table(df: DataFrame) -> DataFrame:
    """`kind`, `value`, `position` in value order: one row per feature column of the customer table."""
    return positions(vocabulary_values(df))


def positions(values: DataFrame) -> DataFrame:
    """`kind`, `value`, `position` of distinct `kind`, `value`.

    The window of a kind sees its distinct values, which are as many as the columns made of them.
    """
    place = F.row_number().over(Window.partitionBy("kind").orderBy("value")) - 1
    return values.withColumn("position", place)


def build_vocabulary(df: DataFrame) -> Vocabulary:
    """The vocabulary on the driver, where it becomes the columns of the next plan."""
    return read_vocabulary(vocabulary_table(df))


def read_vocabulary(table: DataFrame) -> Vocabulary:
    """One row per output column is fetched, however many rows the customer table has."""
    rows = table.orderBy("kind", "position").collect()
    values: dict[str, list[str]] = {kind: [] for kind in [*ONE_HOT_COLUMNS, TOKEN_KIND]}
    for row in rows:
        values[row["kind"]].append(row["value"])
    return Vocabulary({kind: tuple(found) for kind, found in values.items()})


def one_hot(vocabulary: Vocabulary) -> dict[str, Column]:
    """Indicator columns; a null or unseen category has 0 in all of them."""
    return _named(
        (f"{column}_{safe_name(value)}", F.col(column).eqNullSafe(value).cast("int"))
        for kind, column in ONE_HOT_COLUMNS.items()
        for value in vocabulary.values[kind]
    )


def token_counts(vocabulary: Vocabulary, tokens: Column) -> dict[str, Column]:
    """How often each token of the vocabulary occurs in the row's list, repeats counted."""
    return _named(
        (f"{safe_name(token).lower()}_type", count_token(tokens, token))
        for token in vocabulary.values[TOKEN_KIND]
    )


def _named(pairs) -> dict[str, Column]:
    named: dict[str, Column] = {}
    for name, column in pairs:
        if name in named:
            raise ValueError(f"two values of the vocabulary share the column name {name!r}")
        named[name] = column
    return named


def engineer_features(
    df: DataFrame, vocabulary: Vocabulary, leakage: Sequence[str] = LEAKAGE_COLUMNS
) -> DataFrame:
    """Replace categories and the loan list by features and drop the columns that leak the target."""
    dropped = {*leakage, *ONE_HOT_COLUMNS.values(), TOKEN_COLUMN}
    kept = {name: F.col(name) for name in df.columns if name not in dropped}
    indicators, counts = one_hot(vocabulary), token_counts(vocabulary, F.col("_tokens"))
    columns = _named([*kept.items(), *indicators.items(), *counts.items()])
    return df.withColumn("_tokens", list_tokens(F.col(TOKEN_COLUMN))).select(
        *[column.alias(name) for name, column in columns.items()]
    )
