"""Grouped counts, distinct values and rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.schemas import SNAPSHOT


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """`column`, `count`, most frequent first, ties in value order; null is a value."""
    return df.groupBy(column).count().orderBy(F.desc("count"), F.asc(column))


def column_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`column`, `value` as text, `count` for several columns in one pass."""
    texts = df.select(*[F.col(name).cast("string").alias(name) for name in columns])
    counted = texts.unpivot([], list(columns), "column", "value").groupBy("column", "value").count()
    return counted.orderBy("column", F.desc("count"), "value")


def top_values(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows in a total order."""
    return df.orderBy(*order).limit(n)


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """`column`, `count` in value order."""
    return df.groupBy(column).count().orderBy(column)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and exact number of distinct values of each key, in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_distinct(key).alias(f"distinct_{key}") for key in keys]
    )


def one_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the first in the given order, which should be total.

    An aggregate and not a window, so the rows of a hot key are reduced before the shuffle.
    """
    rest = [name for name in df.columns if name != key and name not in order]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return df.groupBy(key).agg(first).select(key, "first.*").select(*df.columns)


def label_shares(labels: DataFrame) -> DataFrame:
    """`label`, `count`, `pct` of all rows. There are two labels, so the window sees two rows."""
    counted = labels.groupBy("label").count()
    total = F.sum("count").over(Window.partitionBy())
    return counted.withColumn("pct", F.col("count") / total * 100).orderBy("label")


def default_rates(labels: DataFrame) -> DataFrame:
    """`snapshot_date`, `total`, `defaults`, `default_rate` in percent with two decimals."""
    total, defaults = F.count(F.lit(1)), F.sum("label")
    return (
        labels.groupBy(SNAPSHOT)
        .agg(
            total.alias("total"),
            defaults.alias("defaults"),
            F.round(defaults / total * 100, 2).alias("default_rate"),
        )
        .orderBy(SNAPSHOT)
    )
