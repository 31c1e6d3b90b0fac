"""Counts that tell how dirty a table is."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.operators.rows import all_of


def count_matching(df: DataFrame, conditions: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """How many rows meet each condition, all in one pass."""
    return df.groupBy(*by).agg(*[F.count_if(test).alias(name) for name, test in conditions.items()])


def step_audit(df: DataFrame, steps: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows read and rows left after each filter step in turn, in place of a count per step."""
    tests = list(steps.values())
    left = {f"after_{name}": all_of(tests[: i + 1]) for i, name in enumerate(steps)}
    return count_matching(df, {"rows_read": F.lit(True), **left}, by)


def null_profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of nulls per column, one row per group; NaN is no null and an empty input has zeros."""
    columns = [name for name in df.columns if name not in by]
    return count_matching(df, {name: F.col(name).isNull() for name in columns}, by)


def null_report(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Only the columns that have nulls: `by`, `column`, `nulls`."""
    profile = null_profile(df, by)
    columns = [name for name in profile.columns if name not in by]
    return profile.unpivot(list(by), columns, "column", "nulls").where("nulls > 0")


def column_info(df: DataFrame) -> DataFrame:
    """`column`, `dtype`, `non_null` in one row per column."""
    facts = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(dtype).alias("dtype"),
            F.count(F.col(name)).alias("non_null"),
        )
        for name, dtype in df.dtypes
    ]
    return df.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))


def rejected_values(raw: DataFrame, cleaned: Mapping[str, Column]) -> DataFrame:
    """`column`, `rejected`: texts that lenient cleaning of the column turns into null."""
    facts = [
        F.struct(
            F.lit(name).alias("column"),
            F.count_if(F.col(name).isNotNull() & value.isNull()).alias("rejected"),
        )
        for name, value in cleaned.items()
    ]
    return raw.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))


def refused_values(raw: DataFrame, cleaned: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """`keys`, `column`, `value`, `rule`: every text that lenient cleaning turns into null, with the type it should have.

    One row per refused value, from one scan; per column they are as many as `rejected_values` counts.
    """
    types = dict(raw.select(*[value.alias(name) for name, value in cleaned.items()]).dtypes)
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.when(value.isNull(), F.col(name).cast("string")).alias("value"),
            F.lit(f"no {types[name]}").alias("rule"),
        )
        for name, value in cleaned.items()
    ]
    refused = F.filter(F.array(*cells), lambda cell: cell["value"].isNotNull())
    return raw.select(*keys, F.inline(refused))
