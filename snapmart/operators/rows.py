"""Row filters, projections and typing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions.cleaning import typed
from snapmart.schemas import SNAPSHOT


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def at_snapshots(df: DataFrame, snapshots: Iterable[date], column: str = SNAPSHOT) -> DataFrame:
    """Rows dated exactly on one of the snapshots; any other day never enters the datamart.

    The days take the type of the column, so that the filter reaches the scan whatever that is.
    """
    kind = df.schema[column].dataType
    return df.where(F.col(column).isin([F.lit(day).cast(kind) for day in snapshots]))


def without_sentinels(df: DataFrame, sentinels: Mapping[str, str]) -> DataFrame:
    """Rows whose columns all differ from their sentinel; a null is unknown too and is dropped."""
    return df.where(all_of(F.col(name) != text for name, text in sentinels.items()))


def within_bounds(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows inside every inclusive range; null is outside."""
    return df.where(all_of(F.col(name).between(low, high) for name, (low, high) in bounds.items()))


def typed_columns(schema: T.StructType, strict: bool = False) -> dict[str, Column]:
    return {field.name: typed(F.col(field.name), field.dataType, strict) for field in schema}


def enforce_schema(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """The declared columns in the declared types, in one projection."""
    missing = [field.name for field in schema if field.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    casts = typed_columns(schema, strict)
    return df.select(
        *[
            F.col(field.name)
            if df.schema[field.name].dataType == field.dataType
            else casts[field.name].alias(field.name)
            for field in schema
        ]
    )
