"""Upper Tukey fences and the outlier filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.operators.distributions import number
from snapmart.operators.quantiles import exact_quantiles, stack_quantiles
from snapmart.operators.rows import all_of
from snapmart.operators.sketches import pooled_quantiles
from snapmart.schemas import SNAPSHOT
from snapmart.session import join_statistics, materialize

# Fence factor and relative rank error of the approximate quartiles (1 / accuracy).
FENCE_FACTOR = 1.5
FENCE_ACCURACY = 1000


def _quartiles(df: DataFrame, columns: Sequence[str], by: Sequence[str], exact: bool) -> DataFrame:
    """One row per group with the quartiles of each column: values of the column, not interpolated, NaN skipped."""
    if exact:
        return exact_quantiles(df, columns, [0.25, 0.75], by, interpolate=False)
    # One mergeable sketch per group and column, all in one pass.
    return df.groupBy(*by).agg(
        *[
            F.percentile_approx(number(name), [0.25, 0.75], FENCE_ACCURACY).alias(name)
            for name in columns
        ]
    )


def _fence(quartiles: str, k: float) -> Column:
    q1, q3 = F.col(quartiles)[0], F.col(quartiles)[1]
    return q3 + k * (q3 - q1)


def upper_fences(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (SNAPSHOT,),
    k: float = FENCE_FACTOR,
    exact: bool = False,
) -> DataFrame:
    """`by`, `column`, `q1`, `q3`, `upper_fence` for every group and column that has values."""
    return stack_quantiles(_quartiles(df, columns, by, exact), columns, by).select(
        *by,
        "column",
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("q3"),
        _fence("quantiles", k).alias("upper_fence"),
    )


def pooled_fences(state: DataFrame, by: Sequence[str] = (), k: float = FENCE_FACTOR) -> DataFrame:
    """`upper_fences` of several months together, from their stored quantile states and not from their rows."""
    quartiles = pooled_quantiles(state, [0.25, 0.75], by)
    return quartiles.select(
        *by,
        "column",
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("q3"),
        _fence("quantiles", k).alias("upper_fence"),
    )


def fence_row(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (SNAPSHOT,),
    k: float = FENCE_FACTOR,
    exact: bool = False,
) -> DataFrame:
    """`by` and `{column}_fence` for every column, one row per group."""
    quartiles = _quartiles(df, columns, by, exact)
    return quartiles.select(*by, *[_fence(name, k).alias(f"{name}_fence") for name in columns])


def below_fences(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (SNAPSHOT,),
    k: float = FENCE_FACTOR,
    exact: bool = False,
    fences: DataFrame | None = None,
) -> DataFrame:
    """Rows with every column between 0 and its fence; all fences come from the unfiltered input.

    `fences` is a stored `fence_row` of that input, if there is one; else they are computed and materialized.
    """
    upper = {name: f"{name}_fence" for name in columns}
    stored = fences is not None
    if not stored:
        fences = fence_row(df, columns, by, k, exact)
    if not by:
        # One row of numbers: as literals they reach the scan.
        found = fences.first()
        literals = {name: F.lit(found[upper[name]]).cast("double") for name in columns}
        return df.where(all_of(F.col(name).between(F.lit(0), literals[name]) for name in columns))
    # Wrapped, so that no part of a test is pushed below the join: there the optimizer would clean the
    # column a second time, once for the filter and once for the projection.
    inside = all_of(
        F.coalesce(F.col(name).between(F.lit(0), F.col(upper[name])), F.lit(False)) for name in columns
    )
    kept = join_statistics(df, fences if stored else materialize(fences), by).where(inside)
    return kept.select(*df.columns)
