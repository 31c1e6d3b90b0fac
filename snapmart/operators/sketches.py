"""Mergeable summaries of a column's values: kept per month, pooled over months without reading the rows again.

The state of a group is its row count and POINTS + 1 order statistics at equal steps. Between two of them lies one part in
POINTS of the rows, so a pooled rank is off by at most one part in POINTS of all rows and one row for each state, besides
the sketch's own error.
Nulls and NaN are skipped; a group without values has no state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.operators.distributions import number
from snapmart.operators.quantiles import stack_columns

POINTS = 1000
ACCURACY = 10_000


def quantile_state(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """`by`, `column`, `n`, `points`: one shuffle of sketches for all columns and groups."""
    steps = [i / POINTS for i in range(POINTS + 1)]
    facts = [
        F.struct(F.count(number(name)).alias("n"), F.percentile_approx(number(name), steps, ACCURACY).alias("points")).alias(name)
        for name in columns
    ]
    return stack_columns(df.groupBy(*by).agg(*facts), columns, by).where("n > 0")


def pooled_quantiles(state: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """`by`, `column`, `n`, `quantiles` of the groups of states together: values of the column, not interpolated.

    A column's states are some thousand numbers per month, whatever the rows, so sorting them takes one task.
    """
    keys = [*by, "column"]
    total = state.groupBy(*keys).agg(F.sum("n").alias("total"))
    weighted = state.select(*keys, "n", F.explode(F.slice("points", 2, POINTS)).alias("value"))
    weighted = weighted.groupBy(*keys, "value").agg(F.sum("n").alias("weight"))
    reached = F.sum("weight").over(Window.partitionBy(*keys).orderBy("value"))
    ranked = weighted.withColumn("reached", reached).join(total, keys)
    at = [F.min(F.when(F.col("reached") >= F.ceil(F.col("total") * p) * POINTS, F.col("value"))) for p in probabilities]
    return ranked.groupBy(*keys, F.col("total").alias("n")).agg(F.array(*at).alias("quantiles"))
