"""Exact quantiles of many columns and groups, without gathering a large group in one task.

A sketch tells where to look: around each wanted quantile it gives a narrow bracket. Counting then keeps the values inside
the brackets and only a count for each stretch between them, so that map-side combining shrinks almost all rows to a few.
The wanted ranks are looked up in the counts. Should a rank fall outside its bracket, the brackets are widened and the
count repeated, so the result never depends on how good the sketch is. There is one path for tables of every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.session import join_on, join_statistics, materialize

# Share of the rows on either side of a quantile that its bracket should span; the sketch errs by a
# quarter of the first one. The last one keeps everything.
BRACKET_WIDTHS = (0.002, 0.02, 1.0)
SKETCH_ACCURACY = 2_000
BINS_PER_BRACKET = 1024
# Ranges that the values of one bin are dealt into, each with about as many different values.
CHUNKS = 256
CHUNK_ACCURACY = 4096


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    interpolate: bool = True,
) -> DataFrame:
    """One row per group: `by` and, under the name of each column, the array of its quantiles.

    Nulls and NaN are skipped; a column without values has null. With `interpolate` a quantile lies
    between its two neighbours, without it is the first value whose share of rows reaches the
    probability. Probabilities are given in ascending order.
    """
    numbers = df.select(*by, *[_number(name) for name in columns])
    long = _bracketed_quantiles(numbers, columns, probabilities, by, interpolate)
    return long.groupBy(*by).agg(
        *[
            F.any_value(F.when(F.col("column") == name, F.col("quantiles")), ignoreNulls=True).alias(name)
            for name in columns
        ]
    )


def stack_quantiles(wide: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """`by`, `column`, `quantiles`, one row per column that has values."""
    rows = F.array(*[F.struct(F.lit(name).alias("column"), F.col(name).alias("quantiles")) for name in columns])
    return wide.select(*by, F.inline(rows)).where("quantiles is not null")


def _number(name: str) -> Column:
    return F.nullif(F.col(name).cast("double"), F.lit(float("nan"))).alias(name)


def _bracketed_quantiles(
    numbers: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str],
    interpolate: bool,
) -> DataFrame:
    """`by`, `column`, `n`, `quantiles`, materialized."""
    keys = [*by, "column"]
    for width in BRACKET_WIDTHS:
        brackets = _settled(_brackets(numbers, columns, probabilities, by, width), by)
        counts = materialize(_bracket_counts(numbers, brackets, columns, by, len(probabilities)))
        found = _settled(_quantiles_at(counts, keys, probabilities, interpolate), by)
        # A rank that fell between the brackets has no value.
        if found.where(F.exists("quantiles", F.isnull)).isEmpty():
            break
    return found


def _settled(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """A table with a row per column, or per group and column, computed once.

    Without groups these are a few numbers per column, which the plan can hold; groups have no bound and are
    checkpointed."""
    return materialize(df) if by else df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def _brackets(
    numbers: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str],
    width: float,
) -> DataFrame:
    """Lower and upper end of each bracket."""
    below = [max(0.0, p - width) for p in probabilities]
    above = [min(1.0, p + width) for p in probabilities]
    summaries = [
        F.struct(
            F.count(name).alias("n"),
            F.min(name).alias("least"),
            F.max(name).alias("greatest"),
            F.percentile_approx(name, [*below, *above], SKETCH_ACCURACY).alias("ends"),
        ).alias(name)
        for name in columns
    ]
    stacked = stack_columns(numbers.groupBy(*by).agg(*summaries), columns, by).where("n > 0")
    whole = F.lit(width >= 1.0)
    k = len(probabilities)
    return stacked.select(
        *by,
        "column",
        F.when(whole, F.array_repeat("least", k)).otherwise(F.slice("ends", 1, k)).alias("low"),
        F.when(whole, F.array_repeat("greatest", k)).otherwise(F.slice("ends", k + 1, k)).alias("high"),
    )


def stack_columns(wide: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One struct per column becomes one row per column."""
    rows = F.array(*[F.struct(F.lit(name).alias("column"), F.col(f"`{name}`.*")) for name in columns])
    return wide.select(*by, F.inline(rows))


def _bracket_counts(
    numbers: DataFrame, brackets: DataFrame, columns: Sequence[str], by: Sequence[str], k: int
) -> DataFrame:
    """Counts per value inside the brackets (odd segments) and per stretch between them (even ones)."""
    value = F.col("value")
    segment = F.lit(2 * k)
    for i in reversed(range(k)):
        low, high = F.col("low")[i], F.col("high")[i]
        segment = F.when(value < low, 2 * i).when(value <= high, 2 * i + 1).otherwise(segment)
    inside = F.col("segment") % 2 == 1
    low = F.get("low", F.shiftright("segment", 1))
    span = F.get("high", F.shiftright("segment", 1)) - low
    bin_ = F.least(F.floor((value - low) / span * BINS_PER_BRACKET), F.lit(BINS_PER_BRACKET - 1))
    long = numbers.unpivot(list(by), list(columns), "column", "value").where("value is not null")
    rows = join_statistics(long, brackets, [*by, "column"])
    return (
        rows.withColumn("segment", segment)
        .select(
            *by,
            "column",
            "segment",
            F.when(inside & (span > 0) & (span < float("inf")), bin_).otherwise(0).alias("bin"),
            F.when(inside, value).alias("value"),
        )
        .groupBy(*by, "column", "segment", "bin", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _positions(total: Column, p: float, interpolate: bool) -> tuple[Column, Column, Column]:
    """Zero-based ranks of the neighbours of a quantile and the weight of the upper one."""
    if interpolate:
        position = (total - 1) * F.lit(float(p))
        return F.floor(position), F.ceil(position), position - F.floor(position)
    rank = F.greatest(F.ceil(total * F.lit(float(p))) - 1, F.lit(0).cast("bigint"))
    return rank, rank, F.lit(0.0)


def _target_cells(
    counts: DataFrame, keys: Sequence[str], probabilities: Sequence[float], interpolate: bool
) -> DataFrame:
    """The (segment, bin) cells that hold a wanted rank, with the number of rows before them.

    A group has at most some thousand cells, whatever its size, so these windows stay small.
    """
    group = Window.partitionBy(*keys)
    cells = counts.groupBy(*keys, "segment", "bin").agg(F.sum("rows").alias("rows"))
    ranks = [r for p in probabilities for r in _positions(F.col("n"), p, interpolate)[:2]]
    end = F.col("before") + F.col("rows")
    return (
        cells.withColumn("n", F.sum("rows").over(group))
        .withColumn("before", F.sum("rows").over(group.orderBy("segment", "bin")) - F.col("rows"))
        .withColumn("ranks", F.array_distinct(F.array(*ranks)))
        .withColumn("ranks", F.filter("ranks", lambda r: (r >= F.col("before")) & (r < end)))
        .where(F.size("ranks") > 0)
        .drop("rows")
    )


def _dealt(counts: DataFrame, targets: DataFrame, cell: Sequence[str]) -> DataFrame:
    """The values of the wanted cells with the range, `chunk`, of each: one of CHUNKS, equal in different values."""
    rows = join_on(counts, targets, cell)
    steps = [i / CHUNKS for i in range(1, CHUNKS)]
    cuts = rows.groupBy(*cell).agg(F.percentile_approx("value", steps, CHUNK_ACCURACY).alias("cuts"))
    before = F.size(F.filter("cuts", lambda cut: cut < F.col("value")))
    return join_on(rows, cuts, cell).withColumn("chunk", before).drop("cuts")


def _quantiles_at(
    counts: DataFrame, keys: Sequence[str], probabilities: Sequence[float], interpolate: bool
) -> DataFrame:
    """Order statistics at the wanted ranks, found among the values of their cells.

    A cell may hold most values of a heavy-tailed column, so its values are dealt out by range first: the ranks are
    looked up among the row counts of the ranges, and then among the values of the ranges that hold one. A sketch of the
    cell's values fixes the ranges, so that both steps see the same ones without storing the values.
    """
    cell = [*keys, "segment", "bin"]
    targets = _target_cells(counts, keys, probabilities, interpolate)
    chunk = [*cell, "chunk"]
    dealt = _dealt(counts, targets, cell)
    sums = dealt.groupBy(*chunk, "n", "before", "ranks").agg(F.sum("rows").alias("held"))
    start = F.col("before") + F.sum("held").over(Window.partitionBy(*cell).orderBy("chunk")) - F.col("held")
    sums = sums.withColumn("start", start).withColumn(
        "ranks", F.filter("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("held")))
    )
    wanted = sums.where(F.size("ranks") > 0).select(*chunk, "start", "ranks")
    running = F.sum("rows").over(Window.partitionBy(*chunk).orderBy("value"))
    end = F.col("start") + F.col("running")
    found = (
        join_on(dealt.drop("before", "ranks"), wanted, chunk)
        .withColumn("running", running)
        .withColumn(
            "ranks",
            F.filter("ranks", lambda r: (r >= end - F.col("rows")) & (r < end)),
        )
        .select(*keys, "n", "value", F.explode("ranks").alias("rank"))
    )
    # At most two ranks per probability, so the collected list is short.
    at_rank = F.map_from_entries(F.collect_list(F.struct("rank", "value")))
    quantiles = []
    for p in probabilities:
        lower, upper, weight = _positions(F.col("n"), p, interpolate)
        low, high = F.col("at_rank")[lower], F.col("at_rank")[upper]
        quantiles.append(F.when(low == high, low).otherwise(low + (high - low) * weight))
    return (
        found.groupBy(*keys, "n")
        .agg(at_rank.alias("at_rank"))
        .select(*keys, "n", F.array(*quantiles).alias("quantiles"))
    )
