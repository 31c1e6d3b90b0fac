"""The numbers behind summaries, histograms, box plots and density curves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.operators.quantiles import exact_quantiles, stack_columns, stack_quantiles
from snapmart.session import materialize

WHISKER = 1.5
# Cells of a bandwidth, and bandwidths within which a value adds to a density.
CELLS = 64
REACH = 9
DENSITY_SCHEMA = "point int, x double, density double, curve double"


def number(name: str) -> Column:
    """The column as a double in which NaN is missing, as it is for the quartiles."""
    return F.nullif(F.col(name).cast("double"), F.lit(float("nan")))


Quartiles = Mapping[str, Sequence[float]]


def _described(value: Column, *quartiles: Column) -> Column:
    return F.struct(
        F.count(value).alias("n"),
        F.mean(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value.cast("double")).alias("min"),
        *quartiles,
        F.max(value.cast("double")).alias("max"),
    )


def describe_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`column`, `n`, `mean`, `stddev` (sample), `min`, `max` for every column, present or all null."""
    return stack_columns(df.agg(*[_described(F.col(name)).alias(name) for name in columns]), columns)


def medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """`by`, `column`, `median`, interpolated."""
    middle = stack_quantiles(exact_quantiles(df, columns, [0.5], by), columns, by)
    return middle.select(*by, "column", F.col("quantiles")[0].alias("median"))


def summary_stats(df: DataFrame, columns: Sequence[str], quartiles: Quartiles | None = None) -> DataFrame:
    """`describe_table` with the interpolated quartiles `p25`, `p50`, `p75`; `quartiles` if they are known already."""
    quartiles = quartile_row(df, columns) if quartiles is None else quartiles
    facts = []
    for name in columns:
        own = zip(["p25", "p50", "p75"], quartiles.get(name, (None, None, None)))
        facts.append(_described(number(name), *[_number(value).alias(title) for title, value in own]).alias(name))
    return stack_columns(df.agg(*facts), columns)


def quartile_row(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """Interpolated quartiles on the driver: three numbers per column that has values."""
    row = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).first()
    return {name: row[name] for name in columns if row[name] is not None}


def _number(value: float | None) -> Column:
    return F.lit(value).cast("double")


def iqr_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, both Tukey bounds and the values outside them, one row per column."""
    quartiles = quartile_row(df, columns)
    facts = []
    for name in columns:
        q1, median, q3 = quartiles.get(name, (None, None, None))
        value = number(name)
        iqr = None if q1 is None else q3 - q1
        low = None if q1 is None else q1 - WHISKER * iqr
        high = None if q1 is None else q3 + WHISKER * iqr
        n, outside = F.count(value), F.count_if((value < _number(low)) | (value > _number(high)))
        facts.append(
            F.struct(
                F.min(value).alias("min"),
                _number(q1).alias("q1"),
                _number(median).alias("median"),
                _number(q3).alias("q3"),
                F.max(value).alias("max"),
                _number(iqr).alias("iqr"),
                _number(low).alias("lower_bound"),
                _number(high).alias("upper_bound"),
                outside.alias("n_outliers"),
                F.round(F.try_divide(100 * outside, n), 2).alias("pct_outliers"),
            ).alias(name)
        )
    return stack_columns(df.agg(*facts), columns)


def boxplot_stats(df: DataFrame, columns: Sequence[str], quartiles: Quartiles | None = None) -> DataFrame:
    """Quartiles, whisker ends (furthest values within 1.5 quartile ranges) and the count beyond them."""
    quartiles = quartile_row(df, columns) if quartiles is None else quartiles
    present = [name for name in columns if name in quartiles]
    facts = []
    for name in present:
        q1, median, q3 = quartiles[name]
        low, high = q1 - WHISKER * (q3 - q1), q3 + WHISKER * (q3 - q1)
        value = number(name)
        facts.append(
            F.struct(
                F.lit(q1).alias("q1"),
                F.lit(median).alias("median"),
                F.lit(q3).alias("q3"),
                F.least(F.min(F.when(value >= low, value)), F.lit(q1)).alias("whisker_low"),
                F.greatest(F.max(F.when(value <= high, value)), F.lit(q3)).alias("whisker_high"),
                F.count_if((value < low) | (value > high)).alias("fliers"),
            ).alias(name)
        )
    if not present:
        empty = "column string, q1 double, median double, q3 double, whisker_low double, whisker_high double, fliers bigint"
        return df.sparkSession.createDataFrame([], empty)
    return stack_columns(df.agg(*facts), present)


def histogram(df: DataFrame, column: str, bins: int, threshold: float | None = None) -> DataFrame:
    """`bin`, `lower`, `upper`, `n` of equal-width bins from least to greatest value, the last one closed.

    Empty bins are listed. A threshold adds `n_at_or_above`, the values of the bin from it on.
    """
    values = df.select(number(column).alias("value")).where("value is not null")
    ends = values.agg(F.min("value").alias("low"), F.max("value").alias("high"))
    flat = F.col("low") == F.col("high")
    ends = ends.select(
        F.struct(
            F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
            F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        )
    )

    low, high, value = F.col("ends.low"), F.col("ends.high"), F.col("value")
    edge = _edges(low, high, bins)
    counts = [F.count(F.lit(1)).alias("n")]
    if threshold is not None:
        counts.append(F.count_if(value >= threshold).alias("n_at_or_above"))
    guess = _guessed_bin(value, low, high, bins).alias("guess")
    counted = (
        values.withColumn("ends", ends.scalar())
        .withColumn("guess", guess)
        .withColumn("bin", _bin_of(value, F.col("guess"), edge, bins))
        .groupBy("bin")
        .agg(*counts)
    )
    # One row per bin on both sides.
    every_bin = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    listed = every_bin.withColumn("ends", ends.scalar()).join(counted, "bin", "left")
    filled = [F.coalesce(name, F.lit(0)).alias(name) for name in counted.columns[1:]]
    return (
        listed.where(F.col("ends.low").isNotNull())
        .select("bin", edge(F.col("bin")).alias("lower"), edge(F.col("bin") + 1).alias("upper"), *filled)
        .orderBy("bin")
    )


def integer_histogram(df: DataFrame, column: str, dense: bool = False) -> DataFrame:
    """`value`, `n` for the integers that have values, each bin centred on its integer, the two ends among them.

    `dense` lists every integer from least to greatest, gaps included; the result is then as long as the range of the
    values, so an outlier makes it long.
    """
    whole = F.floor(F.col(column) + 0.5).alias("value")
    if not dense:
        return df.where(F.col(column).isNotNull()).groupBy(whole).agg(F.count(F.lit(1)).alias("n")).orderBy("value")
    # Materialized, so that finding the ends does not read the input a second time.
    counted = materialize(df.where(F.col(column).isNotNull()).groupBy(whole).agg(F.count(F.lit(1)).alias("n")))
    ends = counted.agg(F.min("value"), F.max("value")).first()
    low, high = ends if ends[0] is not None else (0, -1)
    # Generated in parallel, however far apart the ends are.
    every_value = df.sparkSession.range(low, high + 1).withColumnRenamed("id", "value")
    return (
        every_value.join(counted, "value", "left")
        .select("value", F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("value")
    )


def _edges(low: Column, high: Column, bins: int):
    """The edge below a bin of that number."""
    return lambda index: F.when(index == bins, high).otherwise(low + index * ((high - low) / bins))


def _guessed_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    return F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")


def _bin_of(value: Column, guess: Column, edge, bins: int) -> Column:
    """The scaled position can be off by one rounding step at an edge; the edges themselves decide."""
    return (
        F.when(value < edge(guess), guess - 1)
        .when((value >= edge(guess + 1)) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )


def curves(df: DataFrame, columns: Sequence[str], bins: int = 50, grid: int = 200) -> tuple[DataFrame, DataFrame]:
    """Histograms and Gaussian densities of all columns from two reads of the table, however many columns there are.

    `column`, `bin`, `lower`, `upper`, `n` as in `histogram`, and `column`, `point`, `x`, `density`, `curve` as in
    `kernel_density`. The first read gives counts, deviations and ends, the second counts bins and cells. A cell is a
    CELLS-th of a bandwidth; its values stand in the sum as the count and the first three moments about its middle. The
    series breaks off at the fourth, and points more than REACH bandwidths away are left out, so that a density is within
    one part in a billion of the greatest possible. Work per row does not depend on the grid.
    """
    spark, columns = df.sparkSession, list(columns)
    facts = [
        F.struct(
            F.count(number(name)).alias("n"),
            F.stddev_samp(number(name)).alias("deviation"),
            F.min(number(name)).alias("low"),
            F.max(number(name)).alias("high"),
        ).alias(name)
        for name in columns
    ]
    found = df.agg(*facts).first()
    shapes, parts = [], []
    for name in columns:
        n, deviation, least, most = found[name]
        if not n:
            continue
        low, high = (least - 0.5, most + 0.5) if least == most else (least, most)
        width = deviation * n ** (-1 / 5) if deviation else None
        shapes.append((name, n, low, high, least, (most - least) / (grid - 1), width))
        value = number(name)
        guess = _guessed_bin(value, F.lit(low), F.lit(high), bins)
        cell = F.rint((value - least) / (width / CELLS)) if width else F.lit(None).cast("double")
        offset = (value - least) / width - cell / CELLS if width else F.lit(None).cast("double")
        own = _bin_of(value, guess, _edges(F.lit(low), F.lit(high), bins), bins)
        own = F.when(value.isNotNull(), own)
        parts.append(F.struct(F.lit(name).alias("column"), own.alias("bin"), cell.alias("cell"), offset.alias("d")))
    schema = "column string, total long, low double, high double, least double, step double, width double"
    shape = F.broadcast(spark.createDataFrame(shapes, schema))  # one row per column
    if not parts:
        histogram_schema = "column string, bin int, lower double, upper double, n long"
        return spark.createDataFrame([], histogram_schema), spark.createDataFrame([], f"column string, {DENSITY_SCHEMA}")
    d = F.col("d")
    cells = df.select(F.inline(F.array(*parts))).where("bin is not null").groupBy("column", "bin", "cell")
    cells = materialize(
        cells.agg(F.count(F.lit(1)).alias("n"), F.sum(d).alias("m1"), F.sum(d * d).alias("m2"), F.sum(d * d * d).alias("m3"))
    )
    edge = _edges(F.col("low"), F.col("high"), bins)
    counted = cells.groupBy("column", "bin").agg(F.sum("n").alias("n"))
    every_bin = shape.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    listed = every_bin.join(counted, ["column", "bin"], "left")
    histograms = listed.select(
        "column", "bin", edge(F.col("bin")).alias("lower"), edge(F.col("bin") + 1).alias("upper"), F.coalesce("n", F.lit(0)).alias("n")
    )

    middle = F.col("cell") / CELLS * F.col("width")  # from the least value on
    first = F.greatest(F.ceil((middle - REACH * F.col("width")) / F.col("step")), F.lit(0)).cast("int")
    last = F.least(F.floor((middle + REACH * F.col("width")) / F.col("step")), F.lit(grid - 1)).cast("int")
    near = F.when(first <= last, F.sequence(first, last))
    reached = cells.where("cell is not null").join(shape, "column").withColumn("point", F.explode(near))
    u = F.col("u")
    series = F.col("n") + u * F.col("m1") + (u * u - 1) * F.col("m2") / 2 + (u * u * u - 3 * u) * F.col("m3") / 6
    sums = (
        reached.withColumn("u", F.col("point") * F.col("step") / F.col("width") - F.col("cell") / CELLS)
        .groupBy("column", "point")
        .agg(F.sum(F.exp(-u * u / 2) * series).alias("sum"))
    )
    every_point = shape.where("width is not null").withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    density = F.coalesce("sum", F.lit(0.0)) / (F.col("total") * F.col("width") * F.sqrt(2 * F.pi()))
    densities = every_point.join(sums, ["column", "point"], "left").select(
        "column",
        "point",
        (F.col("least") + F.col("point") * F.col("step")).alias("x"),
        density.alias("density"),
        (density * F.col("total") * ((F.col("high") - F.col("low")) / bins)).alias("curve"),
    )
    return histograms, densities


def kernel_density(df: DataFrame, column: str, grid: int = 200, bins: int = 50) -> DataFrame:
    """Gaussian density from least to greatest value: `point`, `x`, `density`, `curve`.

    Bandwidth by Scott's rule from the sample deviation. `curve` is the density scaled to the counts of
    a histogram with that many bins.
    """
    return curves(df, [column], bins, grid)[1].drop("column").orderBy("point")
