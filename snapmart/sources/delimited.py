"""CSV in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A quote inside a quoted field is written twice, and spaces around a text are part of it.
FORMAT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    sep: str = ",",
    strict: bool = False,
) -> DataFrame:
    """One file, a directory or a glob as one table of text columns, found by their header names.

    Nothing is inferred from the values, so the types never depend on which rows a file happens to
    have. A file whose header differs from the first one's is an error. Lines with too few or too many fields are an
    error if strict; else they are left out, and `refused_lines` has them.
    """
    lines = _lines(spark, paths, columns, sep, strict)
    return lines.where(F.col(lines.columns[-1]).isNull() & _read(lines)).select(*columns)


def refused_lines(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], sep: str = ",") -> DataFrame:
    """`file`, `line`: the lines that `read_delimited` leaves out, as they stand in their file.

    The rows read are those kept and those refused: every line but headers and empty ones is in one of the two.
    """
    lines = _lines(spark, paths, columns, sep, strict=False)
    refused = F.col(lines.columns[-1])
    kept = lines.where(refused.isNotNull() & _read(lines))
    return kept.select(F.col("_metadata.file_path").alias("file"), refused.alias("line"))


def _read(lines: DataFrame) -> Column:
    """Always true, and names a field, without which Spark does not tell whether a line fits."""
    return F.length(F.concat_ws("", *[F.col(f"`{name}`") for name in (lines.columns[0], lines.columns[-1])])) >= 0


def _lines(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], sep: str, strict: bool) -> DataFrame:
    """All columns of the header, and last the text of a line that does not fit it."""
    paths = paths if isinstance(paths, str) else list(paths)
    reader = spark.read.options(**FORMAT, sep=sep, enforceSchema=False).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    header = reader.csv(paths).columns
    missing = [name for name in columns if name not in header]
    if missing:
        raise ValueError(f"columns missing from {paths}: {missing}")
    refused, taken = "refused", {name.lower() for name in header}
    while refused in taken:
        refused += "_"
    fields = [T.StructField(name, T.StringType()) for name in [*header, refused]]
    # Lines are always parsed whole: with some of the fields left out, none would be found not to fit.
    reader = reader.option("columnNameOfCorruptRecord", refused).option("columnPruning", False)
    return reader.schema(T.StructType(fields)).csv(paths)


def write_delimited(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sep: str = ",", mode: str = "overwrite"
) -> None:
    """Part files with a header each, written by the executors; dates in ISO form.

    Of a partitioned table, only the partitions found in the rows are replaced.
    """
    writer = df.write.options(**FORMAT, sep=sep).mode(mode).partitionBy(*partition_by)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.csv(path)
