"""Parquet tables with one partition directory per snapshot date."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from snapmart.operators.rows import at_snapshots
from snapmart.schemas import SNAPSHOT


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_snapshots(
    spark: SparkSession,
    path: str,
    snapshots: Sequence[date] | None = None,
    schema: T.StructType | None = None,
    column: str = SNAPSHOT,
) -> DataFrame:
    """All snapshots of a table, or only some, which prunes the other directories before the scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if snapshots is None else at_snapshots(df, snapshots, column)


def write_snapshots(
    df: DataFrame,
    path: str,
    snapshots: Sequence[date] | None = None,
    rebalance: bool = True,
    write: Callable[[DataFrame, str], None] | None = None,
) -> dict[date, int]:
    """Replace the snapshots found in the rows; with `snapshots`, only those, and return their row counts.

    Other snapshots stay as they are. Those asked for but without rows end up empty, as a fresh run would
    leave them. `rebalance` gathers the rows of a snapshot into files of the advised size and splits a
    large snapshot over many tasks; leave it off if the input is already laid out by snapshot. `write` lays
    the rows out in another way; it must replace the snapshots found in them.
    """
    spark = df.sparkSession
    days = list(snapshots or [])
    before = {day: _any_file(spark, _directory(path, day)) for day in days}
    if snapshots is not None:
        df = at_snapshots(df, days)
    if write is None:
        laid_out = df.hint("rebalance", SNAPSHOT) if rebalance else df
        (
            laid_out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(SNAPSHOT)
            .parquet(path)
        )
    else:
        write(df, path)
    for day, file in before.items():
        # The write replaces all files of a snapshot that has rows, so this one had none.
        if file is not None and path_exists(spark, file):
            _delete(spark, _directory(path, day))
    if not days:
        return {}
    # No column is read: the counts come from the file footers.
    written = read_snapshots(spark, path, days, df.schema).groupBy(SNAPSHOT).count()
    rows = {row[SNAPSHOT]: row["count"] for row in written.collect()}
    return {day: rows.get(day, 0) for day in days}


def _directory(path: str, day: date) -> str:
    return f"{path}/{SNAPSHOT}={day.isoformat()}"


def path_exists(spark: SparkSession, path: str) -> bool:
    location, files = _on_file_system(spark, path)
    return files.exists(location)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, whatever the working directory."""
    location, files = _on_file_system(spark, path)
    return files.makeQualified(location).toString()


def _any_file(spark: SparkSession, directory: str) -> str | None:
    location, files = _on_file_system(spark, directory)
    if not files.exists(location):
        return None
    found = files.listFiles(location, False)
    return found.next().getPath().toString() if found.hasNext() else None


def _delete(spark: SparkSession, directory: str) -> None:
    location, files = _on_file_system(spark, directory)
    files.delete(location, True)


def _on_file_system(spark: SparkSession, path: str):
    """The path and the file system it lives on, local or shared."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
