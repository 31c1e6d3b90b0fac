"""Snapshot tables bucketed by a key: joins on the key and the snapshot read them without an exchange.

An external table in the session's catalog names the layout of the files. Which months were written with it is kept by the
caller; a table with files of another layout, or whose rows crowd in one bucket, is to be read as plain Parquet: the join then
shuffles, and adaptive execution splits a hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.operators.rows import at_snapshots
from snapmart.schemas import SNAPSHOT
from snapmart.session import setting
from snapmart.sources.snapshots import path_exists, qualified, read_snapshots

#: A bucket is crowded if it holds so many times the mean and more than so many bytes.
CROWDED_TIMES = 4
CROWDED_BYTES = 256 << 20


@dataclass(frozen=True)
class Buckets:
    """Rows are dealt by the hash of the key."""

    key: str
    number: int


def write_buckets(df: DataFrame, path: str, buckets: Buckets) -> None:
    """Replace the snapshots found in the rows. A large bucket becomes several files, written by as many tasks."""
    spark = df.sparkSession
    name = _table(spark, path, df.schema, buckets)
    laid_out = df.select(*_columns(df.schema)).hint("rebalance", buckets.number, buckets.key)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        laid_out.write.insertInto(name, overwrite=True)


def read_buckets(
    spark: SparkSession, path: str, schema: T.StructType, buckets: Buckets, snapshots: Sequence[date] | None = None
) -> DataFrame:
    """All snapshots of a bucketed table, or only some; every file read must have been written with these buckets."""
    df = spark.table(_table(spark, path, schema, buckets)).select(*schema.names)
    return df if snapshots is None else at_snapshots(df, snapshots)


def evenly_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, buckets: Buckets, snapshots: Sequence[date] | None = None,
    crowded_bytes: int = CROWDED_BYTES,
) -> bool:
    """Whether all files carry a bucket's number and no bucket is crowded. No column is read."""
    plain = read_snapshots(spark, path, snapshots, schema)
    meta = plain.metadataColumn("_metadata")
    files = plain.select(meta["file_path"].alias("file"), meta["file_size"].alias("size"))
    files = files.groupBy("file").agg(F.max("size").alias("size"))
    of = F.regexp_extract("file", r"_(\d+)(?:\.[^/]*)?$", 1).alias("bucket")
    sizes = files.groupBy(of).agg(F.sum("size").alias("size"))
    found = sizes.agg(
        F.count_if(F.col("bucket") == "").alias("plain"), F.max("size").alias("most"), F.sum("size").alias("all")
    ).first()
    most, mean = found["most"] or 0, (found["all"] or 0) / buckets.number
    return not found["plain"] and (most <= crowded_bytes or most <= CROWDED_TIMES * mean)


def _columns(schema: T.StructType) -> list[str]:
    return [*(name for name in schema.names if name != SNAPSHOT), SNAPSHOT]


def _table(spark: SparkSession, path: str, schema: T.StructType, buckets: Buckets) -> str:
    """The catalog's name of the files, with the partitions that are there now."""
    location = qualified(spark, path)
    name = "snapmart_" + hashlib.md5(f"{location} {buckets} {schema.simpleString()}".encode()).hexdigest()
    columns = ", ".join(f"`{column}` {schema[column].dataType.simpleString()}" for column in _columns(schema))
    escaped = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"create table if not exists {name} ({columns}) using parquet partitioned by (`{SNAPSHOT}`) "
        f"clustered by (`{buckets.key}`) into {buckets.number} buckets location '{escaped}'"
    )
    if path_exists(spark, path):
        spark.sql(f"msck repair table {name} sync partitions")
        spark.catalog.refreshTable(name)
    return name
