"""Helpers the operators share: cutting lineage, names that do not clash, ASCII case folding."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch whose texts are Python objects at a time.
SLICE_ROWS = 128
#: Bytes of rows that travel to a Python worker at a time, where texts do.
BATCH_BYTES = 8 << 20
#: Paths of files broadcast at most.
FILES = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; where it is unset, a folder in the warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder, so that a lost executor costs no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_texts(df: DataFrame) -> DataFrame:
    """materialize() for a table made from texts in Python workers: they get BATCH_BYTES at a time while it runs."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(name, None)
    conf.set(name, BATCH_BYTES)
    try:
        return materialize(df)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have, whatever its letter case."""
    taken = {name.lower() for name in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; all other characters stay. Pure ASCII takes the fast path."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Parts of the batches, in order: what a task makes of a part is gone before the next one comes."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
    give_back()


def give_back() -> None:
    """Return what is free in this Python worker to the system: workers outlive tasks and share the executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def small_enough(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a materialized table counted to have at most so many rows, else the table as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def numbered(docs: DataFrame, name: str = "row_id") -> DataFrame:
    """The table with a number for each row that is the same in every scan, however the files are cut.

    Rows of Parquet files are numbered by file, in the order of paths, and place in the file. Other tables must have fixed
    partitions; a plan over files must be stored first.
    """
    path, place, base = fresh(docs, "file"), fresh(docs, "place"), fresh(docs, "base")
    leaf = docs._jdf.queryExecution().analyzed().children().isEmpty()
    try:
        meta = docs.metadataColumn("_metadata")
        named = docs.select("*", meta["file_path"].alias(path), meta["row_index"].alias(place)) if leaf else None
    except AnalysisException:
        named = None
    if named is None:
        return docs.withColumn(name, F.monotonically_increasing_id())
    files = sorted(row[0] for row in named.select(path).distinct().collect())
    firsts = docs.sparkSession.createDataFrame([(file, at << 33) for at, file in enumerate(files)], f"{path} string, {base} long")
    firsts = F.broadcast(firsts) if len(files) <= FILES else firsts
    rows = named.join(firsts, path).withColumn(name, F.col(base) + F.col(place))
    return rows.drop(path, place, base)


def without_rows(docs: DataFrame, dropped: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """The documents but for those of the given row ids (their only column); docs must be a stored table.

    Up to so many ids, 8 bytes each, are broadcast, so that the texts stay where they are; beyond that they are joined.
    """
    row = fresh(docs, "row")
    ids = small_enough(materialize_texts(dropped.toDF(row)), broadcast_rows)
    return numbered(docs, row).join(ids, row, "left_anti").drop(row)
