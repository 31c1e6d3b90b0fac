"""Session set-up, reliable checkpoints and joins with a side whose size is checked first."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A row of statistics is some dozens of numbers, so this many rows stay within tens of megabytes.
BROADCAST_MAX_ROWS = 100_000


def build_session(app_name: str = "snapmart", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; on a cluster, spark-submit supplies the rest."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session while plans are made and run, as it was afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names; where it names none, one in the warehouse, which is shared too."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context.setCheckpointDir(configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage through the reliable checkpoint folder.

    The columns get an identity of their own, so that the result joins with the table it came from.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.select(*[F.col(name).alias(name) for name in df.columns]).checkpoint(eager=True)


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join on equal keys, null keys included, as a grouping sees them; the right keys are dropped."""
    theirs = {name: f"_right_{name}" for name in on}
    same = [F.col(name).eqNullSafe(F.col(theirs[name])) for name in on]
    return left.join(right.withColumnsRenamed(theirs), same, "inner").drop(*theirs.values())


def join_statistics(
    df: DataFrame,
    statistics: DataFrame,
    on: Sequence[str],
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Rows with the statistics of their group, which have been materialized.

    Their row count decides: up to the limit they are broadcast, so the rows are not shuffled; beyond it
    the planner chooses, and adaptive execution splits the partitions of hot groups.
    """
    if statistics.count() <= max_broadcast_rows:
        statistics = F.broadcast(statistics)
    return join_on(df, statistics, on)
