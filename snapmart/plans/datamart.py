"""The whole run: raw files to bronze, silver and gold tables, all snapshots at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapmart.functions.dates import month_starts
from snapmart.operators.features import Vocabulary, engineer_features, positions, read_vocabulary, vocabulary_values
from snapmart.operators.loans import label_store
from snapmart.operators.outliers import pooled_fences
from snapmart.operators.quality import null_profile, refused_values, step_audit
from snapmart.plans.bronze import build_bronze, rejected_rows
from snapmart.plans.gold import gold_clickstream, gold_customer
from snapmart.plans.profiling import PROFILES
from snapmart.plans.silver import (
    build_silver,
    cleaning_columns,
    cleaning_steps,
    financial_fences,
    financial_state,
    reviewed_export,
    silver_financials,
)
from snapmart.schemas import CUSTOMER_KEYS, DATASETS, DEFAULT_DPD, DEFAULT_MOB, SNAPSHOT, silver_schema
from snapmart.session import setting
from snapmart.sources.buckets import Buckets, evenly_bucketed, read_buckets, write_buckets
from snapmart.sources.delimited import read_delimited, refused_lines, write_delimited
from snapmart.sources.snapshots import path_exists, read_snapshots, table_path, write_snapshots

LAYERS = ("bronze", "silver", "gold")
#: The silver tables that become the customers, in this order.
JOINED = ("attributes", "financials")
#: What tells the row of a refused value.
KEYS = ("loan_id", "Customer_ID", SNAPSHOT)

RowCounts = dict[str, dict[date, int]]


@dataclass(frozen=True)
class DatamartConfig:
    """Where the sources and the tables are, and which months to build."""

    root: str
    sources: Mapping[str, str] = field(default_factory=dict)
    # First and last month of the datamart.
    start: date = date(2023, 1, 1)
    end: date = date(2024, 12, 1)
    dpd: int = DEFAULT_DPD
    mob: int = DEFAULT_MOB
    strict: bool = False
    #: Write the bronze tables as CSV too, under `{root}/bronze_csv`.
    bronze_csv: bool = False
    #: Buckets by customer of the two silver tables that are joined, so that the join needs no exchange; 0: plain files.
    customer_buckets: int = 0

    def path(self, layer: str, name: str) -> str:
        return table_path(self.root, layer, name)

    @property
    def snapshots(self) -> list[date]:
        return month_starts(self.start, self.end)


def run_bronze(spark: SparkSession, config: DatamartConfig, snapshots: Sequence[date]) -> RowCounts:
    rows = {}
    for name, source in config.sources.items():
        spec = DATASETS[name]
        raw = read_delimited(spark, source, spec.column_names, strict=config.strict)
        if not config.strict:
            refused = refused_lines(spark, source, spec.column_names)
            refused.write.mode("overwrite").parquet(config.path("rejects", f"{name}_lines"))
        rejected_rows(raw, spec).write.mode("overwrite").parquet(config.path("rejects", name))
        bronze = build_bronze(raw, spec, snapshots, config.strict)
        path = config.path("bronze", name)
        rows[f"bronze/{name}"] = write_snapshots(bronze, path, snapshots)
        if config.bronze_csv:
            written = read_snapshots(spark, path, snapshots, spec.bronze_schema)
            write_delimited(written, config.path("bronze_csv", name), [SNAPSHOT])
    return rows


def report(spark: SparkSession, config: DatamartConfig, name: str, table: DataFrame, snapshots: Sequence[date]) -> DataFrame:
    """Save a table of few numbers per snapshot, and read it again."""
    path = config.path("reports", name)
    write_snapshots(table, path, snapshots, rebalance=False)
    return read_snapshots(spark, path, snapshots, table.schema)


def run_silver(spark: SparkSession, config: DatamartConfig, snapshots: Sequence[date]) -> RowCounts:
    rows = {}
    for name, spec in DATASETS.items():
        if not path_exists(spark, config.path("bronze", name)):
            continue
        bronze = read_snapshots(spark, config.path("bronze", name), snapshots, spec.bronze_schema)
        report(spark, config, f"cleaning_{name}", step_audit(bronze, cleaning_steps(name), [SNAPSHOT]), snapshots)
        if not config.strict:
            keys = [key for key in KEYS if key in bronze.columns]
            report(spark, config, f"refused_{name}", refused_values(bronze, cleaning_columns(name), keys), snapshots)
        if name == "financials":
            fences = report(spark, config, "fences", financial_fences(bronze, config.strict), snapshots)
            silver = silver_financials(bronze, config.strict, fences=fences)
            state = financial_state(bronze, config.strict)
            report(spark, config, "fence_state", state, snapshots)
            every = read_snapshots(spark, config.path("reports", "fence_state"), None, state.schema)
            pooled = config.path("reports", "pooled_fences")
            pooled_fences(every).coalesce(1).write.mode("overwrite").parquet(pooled)
        else:
            silver = build_silver(name, bronze, config.strict)
        path = config.path("silver", name)
        if name not in JOINED:
            rows[f"silver/{name}"] = write_snapshots(silver, path, snapshots, rebalance=False)
            continue
        buckets = Buckets(CUSTOMER_KEYS[0], config.customer_buckets)
        bucketed = (lambda df, to: write_buckets(df, to, buckets)) if buckets.number else None
        # Whatever becomes of the write, no month is taken for bucketed that is not.
        report(spark, config, f"layout_{name}", layout(spark, snapshots, 0), snapshots)
        rows[f"silver/{name}"] = write_snapshots(silver, path, snapshots, rebalance=False, write=bucketed)
        report(spark, config, f"layout_{name}", layout(spark, snapshots, buckets.number), snapshots)
    return rows


def layout(spark: SparkSession, snapshots: Sequence[date], buckets: int) -> DataFrame:
    """`buckets`, `snapshot_date`: the layout of each month of a table; 0 for plain files."""
    return spark.createDataFrame([(buckets, day) for day in snapshots], f"buckets int, {SNAPSHOT} date").coalesce(1)


def customers(spark: SparkSession, config: DatamartConfig, snapshots: Sequence[date]) -> DataFrame:
    """`gold_customer` of the silver tables; read by buckets if every month of both was written so, and none is crowded."""
    buckets = Buckets(CUSTOMER_KEYS[0], config.customer_buckets)

    def bucketed(name: str) -> bool:
        path = config.path("reports", f"layout_{name}")
        if not buckets.number or not path_exists(spark, path):
            return False
        months = read_snapshots(spark, path, snapshots, layout(spark, [], 0).schema)
        same = months.where(F.col("buckets") == buckets.number).select(SNAPSHOT).distinct().count() == len(set(snapshots))
        return same and evenly_bucketed(spark, config.path("silver", name), silver_schema(name), buckets, snapshots)

    def silver(name: str, by_bucket: bool) -> DataFrame:
        path, schema = config.path("silver", name), silver_schema(name)
        if by_bucket:
            return read_buckets(spark, path, schema, buckets, snapshots)
        return read_snapshots(spark, path, snapshots, schema)

    by_bucket = all(map(bucketed, JOINED))
    return gold_customer(*[silver(name, by_bucket) for name in JOINED])


def run_gold(spark: SparkSession, config: DatamartConfig, snapshots: Sequence[date]) -> RowCounts:
    def has(*names: str) -> bool:
        return all(path_exists(spark, config.path("silver", name)) for name in names)

    def silver(name: str) -> DataFrame:
        return read_snapshots(spark, config.path("silver", name), snapshots, silver_schema(name))

    rows = {}
    if has("clickstream"):
        path = config.path("gold", "feature_store_clickstream")
        clickstream = gold_clickstream(silver("clickstream"))
        rows["gold/feature_store_clickstream"] = write_snapshots(clickstream, path, snapshots, rebalance=False)
    if has("lms"):
        path = config.path("gold", "label_store")
        labels = label_store(silver("lms"), config.dpd, config.mob)
        rows["gold/label_store"] = write_snapshots(labels, path, snapshots, rebalance=False)
    if not has("attributes", "financials"):
        return rows

    customer_path = config.path("gold", "feature_store_customer")
    customer = customers(spark, config, snapshots)
    # The buckets are by customer only; rows that agree on customer and month are in one bucket all the same.
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false" if config.customer_buckets else "true"):
        rows["gold/feature_store_customer"] = write_snapshots(customer, customer_path, snapshots)
    joined = read_snapshots(spark, customer_path, snapshots, customer.schema)
    report(spark, config, "customer_nulls", null_profile(joined, [SNAPSHOT]), snapshots)

    # The vocabulary covers every month of the customer table, so a new value changes the columns of all of
    # them, also of those outside the configured range. It is saved last: should the run break off, the next one finds the old vocabulary and redoes them all.
    customer_schema = customer.schema
    vocabulary = merged_vocabulary(spark, config, customer_path, customer_schema, snapshots)
    changed = vocabulary != saved_vocabulary(spark, config)
    every = read_snapshots(spark, customer_path, None, customer_schema).select(SNAPSHOT).distinct()
    redone = sorted({*[row[0] for row in every.collect()], *snapshots}) if changed else snapshots
    customer = read_snapshots(spark, customer_path, redone, customer_schema)
    path = config.path("gold", "feature_store_customer_engineered")
    engineered = engineer_features(customer, vocabulary)
    rows["gold/feature_store_customer_engineered"] = write_snapshots(engineered, path, redone, rebalance=False)
    if changed:
        table = vocabulary.to_table(spark)
        table.coalesce(1).write.mode("overwrite").parquet(config.path("gold", "vocabulary"))
    return rows


def merged_vocabulary(
    spark: SparkSession, config: DatamartConfig, customer_path: str, schema: StructType, snapshots: Sequence[date]
) -> Vocabulary:
    """The vocabulary of all months, from the values kept per month: of the customers, only the given months are read."""
    path = config.path("gold", "vocabulary_values")
    months = snapshots if path_exists(spark, path) else None
    values = vocabulary_values(read_snapshots(spark, customer_path, months, schema), [SNAPSHOT])
    if months is None:
        values.repartition(SNAPSHOT).write.partitionBy(SNAPSHOT).parquet(path)
    else:
        write_snapshots(values, path, months, rebalance=False)
    every = read_snapshots(spark, path, None, values.schema)
    return read_vocabulary(positions(every.select("kind", "value").distinct()))


def saved_vocabulary(spark: SparkSession, config: DatamartConfig) -> Vocabulary | None:
    path = config.path("gold", "vocabulary")
    return read_vocabulary(spark.read.parquet(path)) if path_exists(spark, path) else None


def run_datamart(
    spark: SparkSession,
    config: DatamartConfig,
    snapshots: Sequence[date] | None = None,
    layers: Sequence[str] = LAYERS,
) -> RowCounts:
    """Build the layers for all configured months, or again for some of them.

    Returns the rows written per table and snapshot. The number of jobs does not depend on the number
    of snapshots. Tables whose sources were never read are left out. Under `{root}/reports` are, per snapshot,
    the rows left after each cleaning step, the fences with the state that they pool from, and the nulls after the
    customer join. The pooled fences are those of all months ever built; no rows of other months are read for them.
    """
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    chosen = config.snapshots if snapshots is None else list(snapshots)
    steps = {"bronze": run_bronze, "silver": run_silver, "gold": run_gold}
    rows: RowCounts = {}
    for layer in LAYERS:
        if layer in layers:
            rows.update(steps[layer](spark, config, chosen))
    return rows


def run_profiles(spark: SparkSession, config: DatamartConfig, names: Sequence[str] = tuple(PROFILES)) -> list[str]:
    """Save the profiles of the bronze tables and of the joined customers over all months; returns their paths."""
    paths = []
    for name in names:
        layer, table, profile = PROFILES[name]
        schema = DATASETS[table].bronze_schema if layer == "bronze" else None
        for title, found in profile(read_snapshots(spark, config.path(layer, table), schema=schema)).items():
            paths.append(config.path("profiles", f"{name}/{title}"))
            found.write.mode("overwrite").parquet(paths[-1])
    return paths


def run_export(spark: SparkSession, config: DatamartConfig, path: str) -> None:
    """Write the reviewed financials of all months as CSV."""
    schema = DATASETS["financials"].bronze_schema
    bronze = read_snapshots(spark, config.path("bronze", "financials"), schema=schema)
    write_delimited(reviewed_export(bronze, config.strict), path)
