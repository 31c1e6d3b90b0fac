"""What the planner makes of the jobs: pruned scans, few shuffles, split hot groups."""

import re
from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from snapmart.operators import counts, loans
from snapmart.operators.features import Vocabulary, engineer_features
from snapmart.operators.outliers import upper_fences
from snapmart.plans.gold import gold_customer
from snapmart.plans.silver import silver_financials, silver_lms
from snapmart.schemas import FENCED_COLUMNS, FINANCIAL_NUMBERS, FINANCIALS, LMS, SNAPSHOT
from snapmart.sources.snapshots import read_snapshots
from snapmart.session import ensure_checkpoint_dir, join_statistics, materialize

JAN = date(2023, 1, 1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **conf):
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.fixture(scope="module")
def lms_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "lms")
    df = spark.range(1000).select(
        *[F.col("id").cast("string").alias(name) for name in LMS.column_names if name != SNAPSHOT],
        F.lit(JAN).alias(SNAPSHOT),
    )
    silver_lms(df.withColumn("loan_start_date", F.lit("2023-01-01"))).write.partitionBy(SNAPSHOT).parquet(path)
    return path


def test_labels_read_only_their_columns_and_push_the_age_filter(spark, lms_table):
    plan = plan_of(counts.default_rates(loans.label_store(spark.read.parquet(lms_table))))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == {"mob", "dpd"}
    assert "EqualTo(mob,6)" in plan


def test_a_day_of_a_timestamp_column_reaches_the_scan(spark):
    days = read_snapshots(spark, "/root/testdata/sf0.001/orders.parquet", [date(1995, 3, 1)], column="o_orderdate")
    plan = plan_of(days.select("o_orderkey"))
    assert "EqualTo(o_orderdate,1995-03-01T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_default_rates_shuffle_partial_sums_once_before_the_sort(spark, lms_table):
    plan = plan_of(counts.default_rates(loans.label_store(spark.read.parquet(lms_table))))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan


def test_labels_and_features_need_no_shuffle(spark, lms_table):
    assert "Exchange" not in plan_of(loans.label_store(spark.read.parquet(lms_table)))
    schema = ", ".join(f"{name} {dtype.simpleString()}" for name, dtype in FINANCIALS.columns)
    customers = spark.createDataFrame([], schema + ", Occupation string").repartition(2)
    vocabulary = Vocabulary(
        {
            "occupations": tuple(f"job {i}" for i in range(20)),
            "credit_mixes": ("Good",),
            "payment_behaviours": ("Low",),
            "loan_types": tuple(f"loan {i}" for i in range(20)),
        }
    )
    with settings(spark, spark__sql__adaptive__enabled="false"):
        plan = plan_of(engineer_features(customers, vocabulary))
    assert plan.count("Exchange") == 1
    # The list is split once, not once per token.
    assert plan.count("split(") == 1
    assert all("*(" in line for line in plan.splitlines() if "Project" in line)


def test_all_fences_come_from_one_shuffle_of_sketches(spark):
    schema = ", ".join(f"{name} {dtype.simpleString()}" for name, dtype in FINANCIALS.columns)
    plan = plan_of(upper_fences(spark.createDataFrame([], schema), FENCED_COLUMNS))
    assert plan.count("Exchange") == 1
    assert plan.count("partial_percentile_approx") == len(FENCED_COLUMNS)


def plan_types(bronze):
    return silver_financials(bronze).dtypes


def test_fenced_columns_are_cleaned_once(spark):
    schema = ", ".join(f"{name} {'date' if name == SNAPSHOT else 'string'}" for name in FINANCIALS.column_names)
    bronze = spark.createDataFrame([], schema)
    plan = plan_of(silver_financials(bronze))
    # Every number in the projection, and the balance in the not-null filter below it. The test for a whole number
    # names its text three times in one expression, which is evaluated once.
    whole = sum(1 for name in FINANCIAL_NUMBERS if dict(plan_types(bronze))[name] == "int")
    assert plan.count("translate(") == len(FINANCIAL_NUMBERS) + 1 + 2 * whole


def test_statistics_are_broadcast_only_below_the_limit(spark):
    rows = spark.range(1000).withColumn("k", F.col("id") % 10)
    statistics = materialize(rows.groupBy("k").count())
    off = {"spark__sql__adaptive__enabled": "false", "spark__sql__autoBroadcastJoinThreshold": "-1"}
    with settings(spark, **off):
        assert "BroadcastHashJoin" in plan_of(join_statistics(rows, statistics, ["k"]))
        beyond = join_statistics(rows, statistics, ["k"], max_broadcast_rows=9)
        assert "SortMergeJoin" in plan_of(beyond)
        assert beyond.count() == 1000


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_statistics_join_the_table_they_came_from(spark, adaptive):
    rows = spark.range(100).withColumn("k", F.col("id") % 10)
    with settings(spark, spark__sql__adaptive__enabled=adaptive):
        statistics = materialize(rows.where("k < 5").groupBy("k").count())
        assert join_statistics(rows, statistics, ["k"]).count() == 50


def test_a_hot_customer_is_split_in_the_join(spark):
    """A third of the attribute rows belong to one customer; the other side has that customer once."""
    n = 300_000
    hot = F.when(F.col("id") % 3 == 0, F.lit("CUS_hot")).otherwise(F.concat(F.lit("CUS_"), F.col("id")))
    left = spark.range(0, n, 1, 8).select(hot.alias("Customer_ID"), F.lit(JAN).alias(SNAPSHOT), F.hex(F.xxhash64("id")).alias("x"))
    right = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") == 0, F.lit("CUS_hot")).otherwise(F.concat(F.lit("CUS_"), F.col("id"))).alias("Customer_ID"),
        F.lit(JAN).alias(SNAPSHOT),
        F.col("id").alias("y"),
    )
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        joined = gold_customer(left, right)
        joined.collect()
        assert "skew=true" in plan_of(joined)
        assert joined.where("Customer_ID = 'CUS_hot'").count() == n // 3


def test_checkpoints_use_the_folder_of_the_session(spark):
    ensure_checkpoint_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured in spark.sparkContext.getCheckpointDir()
