from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.operators import counts, quality
from snapmart.operators.rows import typed_columns
from snapmart.schemas import SNAPSHOT
from tests.conftest import rows

JAN, FEB = date(2023, 1, 1), date(2023, 2, 1)


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(
        [(JAN, "a", 1, 1.0), (JAN, None, 2, None), (FEB, "a", None, float("nan")), (FEB, "b", None, 4.0)],
        f"{SNAPSHOT} date, name string, n int, x double",
    )


def test_null_profile_counts_nulls_but_not_nan(data):
    assert rows(quality.null_profile(data)) == [(0, 1, 2, 1)]
    per_month = quality.null_profile(data, [SNAPSHOT]).orderBy(SNAPSHOT)
    assert rows(per_month) == [(JAN, 1, 0, 1), (FEB, 0, 2, 0)]


def test_null_profile_of_an_empty_table_is_zero(data):
    assert rows(quality.null_profile(data.where("false"))) == [(0, 0, 0, 0)]


def test_null_report_lists_only_columns_with_nulls(data):
    assert sorted(rows(quality.null_report(data))) == [("n", 2), ("name", 1), ("x", 1)]
    assert sorted(rows(quality.null_report(data, [SNAPSHOT]))) == [(JAN, "name", 1), (JAN, "x", 1), (FEB, "n", 2)]


def test_step_audit_is_cumulative(data):
    steps = {"name": F.col("name").isNotNull(), "n": F.col("n").isNotNull()}
    assert rows(quality.step_audit(data, steps)) == [(4, 3, 1)]


def test_rejected_values(spark):
    raw = spark.createDataFrame([("1", "x"), ("y", "2.5"), (None, "")], "a string, b string")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.FloatType())])
    assert rows(quality.rejected_values(raw, typed_columns(schema))) == [("a", 1), ("b", 2)]


def test_column_info(data):
    assert rows(quality.column_info(data)) == [
        (SNAPSHOT, "date", 4),
        ("name", "string", 3),
        ("n", "int", 2),
        ("x", "double", 3),
    ]


def test_value_counts_has_null_and_breaks_ties(data):
    assert rows(counts.value_counts(data, "name")) == [("a", 2), (None, 1), ("b", 1)]
    several = rows(counts.column_value_counts(data, ["name", "n"]))
    assert several == [("n", None, 2), ("n", "1", 1), ("n", "2", 1), ("name", "a", 2), ("name", None, 1), ("name", "b", 1)]


def test_distinct_keys(data):
    assert rows(counts.distinct_keys(data, ["name", "n"])) == [(4, 2, 2)]


def test_one_per_key_takes_the_first_and_keeps_null_keys(spark):
    df = spark.createDataFrame(
        [("k", 2, "late"), ("k", 1, "early"), ("j", 5, None), (None, 1, "z")], "k string, o int, v string"
    ).repartition(4)
    found = counts.one_per_key(df, "k", ["o", "v"])
    assert found.columns == ["k", "o", "v"]
    assert set(rows(found)) == {("k", 1, "early"), ("j", 5, None), (None, 1, "z")}


def test_label_shares_and_default_rates(spark):
    labels = spark.createDataFrame([(JAN, 1), (JAN, 0), (JAN, 0), (FEB, 0)], f"{SNAPSHOT} date, label int")
    assert rows(counts.label_shares(labels)) == [(0, 3, 75.0), (1, 1, 25.0)]
    assert rows(counts.default_rates(labels)) == [(JAN, 3, 1, 33.33), (FEB, 1, 0, 0.0)]


def test_top_values(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 10)
    assert rows(counts.top_values(df, [F.desc("v"), F.asc("id")], 3)) == [(9, 9), (19, 9), (29, 9)]
