from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions import cleaning
from snapmart.functions.dates import month_sequence, month_starts
from snapmart.operators import rows as row_ops
from snapmart.schemas import ATTRIBUTE_SENTINELS, CLICKSTREAM, STATIC_BOUNDS
from tests.conftest import rows


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_clean_number_as_int(spark):
    values = ["3", "3_", "__10000__", "_", "", None, "3.0", "x", "99999999999"]
    found = column(spark, values, lambda v: cleaning.clean_number(v, T.IntegerType()))
    assert found == [3, 3, 10000, None, None, None, 3, None, None]


def test_clean_number_with_decimal_comma_and_rounding(spark):
    swap = column(spark, ["12,5", "_1,25_", "7"], lambda v: cleaning.clean_number(v, T.FloatType(), decimal_comma=True))
    assert swap == [12.5, 1.25, 7.0]
    kept = column(spark, ["12,5"], lambda v: cleaning.clean_number(v, T.FloatType()))
    assert kept == [None]
    double = column(spark, ["2.675", "-1.125_"], lambda v: cleaning.clean_number(v, T.DoubleType(), decimals=2))
    assert double == [2.68, -1.13]


@pytest.mark.parametrize("text", ["3.0", "x"])
def test_strict_int_raises(spark, text):
    with pytest.raises(PySparkException):
        column(spark, [text], lambda v: cleaning.clean_number(v, T.IntegerType(), strict=True))


def test_clean_age(spark):
    values = ["41_", "-500", "41", "4-5", "", None, " 30 "]
    assert column(spark, values, cleaning.clean_age) == [41, -500, 41, None, None, None, 30]
    with pytest.raises(PySparkException):
        column(spark, ["4-5"], lambda v: cleaning.clean_age(v, strict=True))


def test_blank_to_null_keeps_the_rest_untrimmed(spark):
    assert column(spark, [" ", "", None, " a "], cleaning.blank_to_null) == [None, None, None, " a "]


def test_extract_and_coerce_numbers(spark):
    assert column(spark, ["$1,234.5_", "-7", "1-2", "abc"], cleaning.extract_number) == [1234.5, -7.0, None, None]
    assert column(spark, ["1.5", "1_", "nan", None], cleaning.coerce_number) == [1.5, None, None, None]


def test_parse_date_is_strict_about_the_pattern(spark):
    found = column(spark, ["01/02/2023", "1/2/2023", "2023-02-01"], lambda v: cleaning.parse_date(v, "dd/MM/yyyy"))
    assert found == [date(2023, 2, 1), None, None]
    with pytest.raises(PySparkException):
        column(spark, ["1/2/2023"], lambda v: cleaning.parse_date(v, "dd/MM/yyyy", strict=True))


def test_month_spine():
    months = month_starts(date(2023, 1, 15), date(2024, 12, 1))
    assert len(months) == 24 and months[0] == date(2023, 1, 1) and months[-1] == date(2024, 12, 1)
    assert month_starts(date(2023, 11, 1), date(2024, 1, 31)) == [date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1)]
    assert month_starts(date(2024, 2, 1), date(2024, 1, 31)) == []


def test_month_spine_as_column(spark):
    df = spark.createDataFrame([(date(2023, 1, 15), date(2023, 4, 1))], "a date, b date")
    found = df.select(month_sequence(F.col("a"), F.col("b"))).first()[0]
    assert found == month_starts(date(2023, 1, 15), date(2023, 4, 1))


def test_sentinel_filter_drops_nulls_too(spark):
    df = spark.createDataFrame(
        [("1", "Lawyer"), ("2", "_______"), ("#F%$D@*&8", "Lawyer"), ("4", None), (None, "Lawyer")],
        "SSN string, Occupation string",
    )
    assert rows(row_ops.without_sentinels(df, ATTRIBUTE_SENTINELS)) == [("1", "Lawyer")]


def test_bounds_are_inclusive_and_drop_nulls(spark):
    df = spark.createDataFrame([(0,), (10,), (11,), (-1,), (None,)], "Num_Credit_Card int")
    kept = row_ops.within_bounds(df, {"Num_Credit_Card": STATIC_BOUNDS["Num_Credit_Card"]})
    assert sorted(rows(kept)) == [(0,), (10,)]


def test_enforce_schema_names_missing_columns(spark):
    df = spark.createDataFrame([("1",)], "fe_1 string")
    with pytest.raises(ValueError, match="fe_2"):
        row_ops.enforce_schema(df, CLICKSTREAM.typed_schema)


def test_enforce_schema_types_and_order(spark):
    df = spark.createDataFrame([("2023-01-01", "1.0", "1.5", "x")], "d string, i string, f string, extra string")
    schema = T.StructType(
        [T.StructField("i", T.IntegerType()), T.StructField("f", T.FloatType()), T.StructField("d", T.DateType())]
    )
    typed = row_ops.enforce_schema(df, schema)
    assert typed.dtypes == [("i", "int"), ("f", "float"), ("d", "date")]
    assert rows(typed) == [(1, 1.5, date(2023, 1, 1))]
