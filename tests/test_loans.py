from datetime import date

import pytest
from pyspark.sql import functions as F

from snapmart.functions.delinquency import first_missed_date
from snapmart.operators import loans
from snapmart.plans.silver import silver_lms
from snapmart.schemas import LMS, SNAPSHOT
from tests.conftest import rows

JUL = date(2023, 7, 1)


def lms(spark, cases):
    """Text rows with the given installment number, due and overdue amounts."""
    texts = [
        (str(i), "CUS_1", "2023-01-01", "10", mob, "1000", due, "0", overdue, None, JUL)
        for i, (mob, due, overdue) in enumerate(cases)
    ]
    schema = ", ".join(f"{n} {'date' if n == SNAPSHOT else 'string'}" for n in LMS.column_names)
    return spark.createDataFrame(texts, schema)


@pytest.fixture(scope="module")
def silver(spark):
    cases = [
        ("6", "100", "0"),
        ("6", "100", "100"),
        ("6", "100", "250"),
        ("6", "0", "50"),
        ("6", "100", None),
        ("6", None, "50"),
        ("5", "100", "100"),
        ("6.0", "100", "-5"),
    ]
    return silver_lms(lms(spark, cases)).persist()


def test_delinquency_columns(silver):
    picked = silver.orderBy("loan_id").select("mob", "installments_missed", "first_missed_date", "dpd")
    assert rows(picked) == [
        (6, 0, None, 0),
        (6, 1, date(2023, 6, 1), 30),
        (6, 3, date(2023, 4, 1), 91),
        (6, 0, None, None),
        (6, 0, None, 0),
        (6, 0, None, None),
        (5, 1, date(2023, 6, 1), 30),
        (6, 0, None, 0),
    ]


def test_null_numbers_become_zero_but_text_and_dates_stay_null(silver):
    row = silver.where("loan_id = '4'").first()
    assert row.overdue_amt == 0.0 and row.balance == 0.0
    assert row.first_missed_date is None
    assert silver.where("loan_id = '5'").first().due_amt == 0.0


def test_types(silver):
    assert dict(silver.dtypes)["due_amt"] == "float"
    assert [dict(silver.dtypes)[n] for n in ("mob", "installments_missed", "first_missed_date", "dpd")] == [
        "int", "int", "date", "int",
    ]


def test_label_store(silver):
    labels = loans.label_store(silver).orderBy("loan_id")
    assert labels.columns == ["loan_id", "Customer_ID", "label", "label_def", SNAPSHOT]
    assert [(r.loan_id, r.label, r.label_def) for r in labels.collect()] == [
        ("0", 0, "30dpd_6mob"),
        ("1", 1, "30dpd_6mob"),
        ("2", 1, "30dpd_6mob"),
        ("3", 0, "30dpd_6mob"),
        ("4", 0, "30dpd_6mob"),
        ("5", 0, "30dpd_6mob"),
        ("7", 0, "30dpd_6mob"),
    ]
    other = loans.label_store(silver, dpd=31, mob=5)
    assert [(r.loan_id, r.label, r.label_def) for r in other.collect()] == [("6", 0, "31dpd_5mob")]


def test_month_end_is_clamped(spark):
    df = spark.createDataFrame([(date(2024, 3, 31), 1), (date(2024, 3, 31), 0)], "s date, n int")
    assert rows(df.select(first_missed_date(F.col("s"), F.col("n")))) == [(date(2024, 2, 29),), (None,)]
