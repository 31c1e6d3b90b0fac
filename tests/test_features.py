from datetime import date

import pytest
from pyspark.sql import functions as F

from snapmart.operators import features
from snapmart.operators.features import Vocabulary
from snapmart.plans.gold import gold_customer
from tests.conftest import rows

JAN, FEB = date(2023, 1, 1), date(2023, 2, 1)


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [
            ("1", "Lawyer", "Good", "Low", "Auto Loan, Auto Loan, and Credit-Builder Loan", 5),
            ("2", None, "Bad", "Low", None, 6),
            ("3", "Media Manager", None, "High", "Auto Loan", 7),
        ],
        "Customer_ID string, Occupation string, Credit_Mix string, Payment_Behaviour string, "
        "Type_of_Loan string, Interest_Rate int",
    )


def test_vocabulary_is_sorted_and_without_nulls(customers):
    assert features.build_vocabulary(customers).values == {
        "occupations": ("Lawyer", "Media Manager"),
        "credit_mixes": ("Bad", "Good"),
        "payment_behaviours": ("High", "Low"),
        "loan_types": ("Auto Loan", "Credit-Builder Loan"),
    }


def test_vocabulary_survives_its_table(spark, customers):
    vocabulary = features.build_vocabulary(customers)
    assert features.read_vocabulary(vocabulary.to_table(spark)) == vocabulary


def test_a_vocabulary_of_any_size(spark, customers):
    job = F.concat(F.lit("Job "), F.lpad(F.col("id").cast("string"), 5, "0"))
    many = spark.range(1001).select(F.col("id").cast("string").alias("Customer_ID"), job.alias("Occupation"))
    many = many.unionByName(customers, allowMissingColumns=True)
    engineered = features.engineer_features(many, features.build_vocabulary(many))
    assert sum(name.startswith("Occupation_") for name in engineered.columns) == 1003
    assert engineered.where("Customer_ID = '1000'").first()["Occupation_Job_01000"] == 1


def test_engineered_columns(customers):
    engineered = features.engineer_features(customers, features.build_vocabulary(customers))
    assert engineered.columns == [
        "Customer_ID",
        "Occupation_Lawyer",
        "Occupation_Media_Manager",
        "Credit_Mix_Bad",
        "Credit_Mix_Good",
        "Payment_Behaviour_High",
        "Payment_Behaviour_Low",
        "auto_loan_type",
        "credit_builder_loan_type",
    ]
    assert {kind for _, kind in engineered.dtypes[1:]} == {"int"}
    assert rows(engineered.orderBy("Customer_ID")) == [
        ("1", 1, 0, 0, 1, 0, 1, 2, 1),
        ("2", 0, 0, 1, 0, 0, 1, 0, 0),
        ("3", 0, 1, 0, 0, 1, 0, 1, 0),
    ]


def test_unseen_values_have_no_indicator(customers):
    vocabulary = Vocabulary(
        {"occupations": ("Doctor",), "credit_mixes": (), "payment_behaviours": (), "loan_types": ("Payday Loan",)}
    )
    assert set(rows(features.engineer_features(customers, vocabulary).drop("Customer_ID"))) == {(0, 0)}


def test_colliding_names_are_refused(customers):
    vocabulary = Vocabulary(
        {"occupations": ("A B", "A-B"), "credit_mixes": (), "payment_behaviours": (), "loan_types": ()}
    )
    with pytest.raises(ValueError, match="Occupation_A_B"):
        features.engineer_features(customers, vocabulary)


def test_distinct_values(customers):
    found = features.distinct_values(customers, ["Occupation", "Credit_Mix"])
    assert rows(found) == [
        ("Credit_Mix", "Bad"),
        ("Credit_Mix", "Good"),
        ("Occupation", "Lawyer"),
        ("Occupation", "Media Manager"),
    ]


def test_customer_join_needs_the_same_snapshot(spark):
    left = spark.createDataFrame([("1", JAN, "a"), ("1", FEB, "b"), ("2", JAN, "c")], "Customer_ID string, snapshot_date date, x string")
    right = spark.createDataFrame([("1", JAN, 1), ("2", FEB, 2), ("1", FEB, 3)], "Customer_ID string, snapshot_date date, y int")
    joined = gold_customer(left, right)
    assert joined.columns == ["Customer_ID", "snapshot_date", "x", "y"]
    assert sorted(rows(joined)) == [("1", JAN, "a", 1), ("1", FEB, "b", 3)]
