import random

from pyspark.sql import functions as F

from snapmart.functions import tokens
from snapmart.operators import features


def strip_one_and(token):
    return token[4:] if token.startswith("and ") else token


def expected_list(text):
    return [strip_one_and(token.strip(" ")) for token in (text or "").split(",")]


def expected_loose(text):
    return [token.strip().lower() for token in text.replace("and ", "").split(",")]


def some_texts():
    random.seed(3)
    pieces = ["and ", "and", " ", "  ", ",", ", ", "Auto Loan", "Brand X", "Land ", "a", "AND ", "-", "\t", "\n"]
    texts = ["".join(random.choices(pieces, k=random.randint(0, 9))) for _ in range(2000)]
    return [*texts, "", " ", ",", "and ", " and ,", "and and x", "A, B, and C", "and  x", "x and ", "a,\n"]


def test_list_tokens_against_plain_python(spark):
    texts = [*some_texts(), None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tokens.list_tokens(F.col("t")).alias("k"))
    wrong = [(r.t, r.k, expected_list(r.t)) for r in df.collect() if r.k != expected_list(r.t)]
    assert wrong == []


def test_loose_tokens_against_plain_python(spark):
    df = spark.createDataFrame([(t,) for t in some_texts()], "t string")
    df = df.select("t", tokens.loose_tokens(F.col("t")).alias("k"))
    wrong = [(r.t, r.k, expected_loose(r.t)) for r in df.collect() if r.k != expected_loose(r.t)]
    assert wrong == []


def test_null_lists(spark):
    df = spark.createDataFrame([(None,), ("Auto Loan, and Payday Loan",), (" ",)], "Type_of_Loan string")
    assert [r.token for r in features.distinct_tokens(df).collect()] == ["Auto Loan", "Payday Loan"]
    assert [tuple(r) for r in features.token_value_counts(df).collect()] == [
        ("", 1),
        ("auto loan", 1),
        ("payday loan", 1),
    ]


def test_count_token(spark):
    df = spark.createDataFrame([("Auto Loan, Auto Loan, and Auto Loan",), (None,), ("auto loan",)], "t string")
    counts = [r[0] for r in df.select(tokens.count_token(tokens.list_tokens(F.col("t")), "Auto Loan")).collect()]
    assert counts == [3, 0, 0]


def test_safe_name():
    assert tokens.safe_name("Credit-Builder Loan, Other") == "Credit_Builder_Loan_Other"
