"""One query per operator and job, each over whole tables.

The datamart keeps money in 32-bit floats; results are widened to doubles and rounded here so that
equal values have equal text in both engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import table, view
from snapmart.functions import cleaning
from snapmart.functions.dates import month_sequence
from snapmart.operators import counts, distributions, features, loans, outliers, quality, rows
from snapmart.plans import bronze, gold, profiling, silver
from snapmart.schemas import (
    AGE_RANGE,
    ATTRIBUTE_SENTINELS,
    CLICKSTREAM,
    FENCED_COLUMNS,
    FINANCIAL_NUMBERS,
    FINANCIAL_SENTINELS,
    LMS,
    ONE_HOT_COLUMNS,
    PROFILE_FENCED_COLUMNS,
    SNAPSHOT,
)
from snapmart.sources.snapshots import read_snapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame, digits: int = 4) -> DataFrame:
    """Floats and doubles as rounded doubles."""
    return df.select(
        *[
            F.round(F.col(name).cast("double"), digits).alias(name) if dtype in ("float", "double") else F.col(name)
            for name, dtype in df.dtypes
        ]
    )


def attributes_raw(spark, sf):
    return view(spark, sf, "attributes_raw")


def financials_raw(spark, sf):
    return view(spark, sf, "financials_raw")


def lms_raw(spark, sf):
    return view(spark, sf, "lms_raw")


def clickstream_raw(spark, sf):
    return view(spark, sf, "clickstream_raw")


def clean_financials(spark, sf):
    return silver.clean_financials(financials_raw(spark, sf))


def lms_silver(spark, sf):
    return silver.silver_lms(lms_raw(spark, sf))


def customer(spark, sf):
    fenced = silver.silver_financials(financials_raw(spark, sf))
    return gold.gold_customer(silver.silver_attributes(attributes_raw(spark, sf)), fenced)


# Scans and snapshots


@query
def scan_snapshot(spark, sf):
    path = f"{sf}/orders.parquet"
    days = read_snapshots(spark, path, [date(1995, 3, 1)], column="o_orderdate")
    return days.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query
def scan_all_snapshots(spark, sf):
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    return counts.counts_by(read_snapshots(spark, f"{sf}/orders.parquet").withColumn(SNAPSHOT, month), SNAPSHOT)


@query
def bronze_snapshot_slice(spark, sf):
    snapshots = [date(2023, 1, 1), date(2023, 7, 1), date(2024, 12, 1)]
    raw = attributes_raw(spark, sf).withColumn(SNAPSHOT, F.date_format(SNAPSHOT, "dd/MM/yyyy"))
    return bronze.build_bronze(raw, silver.ATTRIBUTES, snapshots)


@query
def date_spine(spark, sf):
    day = F.col("o_orderdate").cast("date")
    orders = table(spark, sf, "orders").select(day.alias(SNAPSHOT))
    ends = orders.agg(F.min(SNAPSHOT).alias("start"), F.max(SNAPSHOT).alias("end"))
    spine = ends.select(F.explode(month_sequence(F.col("start"), F.col("end"))).alias(SNAPSHOT))
    on_day = orders.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("orders"))
    return spine.join(on_day, SNAPSHOT, "left").fillna(0)


@query
def parse_snapshot_date(spark, sf):
    text = F.date_format(F.col("ts"), "dd/MM/yyyy")
    text = F.when(F.col("event_type") == "click", F.concat(text, F.lit("x"))).otherwise(text)
    events = table(spark, sf, "events").select("event_id", text.alias("text"))
    return events.select("event_id", cleaning.parse_date(F.col("text"), "dd/MM/yyyy").alias(SNAPSHOT))


# Filters, cleaning, typing


@query
def sentinel_filter(spark, sf):
    return rows.without_sentinels(attributes_raw(spark, sf), ATTRIBUTE_SENTINELS)


@query
def pii_drop(spark, sf):
    return silver.silver_attributes(attributes_raw(spark, sf), drop_pii=("SSN", "Name"))


@query
def age_range(spark, sf):
    aged = attributes_raw(spark, sf).withColumn("Age", cleaning.clean_age(F.col("Age")))
    return rows.within_bounds(aged, {"Age": AGE_RANGE}).select("Customer_ID", "Age")


@query
def clean_age(spark, sf):
    return attributes_raw(spark, sf).select("Customer_ID", cleaning.clean_age(F.col("Age")).alias("Age"))


@query
def clean_num(spark, sf):
    numbers = silver.financial_columns()
    picked = ["Monthly_Inhand_Salary", "Num_of_Loan", "Outstanding_Debt", "Amount_invested_monthly", "Monthly_Balance"]
    return plain(financials_raw(spark, sf).select("Customer_ID", *[numbers[name].alias(name) for name in picked]))


@query
def clean_num_round(spark, sf):
    numbers = silver.financial_columns()
    raw = rows.without_sentinels(financials_raw(spark, sf), FINANCIAL_SENTINELS)
    picked = ["Annual_Income", "Changed_Credit_Limit"]
    return plain(raw.select("Customer_ID", *[numbers[name].alias(name) for name in picked]))


@query
def blank_to_null(spark, sf):
    loans_text = cleaning.blank_to_null(F.col("Type_of_Loan"))
    return financials_raw(spark, sf).select("Customer_ID", loans_text.alias("Type_of_Loan"))


@query
def not_null_filter(spark, sf):
    return plain(clean_financials(spark, sf).select("Customer_ID", "Monthly_Balance"))


@query
def extract_numeric(spark, sf):
    names = ["Annual_Income", "Num_of_Loan", "Outstanding_Debt", "Amount_invested_monthly"]
    numbers = [cleaning.extract_number(F.col(name)).alias(name) for name in names]
    return plain(financials_raw(spark, sf).select("Customer_ID", *numbers))


@query
def enforce_schema(spark, sf):
    return plain(rows.enforce_schema(lms_raw(spark, sf), LMS.typed_schema))


@query
def rejected_values(spark, sf):
    return quality.rejected_values(financials_raw(spark, sf), silver.financial_columns())


@query
def static_bounds(spark, sf):
    return plain(silver.reviewed_export(financials_raw(spark, sf)))


@query
def fill_numeric_nulls(spark, sf):
    typed = rows.enforce_schema(lms_raw(spark, sf), LMS.typed_schema)
    return plain(typed.fillna(0).select("loan_id", "installment_num", "due_amt", "overdue_amt", SNAPSHOT))


# Outliers


@query
def tukey_fences(spark, sf):
    return plain(outliers.upper_fences(clean_financials(spark, sf), FENCED_COLUMNS))


@query
def fence_filter(spark, sf):
    kept = outliers.below_fences(clean_financials(spark, sf), FENCED_COLUMNS)
    return plain(kept.select("Customer_ID", SNAPSHOT, *FENCED_COLUMNS))


@query
def fence_filter_global(spark, sf):
    kept = outliers.below_fences(clean_financials(spark, sf), PROFILE_FENCED_COLUMNS, by=(), exact=True)
    return plain(kept.select("Customer_ID", SNAPSHOT, *PROFILE_FENCED_COLUMNS))


@query
def order_price_fences(spark, sf):
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias(SNAPSHOT)
    orders = table(spark, sf, "orders").select(month, "o_totalprice")
    return plain(outliers.upper_fences(orders, ["o_totalprice"]))


# Silver


@query
def silver_clickstream(spark, sf):
    return silver.silver_clickstream(clickstream_raw(spark, sf))


@query
def silver_attributes(spark, sf):
    return silver.silver_attributes(attributes_raw(spark, sf))


@query
def silver_financials(spark, sf):
    return plain(silver.silver_financials(financials_raw(spark, sf)))


@query
def silver_lms(spark, sf):
    return plain(lms_silver(spark, sf))


@query
def installments_missed(spark, sf):
    typed = rows.enforce_schema(lms_raw(spark, sf), LMS.typed_schema)
    return counts.counts_by(loans.with_missed_installments(typed), "installments_missed")


@query
def first_missed_date(spark, sf):
    return lms_silver(spark, sf).groupBy(SNAPSHOT, "first_missed_date").count()


@query
def days_past_due(spark, sf):
    return lms_silver(spark, sf).groupBy("mob", "installments_missed", "dpd").count()


# Gold


@query
def gold_clickstream(spark, sf):
    return gold.gold_clickstream(silver.silver_clickstream(clickstream_raw(spark, sf)))


@query
def customer_feature_join(spark, sf):
    return plain(customer(spark, sf))


@query
def vocabulary_table(spark, sf):
    return features.vocabulary_table(customer(spark, sf))


@query
def engineered_customer(spark, sf):
    joined = customer(spark, sf)
    return plain(features.engineer_features(joined, features.build_vocabulary(joined)))


@query
def one_hot_features(spark, sf):
    joined = customer(spark, sf)
    indicators = features.one_hot(features.build_vocabulary(joined))
    return joined.select("Customer_ID", *[column.alias(name) for name, column in indicators.items()])


@query
def token_count_features(spark, sf):
    joined = customer(spark, sf)
    found = features.token_counts(features.build_vocabulary(joined), F.col("tokens"))
    tokens = features.list_tokens(F.col("Type_of_Loan")).alias("tokens")
    return joined.select("Customer_ID", tokens).select(
        "Customer_ID", *[column.alias(name) for name, column in found.items()]
    )


@query
def label_store(spark, sf):
    return loans.label_store(lms_silver(spark, sf))


@query
def label_distribution(spark, sf):
    return plain(counts.label_shares(loans.label_store(lms_silver(spark, sf))))


@query
def default_rate_by_snapshot(spark, sf):
    return counts.default_rates(loans.label_store(lms_silver(spark, sf)))


# Tokens and vocabulary


@query
def loan_type_tokens(spark, sf):
    tokens = F.posexplode(features.list_tokens(F.col("Type_of_Loan"))).alias("position", "token")
    return financials_raw(spark, sf).select("Customer_ID", tokens)


@query
def token_vocabulary(spark, sf):
    return features.distinct_tokens(financials_raw(spark, sf))


@query
def token_value_counts(spark, sf):
    return features.token_value_counts(financials_raw(spark, sf))


@query
def category_vocabulary(spark, sf):
    joined = silver.silver_attributes(attributes_raw(spark, sf)).join(
        clean_financials(spark, sf), ["Customer_ID", SNAPSHOT]
    )
    return features.distinct_values(joined, list(ONE_HOT_COLUMNS.values()))


# Counts and quality


@query
def cleaning_audit(spark, sf):
    raw = financials_raw(spark, sf)
    balance = silver.financial_columns()["Monthly_Balance"]
    steps = {
        "credit_limit": F.col("Changed_Credit_Limit") != FINANCIAL_SENTINELS["Changed_Credit_Limit"],
        "credit_mix": F.col("Credit_Mix") != FINANCIAL_SENTINELS["Credit_Mix"],
        "behaviour": F.col("Payment_Behaviour") != FINANCIAL_SENTINELS["Payment_Behaviour"],
        "balance": balance.isNotNull(),
    }
    return quality.step_audit(raw, steps, [SNAPSHOT])


@query
def null_profile(spark, sf):
    columns = silver.financial_columns()
    typed = financials_raw(spark, sf).select(*[c.alias(name) for name, c in columns.items()])
    return quality.null_profile(typed, [SNAPSHOT])


@query
def null_report(spark, sf):
    columns = silver.financial_columns()
    typed = financials_raw(spark, sf).select(*[c.alias(name) for name, c in columns.items()])
    return quality.null_report(typed)


@query
def column_info(spark, sf):
    return quality.column_info(clean_financials(spark, sf))


@query
def dirty_counts(spark, sf):
    age = cleaning.clean_age(F.col("Age"))
    conditions = {
        "bad_ssn": F.col("SSN") == ATTRIBUTE_SENTINELS["SSN"],
        "bad_occupation": F.col("Occupation") == ATTRIBUTE_SENTINELS["Occupation"],
        "underscore_age": F.col("Age").rlike("_"),
        "age_above": age > AGE_RANGE[1],
        "age_below": age < AGE_RANGE[0],
        "age_inside": age.between(*AGE_RANGE),
    }
    return quality.count_matching(attributes_raw(spark, sf), conditions)


@query
def null_consistency(spark, sf):
    without = clean_financials(spark, sf).where(F.col("Type_of_Loan").isNull())
    return counts.counts_by(without, "Num_of_Loan")


@query
def value_counts(spark, sf):
    return counts.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query
def column_value_counts(spark, sf):
    names = ["Credit_Mix", "Payment_Behaviour", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate"]
    return counts.column_value_counts(clean_financials(spark, sf), names)


@query
def top_values(spark, sf):
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    picked = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return counts.top_values(picked, order, 20)


@query
def rows_per_snapshot(spark, sf):
    return counts.counts_by(lms_raw(spark, sf), SNAPSHOT)


@query
def installment_distribution(spark, sf):
    return counts.counts_by(rows.enforce_schema(lms_raw(spark, sf), LMS.typed_schema), "installment_num")


@query
def distinct_keys(spark, sf):
    return counts.distinct_keys(lms_raw(spark, sf), ["loan_id", "Customer_ID"])


@query
def dedupe_by_key(spark, sf):
    loan_rows = rows.enforce_schema(lms_raw(spark, sf), LMS.typed_schema).select(
        "loan_id", "loan_amt", "installment_num", "Customer_ID", SNAPSHOT, "balance"
    )
    order = [SNAPSHOT, "installment_num", "Customer_ID", "loan_amt", "balance"]
    return plain(counts.one_per_key(loan_rows, "loan_id", order))


# Distributions


@query
def median_by_column(spark, sf):
    lines = table(spark, sf, "lineitem")
    return plain(distributions.medians(lines, ["l_quantity", "l_extendedprice", "l_discount"]))


@query
def describe_table(spark, sf):
    lines = table(spark, sf, "lineitem")
    return plain(distributions.describe_table(lines, ["l_linenumber", "l_quantity", "l_extendedprice"]))


@query
def summary_stats(spark, sf):
    orders = table(spark, sf, "orders")
    return plain(distributions.summary_stats(orders, ["o_totalprice"]))


@query
def financial_summary(spark, sf):
    return plain(distributions.summary_stats(clean_financials(spark, sf), FINANCIAL_NUMBERS))


@query
def iqr_report(spark, sf):
    numbers = [cleaning.coerce_number(F.col(name)).alias(name) for name in FINANCIAL_NUMBERS]
    return plain(distributions.iqr_report(financials_raw(spark, sf).select(*numbers), FINANCIAL_NUMBERS))


@query
def boxplot_stats(spark, sf):
    lines = table(spark, sf, "lineitem")
    return plain(distributions.boxplot_stats(lines, ["l_extendedprice", "l_quantity"]))


@query
def histogram(spark, sf):
    return plain(distributions.histogram(table(spark, sf, "orders"), "o_totalprice", 50))


@query
def dpd_histogram(spark, sf):
    at_age = lms_silver(spark, sf).where("mob = 6")
    return plain(distributions.histogram(at_age, "dpd", 60, threshold=30))


@query
def integer_histogram(spark, sf):
    return distributions.integer_histogram(clean_financials(spark, sf), "Delay_from_due_date", dense=True)


@query
def kernel_density(spark, sf):
    density = distributions.kernel_density(table(spark, sf, "orders"), "o_totalprice")
    scaled = density.withColumn("density", F.col("density") * 1_000_000)
    return plain(scaled)


@query
def profile_table(spark, sf):
    return plain(profiling.profile_table(clean_financials(spark, sf), ["Customer_ID"]))


@query
def profile_table_lms(spark, sf):
    typed = rows.enforce_schema(lms_raw(spark, sf), LMS.typed_schema)
    return plain(profiling.profile_table(typed, ["loan_id", "Customer_ID"]))


@query
def profile_table_clickstream(spark, sf):
    typed = rows.enforce_schema(clickstream_raw(spark, sf), CLICKSTREAM.typed_schema)
    return plain(profiling.profile_table(typed, ["Customer_ID"]))
