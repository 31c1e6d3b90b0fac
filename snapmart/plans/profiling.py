"""Profiles of the four datasets, as tables of numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions.cleaning import clean_age, coerce_number
from snapmart.operators import counts, distributions, features, loans, outliers, quality, rows
from snapmart.operators.quantiles import exact_quantiles, stack_columns
from snapmart.plans.silver import clean_financials, financial_columns, silver_attributes, silver_lms
from snapmart.schemas import (
    AGE_RANGE,
    ATTRIBUTE_SENTINELS,
    CLICKSTREAM,
    DEFAULT_DPD,
    DEFAULT_MOB,
    FINANCIAL_NUMBERS,
    LMS,
    PROFILE_FENCED_COLUMNS,
    SNAPSHOT,
)

# Bins of the histograms, and the columns whose density is estimated.
BINS, DPD_BINS = 50, 60
DENSITY_COLUMNS = (
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
)

Reports = dict[str, DataFrame]


def profile_table(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`column`, `metric`, `value`: rows and nulls of every column, moments and quartiles of the numbers,
    distinct values of the keys."""
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    facts = [F.struct(*_facts(name, name in numbers)).alias(name) for name in df.columns]
    described = _metrics(stack_columns(df.agg(*facts), df.columns))
    parts = [described.where(F.col("metric").isin("rows", "nulls") | F.col("column").isin(numbers))]
    if keys:
        distinct = [F.struct(F.count_distinct(key).alias("distinct")).alias(key) for key in keys]
        parts.append(_metrics(stack_columns(df.agg(*distinct), keys)))
    if numbers:
        quartiles = exact_quantiles(df, numbers, [0.25, 0.5, 0.75])
        named = [
            F.struct(*[F.col(name)[i].alias(p) for i, p in enumerate(["p25", "p50", "p75"])]).alias(name)
            for name in numbers
        ]
        parts.append(_metrics(stack_columns(quartiles.select(*named), numbers)))
    return reduce(DataFrame.unionByName, parts)


def _facts(name: str, is_number: bool) -> list[Column]:
    value = distributions.number(name) if is_number else F.lit(None).cast("double")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(name).isNull()).alias("nulls"),
        F.mean(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def _metrics(table: DataFrame) -> DataFrame:
    names = [name for name in table.columns if name != "column"]
    doubles = table.select("column", *[F.col(name).cast("double").alias(name) for name in names])
    return doubles.unpivot(["column"], names, "metric", "value")


def profile_clickstream(bronze: DataFrame) -> Reports:
    typed = rows.enforce_schema(bronze, CLICKSTREAM.typed_schema)
    features_only = [name for name in typed.columns if name.startswith("fe_")]
    return {
        "columns": quality.column_info(bronze),
        "nulls": quality.null_profile(bronze),
        "rejected": quality.rejected_values(bronze, rows.typed_columns(CLICKSTREAM.typed_schema)),
        "describe": distributions.describe_table(typed, features_only),
        "rows_per_snapshot": counts.counts_by(bronze, SNAPSHOT),
    }


def profile_attributes(bronze: DataFrame) -> Reports:
    """Dirt before cleaning, then age and uniqueness after it."""
    known = rows.without_sentinels(bronze, ATTRIBUTE_SENTINELS)
    aged = known.withColumn("Age", clean_age(F.col("Age")))
    age = F.col("Age")
    sentinels = {f"bad_{name}": F.col(name) == text for name, text in ATTRIBUTE_SENTINELS.items()}
    sentinels["underscored_Age"] = F.col("Age").cast("string").contains("_")
    ages = {
        "above": age > AGE_RANGE[1],
        "below": age < AGE_RANGE[0],
        "inside": age.between(*AGE_RANGE),
    }
    return {
        "columns": quality.column_info(bronze),
        "nulls": quality.null_profile(bronze),
        "occupations": counts.value_counts(bronze, "Occupation"),
        "sentinels": quality.count_matching(bronze, sentinels),
        "sentinels_left": quality.count_matching(
            silver_attributes(bronze), {name: sentinels[name] for name in ("bad_Occupation", "underscored_Age")}
        ),
        "rejected": quality.rejected_values(bronze, {"Age": clean_age(F.col("Age"))}),
        "distinct_customers": counts.distinct_keys(known, ["Customer_ID"]),
        "age": distributions.summary_stats(aged, ["Age"]),
        "age_histogram": distributions.histogram(aged, "Age", BINS),
        "age_range": quality.count_matching(aged, ages),
    }


def profile_lms(bronze: DataFrame, dpd: int = DEFAULT_DPD, mob: int = DEFAULT_MOB) -> Reports:
    typed = rows.enforce_schema(bronze, LMS.typed_schema)
    amounts = [field.name for field in typed.schema if isinstance(field.dataType, T.NumericType)]
    silver = silver_lms(bronze)
    at_age = silver.where(F.col("mob") == mob)
    labels = loans.label_store(silver, dpd, mob)
    per_loan = counts.one_per_key(typed.select("loan_id", SNAPSHOT, "loan_amt"), "loan_id", [SNAPSHOT, "loan_amt"])
    unknown_dpd = {"overdue_without_due": (F.col("overdue_amt") > 0) & F.col("dpd").isNull()}
    return {
        "columns": quality.column_info(bronze),
        "nulls": quality.null_profile(bronze),
        "rejected": quality.rejected_values(bronze, rows.typed_columns(LMS.typed_schema)),
        "describe": distributions.describe_table(typed, amounts),
        "rows_per_snapshot": counts.counts_by(bronze, SNAPSHOT),
        "distinct": counts.distinct_keys(bronze, ["loan_id", "Customer_ID"]),
        "installments": counts.counts_by(typed, "installment_num"),
        "loan_amounts": distributions.histogram(per_loan, "loan_amt", BINS),
        "loan_amount_median": distributions.medians(per_loan, ["loan_amt"]),
        "unknown_dpd": quality.count_matching(silver, unknown_dpd),
        "dpd": distributions.summary_stats(silver, ["dpd"]),
        "dpd_histogram": distributions.histogram(silver, "dpd", DPD_BINS),
        "dpd_at_age": distributions.histogram(at_age, "dpd", DPD_BINS, threshold=dpd),
        "labels": counts.label_shares(labels),
        "default_rates": counts.default_rates(labels),
    }


def profile_financials(bronze: DataFrame) -> Reports:
    """The raw numbers as they are, then the cleaned ones and their pooled fences."""
    coerced = bronze.select(*[coerce_number(F.col(name)).alias(name) for name in FINANCIAL_NUMBERS])
    cleaned = clean_financials(bronze)
    numbers = list(FINANCIAL_NUMBERS)
    quartiles = distributions.quartile_row(cleaned, numbers)
    reports = {
        "columns": quality.column_info(bronze),
        "nulls": quality.null_profile(bronze),
        "rejected": quality.rejected_values(bronze, financial_columns()),
        "categories": counts.column_value_counts(bronze, ["Credit_Mix", "Payment_Behaviour"]),
        "loan_types": features.token_value_counts(bronze),
        "raw_summary": distributions.describe_table(coerced, numbers),
        "iqr": distributions.iqr_report(coerced, numbers),
        "values": counts.column_value_counts(cleaned, numbers),
        "summary": distributions.summary_stats(cleaned, numbers, quartiles),
        "boxplots": distributions.boxplot_stats(cleaned, numbers, quartiles),
        "delay_histogram": distributions.integer_histogram(cleaned, "Delay_from_due_date"),
        "fences": outliers.upper_fences(cleaned, PROFILE_FENCED_COLUMNS, by=()),
        "no_loan_list": counts.counts_by(cleaned.where(F.col("Type_of_Loan").isNull()), "Num_of_Loan"),
    }
    histograms, densities = distributions.curves(cleaned, DENSITY_COLUMNS, BINS)
    for name in DENSITY_COLUMNS:
        own = F.col("column") == name
        reports[f"histogram_{name}"] = histograms.where(own).drop("column").orderBy("bin")
        reports[f"density_{name}"] = densities.where(own).drop("column").orderBy("point")
    return reports


def profile_customer(customer: DataFrame) -> Reports:
    """What the customer join left: nulls per snapshot, and the loan counts where the loan list is missing."""
    return {
        "columns": quality.column_info(customer),
        "rows_per_snapshot": counts.counts_by(customer, SNAPSHOT),
        "nulls": quality.null_report(customer, [SNAPSHOT]),
        "no_loan_list": counts.counts_by(customer.where(F.col("Type_of_Loan").isNull()), "Num_of_Loan"),
    }


#: Layer and table that each profile reads.
PROFILES = {
    "clickstream": ("bronze", "clickstream", profile_clickstream),
    "attributes": ("bronze", "attributes", profile_attributes),
    "financials": ("bronze", "financials", profile_financials),
    "lms": ("bronze", "lms", profile_lms),
    "customer": ("gold", "feature_store_customer", profile_customer),
}
