"""Delinquency columns and the default label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions.delinquency import (
    days_past_due,
    default_label,
    first_missed_date,
    installments_missed,
)
from snapmart.schemas import DEFAULT_DPD, DEFAULT_MOB, SNAPSHOT


def with_missed_installments(df: DataFrame) -> DataFrame:
    """Add months on book and missed installments, then set every null number of the row to 0.

    The division sees the nulls and the later steps do not: a null due or overdue amount means that
    nothing is missed, and counts as 0 from here on.
    """
    return df.withColumns(
        {
            "mob": F.col("installment_num").cast("int"),
            "installments_missed": installments_missed(F.col("overdue_amt"), F.col("due_amt")),
        }
    ).fillna(0)


def with_days_past_due(df: DataFrame) -> DataFrame:
    missed = df.withColumn(
        "first_missed_date", first_missed_date(F.col(SNAPSHOT), F.col("installments_missed"))
    )
    return missed.withColumn(
        "dpd", days_past_due(F.col(SNAPSHOT), F.col("first_missed_date"), F.col("overdue_amt"))
    )


def label_store(df: DataFrame, dpd: int = DEFAULT_DPD, mob: int = DEFAULT_MOB) -> DataFrame:
    """The default label of every loan at one age, with the definition it follows."""
    return df.where(F.col("mob") == mob).select(
        "loan_id",
        "Customer_ID",
        default_label(F.col("dpd"), dpd).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        SNAPSHOT,
    )
