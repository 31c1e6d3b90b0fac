"""Delinquency of a loan at a snapshot."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def installments_missed(overdue: Column, due: Column) -> Column:
    """How many installments the overdue amount covers, begun ones included; null without a due amount."""
    return F.ceil(F.try_divide(overdue, due)).cast("int")


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    """The snapshot moved back by the missed months, clamped to the month's end; null if none is missed."""
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(snapshot: Column, first_missed: Column, overdue: Column) -> Column:
    """Days since the first missed installment.

    0 if nothing is overdue; null if something is overdue but no due amount tells since when.
    """
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0))


def default_label(dpd: Column, threshold: int) -> Column:
    """1 from the threshold on, else 0; unknown days past due count as no default."""
    return F.coalesce((dpd >= threshold).cast("int"), F.lit(0))
