"""Gold: feature stores and the label store."""

from __future__ import annotations

from pyspark.sql import DataFrame

from snapmart.schemas import CUSTOMER_KEYS, silver_schema


def gold_clickstream(silver: DataFrame) -> DataFrame:
    """The clickstream features as they are."""
    return silver.select(*silver_schema("clickstream").names)


def gold_customer(attributes: DataFrame, financials: DataFrame) -> DataFrame:
    """Attributes and financials of the customers that both silver tables kept, at the same snapshot.

    No hint: neither side has a size bound. The planner broadcasts a side it knows to be small, and
    adaptive execution splits the partition of a customer with very many rows.
    """
    return attributes.join(financials, on=CUSTOMER_KEYS, how="inner")
