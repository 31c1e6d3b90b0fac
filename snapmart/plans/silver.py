"""Silver: typed, cleaned rows. Every function takes all snapshots of a bronze table at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions.cleaning import blank_to_null, clean_age, clean_number, typed
from snapmart.operators.loans import with_days_past_due, with_missed_installments
from snapmart.operators.outliers import below_fences, fence_row
from snapmart.operators.rows import enforce_schema, typed_columns, within_bounds, without_sentinels
from snapmart.operators.sketches import quantile_state
from snapmart.schemas import (
    AGE_RANGE,
    ATTRIBUTE_SENTINELS,
    ATTRIBUTES,
    CLICKSTREAM,
    DECIMAL_COMMA_COLUMNS,
    FENCED_COLUMNS,
    FINANCIAL_NUMBERS,
    FINANCIAL_SENTINELS,
    FINANCIALS,
    LMS,
    PII_COLUMNS,
    PROFILE_FENCED_COLUMNS,
    SNAPSHOT,
    STATIC_BOUNDS,
    TOKEN_COLUMN,
    TWO_DECIMAL_COLUMNS,
    dataset,
)


def silver_clickstream(bronze: DataFrame, strict: bool = False) -> DataFrame:
    return enforce_schema(bronze, CLICKSTREAM.typed_schema, strict)


def silver_attributes(
    bronze: DataFrame, strict: bool = False, drop_pii: Sequence[str] = PII_COLUMNS
) -> DataFrame:
    """Known SSN and occupation, a plausible age, personal data dropped."""
    known = without_sentinels(bronze, ATTRIBUTE_SENTINELS)
    cleaned = known.select(
        *[
            (
                clean_age(F.col(name), strict)
                if name == "Age"
                else typed(F.col(name), dtype, strict)
            ).alias(name)
            for name, dtype in ATTRIBUTES.columns
            if name not in drop_pii
        ]
    )
    return within_bounds(cleaned, {"Age": AGE_RANGE})


def financial_columns(strict: bool = False, blank_loans_to_null: bool = True) -> dict[str, Column]:
    """The cleaning expression of each financials column."""
    columns = {}
    for name, dtype in FINANCIALS.columns:
        value = F.col(name)
        if name in FINANCIAL_NUMBERS:
            value = clean_number(
                value,
                dtype,
                decimal_comma=name in DECIMAL_COMMA_COLUMNS,
                decimals=2 if name in TWO_DECIMAL_COLUMNS else None,
                strict=strict,
            )
        elif name == TOKEN_COLUMN and blank_loans_to_null:
            value = blank_to_null(value)
        else:
            value = typed(value, dtype, strict)
        columns[name] = value
    return columns


def clean_financials(
    bronze: DataFrame, strict: bool = False, blank_loans_to_null: bool = True
) -> DataFrame:
    """Typed financials with known categories and a balance, before any outlier is cut."""
    columns = financial_columns(strict, blank_loans_to_null)
    return (
        without_sentinels(bronze, FINANCIAL_SENTINELS)
        .select(*[column.alias(name) for name, column in columns.items()])
        .where(F.col("Monthly_Balance").isNotNull())
    )


def silver_financials(
    bronze: DataFrame,
    strict: bool = False,
    fence_scope: str = "snapshot",
    fence_columns: Sequence[str] = FENCED_COLUMNS,
    exact_fences: bool = False,
    bounds: Mapping[str, tuple[float, float]] | None = None,
    blank_loans_to_null: bool = True,
    fences: DataFrame | None = None,
) -> DataFrame:
    """Cleaned financials below their fences, taken per snapshot or over the whole table.

    `bounds` cuts at fixed ranges as well, as the reviewed export does. `fences` are those of `financial_fences`,
    if they are stored.
    """
    scopes = {"snapshot": (SNAPSHOT,), "global": ()}
    if fence_scope not in scopes:
        raise ValueError(f"unknown fence scope {fence_scope!r}, expected one of {sorted(scopes)}")
    cleaned = clean_financials(bronze, strict, blank_loans_to_null)
    fenced = below_fences(cleaned, fence_columns, scopes[fence_scope], exact=exact_fences, fences=fences)
    return within_bounds(fenced, bounds) if bounds else fenced


def financial_fences(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """The fences of every snapshot, one row each."""
    return fence_row(clean_financials(bronze, strict), FENCED_COLUMNS)


def financial_state(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """The quantile state of every snapshot and fenced column, from which fences of any months together follow."""
    columns = list(dict.fromkeys([*FENCED_COLUMNS, *PROFILE_FENCED_COLUMNS]))
    return quantile_state(clean_financials(bronze, strict), columns, [SNAPSHOT])


def reviewed_export(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Financials below exact pooled fences and inside the reviewed ranges, blank loan lists left as they are."""
    return silver_financials(
        bronze,
        strict,
        fence_scope="global",
        fence_columns=PROFILE_FENCED_COLUMNS,
        exact_fences=True,
        bounds=STATIC_BOUNDS,
        blank_loans_to_null=False,
    )


def cleaning_steps(name: str) -> dict[str, Column]:
    """What each filter of a dataset asks of a bronze row, in order; the fences of financials come after them."""
    if name == "attributes":
        known = {column: F.col(column) != text for column, text in ATTRIBUTE_SENTINELS.items()}
        return {**known, "Age": clean_age(F.col("Age")).between(*AGE_RANGE)}
    if name == "financials":
        known = {column: F.col(column) != text for column, text in FINANCIAL_SENTINELS.items()}
        return {**known, "Monthly_Balance": financial_columns()["Monthly_Balance"].isNotNull()}
    return {}


def cleaning_columns(name: str) -> dict[str, Column]:
    """The lenient cleaning of each column of a dataset that can refuse a text."""
    if name == "attributes":
        return {"Age": clean_age(F.col("Age"))}
    return financial_columns() if name == "financials" else typed_columns(dataset(name).typed_schema)


def silver_lms(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Typed installments with months on book, missed installments and days past due."""
    typed_rows = enforce_schema(bronze, LMS.typed_schema, strict)
    return with_days_past_due(with_missed_installments(typed_rows))


SILVER_JOBS = {
    "clickstream": silver_clickstream,
    "attributes": silver_attributes,
    "financials": silver_financials,
    "lms": silver_lms,
}


def build_silver(name: str, bronze: DataFrame, strict: bool = False) -> DataFrame:
    return SILVER_JOBS[dataset(name).name](bronze, strict=strict)
