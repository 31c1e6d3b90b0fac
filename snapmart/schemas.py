"""Dataset declarations and the fixed values that the cleaning rules use."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, INT, FLOAT, DATE = T.StringType(), T.IntegerType(), T.FloatType(), T.DateType()

SNAPSHOT = "snapshot_date"
CUSTOMER_KEYS = ["Customer_ID", SNAPSHOT]


@dataclass(frozen=True)
class DatasetSpec:
    """One source: its columns with their silver types and the date pattern of the raw text."""

    name: str
    date_format: str
    columns: tuple[tuple[str, T.DataType], ...]

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def bronze_schema(self) -> T.StructType:
        """Text as delivered; only the snapshot date is parsed, because the table is partitioned by it."""
        return T.StructType(
            [T.StructField(name, DATE if name == SNAPSHOT else STRING) for name in self.column_names]
        )

    @property
    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, dtype) for name, dtype in self.columns])


# Column names, types and date patterns of the four sources.
CLICKSTREAM = DatasetSpec(
    "clickstream",
    "dd/MM/yyyy",
    (*((f"fe_{i}", INT) for i in range(1, 21)), ("Customer_ID", STRING), (SNAPSHOT, DATE)),
)
ATTRIBUTES = DatasetSpec(
    "attributes",
    "dd/MM/yyyy",
    (
        ("Customer_ID", STRING),
        ("Name", STRING),
        ("Age", INT),
        ("SSN", STRING),
        ("Occupation", STRING),
        (SNAPSHOT, DATE),
    ),
)
FINANCIALS = DatasetSpec(
    "financials",
    "dd/MM/yyyy",
    (
        ("Customer_ID", STRING),
        ("Annual_Income", FLOAT),
        ("Monthly_Inhand_Salary", FLOAT),
        ("Num_Bank_Accounts", INT),
        ("Num_Credit_Card", INT),
        ("Interest_Rate", INT),
        ("Num_of_Loan", INT),
        ("Type_of_Loan", STRING),
        ("Delay_from_due_date", INT),
        ("Num_of_Delayed_Payment", INT),
        ("Changed_Credit_Limit", FLOAT),
        ("Num_Credit_Inquiries", INT),
        ("Credit_Mix", STRING),
        ("Outstanding_Debt", FLOAT),
        ("Credit_Utilization_Ratio", FLOAT),
        ("Credit_History_Age", STRING),
        ("Payment_of_Min_Amount", STRING),
        ("Total_EMI_per_month", FLOAT),
        ("Amount_invested_monthly", FLOAT),
        ("Payment_Behaviour", STRING),
        ("Monthly_Balance", FLOAT),
        (SNAPSHOT, DATE),
    ),
)
LMS = DatasetSpec(
    "lms",
    "yyyy-MM-dd",
    (
        ("loan_id", STRING),
        ("Customer_ID", STRING),
        ("loan_start_date", DATE),
        ("tenure", INT),
        ("installment_num", INT),
        ("loan_amt", FLOAT),
        ("due_amt", FLOAT),
        ("paid_amt", FLOAT),
        ("overdue_amt", FLOAT),
        ("balance", FLOAT),
        (SNAPSHOT, DATE),
    ),
)

DATASETS = {spec.name: spec for spec in (CLICKSTREAM, ATTRIBUTES, FINANCIALS, LMS)}


def dataset(name: str) -> DatasetSpec:
    if name not in DATASETS:
        raise ValueError(f"unknown dataset {name!r}, expected one of {sorted(DATASETS)}")
    return DATASETS[name]


# Texts that stand for "unknown" in the sources; a row that has one is dropped.
ATTRIBUTE_SENTINELS = {"SSN": "#F%$D@*&8", "Occupation": "_______"}
FINANCIAL_SENTINELS = {"Changed_Credit_Limit": "_", "Credit_Mix": "_", "Payment_Behaviour": "!@9#%8"}

# Accepted ages, inclusive.
AGE_RANGE = (18, 70)

# Columns written with a decimal comma, and columns rounded to two decimals.
DECIMAL_COMMA_COLUMNS = (
    "Monthly_Inhand_Salary",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Monthly_Balance",
)
TWO_DECIMAL_COLUMNS = ("Annual_Income", "Changed_Credit_Limit")

# Columns cut at their upper Tukey fence in the datamart; profiling adds the interest rate.
FENCED_COLUMNS = (
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Outstanding_Debt",
    "Num_Credit_Inquiries",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
)
PROFILE_FENCED_COLUMNS = (*FENCED_COLUMNS, "Interest_Rate")

# Inclusive bounds of the exported, manually reviewed financials.
STATIC_BOUNDS = {
    "Num_Bank_Accounts": (0, 10),
    "Num_Credit_Card": (0, 10),
    "Interest_Rate": (0, 34),
    "Num_of_Loan": (0, 9),
    "Delay_from_due_date": (0, 55),
    "Num_of_Delayed_Payment": (0, 25),
    "Changed_Credit_Limit": (0, 30),
    "Outstanding_Debt": (0, 4500),
    "Num_Credit_Inquiries": (0, 18),
    "Total_EMI_per_month": (0, 370),
    "Amount_invested_monthly": (0, 420),
}

FINANCIAL_NUMBERS = tuple(name for name, dtype in FINANCIALS.columns if dtype in (INT, FLOAT))

# Personal data dropped in silver, columns that leak the target, categories and lists to encode.
PII_COLUMNS = ("SSN",)
LEAKAGE_COLUMNS = ("Interest_Rate",)
ONE_HOT_COLUMNS = {
    "occupations": "Occupation",
    "credit_mixes": "Credit_Mix",
    "payment_behaviours": "Payment_Behaviour",
}
TOKEN_KIND, TOKEN_COLUMN = "loan_types", "Type_of_Loan"

# A default is 30 days past due at the sixth month on book.
DEFAULT_DPD, DEFAULT_MOB = 30, 6

LMS_DERIVED = (("mob", INT), ("installments_missed", INT), ("first_missed_date", DATE), ("dpd", INT))


def _without(spec: DatasetSpec, dropped: tuple[str, ...]) -> T.StructType:
    return T.StructType([field for field in spec.typed_schema if field.name not in dropped])


def silver_schema(name: str, drop_pii: tuple[str, ...] = PII_COLUMNS) -> T.StructType:
    spec = dataset(name)
    if spec is ATTRIBUTES:
        return _without(spec, drop_pii)
    if spec is LMS:
        return T.StructType([*spec.typed_schema, *(T.StructField(n, t) for n, t in LMS_DERIVED)])
    return spec.typed_schema
