"""The same results in plain SQL, for DuckDB over the same tables."""

from __future__ import annotations

from checks.views import view_sql
# Columns, types and ranges, written out here so that a wrong list in the package shows.
INT, FLOAT, DATE, STRING = "int", "float", "date", "string"
CLICKSTREAM = {f"fe_{i}": INT for i in range(1, 21)} | {"Customer_ID": STRING, "snapshot_date": DATE}
LMS = {
    "loan_id": STRING, "Customer_ID": STRING, "loan_start_date": DATE, "tenure": INT, "installment_num": INT,
    "loan_amt": FLOAT, "due_amt": FLOAT, "paid_amt": FLOAT, "overdue_amt": FLOAT, "balance": FLOAT,
    "snapshot_date": DATE,
}
FINANCIALS = {
    "Customer_ID": STRING, "Annual_Income": FLOAT, "Monthly_Inhand_Salary": FLOAT, "Num_Bank_Accounts": INT,
    "Num_Credit_Card": INT, "Interest_Rate": INT, "Num_of_Loan": INT, "Type_of_Loan": STRING,
    "Delay_from_due_date": INT, "Num_of_Delayed_Payment": INT, "Changed_Credit_Limit": FLOAT,
    "Num_Credit_Inquiries": INT, "Credit_Mix": STRING, "Outstanding_Debt": FLOAT, "Credit_Utilization_Ratio": FLOAT,
    "Credit_History_Age": STRING, "Payment_of_Min_Amount": STRING, "Total_EMI_per_month": FLOAT,
    "Amount_invested_monthly": FLOAT, "Payment_Behaviour": STRING, "Monthly_Balance": FLOAT, "snapshot_date": DATE,
}
FINANCIAL_NUMBERS = [name for name, dtype in FINANCIALS.items() if dtype in (INT, FLOAT)]
DECIMAL_COMMA_COLUMNS = ["Monthly_Inhand_Salary", "Credit_Utilization_Ratio", "Total_EMI_per_month", "Monthly_Balance"]
TWO_DECIMAL_COLUMNS = ["Annual_Income", "Changed_Credit_Limit"]
FENCED_COLUMNS = [
    "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment",
    "Changed_Credit_Limit", "Outstanding_Debt", "Num_Credit_Inquiries", "Total_EMI_per_month", "Amount_invested_monthly",
]
PROFILE_FENCED_COLUMNS = [*FENCED_COLUMNS, "Interest_Rate"]
STATIC_BOUNDS = {
    "Num_Bank_Accounts": (0, 10), "Num_Credit_Card": (0, 10), "Interest_Rate": (0, 34), "Num_of_Loan": (0, 9),
    "Delay_from_due_date": (0, 55), "Num_of_Delayed_Payment": (0, 25), "Changed_Credit_Limit": (0, 30),
    "Outstanding_Debt": (0, 4500), "Num_Credit_Inquiries": (0, 18), "Total_EMI_per_month": (0, 370),
    "Amount_invested_monthly": (0, 420),
}

# The categories and loan types that the views write.
VOCABULARY = {
    "occupations": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "credit_mixes": ["Bad", "Good", "Standard"],
    "payment_behaviours": ["High_spent_Large_value_payments", "Low_spent_Small_value_payments"],
    "loan_types": ["Auto Loan", "Credit-Builder Loan", "Home Equity Loan", "Not Specified"],
}
CATEGORY_COLUMNS = {
    "occupations": "Occupation",
    "credit_mixes": "Credit_Mix",
    "payment_behaviours": "Payment_Behaviour",
}
SQL_TYPES = {"int": "integer", "float": "float", "date": "date", "string": "varchar"}

LOAN_TOKENS = (
    "list_transform(string_split(coalesce(Type_of_Loan, ''), ','), "
    "lambda x: regexp_replace(trim(x, ' '), '^and ', ''))"
)


def cast_of(name: str, dtype) -> str:
    return f"try_cast({name} as {SQL_TYPES[dtype]})"


def rounded(name: str, dtype=FLOAT, digits: int = 4) -> str:
    return f"round(cast({name} as double), {digits}) as {name}" if dtype == FLOAT else name


def clean_expression(name: str, dtype) -> str:
    if name not in FINANCIAL_NUMBERS:
        return cast_of(name, dtype)
    text = f"replace({name}, '_', '')"
    if name in DECIMAL_COMMA_COLUMNS:
        text = f"replace({text}, ',', '.')"
    number = cast_of(f"nullif({text}, '')", dtype)
    if name in TWO_DECIMAL_COLUMNS:
        number = f"cast(round(cast({number} as double), 2) as float)"
    return number


def clean_columns(blank_loans_to_null: bool = True) -> dict[str, str]:
    columns = {name: clean_expression(name, dtype) for name, dtype in FINANCIALS.items()}
    if blank_loans_to_null:
        columns["Type_of_Loan"] = "case when trim(Type_of_Loan, ' ') <> '' then Type_of_Loan end"
    return columns


def select_list(columns: dict[str, str]) -> str:
    return ",\n  ".join(f"{sql} as {name}" for name, sql in columns.items())


def typed_view(view: str, spec) -> str:
    return f"select {select_list({n: cast_of(n, t) for n, t in spec.items()})} from {view}"


def clean_financials(blank_loans_to_null: bool = True) -> str:
    return f"""
select * from (
  select {select_list(clean_columns(blank_loans_to_null))}
  from financials_raw
  where Changed_Credit_Limit <> '_' and Credit_Mix <> '_' and Payment_Behaviour <> '!@9#%8')
where Monthly_Balance is not null"""


def fences(columns, by: str) -> str:
    """One row per group with a fence for each column."""
    parts = []
    for name in columns:
        q1, q3 = (f"quantile_disc(cast({name} as double), {p})" for p in (0.25, 0.75))
        parts.append(f"{q3} + 1.5 * ({q3} - {q1}) as {name}_fence")
    keys = f"{by}, " if by else ""
    group = f" group by {by}" if by else ""
    return f"select {keys}{', '.join(parts)} from fin_clean{group}"


def below(columns) -> str:
    return " and ".join(f"f.{name} between 0 and {name}_fence" for name in columns)


CTES = {
    "attributes_raw": view_sql("attributes_raw"),
    "financials_raw": view_sql("financials_raw"),
    "lms_raw": view_sql("lms_raw"),
    "clickstream_raw": view_sql("clickstream_raw"),
    "attributes_silver": """
select * from (
  select Customer_ID, Name, try_cast(regexp_replace(Age, '[^0-9-]', '', 'g') as integer) as Age,
    Occupation, snapshot_date
  from attributes_raw where SSN <> '#F%$D@*&8' and Occupation <> '_______')
where Age between 18 and 70""",
    "fin_clean": clean_financials(),
    "fin_blank": clean_financials(blank_loans_to_null=False),
    "fin_fences": fences(FENCED_COLUMNS, "snapshot_date"),
    "fin_fences_global": fences(PROFILE_FENCED_COLUMNS, ""),
    "fin_silver": f"""
select f.* from fin_clean f join fin_fences using (snapshot_date) where {below(FENCED_COLUMNS)}""",
    "lms_typed": typed_view("lms_raw", LMS),
    "lms_filled": """
select loan_id, Customer_ID, loan_start_date, coalesce(tenure, 0) as tenure,
  coalesce(installment_num, 0) as installment_num, coalesce(loan_amt, 0) as loan_amt,
  coalesce(due_amt, 0) as due_amt, coalesce(paid_amt, 0) as paid_amt,
  coalesce(overdue_amt, 0) as overdue_amt, coalesce(balance, 0) as balance, snapshot_date,
  coalesce(installment_num, 0) as mob,
  coalesce(cast(ceil(cast(overdue_amt as double) / nullif(cast(due_amt as double), 0)) as integer), 0)
    as installments_missed
from lms_typed""",
    "lms_missed": """
select *, case when installments_missed > 0
  then cast(snapshot_date - to_months(installments_missed) as date) end as first_missed_date
from lms_filled""",
    "lms_silver": """
select *, case when overdue_amt > 0 then cast(date_diff('day', first_missed_date, snapshot_date) as integer)
  else 0 end as dpd
from lms_missed""",
    "labels_at_age": """
select loan_id, Customer_ID, case when dpd >= 30 then 1 else 0 end as label, '30dpd_6mob' as label_def,
  snapshot_date
from lms_silver where mob = 6""",
    "customer_gold": """
select * from attributes_silver join fin_silver using (Customer_ID, snapshot_date)""",
}

NEEDS = {
    "attributes_silver": ["attributes_raw"],
    "fin_clean": ["financials_raw"],
    "fin_blank": ["financials_raw"],
    "fin_fences": ["fin_clean"],
    "fin_fences_global": ["fin_clean"],
    "fin_silver": ["fin_fences"],
    "lms_typed": ["lms_raw"],
    "lms_filled": ["lms_typed"],
    "lms_missed": ["lms_filled"],
    "lms_silver": ["lms_missed"],
    "labels_at_age": ["lms_silver"],
    "customer_gold": ["attributes_silver", "fin_silver"],
}


def with_ctes(names: list[str], body: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "with " + ",\n".join(f"{name} as ({CTES[name]})" for name in order) + "\n" + body


def all_columns(spec, prefix: str = "", skip=()) -> str:
    return ", ".join(rounded(f"{prefix}{name}", dtype) for name, dtype in spec.items() if name not in skip)


def customer_columns(skip=()) -> list[str]:
    names = ["Customer_ID", "snapshot_date", "Name", "Age", "Occupation"]
    columns = [name for name in names if name not in skip]
    for name, dtype in FINANCIALS.items():
        if name not in names and name not in skip:
            columns.append(rounded(name, dtype))
    return columns


def safe(value: str) -> str:
    return value.replace(" ", "_").replace("-", "_")


def indicator_columns() -> list[str]:
    return [
        f"case when {column} = '{value}' then 1 else 0 end as \"{column}_{safe(value)}\""
        for kind, column in CATEGORY_COLUMNS.items()
        for value in VOCABULARY[kind]
    ]


def token_columns() -> list[str]:
    return [
        f"cast(len(list_filter({LOAN_TOKENS}, lambda x: x = '{value}')) as integer) as {safe(value).lower()}_type"
        for value in VOCABULARY["loan_types"]
    ]


def vocabulary_rows() -> str:
    parts = [
        f"select '{kind}' as kind, {column} as value from customer_gold where {column} is not null"
        for kind, column in CATEGORY_COLUMNS.items()
    ]
    parts.append(
        f"select 'loan_types' as kind, t as value from (select unnest({LOAN_TOKENS}) as t from customer_gold) where t <> ''"
    )
    return f"""
select kind, value, cast(row_number() over (partition by kind order by value) - 1 as integer) as position
from ({' union '.join(parts)})"""


def summary_sql(source: str, name: str, quartiles: bool = True) -> str:
    v = f"cast({name} as double)"
    extra = (
        "".join(f", round(quantile_cont({v}, {p}), 4) as p{int(100 * p)}" for p in (0.25, 0.5, 0.75))
        if quartiles
        else ""
    )
    return f"""select '{name}' as "column", count({name}) as n, round(avg({v}), 4) as mean,
  round(stddev_samp({v}), 4) as stddev, round(min({v}), 4) as min{extra}, round(max({v}), 4) as max from {source}"""


def union(parts) -> str:
    return "\nunion all\n".join(parts)


def iqr_sql(source: str, name: str) -> str:
    q1, q2, q3 = (f"(select quantile_cont(v, {p}) from x)" for p in (0.25, 0.5, 0.75))
    low, high = f"{q1} - 1.5 * ({q3} - {q1})", f"{q3} + 1.5 * ({q3} - {q1})"
    outside = f"count(*) filter (where v < {low} or v > {high})"
    return f"""(with x as (select try_cast({name} as double) as v from {source})
select '{name}' as "column", round(min(v), 4) as min, round({q1}, 4) as q1, round({q2}, 4) as median,
  round({q3}, 4) as q3, round(max(v), 4) as max, round({q3} - {q1}, 4) as iqr,
  round({low}, 4) as lower_bound, round({high}, 4) as upper_bound, {outside} as n_outliers,
  round(100 * {outside} / nullif(count(v), 0), 2) as pct_outliers from x)"""


def boxplot_sql(source: str, name: str) -> str:
    q1, q2, q3 = (f"(select quantile_cont(v, {p}) from x)" for p in (0.25, 0.5, 0.75))
    low, high = f"{q1} - 1.5 * ({q3} - {q1})", f"{q3} + 1.5 * ({q3} - {q1})"
    return f"""(with x as (select cast({name} as double) as v from {source})
select '{name}' as "column", round({q1}, 4) as q1, round({q2}, 4) as median, round({q3}, 4) as q3,
  round(least(min(v) filter (where v >= {low}), {q1}), 4) as whisker_low,
  round(greatest(max(v) filter (where v <= {high}), {q3}), 4) as whisker_high,
  count(*) filter (where v < {low} or v > {high}) as fliers from x)"""


def histogram_sql(value: str, source: str, bins: int, threshold: float | None = None) -> str:
    extra = f", count(v) filter (where v >= {threshold}) as n_at_or_above" if threshold is not None else ""
    return f"""
select b.bin, round(b.lower, 4) as lower, round(b.upper, 4) as upper, count(v) as n{extra}
from (
  select cast(i as integer) as bin, lo + i * ((hi - lo) / {bins}) as lower,
    case when i = {bins - 1} then hi else lo + (i + 1) * ((hi - lo) / {bins}) end as upper, hi
  from range({bins}) r(i), (select min(cast({value} as double)) as lo, max(cast({value} as double)) as hi from {source})
) b left join (select cast({value} as double) as v from {source}) d
  on v >= b.lower and (v < b.upper or (b.bin = {bins - 1} and v <= b.upper))
group by b.bin, b.lower, b.upper"""


def metric_rows(source: str, columns, keys) -> str:
    parts = []
    for name, dtype in columns:
        v = f"cast({name} as double)"
        metrics = {
            "rows": "count(*)",
            "nulls": f"count(*) - count({name})",
        }
        if name in keys:
            metrics["distinct"] = f"count(distinct {name})"
        if dtype in (INT, FLOAT):
            metrics |= {
                "mean": f"avg({v})",
                "stddev": f"stddev_samp({v})",
                "min": f"min({v})",
                "p25": f"quantile_cont({v}, 0.25)",
                "p50": f"quantile_cont({v}, 0.5)",
                "p75": f"quantile_cont({v}, 0.75)",
                "max": f"max({v})",
            }
        for metric, sql in metrics.items():
            parts.append(
                f"select '{name}' as \"column\", '{metric}' as metric, round(cast({sql} as double), 4) as value from {source}"
            )
    return union(parts)


def count_of(source: str, keys: str, where: str = "") -> str:
    return f"select {keys}, count(*) as count from {source} {where} group by {keys}"


def columns_of(typed, names=None) -> dict[str, str]:
    return {name: sql for name, sql in typed.items() if names is None or name in names}


def oracle() -> dict[str, str]:
    clean = clean_columns()
    raw_numbers = ["Monthly_Inhand_Salary", "Num_of_Loan", "Outstanding_Debt", "Amount_invested_monthly", "Monthly_Balance"]
    extracted = ["Annual_Income", "Num_of_Loan", "Outstanding_Debt", "Amount_invested_monthly"]
    types = FINANCIALS
    sql: dict[str, str] = {}

    sql["scan_snapshot"] = """
select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders where o_orderdate = timestamp '1995-03-01'"""
    sql["scan_all_snapshots"] = """
select cast(date_trunc('month', o_orderdate) as date) as snapshot_date, count(*) as count from orders group by 1"""
    sql["bronze_snapshot_slice"] = with_ctes(
        ["attributes_raw"],
        "select * from attributes_raw where snapshot_date in (date '2023-01-01', date '2023-07-01', date '2024-12-01')",
    )
    sql["date_spine"] = """
with o as (select cast(o_orderdate as date) as d from orders),
spine as (select cast(unnest(generate_series(date_trunc('month', min(d)), cast(max(d) as timestamp), interval 1 month)) as date) as d from o)
select spine.d as snapshot_date, count(o.d) as orders from spine left join o on o.d = spine.d group by 1"""
    sql["parse_snapshot_date"] = """
select event_id, case when event_type = 'click' then null else cast(ts as date) end as snapshot_date from events"""

    sql["sentinel_filter"] = with_ctes(
        ["attributes_raw"], "select * from attributes_raw where SSN <> '#F%$D@*&8' and Occupation <> '_______'"
    )
    sql["pii_drop"] = with_ctes(
        ["attributes_silver"], "select Customer_ID, Age, Occupation, snapshot_date from attributes_silver"
    )
    age = "try_cast(regexp_replace(Age, '[^0-9-]', '', 'g') as integer)"
    sql["age_range"] = with_ctes(
        ["attributes_raw"], f"select Customer_ID, {age} as Age from attributes_raw where {age} between 18 and 70"
    )
    sql["clean_age"] = with_ctes(["attributes_raw"], f"select Customer_ID, {age} as Age from attributes_raw")
    numbers = {n: f"round(cast({clean[n]} as double), 4)" if types[n] == FLOAT else clean[n] for n in clean}
    sql["clean_num"] = with_ctes(
        ["financials_raw"],
        f"select Customer_ID, {select_list(columns_of(numbers, raw_numbers))} from financials_raw",
    )
    sql["clean_num_round"] = with_ctes(
        ["financials_raw"],
        f"""select Customer_ID, {select_list(columns_of(numbers, TWO_DECIMAL_COLUMNS))} from financials_raw
where Changed_Credit_Limit <> '_' and Credit_Mix <> '_' and Payment_Behaviour <> '!@9#%8'""",
    )
    sql["blank_to_null"] = with_ctes(
        ["financials_raw"], f"select Customer_ID, {clean['Type_of_Loan']} as Type_of_Loan from financials_raw"
    )
    sql["not_null_filter"] = with_ctes(
        ["fin_clean"], f"select Customer_ID, {rounded('Monthly_Balance')} from fin_clean"
    )
    numeric = {n: f"round(try_cast(regexp_replace({n}, '[^0-9.-]', '', 'g') as double), 4)" for n in extracted}
    sql["extract_numeric"] = with_ctes(
        ["financials_raw"], f"select Customer_ID, {select_list(numeric)} from financials_raw"
    )
    sql["enforce_schema"] = with_ctes(["lms_typed"], f"select {all_columns(LMS)} from lms_typed")
    sql["rejected_values"] = with_ctes(
        ["financials_raw"],
        union(
            f"select '{n}' as \"column\", count(*) filter (where {n} is not null and {clean[n]} is null) as rejected from financials_raw"
            for n in clean
        ),
    )
    bounds = " and ".join(f"f.{n} between {low} and {high}" for n, (low, high) in STATIC_BOUNDS.items())
    sql["static_bounds"] = with_ctes(
        ["fin_blank", "fin_fences_global"],
        f"""select {all_columns(FINANCIALS)} from (
  select f.* from fin_blank f, fin_fences_global where {below(PROFILE_FENCED_COLUMNS)} and {bounds})""",
    )
    sql["fill_numeric_nulls"] = with_ctes(
        ["lms_filled"],
        f"select loan_id, installment_num, {rounded('due_amt')}, {rounded('overdue_amt')}, snapshot_date from lms_filled",
    )

    def fence_rows(source: str, name: str, by: str) -> str:
        v = f"cast({name} as double)"
        q1, q3 = f"quantile_disc({v}, 0.25)", f"quantile_disc({v}, 0.75)"
        return f"""select {by} as snapshot_date, '{name}' as "column", round({q1}, 4) as q1, round({q3}, 4) as q3,
  round({q3} + 1.5 * ({q3} - {q1}), 4) as upper_fence from {source} group by 1 having count({name}) > 0"""

    sql["tukey_fences"] = with_ctes(
        ["fin_clean"], union(fence_rows("fin_clean", name, "snapshot_date") for name in FENCED_COLUMNS)
    )
    sql["order_price_fences"] = fence_rows("orders", "o_totalprice", "cast(date_trunc('month', o_orderdate) as date)")
    fenced = ", ".join(rounded(n, types[n]) for n in FENCED_COLUMNS)
    sql["fence_filter"] = with_ctes(["fin_silver"], f"select Customer_ID, snapshot_date, {fenced} from fin_silver")
    fenced_all = ", ".join(rounded(n, types[n]) for n in PROFILE_FENCED_COLUMNS)
    sql["fence_filter_global"] = with_ctes(
        ["fin_clean", "fin_fences_global"],
        f"""select Customer_ID, snapshot_date, {fenced_all} from (
  select f.* from fin_clean f, fin_fences_global where {below(PROFILE_FENCED_COLUMNS)})""",
    )

    clickstream = with_ctes(["clickstream_raw"], typed_view("clickstream_raw", CLICKSTREAM))
    sql["silver_clickstream"] = clickstream
    sql["gold_clickstream"] = clickstream
    sql["silver_attributes"] = with_ctes(["attributes_silver"], "select * from attributes_silver")
    sql["silver_financials"] = with_ctes(["fin_silver"], f"select {all_columns(FINANCIALS)} from fin_silver")
    sql["silver_lms"] = with_ctes(
        ["lms_silver"],
        f"select {all_columns(LMS)}, mob, installments_missed, first_missed_date, dpd from lms_silver",
    )
    sql["installments_missed"] = with_ctes(["lms_filled"], count_of("lms_filled", "installments_missed"))
    sql["first_missed_date"] = with_ctes(["lms_missed"], count_of("lms_missed", "snapshot_date, first_missed_date"))
    sql["days_past_due"] = with_ctes(["lms_silver"], count_of("lms_silver", "mob, installments_missed, dpd"))

    sql["customer_feature_join"] = with_ctes(
        ["customer_gold"], f"select {', '.join(customer_columns())} from customer_gold"
    )
    sql["vocabulary_table"] = with_ctes(["customer_gold"], vocabulary_rows())
    dropped = ["Interest_Rate", "Type_of_Loan", *CATEGORY_COLUMNS.values()]
    engineered = customer_columns(skip=dropped) + indicator_columns() + token_columns()
    sql["engineered_customer"] = with_ctes(["customer_gold"], f"select {', '.join(engineered)} from customer_gold")
    sql["one_hot_features"] = with_ctes(
        ["customer_gold"], f"select Customer_ID, {', '.join(indicator_columns())} from customer_gold"
    )
    sql["token_count_features"] = with_ctes(
        ["customer_gold"], f"select Customer_ID, {', '.join(token_columns())} from customer_gold"
    )
    sql["label_store"] = with_ctes(["labels_at_age"], "select * from labels_at_age")
    sql["label_distribution"] = with_ctes(
        ["labels_at_age"],
        """select label, count(*) as count, round(count(*) * 100.0e0 / (select count(*) from labels_at_age), 4) as pct
from labels_at_age group by label""",
    )
    sql["default_rate_by_snapshot"] = with_ctes(
        ["labels_at_age"],
        """select snapshot_date, count(*) as total, cast(sum(label) as bigint) as defaults,
  round(cast(sum(label) as double) / count(*) * 100, 2) as default_rate
from labels_at_age group by snapshot_date""",
    )

    sql["loan_type_tokens"] = with_ctes(
        ["financials_raw"],
        f"""select Customer_ID, cast(i - 1 as integer) as position, tokens[i] as token from (
  select Customer_ID, tokens, unnest(range(1, len(tokens) + 1)) as i from (
    select Customer_ID, {LOAN_TOKENS} as tokens from financials_raw))""",
    )
    sql["token_vocabulary"] = with_ctes(
        ["financials_raw"],
        f"select distinct token from (select unnest({LOAN_TOKENS}) as token from financials_raw) where token <> ''",
    )
    sql["token_value_counts"] = with_ctes(
        ["financials_raw"],
        """select token, count(*) as count from (
  select lower(trim(unnest(string_split(replace(Type_of_Loan, 'and ', ''), ',')))) as token
  from financials_raw where Type_of_Loan is not null) group by token""",
    )
    sql["category_vocabulary"] = with_ctes(
        ["attributes_silver", "fin_clean"],
        " union ".join(
            f"select '{c}' as \"column\", {c} as value from attributes_silver "
            f"join fin_clean using (Customer_ID, snapshot_date) where {c} is not null"
            for c in CATEGORY_COLUMNS.values()
        ),
    )

    steps = ["Changed_Credit_Limit <> '_'", "Credit_Mix <> '_'", "Payment_Behaviour <> '!@9#%8'",
             f"{clean['Monthly_Balance']} is not null"]
    audited = [
        f"count(*) filter (where {' and '.join(steps[: i + 1])}) as after_{name}"
        for i, name in enumerate(["credit_limit", "credit_mix", "behaviour", "balance"])
    ]
    sql["cleaning_audit"] = with_ctes(
        ["financials_raw"],
        f"select snapshot_date, count(*) as rows_read, {', '.join(audited)} from financials_raw group by snapshot_date",
    )
    value_columns = [n for n, _ in FINANCIALS.items() if n != "snapshot_date"]
    sql["null_profile"] = with_ctes(
        ["financials_raw"],
        "select snapshot_date, "
        + ", ".join(f"count(*) filter (where {clean[n]} is null) as {n}" for n in value_columns)
        + " from financials_raw group by snapshot_date",
    )
    sql["null_report"] = with_ctes(
        ["financials_raw"],
        "select * from ("
        + union(
            f"select '{n}' as \"column\", count(*) filter (where {clean[n]} is null) as nulls from financials_raw"
            for n in clean
        )
        + ") where nulls > 0",
    )
    sql["column_info"] = with_ctes(
        ["fin_clean"],
        union(
            f"select '{n}' as \"column\", '{t}' as dtype, count({n}) as non_null from fin_clean"
            for n, t in FINANCIALS.items()
        ),
    )
    sql["dirty_counts"] = with_ctes(
        ["attributes_raw"],
        f"""select count(*) filter (where SSN = '#F%$D@*&8') as bad_ssn,
  count(*) filter (where Occupation = '_______') as bad_occupation,
  count(*) filter (where contains(Age, '_')) as underscore_age,
  count(*) filter (where {age} > 70) as age_above, count(*) filter (where {age} < 18) as age_below,
  count(*) filter (where {age} between 18 and 70) as age_inside from attributes_raw""",
    )
    sql["null_consistency"] = with_ctes(
        ["fin_clean"], count_of("fin_clean", "Num_of_Loan", "where Type_of_Loan is null")
    )
    sql["value_counts"] = count_of("orders", "o_orderpriority")
    counted = ["Credit_Mix", "Payment_Behaviour", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate"]
    sql["column_value_counts"] = with_ctes(
        ["fin_clean"],
        union(
            f"select '{n}' as \"column\", cast({n} as varchar) as value, count(*) as count from fin_clean group by {n}"
            for n in counted
        ),
    )
    sql["top_values"] = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem
order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_suppkey limit 20"""
    sql["rows_per_snapshot"] = with_ctes(["lms_raw"], count_of("lms_raw", "snapshot_date"))
    sql["installment_distribution"] = with_ctes(["lms_typed"], count_of("lms_typed", "installment_num"))
    sql["distinct_keys"] = with_ctes(
        ["lms_raw"],
        """select count(*) as rows, count(distinct loan_id) as distinct_loan_id,
  count(distinct Customer_ID) as "distinct_Customer_ID" from lms_raw""",
    )
    sql["dedupe_by_key"] = with_ctes(
        ["lms_typed"],
        f"""select loan_id, {rounded('loan_amt')}, installment_num, Customer_ID, snapshot_date, {rounded('balance')} from (
  select *, row_number() over (partition by loan_id
    order by snapshot_date, installment_num, Customer_ID, loan_amt, balance) as rn from lms_typed) where rn = 1""",
    )

    sql["median_by_column"] = union(
        f"select '{n}' as \"column\", round(quantile_cont(cast({n} as double), 0.5), 4) as median from lineitem"
        for n in ["l_quantity", "l_extendedprice", "l_discount"]
    )
    sql["describe_table"] = union(
        summary_sql("lineitem", n, quartiles=False) for n in ["l_linenumber", "l_quantity", "l_extendedprice"]
    )
    sql["summary_stats"] = summary_sql("orders", "o_totalprice")
    sql["financial_summary"] = with_ctes(["fin_clean"], union(summary_sql("fin_clean", n) for n in FINANCIAL_NUMBERS))
    sql["iqr_report"] = with_ctes(["financials_raw"], union(iqr_sql("financials_raw", n) for n in FINANCIAL_NUMBERS))
    sql["boxplot_stats"] = union(boxplot_sql("lineitem", n) for n in ["l_extendedprice", "l_quantity"])
    sql["histogram"] = histogram_sql("o_totalprice", "orders", 50)
    sql["dpd_histogram"] = with_ctes(
        ["lms_silver"],
        "select * from (" + histogram_sql("dpd", "(select dpd from lms_silver where mob = 6)", 60, 30) + ")",
    )
    sql["integer_histogram"] = with_ctes(
        ["fin_clean"],
        """select v as value, count(Delay_from_due_date) as n from (
  select unnest(range(min(Delay_from_due_date), max(Delay_from_due_date) + 1)) as v from fin_clean) s
left join fin_clean on Delay_from_due_date = v group by v""",
    )
    sql["kernel_density"] = """
with d as (select o_totalprice as v, count(*) as c from orders group by 1),
s as (select cast(count(o_totalprice) as double) as n, min(o_totalprice) as lo, max(o_totalprice) as hi,
  stddev_samp(o_totalprice) * pow(count(o_totalprice), -0.2e0) as h from orders),
g as (select i, lo + i * ((hi - lo) / 199) as x, lo, hi, n, h from range(200) r(i), s),
k as (select i, any_value(x) as x, any_value(n) as n, any_value(hi - lo) as span,
  sum(c * exp(-((x - v) / h) * ((x - v) / h) / 2)) / any_value(n * h * sqrt(2 * pi())) as density
  from g, d group by i)
select cast(i as integer) as point, round(x, 4) as x, round(density * 1000000, 4) as density,
  round(density * n * (span / 50), 4) as curve from k"""
    sql["profile_table"] = with_ctes(["fin_clean"], metric_rows("fin_clean", FINANCIALS.items(), ["Customer_ID"]))
    sql["profile_table_lms"] = with_ctes(["lms_typed"], metric_rows("lms_typed", LMS.items(), ["loan_id", "Customer_ID"]))
    sql["profile_table_clickstream"] = (
        "with clickstream_raw as (" + view_sql("clickstream_raw") + "), clicks as ("
        + typed_view("clickstream_raw", CLICKSTREAM) + ")\n" + metric_rows("clicks", CLICKSTREAM.items(), ["Customer_ID"])
    )
    return {name: text.strip() for name, text in sql.items()}
