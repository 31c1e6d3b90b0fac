"""Loan-customer views over the given tables.

The tables are clean, so these views write dirt into them. Each text runs unchanged in Spark SQL and in
DuckDB; `{table}` stands for the table it reads. Every view reads its whole table. Every fifth customer
has two snapshots, so that a join must use both keys, and loans at every installment have missed none to
three, so that some are 28 to 31 days past due at the sixth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ATTRIBUTES_RAW = """
select 'CUS_' || cast(c_custkey as string) as Customer_ID, c_name as Name,
  case when c_custkey % 50 = 7 then '-500'
       else cast(15 + (c_custkey + later) % 60 as string) || case when c_custkey % 20 = 0 then '_' else '' end end as Age,
  case when c_custkey % 17 = 0 then '#F%$D@*&8'
       else '100-20-' || lpad(cast(c_custkey % 10000 as string), 4, '0') end as SSN,
  case when c_custkey % 14 = 0 then '_______' else c_mktsegment end as Occupation,
  make_date(2023 + cast(floor(((c_custkey + later) % 24) / 12) as int), cast((c_custkey + later) % 12 as int) + 1, 1) as snapshot_date
from (select *, 0 as later from {customer} union all select *, 1 as later from {customer} where c_custkey % 5 = 0) as months
"""

FINANCIALS_RAW = """
select 'CUS_' || cast(c_custkey as string) as Customer_ID,
  cast(c_acctbal as string) || case when c_custkey % 9 = 0 then '_' else '' end as Annual_Income,
  replace(cast(abs(c_acctbal) as string), '.', ',') as Monthly_Inhand_Salary,
  cast(c_custkey % 11 + case when c_custkey % 97 = 0 then 500 else 0 end as string) as Num_Bank_Accounts,
  cast(c_custkey % 9 as string) as Num_Credit_Card,
  cast((c_custkey + later) % 35 as string) as Interest_Rate,
  cast(case when c_custkey % 10 = 0 then 0 else c_custkey % 4 + 1 end as string)
    || case when c_custkey % 11 = 0 then '_' else '' end as Num_of_Loan,
  case when c_custkey % 10 = 0 then ' '
       when c_custkey % 3 = 0 then 'Auto Loan, and Auto Loan'
       when c_custkey % 3 = 1 then 'Credit-Builder Loan, Auto Loan, and Home Equity Loan'
       else 'Not Specified' end as Type_of_Loan,
  cast(c_custkey % 60 - 3 as string) as Delay_from_due_date,
  cast(c_custkey % 26 as string) || case when c_custkey % 21 = 0 then '_' else '' end as Num_of_Delayed_Payment,
  case when c_custkey % 13 = 0 then '_' else cast(c_custkey % 30 + 0.5e0 as string) end as Changed_Credit_Limit,
  cast(c_custkey % 18 as string) as Num_Credit_Inquiries,
  case when c_custkey % 19 = 0 then '_' when c_custkey % 3 = 0 then 'Good'
       when c_custkey % 3 = 1 then 'Standard' else 'Bad' end as Credit_Mix,
  cast(abs(c_acctbal) as string) || case when c_custkey % 23 = 0 then '_' else '' end as Outstanding_Debt,
  replace(cast(c_custkey % 20 + 20.5e0 as string), '.', ',') as Credit_Utilization_Ratio,
  cast(c_custkey % 30 as string) || ' Years and ' || cast(c_custkey % 12 as string) || ' Months' as Credit_History_Age,
  case when c_custkey % 3 = 0 then 'Yes' when c_custkey % 3 = 1 then 'No' else 'NM' end as Payment_of_Min_Amount,
  replace(cast(c_custkey % 400 + 0.25e0 as string), '.', ',') as Total_EMI_per_month,
  case when c_custkey % 37 = 0 then '__10000__'
       else cast(c_custkey % 300 + 0.5e0 as string) end as Amount_invested_monthly,
  case when c_custkey % 29 = 0 then '!@9#%8' when c_custkey % 2 = 0 then 'Low_spent_Small_value_payments'
       else 'High_spent_Large_value_payments' end as Payment_Behaviour,
  case when c_custkey % 31 = 0 then '' else replace(cast(abs(c_acctbal) as string), '.', ',') end as Monthly_Balance,
  make_date(2023 + cast(floor(((c_custkey + later) % 24) / 12) as int), cast((c_custkey + later) % 12 as int) + 1, 1) as snapshot_date
from (select *, 0 as later from {customer} union all select *, 1 as later from {customer} where c_custkey % 5 = 0) as months
"""

LMS_RAW = """
select cast(l_orderkey as string) as loan_id, 'CUS_' || cast(l_partkey as string) as Customer_ID,
  cast(date_trunc('year', l_shipdate) as date) as loan_start_date,
  cast(10 + l_suppkey % 3 as string) as tenure,
  cast(l_linenumber as string) as installment_num,
  cast(l_quantity * 1000 as string) as loan_amt,
  case when l_quantity = 1 then '0.0' when l_quantity = 2 then null
       else cast(l_extendedprice as string) end as due_amt,
  case when l_returnflag = 'R' then '0.0' else cast(l_extendedprice as string) end as paid_amt,
  case when l_quantity = 3 then null
       when l_returnflag = 'R' then cast(l_extendedprice * ((l_linenumber + l_orderkey) % 4) as string)
       else '0.0' end as overdue_amt,
  cast(l_extendedprice + l_quantity as string) as balance,
  cast(date_trunc('month', l_shipdate) as date) as snapshot_date
from {lineitem}
"""

CLICKSTREAM_RAW = (
    """
select 'CUS_' || cast(user_id as string) as Customer_ID,
  cast(cast(floor(value) as bigint) as string) as fe_1, cast(length(event_type) as string) as fe_2,
  case when event_id % 11 = 0 then 'n/a' when event_id % 13 = 0 then '' else cast(hour(ts) as string) end as fe_3,
"""
    + "".join(f"  cast((user_id + event_id) % {i * 7} - {i} as string) as fe_{i},\n" for i in range(4, 21))
    + """
  cast(cast(ts as date) as string) as snapshot_date
from {events}
"""
)

VIEWS = {
    "attributes_raw": (ATTRIBUTES_RAW, "customer"),
    "financials_raw": (FINANCIALS_RAW, "customer"),
    "lms_raw": (LMS_RAW, "lineitem"),
    "clickstream_raw": (CLICKSTREAM_RAW, "events"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, source = VIEWS[name]
    return spark.sql(text, **{source: table(spark, sf_dir, source)})


def view_sql(name: str) -> str:
    text, source = VIEWS[name]
    return text.replace(f"{{{source}}}", source)
