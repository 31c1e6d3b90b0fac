"""Raw CSV sources in the form the datamart reads, written by hand into a folder."""

from __future__ import annotations

import csv
from datetime import date
from pathlib import Path

from snapmart.schemas import DATASETS

MONTHS = [date(2023, 1, 1), date(2023, 2, 1), date(2023, 3, 1)]
OCCUPATIONS = ["Lawyer", "Media_Manager", "Doctor", "_______"]
LOANS = ["Auto Loan, Auto Loan, and Credit-Builder Loan", "Not Specified", " ", "Home Equity Loan, and Payday Loan"]


def attribute_row(i, day):
    age = "-500" if i % 40 == 39 else f"{15 + i % 60}{'_' if i % 10 == 0 else ''}"
    ssn = "#F%$D@*&8" if i % 17 == 0 else f"100-20-{i:04d}"
    return [f"CUS_{i}", f'Name "{i}", Jr', age, ssn, OCCUPATIONS[i % 4], day]


def financial_row(i, day):
    return {
        "Customer_ID": f"CUS_{i}",
        "Annual_Income": f"{1000 + i}.5{'_' if i % 9 == 0 else ''}",
        "Monthly_Inhand_Salary": f"{100 + i},25",
        "Num_Bank_Accounts": str(500 if i % 50 == 49 else i % 9),
        "Num_Credit_Card": str(i % 7),
        "Interest_Rate": str(i % 30),
        "Num_of_Loan": f"{i % 5}_",
        "Type_of_Loan": LOANS[i // 4 % 4],
        "Delay_from_due_date": str(i % 50 - 2),
        "Num_of_Delayed_Payment": str(i % 20),
        "Changed_Credit_Limit": "_" if i % 13 == 0 else f"{i % 25}.5",
        "Num_Credit_Inquiries": f"{i % 12}.0",
        "Credit_Mix": "_" if i % 19 == 0 else ["Good", "Standard", "Bad"][i % 3],
        "Outstanding_Debt": f"{i % 300}.75",
        "Credit_Utilization_Ratio": f"{20 + i % 20},5",
        "Credit_History_Age": f"{i % 30} Years and {i % 12} Months",
        "Payment_of_Min_Amount": "Yes",
        "Total_EMI_per_month": f"{i % 90},5",
        "Amount_invested_monthly": "__10000__" if i % 60 == 59 else f"{i % 100}.5",
        "Payment_Behaviour": "!@9#%8" if i % 29 == 0 else ["Low_spent", "High_spent"][i % 2],
        "Monthly_Balance": "" if i % 31 == 0 else f"{i},5",
        "snapshot_date": day,
    }


def loan_rows(i, month):
    mob = i % 8
    overdue = 100.0 * (i % 3)
    return [f"LOAN_{i}", f"CUS_{i}", "2022-07-01", "10", str(mob), "1000", "100.0", "0.0", str(overdue), "500", month.isoformat()]


def write(path: Path, header, lines) -> str:
    with path.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(lines)
    return str(path)


def write_sources(folder: Path, customers: int = 240, months=MONTHS, extra_occupation: str | None = None) -> dict[str, str]:
    attributes, financials, loans, clicks = [], [], [], []
    for i in range(customers):
        month = months[i % len(months)]
        day = month.strftime("%d/%m/%Y")
        row = attribute_row(i, day)
        if extra_occupation and i % 4 == 0:
            row[4] = extra_occupation
        attributes.append(row)
        financials.append(financial_row(i, day))
        clicks.append([str((i * j) % 50 - 10) for j in range(1, 21)] + [f"CUS_{i}", day])
        loans += [loan_rows(i, m) for m in months]
    # A mid-month row never enters the datamart.
    attributes.append(["CUS_mid", "Mid", "30", "1", "Lawyer", "15/01/2023"])
    loans.append(loan_rows(9999, date(2023, 1, 15)))
    fin_names = list(DATASETS["financials"].column_names)
    return {
        "clickstream": write(folder / "clickstream.csv", DATASETS["clickstream"].column_names, clicks),
        "attributes": write(folder / "attributes.csv", DATASETS["attributes"].column_names, attributes),
        # Columns in another order: they are found by name.
        "financials": write(
            folder / "financials.csv", fin_names[::-1], [[row[n] for n in fin_names[::-1]] for row in financials]
        ),
        "lms": write(folder / "lms.csv", DATASETS["lms"].column_names, loans),
    }
