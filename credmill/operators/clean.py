"""Vertical split and cleaning of the four tables.

The ``*_values`` functions hold the cleaning rules, as SQL per column.  The
``clean_*`` functions apply them to one split table; the single-pass plan
applies the same rules to the unsplit rows.  The two rules that fill in a mean
find it in the columns ``AVERAGE`` and ``MEAN``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame

from credmill import schemas
from credmill.functions import text
from credmill.functions.columns import rework
from credmill.operators import stats
from credmill.schemas import KEY

AVERAGE = "_avg_emp_length"
MEAN = "_dti_mean"

# --- vertical split ------------------------------------------------------------


def split(keyed: DataFrame, table: str) -> DataFrame:
    return keyed.select(KEY, *schemas.SPLITS[table])


def split_borrower(keyed: DataFrame) -> DataFrame:
    return split(keyed, "borrower_info")


def split_loan(keyed: DataFrame) -> DataFrame:
    return split(keyed, "loan_details")


def split_payment(keyed: DataFrame) -> DataFrame:
    return split(keyed, "payment_recovery")


def split_risk(keyed: DataFrame) -> DataFrame:
    return split(keyed, "credit_risk")


# --- borrowers -------------------------------------------------------------------

# NULL income does not qualify.
HAS_INCOME = "annual_inc > 0"


def positive_income(borrower: DataFrame) -> DataFrame:
    return borrower.where(HAS_INCOME)


def employer_title() -> str:
    return f"coalesce({text.title_case('emp_title')}, '{schemas.MISSING_TITLE}')"


def emp_length_years(average: str = AVERAGE) -> str:
    """Whole years.  Text without digits takes the mean cut to whole years,
    NULL and what does not fit an int take the fixed default."""
    kept = text.digits("emp_length")
    years = f"if({kept} = '', try_cast({average} AS int), try_cast({kept} AS int))"
    return f"coalesce({years}, {schemas.MISSING_EMP_LENGTH})"


def ingestion_values(as_of: datetime | None = None) -> dict[str, str]:
    now = f"timestamp '{as_of.isoformat(sep=' ')}'" if as_of else "current_timestamp()"
    return {"ingestion_date": now, "country": f"'{schemas.COUNTRY}'"}


def borrower_values(as_of: datetime | None = None) -> dict[str, str]:
    return {
        "emp_title": employer_title(),
        "emp_length": emp_length_years(),
        **ingestion_values(as_of),
    }


def clean_borrower(
    borrower: DataFrame, *, average: Column | None = None, as_of: datetime | None = None
) -> DataFrame:
    """Borrowers with income, typed.  ``average`` defaults to the mean length
    of employment over those same borrowers."""
    customers = positive_income(borrower)
    if average is None:
        average = stats.average_emp_length(customers).scalar()
    return rework(
        customers.withColumn(AVERAGE, average),
        borrower_values(as_of),
        renames=schemas.BORROWER_RENAMES,
        drops=[AVERAGE],
    )


# --- loans -----------------------------------------------------------------------


def loan_values() -> dict[str, str]:
    return {
        "term": text.whole_number("term"),
        "int_rate": text.percentage("int_rate"),
        "issue_d": text.month_date("issue_d", schemas.MONTH_YEAR_FORMAT),
        "purpose": text.title_case("purpose"),
    }


def clean_loan(loan: DataFrame) -> DataFrame:
    return rework(loan, loan_values(), renames=schemas.LOAN_RENAMES, drops=schemas.LOAN_DROPS)


# --- payments ----------------------------------------------------------------------


def payment_values() -> dict[str, str]:
    return {
        name: text.month_date(name, schemas.MONTH_YEAR_FORMAT)
        for name in schemas.PAYMENT_RENAMES
    }


def clean_payment(payment: DataFrame) -> DataFrame:
    return rework(payment, payment_values(), renames=schemas.PAYMENT_RENAMES)


# --- credit risk ---------------------------------------------------------------------


def filled_dti(mean: str = MEAN) -> str:
    """NULL and NaN take the mean."""
    return f"coalesce(nanvl(dti, NULL), {mean})"


def fill_values() -> dict[str, str]:
    constants = {
        name: f"coalesce({name}, {value})" for name, value in schemas.RISK_FILLS.items()
    }
    return {"dti": filled_dti(), **constants}


def risk_values() -> dict[str, str]:
    return {
        **fill_values(),
        "earliest_cr_line": text.month_date("earliest_cr_line", schemas.CREDIT_LINE_FORMAT),
        "revol_util": text.percentage("revol_util", "float"),
    }


def with_mean(risk: DataFrame, mean: Column | None = None) -> DataFrame:
    if mean is None:
        mean = stats.dti_mean(risk).scalar()
    return risk.withColumn(MEAN, mean)


def fill_risk(risk: DataFrame, *, mean: Column | None = None) -> DataFrame:
    return rework(with_mean(risk, mean), fill_values(), drops=[MEAN])


def clean_risk(
    risk: DataFrame, *, mean: Column | None = None, unique_keys: bool = False
) -> DataFrame:
    """Risk rows, filled, typed and distinct.

    ``unique_keys=True`` says that no ``member_id`` repeats; the distinct then
    has nothing to remove and its shuffle is left out.
    """
    typed = rework(
        with_mean(risk, mean), risk_values(), renames=schemas.RISK_RENAMES, drops=[MEAN]
    )
    rows = typed if unique_keys else stats.distinct_rows(typed)
    return rows.drop(*schemas.RISK_DROPS)


KNOWN_DELINQUENCY = f"mths_since_last_delinq != {schemas.UNKNOWN_MONTHS}"


def known_delinquency(risk: DataFrame) -> DataFrame:
    """Only members whose last delinquency has a known age."""
    return risk.where(KNOWN_DELINQUENCY)
