from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from credmill import schemas
from credmill.operators import clean, keys, stats
from credmill.schemas import KEY


@pytest.fixture(scope="module")
def split(loans):
    def build(name, *overrides):
        return clean.split(keys.with_member_key(loans(*overrides)), name)

    return build


def test_splits_hold_their_columns(loans):
    keyed = keys.with_member_key(loans({}))
    for name, columns in schemas.SPLITS.items():
        assert clean.split(keyed, name).columns == [KEY, *columns]


@pytest.mark.parametrize(
    ("income", "kept"), [(0.0, 0), (-1.0, 0), (None, 0), (0.01, 1), (float("nan"), 1)]
)
def test_only_positive_income_stays(split, income, kept):
    rows = clean.positive_income(split("borrower_info", {"annual_inc": income}))
    assert rows.count() == kept


def test_clean_borrower(split):
    cases = [
        ("engineer", "< 1 year", "Engineer", 1),
        ("o'neil", "10+ years", "O'Neil", 10),
        (None, "n/a", "Others", 5),  # mean of 1, 10, 4, 6 is 5.25, cut to 5
        ("", "", "Others", 5),
        ("a", None, "A", 6),
        ("b", "99999999999", "B", 6),
        ("c", "4 years", "C", 4),
        ("d", "6 years", "D", 6),
    ]
    borrower = split(
        "borrower_info",
        *(
            {"emp_title": title, "emp_length": length, "zip_code": str(i)}
            for i, (title, length, _, _) in enumerate(cases)
        ),
    )
    parsed = borrower.where("emp_length IS NULL OR emp_length NOT LIKE '999%'")
    average = stats.average_emp_length(parsed).scalar()
    as_of = datetime(2020, 1, 2, 3, 4, 5)
    out = clean.clean_borrower(borrower, average=average, as_of=as_of).orderBy("zip_code")
    assert out.columns == [
        KEY, "emp_title", "emp_length_in_years", "home_ownership", "annual_inc",
        "verification_status", "zip_code", "addr_state", "ingestion_date", "country",
    ]
    assert dict(out.dtypes)["emp_length_in_years"] == "int"
    rows = out.collect()
    assert [(r.emp_title, r.emp_length_in_years) for r in rows] == [c[2:] for c in cases]
    assert {(r.ingestion_date, r.country) for r in rows} == {(as_of, "USA")}


def test_average_counts_members_with_income_only(split):
    borrower = split(
        "borrower_info",
        {"emp_length": "2 years", "zip_code": "1"},
        {"emp_length": "4 years", "zip_code": "2"},
        {"emp_length": "9 years", "zip_code": "3", "annual_inc": 0.0},
        {"emp_length": "n/a", "zip_code": "4"},
    )
    years = {r.zip_code: r.emp_length_in_years for r in clean.clean_borrower(borrower).collect()}
    assert years == {"1": 2, "2": 4, "4": 3}


def test_blank_lengths_without_any_number_take_the_default(split):
    borrower = split("borrower_info", {"emp_length": "n/a"})
    assert clean.clean_borrower(borrower).first().emp_length_in_years == 6


def test_clean_loan(split):
    row = clean.clean_loan(split("loan_details", {}, {"purpose": ""})).orderBy("purpose")
    empty, row = row.collect()
    assert empty.purpose is None
    assert row.purpose == "Debt_Consolidation"
    assert row.tenure_period_in_month == 36
    assert row.interest_rate_in_percentage == 13.56
    assert row.issued_date == date(2018, 6, 1)
    assert not {"pymnt_plan", "title", "term", "int_rate", "issue_d"} & set(row.asDict())


def test_clean_payment(split):
    row = clean.clean_payment(split("payment_recovery", {"next_pymnt_d": "x"})).first()
    assert row.last_payment_date == date(2018, 7, 1)
    assert row.next_payment_date is None


def test_clean_risk_fills_and_types(split):
    nothing = {
        "delinq_2yrs": None, "inq_last_6mths": None, "mths_since_last_delinq": None,
        "mths_since_last_record": None, "pub_rec": None, "revol_util": "",
    }
    risk = split(
        "credit_risk",
        {"dti": 10.0, "zip_code": "1"},
        {"dti": 20.0, "zip_code": "2"},
        {"dti": None, "zip_code": "3", **nothing},
    )
    rows = clean.clean_risk(risk).orderBy("dti").collect()
    assert [r.dti for r in rows] == [10.0, 15.0, 20.0]
    filled = rows[1]
    assert (filled.delinq_2yrs, filled.inq_last_6mths, filled.pub_rec) == (0, 0, 0)
    assert filled.mths_since_last_delinq == -1
    assert filled.revol_util_in_percentage is None
    assert filled.earliest_cr_line == date(2005, 8, 1)
    assert "mths_since_last_record" not in filled.asDict()
    assert clean.known_delinquency(clean.clean_risk(risk)).count() == 2


def test_nan_dti_counts_as_missing(spark, split):
    risk = split("credit_risk", {"dti": float("nan")})
    assert clean.fill_risk(risk, mean=F.lit(7.0)).first().dti == 7.0


def test_clean_risk_is_distinct(split):
    risk = split("credit_risk", {}, {})
    assert clean.clean_risk(risk).count() == 1
    assert clean.clean_risk(risk, unique_keys=True).count() == 2
