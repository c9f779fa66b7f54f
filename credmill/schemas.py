"""Column lists, table names and scoring constants.

Everything here is a fixed value: it has to equal what existing consumers of
the tables expect, so it is kept as plain data in one place.
"""

from __future__ import annotations

# --- fixed values: identity ------------------------------------------------

KEY = "member_id"
KEY_SEPARATOR = "||"
KEY_COLUMNS = (
    "emp_title",
    "emp_length",
    "home_ownership",
    "annual_inc",
    "verification_status",
    "grade",
    "term",
    "zip_code",
)

# --- fixed values: the raw loan record and its vertical split ----------------

LOAN_SCHEMA = """
    emp_title string, emp_length string, home_ownership string,
    annual_inc double, verification_status string, zip_code string,
    addr_state string,
    loan_amnt double, funded_amnt double, funded_amnt_inv double,
    term string, int_rate string, installment double, grade string,
    sub_grade string, issue_d string, loan_status string, pymnt_plan string,
    purpose string, title string,
    total_pymnt double, total_pymnt_inv double, total_rec_prncp double,
    total_rec_int double, total_rec_late_fee double, recoveries double,
    collection_recovery_fee double, last_pymnt_d string,
    last_pymnt_amnt double, next_pymnt_d string,
    dti double, delinq_2yrs int, earliest_cr_line string,
    inq_last_6mths int, mths_since_last_delinq int,
    mths_since_last_record int, open_acc int, pub_rec int, revol_bal int,
    revol_util string, total_acc int, initial_list_status string,
    out_prncp double, out_prncp_inv double
"""

BORROWER_SCHEMA = """
    member_id string, emp_title string, emp_length string,
    home_ownership string, annual_inc double, verification_status string,
    zip_code string, addr_state string
"""

BORROWER_COLUMNS = (
    "emp_title", "emp_length", "home_ownership", "annual_inc",
    "verification_status", "zip_code", "addr_state",
)
LOAN_COLUMNS = (
    "loan_amnt", "funded_amnt", "funded_amnt_inv", "term", "int_rate",
    "installment", "grade", "sub_grade", "issue_d", "loan_status",
    "pymnt_plan", "purpose", "title",
)
PAYMENT_COLUMNS = (
    "total_pymnt", "total_pymnt_inv", "total_rec_prncp", "total_rec_int",
    "total_rec_late_fee", "recoveries", "collection_recovery_fee",
    "last_pymnt_d", "last_pymnt_amnt", "next_pymnt_d",
)
RISK_COLUMNS = (
    "dti", "delinq_2yrs", "earliest_cr_line", "inq_last_6mths",
    "mths_since_last_delinq", "mths_since_last_record", "open_acc",
    "pub_rec", "revol_bal", "revol_util", "total_acc",
    "initial_list_status", "out_prncp", "out_prncp_inv",
)
SPLITS = {
    "borrower_info": BORROWER_COLUMNS,
    "loan_details": LOAN_COLUMNS,
    "payment_recovery": PAYMENT_COLUMNS,
    "credit_risk": RISK_COLUMNS,
}

# --- fixed values: renames and drops while cleaning --------------------------

BORROWER_RENAMES = {"emp_length": "emp_length_in_years"}
LOAN_RENAMES = {
    "term": "tenure_period_in_month",
    "int_rate": "interest_rate_in_percentage",
    "issue_d": "issued_date",
}
PAYMENT_RENAMES = {
    "last_pymnt_d": "last_payment_date",
    "next_pymnt_d": "next_payment_date",
}
RISK_RENAMES = {"revol_util": "revol_util_in_percentage"}
LOAN_DROPS = ("pymnt_plan", "title")
RISK_DROPS = ("mths_since_last_record",)

COUNTRY = "USA"
MISSING_TITLE = "Others"
MISSING_EMP_LENGTH = 6
UNKNOWN_MONTHS = -1
RISK_FILLS = {
    "delinq_2yrs": 0,
    "inq_last_6mths": 0,
    "mths_since_last_delinq": UNKNOWN_MONTHS,
    "mths_since_last_record": UNKNOWN_MONTHS,
    "pub_rec": 0,
}
MONTH_YEAR_FORMAT = "MMM-yy"
CREDIT_LINE_FORMAT = "MM/yyyy"

# --- fixed values: the joined table ------------------------------------------

CRUNCHED_CUSTOMER = (
    "emp_title", "emp_length_in_years", "home_ownership", "annual_inc",
    "verification_status", "zip_code", "addr_state", "ingestion_date",
    "country",
)
CRUNCHED_LOAN = (
    "loan_amnt", "funded_amnt", "funded_amnt_inv", "tenure_period_in_month",
    "interest_rate_in_percentage", "installment", "grade", "sub_grade",
    "issued_date", "loan_status", "purpose",
)
CRUNCHED_PAYMENT = (
    "total_pymnt", "total_pymnt_inv", "total_rec_prncp", "total_rec_int",
    "total_rec_late_fee", "recoveries", "collection_recovery_fee",
    "last_payment_date", "last_pymnt_amnt", "next_payment_date",
)
CRUNCHED_RISK = (
    "dti", "delinq_2yrs", "earliest_cr_line", "inq_last_6mths",
    "mths_since_last_delinq", "open_acc", "pub_rec", "revol_bal",
    "revol_util_in_percentage", "total_acc", "initial_list_status",
    "out_prncp", "out_prncp_inv",
)
CRUNCHED_COLUMNS = (
    KEY, *CRUNCHED_CUSTOMER, *CRUNCHED_LOAN, *CRUNCHED_PAYMENT, *CRUNCHED_RISK,
)

# --- fixed values: scoring ---------------------------------------------------

CRITICAL_COLUMNS = (
    "member_id", "loan_amnt", "funded_amnt", "annual_inc", "dti",
    "delinq_2yrs", "revol_bal", "total_acc", "out_prncp", "out_prncp_inv",
)
MAX_UTILIZATION = 100

# score column -> (input column, ladder of (comparison, bound, points)).
# The first rung that holds wins; no rung (NULL included) scores 0.
SCORE_BANDS = {
    "income_score": (
        "annual_inc",
        ((">", 100000, 100), (">", 75000, 75), (">", 50000, 50), (">", 25000, 25)),
    ),
    "dti_score": ("dti", (("<", 10, 100), ("<", 20, 75), ("<", 30, 50))),
    "delinq_score": ("delinq_2yrs", (("=", 0, 100), ("=", 1, 50))),
    "revol_bal_score": (
        "revol_bal",
        (("<", 5000, 100), ("<", 10000, 75), ("<", 20000, 50)),
    ),
    "revol_util_score": (
        "revol_util_in_percentage",
        (("<", 30, 100), ("<", 50, 75), ("<", 70, 50)),
    ),
    "total_acc_score": (
        "total_acc",
        ((">", 20, 100), (">", 10, 75), (">", 5, 50)),
    ),
    "out_prncp_score": (
        "out_prncp",
        (("=", 0, 100), ("<", 1000, 75), ("<", 5000, 50)),
    ),
    "out_prncp_inv_score": (
        "out_prncp_inv",
        (("=", 0, 100), ("<", 1000, 75), ("<", 5000, 50)),
    ),
}
SCORE_COLUMNS = tuple(SCORE_BANDS)
MAX_TOTAL = 800
SCORE_FLOOR = 300
SCORE_CEILING = 850
GRADE_BANDS = (
    (">=", 750, "very_good"),
    (">=", 700, "good"),
    (">=", 650, "medium"),
    (">=", 600, "bad"),
)
LOWEST_GRADE = "very_bad"
GRADES = (*(name for _, _, name in GRADE_BANDS), LOWEST_GRADE)

# --- fixed values: catalog names ---------------------------------------------

CUSTOMERS_TABLE = "customers_details_datasets"
LOANS_TABLE = "loan_details_datasets"
PAYMENTS_TABLE = "payment_recovery_datasets"
RISK_TABLE = "credit_risk_dataset"
ULTRA_RISK_TABLE = "ultra_clean_credit_risk_dataset"
CRUNCHED_TABLE = "crunched_dataset"
REPORT_TABLE = "graded_score_dataset"
GRADE_VIEW = "{grade}_score_dataset"
DEDUPED_VIEW = "deduplicated_loans_view"
INGESTED_TABLE = "ingested_loans"
QUARANTINE_COLUMN = "quarantined"
LINE_COLUMN = "rejected_line"
SOURCE_COLUMN = "source_file"
