from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from credmill import schemas  # noqa: E402
from credmill.session import build_session  # noqa: E402

TESTDATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        settings={
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = TESTDATA / "sf0.001"
    if not path.exists():
        pytest.skip(f"no test data at {path}")
    return str(path)


# One raw loan that passes every filter; tests override single columns.
LOAN = {
    "emp_title": "teacher", "emp_length": "10+ years", "home_ownership": "RENT",
    "annual_inc": 60000.0, "verification_status": "Verified", "zip_code": "941xx",
    "addr_state": "CA", "loan_amnt": 1000.0, "funded_amnt": 1000.0,
    "funded_amnt_inv": 1000.0, "term": " 36 months", "int_rate": "13.56%",
    "installment": 30.0, "grade": "A", "sub_grade": "A1", "issue_d": "Jun-18",
    "loan_status": "Current", "pymnt_plan": "n", "purpose": "debt_consolidation",
    "title": "Debt", "total_pymnt": 100.0, "total_pymnt_inv": 100.0,
    "total_rec_prncp": 80.0, "total_rec_int": 20.0, "total_rec_late_fee": 0.0,
    "recoveries": 0.0, "collection_recovery_fee": 0.0, "last_pymnt_d": "Jul-18",
    "last_pymnt_amnt": 30.0, "next_pymnt_d": "Aug-18", "dti": 5.0, "delinq_2yrs": 0,
    "earliest_cr_line": "08/2005", "inq_last_6mths": 0, "mths_since_last_delinq": 12,
    "mths_since_last_record": None, "open_acc": 5, "pub_rec": 0, "revol_bal": 100,
    "revol_util": "12.5%", "total_acc": 25, "initial_list_status": "w",
    "out_prncp": 0.0, "out_prncp_inv": 0.0,
}


@pytest.fixture(scope="session")
def loans(spark):
    """Build a loan table from dicts of overrides."""

    def build(*overrides: dict):
        rows = [tuple({**LOAN, **changes}.values()) for changes in overrides]
        return spark.createDataFrame(rows, schemas.LOAN_SCHEMA)

    return build
