"""Data-quality checks, each a one-row summary over the whole table.

The anomaly counts belong to the job.  The payment rules are derived from its
documentation, which states them without running them.  Each check is a set of named
aggregates: a query over a table, or observed while the table is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from credmill.functions.columns import aliased

ZIP_LENGTH = 5
STATE_LENGTH = 2
TOLERANCE = 0.01

_CORE = "total_rec_prncp + total_rec_int"
_GAP = "abs(total_pymnt - total_pymnt_inv)"


ZIP_ANOMALY = {"zip_anomalies": f"count_if(length(zip_code) > {ZIP_LENGTH})"}
STATE_ANOMALY = {"state_anomalies": f"count_if(length(addr_state) > {STATE_LENGTH})"}


def breaks_payment_identity(tolerance: float = TOLERANCE) -> str:
    """The total is not principal plus interest plus late fees."""
    return f"abs(total_pymnt - ({_CORE} + total_rec_late_fee)) > {tolerance}"


def payment_identity_check(tolerance: float = TOLERANCE) -> dict[str, str]:
    return {
        "payments": "count(1)",
        "violations": f"count_if({breaks_payment_identity(tolerance)})",
    }


def investor_gap_check(tolerance: float = TOLERANCE) -> dict[str, str]:
    return {
        "payments_with_gap": f"count_if({_GAP} > {tolerance})",
        "largest_gap": f"max({_GAP})",
        "mean_gap": f"avg({_GAP})",
    }


PRINCIPAL_INTEREST_SHARE = {
    "principal_and_interest": f"sum({_CORE})",
    "total_paid": "sum(total_pymnt)",
    "share": f"try_divide(sum({_CORE}), sum(total_pymnt))",
}


def zip_anomaly(customers: DataFrame) -> DataFrame:
    return customers.selectExpr(*aliased(ZIP_ANOMALY))


def state_anomaly(customers: DataFrame) -> DataFrame:
    return customers.selectExpr(*aliased(STATE_ANOMALY))


def payment_identity(payments: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    return payments.selectExpr(*aliased(payment_identity_check(tolerance)))


def investor_gap(payments: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """How far the total and the investors' share of it lie apart."""
    return payments.selectExpr(*aliased(investor_gap_check(tolerance)))


def principal_interest_share(payments: DataFrame) -> DataFrame:
    """Principal and interest as a share of all that was paid."""
    return payments.selectExpr(*aliased(PRINCIPAL_INTEREST_SHARE))
