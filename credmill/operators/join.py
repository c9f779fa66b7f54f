"""The four cleaned tables, joined into one row per member."""

from __future__ import annotations

from pyspark.sql import DataFrame

from credmill import schemas
from credmill.schemas import KEY


def crunched(
    risk: DataFrame, customers: DataFrame, loans: DataFrame, payments: DataFrame
) -> DataFrame:
    """Left joins from risk to the other three on ``member_id``.

    All joins share the key, so one hash partitioning serves the three of them.
    Tables that were written bucketed on the key join without any shuffle.
    No join is hinted: the sides grow with the data.
    """
    return (
        risk.select(KEY, *schemas.CRUNCHED_RISK)
        .join(customers.select(KEY, *schemas.CRUNCHED_CUSTOMER), KEY, "left")
        .join(loans.select(KEY, *schemas.CRUNCHED_LOAN), KEY, "left")
        .join(payments.select(KEY, *schemas.CRUNCHED_PAYMENT), KEY, "left")
        .select(*schemas.CRUNCHED_COLUMNS)
    )
