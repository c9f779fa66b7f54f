"""Eight factor scores, their total, the scaled credit score and its grade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from credmill import schemas
from credmill.functions.bands import ladder
from credmill.functions.columns import aliased
from credmill.operators import stats


def critical_values_present(df: DataFrame) -> str:
    """No critical column is NULL, or NaN where it is a floating number.

    One ``IS NOT NULL`` per column lets Catalyst push each test to its side of a
    join and turn the outer joins below into inner ones.
    """
    tests = [f"{name} IS NOT NULL" for name in schemas.CRITICAL_COLUMNS]
    tests += [
        f"NOT isnan({field.name})"
        for field in df.schema
        if field.name in schemas.CRITICAL_COLUMNS
        and isinstance(field.dataType, (DoubleType, FloatType))
    ]
    return " AND ".join(tests)


def drop_critical_nulls(df: DataFrame) -> DataFrame:
    return df.where(critical_values_present(df))


# Unknown utilization does not qualify.
VALID_UTILIZATION = f"revol_util_in_percentage <= {schemas.MAX_UTILIZATION}"


def valid_utilization(df: DataFrame) -> DataFrame:
    return df.where(VALID_UTILIZATION)


def impute_income(df: DataFrame, median: Column | None = None) -> DataFrame:
    """NULL income takes the lower median.

    Behind ``drop_critical_nulls`` no income is NULL any more, so the scoring
    plan leaves this step, and the ranking it costs, out.
    """
    if median is None:
        median = stats.median_income(df).scalar()
    return df.withColumn("annual_inc", F.coalesce(F.col("annual_inc"), median))


def factor_values() -> dict[str, str]:
    return {
        name: ladder(source, rungs, 0)
        for name, (source, rungs) in schemas.SCORE_BANDS.items()
    }


def with_factor_scores(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", *aliased(factor_values()))


def with_total_score(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", f"{' + '.join(schemas.SCORE_COLUMNS)} AS total_score")


def with_credit_score(df: DataFrame) -> DataFrame:
    """Scale the total linearly to the range of credit scores."""
    span = schemas.SCORE_CEILING - schemas.SCORE_FLOOR
    share = f"total_score / {schemas.MAX_TOTAL}"
    return df.selectExpr("*", f"{share} * {span} + {schemas.SCORE_FLOOR} AS credit_score")


def with_credit_grade(df: DataFrame) -> DataFrame:
    grade = ladder("credit_score", schemas.GRADE_BANDS, schemas.LOWEST_GRADE)
    return df.selectExpr("*", f"{grade} AS credit_grade")


def scored(df: DataFrame) -> DataFrame:
    """All score columns, for rows that passed the filters."""
    return with_credit_grade(with_credit_score(with_total_score(with_factor_scores(df))))


def graded(crunched: DataFrame) -> DataFrame:
    """From the joined table to graded rows."""
    return scored(valid_utilization(drop_critical_nulls(crunched)))


def grade_counts(graded_rows: DataFrame) -> DataFrame:
    return graded_rows.groupBy("credit_grade").agg(
        F.expr("count(1) AS members"),
        F.expr("min(credit_score) AS lowest_score"),
        F.expr("max(credit_score) AS highest_score"),
    )
