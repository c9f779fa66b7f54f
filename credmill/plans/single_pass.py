"""From raw loans to graded members without joining the splits back together.

The four tables are projections of the same de-duplicated rows, and every
``member_id`` is unique by then.  Joining them on it gives back the very rows
they were cut from, so the plans here compute the joined columns in place: the
only shuffle left is the one that finds the duplicates.  ``operators.join``
remains for tables that were stored apart.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame

from credmill import schemas
from credmill.functions import text
from credmill.functions.columns import aliased, rework
from credmill.operators import clean, keys, score, stats
from credmill.schemas import KEY


def dti_mean(keyed: DataFrame) -> Column:
    """Mean dti over the unambiguous rows, as a scalar."""
    return stats.dti_mean(keys.unique_values(keyed.select(KEY, "dti"))).scalar()


def numbers_per_key(keyed: DataFrame) -> DataFrame:
    """The aggregate that finds the duplicates, with the numbers that both means are taken of."""
    return keys.rows_per_key(
        keyed.selectExpr(KEY, "dti", "annual_inc", f"{stats.emp_years()} AS years")
    )


def means_of(per_key: DataFrame) -> DataFrame:
    """One row with both means, of what ``numbers_per_key`` found."""
    return per_key.where("member_count = 1").selectExpr(
        f"{stats.exact_mean('dti')} AS dti_mean",
        f"{stats.exact_mean(f'if({clean.HAS_INCOME}, years, NULL)')} AS avg_emp_length",
    )


def means(keyed: DataFrame) -> DataFrame:
    """One row with both means that cleaning fills in, from one pass.

    ``dti_mean`` is taken over all unambiguous rows, ``avg_emp_length`` over
    those with income.
    """
    return means_of(numbers_per_key(keyed))


def unique_and_means(keyed: DataFrame) -> tuple[DataFrame, Column]:
    """The unambiguous rows, and a struct of both means; one aggregate per key serves both."""
    per_key = numbers_per_key(keyed)
    unique = keys.exclude_duplicates(keyed, per_key=per_key)
    return unique, means_of(per_key).selectExpr("struct(*) AS means").scalar()


def crunched(keyed: DataFrame, *, as_of: datetime | None = None) -> DataFrame:
    """The joined table, computed row by row from the keyed loans.

    A member without income has no customer row, so the customer columns of
    such a member are NULL.
    """
    unique, filled_in = unique_and_means(keyed)
    # Row values come from before the projection: annual_inc is the raw income.
    customer = {name: name for name in schemas.BORROWER_COLUMNS}
    customer.update(clean.borrower_values(as_of))
    values = {
        **{name: f"if({clean.HAS_INCOME}, {sql}, NULL)" for name, sql in customer.items()},
        **clean.loan_values(),
        **clean.payment_values(),
        **clean.risk_values(),
    }
    renames = {
        **schemas.BORROWER_RENAMES,
        **schemas.LOAN_RENAMES,
        **schemas.PAYMENT_RENAMES,
        **schemas.RISK_RENAMES,
    }
    members = rework(
        unique.withColumn("_means", filled_in).selectExpr(
            "*", f"_means.dti_mean AS {clean.MEAN}", f"_means.avg_emp_length AS {clean.AVERAGE}"
        ),
        values,
        columns=[KEY, *(name for table in schemas.SPLITS.values() for name in table)],
        renames=renames,
    )
    return clean.known_delinquency(members).select(*schemas.CRUNCHED_COLUMNS)


SCORE_INPUTS = (
    *(name for name in schemas.CRITICAL_COLUMNS if name != KEY),
    "mths_since_last_delinq",
)


def score_inputs(keyed: DataFrame) -> DataFrame:
    """Key and numbers the scores need, before the shuffle cut to fixed width.

    Utilization is parsed first: all values then live in a hash aggregate,
    which keeps the whole path in generated code and the shuffle narrow.
    """
    utilization = {"revol_util_in_percentage": text.percentage("revol_util", "float")}
    return keyed.selectExpr(KEY, *SCORE_INPUTS, *aliased(utilization))


def _shared_mean(per_key: DataFrame) -> Column:
    """Mean dti of the keys with one row, as a scalar.

    The subquery also asks for the maximum of the other columns.  It so needs
    the very shuffle the rows themselves come from, which Spark then runs once
    for both, instead of a second scan for a narrower one.
    """
    others = (f"max({name}) AS {name}" for name in per_key.columns if name != KEY)
    row = per_key.where("member_count = 1").selectExpr(
        f"struct({stats.exact_mean('dti')} AS mean, {', '.join(others)}) AS row"
    )
    return row.scalar()["mean"]


def _filled(per_key: DataFrame) -> DataFrame:
    fills = {
        name: sql for name, sql in clean.fill_values().items() if name in SCORE_INPUTS
    }
    income = {"annual_inc": f"if({clean.HAS_INCOME}, annual_inc, NULL)"}
    return rework(
        clean.with_mean(per_key, _shared_mean(per_key)),
        {**fills, **income},
        drops=[clean.MEAN],
    )


def score_members(keyed: DataFrame) -> DataFrame:
    """The joined members before the filters, with the score inputs only."""
    per_key = keys.rows_per_key(score_inputs(keyed))
    unique = _filled(per_key).where("member_count = 1").drop("member_count")
    return clean.known_delinquency(unique)


def graded(keyed: DataFrame) -> DataFrame:
    """Graded members with the score inputs and all score columns."""
    return score.graded(score_members(keyed))


def row_counts(keyed: DataFrame) -> DataFrame:
    """Rows left after each stage, all counted in one pass."""
    per_key = _filled(keys.rows_per_key(score_inputs(keyed)))
    unique = "member_count = 1"
    joined = f"{unique} AND {clean.KNOWN_DELINQUENCY}"
    complete = f"{joined} AND {score.critical_values_present(per_key)}"
    stages = {
        "raw": "coalesce(sum(member_count), 0)",
        "deduplicated": f"count_if({unique})",
        "customers": f"count_if({unique} AND {clean.HAS_INCOME})",
        "joined": f"count_if({joined})",
        "complete": f"count_if({complete})",
        "scored": f"count_if({complete} AND {score.VALID_UTILIZATION})",
    }
    counts = per_key.selectExpr(*aliased(stages))
    return counts.unpivot([], list(stages), "stage", "row_count")
