"""Global statistics as one-row DataFrames.

``.scalar()`` turns such a frame into a column, so a statistic takes part in a
plan as a scalar subquery and never passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credmill.functions.columns import aliased
from credmill.functions.text import digits

def emp_years() -> str:
    return f"try_cast({digits('emp_length')} AS double)"


# Digits before and behind the point of the numbers that are summed exactly.
_EXACT = "DECIMAL(38, 15)"


def exact_mean(value: str) -> str:
    """SQL of a mean that does not depend on the order of the rows.

    Sums of doubles differ in their last bits with the order of summation, so with the number of
    partitions.  Here each value becomes a decimal with 15 digits behind the point and the
    decimals are summed without any rounding.  Where a value does not fit (NaN, infinity, 1e23 or
    more), or the sum does not, it is the plain mean.
    """
    exact = f"try_cast({value} AS {_EXACT})"
    mean = f"cast(try_sum({exact}) AS double) / count({value})"
    return f"coalesce(if(count({exact}) = count({value}), {mean}, NULL), avg({value}))"


def average_emp_length(customers: DataFrame) -> DataFrame:
    """Mean number of years over the lengths that hold digits."""
    return customers.selectExpr(f"{exact_mean(emp_years())} AS avg_emp_length")


def dti_mean(risk: DataFrame) -> DataFrame:
    return risk.selectExpr(f"{exact_mean('dti')} AS dti_mean")


def dti_stddev(risk: DataFrame) -> DataFrame:
    return risk.selectExpr("stddev_samp(dti) AS dti_stddev")


DTI_SPREAD = {"dti_mean": exact_mean("dti"), "dti_stddev": "stddev_samp(dti)"}


def dti_spread(risk: DataFrame) -> DataFrame:
    """Mean and deviation next to each other, from one pass."""
    return risk.selectExpr(*aliased(DTI_SPREAD))


def lower_median(df: DataFrame, column: str, name: str) -> DataFrame:
    """The exact lower median: an element of the data, NULL if there is none.

    Equal values are counted first, so a hot value is one row.  The counts are laid out by ranges
    of values; how many each range holds tells which one has the middle rank, and only the values
    of that range are ranked.  So no task ranks more rows than a sort would give it, and any
    choice of ranges finds the same value.  NULL and NaN do not count.
    """
    counted = (
        df.selectExpr(f"`{column}` AS grouped")
        .where("grouped IS NOT NULL AND NOT isnan(cast(grouped AS double))")
        .groupBy("grouped")
        # The filter on a range below is on an aggregate: it stays above the shuffle, which
        # both uses of the counts so share.
        .agg(F.expr("max(grouped) AS value"), F.expr("count(1) AS copies"))
        .select("value", "copies")
    )
    ranked = _within(counted, _middle_range(counted)).selectExpr(
        "value", "found.middle", "found.before + sum(copies) OVER (ORDER BY value) AS up_to"
    )
    return ranked.where("up_to >= middle").selectExpr(f"min(value) AS `{name}`")


def _middle_range(counted: DataFrame) -> DataFrame:
    """One row: bounds of the range with the middle rank, the number of values before it, the rank."""
    ranges = (
        counted.repartitionByRange("value")
        .withColumn("part", F.spark_partition_id())
        .groupBy("part")
        .agg(F.expr("sum(copies) AS held"), F.expr("min(value) AS low"), F.expr("max(value) AS high"))
    )
    ranked = ranges.selectExpr(
        "low", "high", "held", "sum(held) OVER (ORDER BY low) AS up_to",
        "ceil(sum(held) OVER () / 2) AS middle",
    )
    return ranked.where("up_to - held < middle AND middle <= up_to").selectExpr(
        "low", "high", "up_to - held AS before", "middle"
    )


def _within(counted: DataFrame, found: DataFrame) -> DataFrame:
    """The values of the range found, with what is known of it.

    A join with the one row that was found: as a scalar subquery it would be copied into every
    place that names it.
    """
    one_row = F.broadcast(found.selectExpr("struct(*) AS found"))
    return counted.join(one_row, F.expr("value BETWEEN found.low AND found.high"))


def median_income(df: DataFrame) -> DataFrame:
    return lower_median(df, "annual_inc", "median_annual_inc")


def title_frequency(customers: DataFrame) -> DataFrame:
    """Customers per employer title, most frequent first, ties by title."""
    counts = customers.groupBy("emp_title").agg(F.expr("count(1) AS count"))
    return counts.orderBy(F.desc("count"), "emp_title")


def row_count(df: DataFrame) -> DataFrame:
    return df.selectExpr("count(1) AS row_count")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct.  It changes nothing where ``member_id`` is unique."""
    return df.dropDuplicates()
