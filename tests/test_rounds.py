"""The ranges of the exact median, the bound of hot keys, and the layout of the job."""

from __future__ import annotations

import math
import random

import plans
import pytest
from pyspark.sql import functions as F

from credmill import schemas
from credmill.operators import keys, stats
from credmill.plans import single_pass
from credmill.plans.batch_job import DEDUPED_TABLE, Job, buckets_for
from credmill.sources import readers
from loan_view import loan_view


def lower(values):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[(len(kept) - 1) // 2] if kept else None


def median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return stats.lower_median(df, "x", "m").first().m


@pytest.mark.parametrize(
    "values",
    [
        [],
        [None, float("nan")],
        [5.0],
        [1.0, 2.0],
        [-3.0, -1.0, 0.0, 2.0],
        [7.5] * 9,
        [1e-300, 1e300, 1e-310, -1e300, 5e-324],
        [float("inf"), float("-inf"), 1.0, float("inf")],
        [1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1.5],
        [0.0] * 5 + [1.0, 2.0, 3.0],
    ],
)
def test_lower_median_of_special_values(spark, values):
    assert median(spark, values) == lower(values)


@pytest.mark.parametrize("scale", [1.0, 1e-7, 1e12])
def test_lower_median_of_random_doubles(spark, scale):
    rng = random.Random(5)
    values = [rng.gauss(0, 1) * scale for _ in range(5001)]
    assert median(spark, values) == lower(values)


def test_only_one_range_is_ranked(spark):
    names = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        df = spark.range(300_000).select((F.rand(3) * 1e-7).alias("value"), F.lit(1).alias("copies"))
        found = stats._middle_range(df).first()
        assert found.before < 150_000 == found.middle
        assert stats._within(df, stats._middle_range(df)).count() < 20_000
        values = sorted(row.value for row in df.collect())
        assert stats.lower_median(df, "value", "m").first().m == values[149_999]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_plan_of_the_median_is_short(spark, sf_dir, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        plain = stats.lower_median(spark.range(50).selectExpr("cast(id AS double) AS x"), "x", "m")
        assert plans.count(plain, "Exchange") <= 10
        eligible = single_pass.score_members(keys.with_member_key(loan_view(spark, sf_dir)))
        median = stats.median_income(eligible)
        assert plans.count(median, "Exchange") < 25
        assert len(plans.explain(median)) < 60_000
        assert median.first()[0] is not None
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def keyed_rows(spark, hot, single):
    rows = spark.range(hot + single).select(
        F.when(F.col("id") < hot, F.lit("hot")).otherwise(F.col("id").cast("string")).alias(schemas.KEY),
        F.col("id").alias("value"),
    )
    return rows


@pytest.mark.parametrize("bound", [1, 50, 10_000])
def test_hot_bound_does_not_change_the_rows(spark, bound):
    rows = keyed_rows(spark, 100, 200).unionByName(keyed_rows(spark, 0, 120))
    kept = keys.exclude_duplicates(rows, hot_copies=bound)
    assert sorted(r.value for r in kept.collect()) == [*range(100), *range(120, 300)]


def test_rows_are_laid_out_once(spark):
    rows = keyed_rows(spark, 10, 50)
    kept = keys.exclude_duplicates(rows, partitions=7).repartition(7, schemas.KEY)
    assert kept.rdd.getNumPartitions() == 7
    assert kept.count() == 50


def test_row_counts_of_nothing(loans, spark):
    empty = keys.with_member_key(loans({})).filter("false")
    counts = {r.stage: r.row_count for r in single_pass.row_counts(empty).collect()}
    assert set(counts.values()) == {0}


def test_job_needs_buckets(spark):
    with pytest.raises(ValueError, match="buckets"):
        Job(spark, "/nowhere", 0)
    assert buckets_for(0) == 1
    assert buckets_for(10 << 30) == 40


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_buckets_alone_decide_the_layout(spark, sf_dir, tmp_path, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        job = Job(
            spark, str(tmp_path), 3, prefix=f"layout_{adaptive}_",
            names={"good_score_dataset": "fine_members"},
        )
        job.run(loan_view(spark, sf_dir))
        assert len(list((tmp_path / "staging" / DEDUPED_TABLE).glob("v*/part-*"))) == 3
        assert job.grade("good").count() > 0
        from credmill.operators import join

        joined = join.crunched(
            *(
                job.table(name)
                for name in (
                    schemas.ULTRA_RISK_TABLE, schemas.CUSTOMERS_TABLE,
                    schemas.LOANS_TABLE, schemas.PAYMENTS_TABLE,
                )
            )
        )
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert plans.count(joined, "Exchange") == 0

        assert [op for _, op in plans.operators(joined) if op == "Sort"] == []
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fields_that_do_not_parse(spark, loans, tmp_path):
    path = str(tmp_path / "loans")
    bad = loans({}).withColumn("delinq_2yrs", F.lit("0.0"))
    bad.write.csv(path, header=True)
    assert readers.read_loans_csv(spark, path).first().delinq_2yrs is None
    kept = readers.read_loans_csv(spark, path, on_error="keep").first()
    assert kept["_corrupt_record"] is not None
    with pytest.raises(Exception, match="(?i)malformed|parse|FAILFAST"):
        readers.read_loans_csv(spark, path, on_error="fail").collect()
    with pytest.raises(ValueError, match="on_error"):
        readers.read_loans_csv(spark, path, on_error="ignore")
