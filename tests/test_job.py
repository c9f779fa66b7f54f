"""What the job takes in, observes and answers from its tables."""

from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from credmill import schemas
from credmill.operators import stats
from credmill.plans.batch_job import CHECKS, Job, TooManyBadLines
from credmill.schemas import KEY
from credmill.session import COST_BASED
from credmill.sources import writers
from loan_view import loan_view
from tests.plans import count, explain


@pytest.fixture(scope="module")
def job(spark, sf_dir, tmp_path_factory):
    job = Job(spark, str(tmp_path_factory.mktemp("job")), 4, prefix="w_", statistics=True)
    job.run(loan_view(spark, sf_dir))
    return job


def jobs_run(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("observed"))


def close(a, b):
    return a == b or (isinstance(a, float) and math.isclose(a, b, rel_tol=1e-12))


def test_observed_checks_equal_the_queries(spark, job):
    spark.sparkContext.setJobGroup("observed", "")
    try:
        values = job.check_values()
        assert jobs_run(spark) == 0
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    queries = job.checks()
    assert set(queries) == set(values) | {"grades"}
    for check, found in values.items():
        wanted = queries[check].first().asDict()
        assert found.keys() == wanted.keys()
        assert all(close(found[name], wanted[name]) for name in found), check


def test_observing_adds_no_job(spark, job):
    """Landing runs as many jobs with the checks as without them."""

    def landing():
        spark.sparkContext.setJobGroup("observed", "")
        before = jobs_run(spark)
        job._save(job.table("payment_recovery"), "landing", schemas.PAYMENTS_TABLE, "parquet")
        return jobs_run(spark) - before

    checks = CHECKS[schemas.PAYMENTS_TABLE]
    try:
        observed = landing()
        CHECKS[schemas.PAYMENTS_TABLE] = {}
        assert observed == landing() > 0
    finally:
        CHECKS[schemas.PAYMENTS_TABLE] = checks
        spark.sparkContext._jsc.clearJobGroup()


def test_a_lookup_reads_one_bucket(spark, job):
    key = job.table("loan_details").select(KEY).first()[0]
    found = job.member("loan_details", key)
    assert "SelectedBucketsCount: 1 out of 4" in bucketed_plan(spark, found)
    assert f"EqualTo({KEY},{key})" in explain(found)
    assert [row[KEY] for row in found.collect()] == [key]
    assert job.member("loan_details", "nobody").count() == 0


def bucketed_plan(spark, df):
    """The plan that names the buckets; pruned they are in any case."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        return explain(df.select("*"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def cost(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("cost"))


def test_stored_tables_know_their_rows(spark, job):
    rows = job.table(schemas.LOANS_TABLE).count()
    for name, value in COST_BASED.items():
        spark.conf.set(name, value)
    try:
        text = cost(job.table(schemas.LOANS_TABLE))
    finally:
        for name in COST_BASED:
            spark.conf.unset(name)
    assert f"rowCount={rows / 10 ** (len(str(rows)) - 1):.2f}E+{len(str(rows)) - 1}" in text


def test_statistics_order_the_joins(spark, job):
    """The two large tables are not joined first, although the query says so."""
    job.analyze(schemas.LOANS_TABLE, schemas.PAYMENTS_TABLE)
    job.analyze(schemas.ULTRA_RISK_TABLE, columns=(KEY, "total_acc"))

    def joined():
        few = job.table(schemas.ULTRA_RISK_TABLE).where("total_acc = 7").select(KEY)
        loans = job.table(schemas.LOANS_TABLE).select(KEY, "loan_amnt")
        return loans.join(job.table(schemas.PAYMENTS_TABLE).select(KEY, "total_pymnt"), KEY).join(few, KEY)

    def joined_last(df):
        tree = df._jdf.queryExecution().optimizedPlan().toString()
        depths = {name: len(before) for before, name in re.findall(r"^(.*)Relation spark_catalog\.default\.w_(\w+)", tree, re.M)}
        return min(depths, key=depths.get)

    assert joined_last(joined()) == schemas.ULTRA_RISK_TABLE
    rows = sorted(map(tuple, joined().collect()))
    try:
        for name, value in COST_BASED.items():
            spark.conf.set(name, value)
        assert joined_last(joined()) != schemas.ULTRA_RISK_TABLE
        assert rows == sorted(map(tuple, joined().collect())) != []
    finally:
        for name in COST_BASED:
            spark.conf.unset(name)


LINES = [
    "a,b,c",
    "1,2.5,x",
    "2,lots,y",
    "3,3.5",
    "4,4.5,z,more",
    '5,5.5,"u, v"',
    ",,",
]


def ingest(spark, tmp_path, share):
    job = Job(spark, str(tmp_path / "job"), 2, prefix=f"in_{tmp_path.name}_")
    path = tmp_path / "lines.csv"
    path.write_text("\n".join(LINES) + "\n")
    job.ingest(str(path), max_bad_share=share, schema="a int, b double, c string")
    return job


def test_lines_that_do_not_parse_are_kept_apart(spark, tmp_path):
    job = ingest(spark, tmp_path, 0.5)
    assert sorted(map(tuple, job.ingested().collect()), key=str) == [
        (1, 2.5, "x"), (5, 5.5, "u, v"), (None, None, None),
    ]
    found = job.quarantined().collect()
    assert sorted(row.rejected_line for row in found) == ["2,lots,y", "3,3.5", "4,4.5,z,more"]
    assert {row.source_file.rsplit("/", 1)[1] for row in found} == {"lines.csv"}
    assert job.check_values()["ingested"] == {"lines": 6, "bad_lines": 3}
    assert "PartitionFilters: [isnotnull(quarantined" in explain(job.ingested())


def test_a_file_with_too_many_bad_lines_is_refused(spark, tmp_path):
    job = Job(spark, str(tmp_path / "job"), 2, prefix=f"in_{tmp_path.name}_")
    with pytest.raises(TooManyBadLines, match="3 of 6 lines"):
        ingest(spark, tmp_path, 0.4)
    assert job.quarantined().count() == 3  # still there to look at


def test_ingested_loans_run_through_the_job(spark, loans, tmp_path):
    path = str(tmp_path / "csv")
    rows = loans(*({"zip_code": f"{i}xx", "loan_amnt": float(i)} for i in range(200)))
    broken = F.expr("if(loan_amnt = 7, 'lots', cast(loan_amnt AS string))")
    writers.write_csv(rows.withColumn("loan_amnt", broken), path, nullValue="NULL")
    job = Job(spark, str(tmp_path / "job"), 2, prefix="thru_")
    job.run(job.ingest(path, nullValue="NULL"))
    assert job.check_values()["deduplicated"] == {"row_count": 199}
    assert count(job.ingested(), "Exchange") == 0
    job.drop()
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("thru_")] == []
    assert not any(path.suffix == ".parquet" for path in (tmp_path / "job").rglob("*"))


# --- means -----------------------------------------------------------------------------


def mean(spark, values, partitions=1):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)
    return df.selectExpr(f"{stats.exact_mean('x')} AS m").first().m


def test_a_mean_does_not_depend_on_partitions(spark):
    df = spark.range(100_000).selectExpr("round(rand(7) * 40, 2) + id % 3 * 1e9 AS dti")
    found = {
        stats.dti_mean(df.repartition(n, F.rand(n))).first()[0].hex() for n in (1, 3, 16)
    }
    assert len(found) == 1


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([], None),
        ([None], None),
        ([1.0, None, 2.0], 1.5),
        ([0.1] * 10, 0.1),
        ([1.0, math.nan], math.nan),
        ([1.0, math.inf], math.inf),
        ([math.inf, -math.inf], math.nan),
        ([1e30, 3e30], 2e30),
        ([9e22] * 3, 9e22),
    ],
)
def test_means_of_special_values(spark, values, expected):
    found = mean(spark, values)
    assert found == expected or (expected is not None and math.isnan(expected) and math.isnan(found))
