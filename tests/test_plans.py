"""Equality of the plans with each other, and what their physical plans avoid."""

from __future__ import annotations

import re
from contextlib import contextmanager
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from credmill import schemas
from credmill.operators import clean, join, keys, score, stats
from credmill.plans import single_pass
from credmill.plans.batch_job import DEDUPED_TABLE, Job
from credmill.schemas import KEY
from loan_view import loan_view
from tests.plans import count, explain

AS_OF = datetime(2020, 1, 1)

# Rows per stage and members per grade of the loan view at the smallest scale.
STAGES = {
    "raw": 1530, "deduplicated": 1468, "customers": 1316, "joined": 714,
    "complete": 635, "scored": 564,
}
GRADES = {"very_good": 53, "good": 88, "medium": 147, "bad": 111, "very_bad": 165}


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__enabled": "false",
}


def rows(df):
    """All rows as sorted text; a mean depends on the order of summation."""
    df = df.withColumn("dti", F.round("dti", 6)) if "dti" in df.columns else df
    columns = sorted(df.columns)
    return sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())


@pytest.fixture(scope="module")
def keyed(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("loans") / "loans")
    loan_view(spark, sf_dir).write.parquet(path)
    return keys.with_member_key(spark.read.parquet(path))


@pytest.fixture(scope="module")
def job(spark, sf_dir, tmp_path_factory):
    job = Job(spark, str(tmp_path_factory.mktemp("job")), prefix="t_", buckets=4, as_of=AS_OF)
    with settings(spark, **NO_BROADCAST):
        job.run(loan_view(spark, sf_dir))
    return job


def joined(keyed):
    unique = keys.exclude_duplicates(keyed)
    return join.crunched(
        clean.known_delinquency(clean.clean_risk(clean.split_risk(unique))),
        clean.clean_borrower(clean.split_borrower(unique), as_of=AS_OF),
        clean.clean_loan(clean.split_loan(unique)),
        clean.clean_payment(clean.split_payment(unique)),
    )


def test_single_pass_equals_the_joins(keyed):
    fused = single_pass.crunched(keyed, as_of=AS_OF)
    assert fused.columns == list(schemas.CRUNCHED_COLUMNS)
    assert fused.dtypes == joined(keyed).dtypes
    assert rows(fused) == rows(joined(keyed))


def test_stage_counts(keyed):
    counts = {r.stage: r.row_count for r in single_pass.row_counts(keyed).collect()}
    assert counts == STAGES


def test_grades(keyed):
    graded = single_pass.graded(keyed).select(KEY, "total_score", "credit_score", "credit_grade")
    members = graded.collect()
    counts = {g: sum(m.credit_grade == g for m in members) for g in schemas.GRADES}
    assert counts == GRADES
    assert len({m[KEY] for m in members}) == len(members)
    assert all(m.total_score % 25 == 0 and 300 <= m.credit_score <= 850 for m in members)
    wide = score.graded(single_pass.crunched(keyed)).select(*graded.columns)
    assert rows(wide) == rows(graded)


def test_join_partners_may_be_missing(loans):
    """No customer, no loan and no payment row for a risk row."""
    keyed = keys.with_member_key(loans({"zip_code": "1"}, {"zip_code": "2"}))
    risk = clean.clean_risk(clean.split_risk(keyed))
    others = [
        clean.clean_borrower(clean.split_borrower(keyed)),
        clean.clean_loan(clean.split_loan(keyed)),
        clean.clean_payment(clean.split_payment(keyed)),
    ]
    for position in range(3):
        sides = list(others)
        sides[position] = sides[position].limit(0)
        out = join.crunched(risk, *sides)
        assert out.count() == 2
        complete = score.drop_critical_nulls(out).count()
        assert complete == (2 if position == 2 else 0)


def test_edge_rows_through_both_plans(loans):
    keyed = keys.with_member_key(
        loans(
            {"zip_code": "1", "annual_inc": None},
            {"zip_code": "2", "annual_inc": 0.0},
            {"zip_code": "3", "dti": None, "emp_length": "n/a"},
            {"zip_code": "4", "dti": float("nan"), "emp_length": None},
            {"zip_code": "5", "mths_since_last_delinq": None},
            {"zip_code": "6", "revol_util": ""},
            {"zip_code": "7", "revol_util": "100.1%"},
            {"zip_code": "8", "emp_title": "", "purpose": ""},
            {"zip_code": "9"},
            {"zip_code": "9"},
        )
    )
    assert rows(single_pass.crunched(keyed, as_of=AS_OF)) == rows(joined(keyed))
    members = {
        r.zip_code
        for r in score.graded(single_pass.crunched(keyed)).select("zip_code").collect()
    }
    # A NaN makes the mean NaN, so neither filled row has a dti.
    assert members == {"8"}


# --- physical plans ------------------------------------------------------------------


def test_scores_stay_in_generated_code(keyed):
    plan = single_pass.graded(keyed)
    text = explain(plan)
    assert "Python" not in text
    plan.collect()
    assert "ReusedExchange" in explain(plan)  # the rows and the mean of dti share a shuffle
    assert count(plan, "SortMergeJoin") == count(plan, "Sort") == 0
    assert "CollectLimit" not in text


def test_scan_reads_the_needed_columns_only(keyed):
    text = explain(keys.key_counts(keyed))
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert schema.count(":") - 1 == len(schemas.KEY_COLUMNS)


def test_cleaning_has_no_python_and_no_shuffle(spark, job):
    for df in (
        clean.clean_loan(job.table("loan_details")),
        clean.clean_payment(job.table("payment_recovery")),
    ):
        assert "Python" not in explain(df)
        assert count(df, "Exchange") == 0


def test_income_filter_reaches_the_files(job):
    text = explain(clean.positive_income(job.table("borrower_info")))
    assert "GreaterThan(annual_inc,0.0)" in text


def test_critical_filter_turns_outer_joins_inner(spark, job):
    with settings(spark, **NO_BROADCAST):
        df = score.drop_critical_nulls(
            join.crunched(
                job.table(schemas.ULTRA_RISK_TABLE),
                job.table(schemas.CUSTOMERS_TABLE),
                job.table(schemas.LOANS_TABLE),
                job.table(schemas.PAYMENTS_TABLE),
            )
        )
        text = explain(df)
    assert text.count("Join type: Inner") == 2
    assert text.count("Join type: LeftOuter") == 1  # payments hold no critical column


def test_landed_tables_join_without_a_shuffle(spark, job):
    with settings(spark, **NO_BROADCAST):
        df = join.crunched(
            job.table(schemas.ULTRA_RISK_TABLE),
            job.table(schemas.CUSTOMERS_TABLE),
            job.table(schemas.LOANS_TABLE),
            job.table(schemas.PAYMENTS_TABLE),
        )
        assert count(df, "SortMergeJoin") == 3
        assert count(df, "Exchange") == 0


def test_four_table_join_shuffles_each_side_once_at_most(spark, keyed):
    with settings(spark, **NO_BROADCAST):
        plan = joined(keyed)
        assert count(plan, "BroadcastNestedLoopJoin") == count(plan, "CartesianProduct") == 0


def test_hot_keys_are_dropped_before_the_shuffle(spark):
    """The broadcast of hot keys sits below the exchange of the wide rows."""
    keyed = spark.range(100).selectExpr(f"cast(id AS string) AS {KEY}", "id AS payload")
    with settings(spark, **NO_BROADCAST):
        text = explain(keys.exclude_duplicates(keyed, partitions=4))
    tree = text[: text.index("\n\n\n")]
    order = [
        word
        for word in re.findall(r"SortMergeJoin|BroadcastHashJoin|BroadcastExchange|Exchange", tree)
    ]
    assert order[:3] == ["SortMergeJoin", "Exchange", "BroadcastHashJoin"]
    assert text.count("ReusedExchange") >= 1  # one count serves filter and join


def test_unique_rows_pass_the_filter_in_place(spark):
    """Rows that miss the filter are never shuffled; only keys and suspects are."""
    keyed = spark.range(6000).selectExpr(
        f"coalesce(cast(if(id < 300, id % 100, id) AS string), '') AS {KEY}", "repeat('x', 100) AS payload"
    )
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        kept = keys.exclude_duplicates(keyed)
        assert kept.count() == 5700
        assert shuffled(spark, keys.exclude_duplicates(keyed))[-2:] == [300, 5800]
        everything = keys.exclude_duplicates(keyed, words=1)
        assert shuffled(spark, everything)[-2:] == [5800, 6000]
        assert everything.count() == 5700


def shuffled(spark, df):
    """Records that each exchange of a query wrote, ascending."""
    df.write.format("noop").mode("overwrite").save()
    store = spark._jsparkSession.sharedState().statusStore()
    execution = store.executionsList().last().executionId()
    values, nodes = store.executionMetrics(execution), store.planGraph(execution).allNodes()
    found = []
    for i in range(nodes.size()):
        node = nodes.apply(i)
        metrics = node.metrics()
        for j in range(metrics.size()):
            metric = metrics.apply(j)
            if node.name() == "Exchange" and metric.name() == "shuffle records written":
                if values.contains(metric.accumulatorId()):
                    found.append(int(values.apply(metric.accumulatorId()).replace(",", "")))
    return sorted(found)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_one_aggregate_per_key_serves_rows_and_means(spark, keyed, adaptive):
    """Keys, filter, join and both means read one shuffle; the wide rows are read twice."""
    with settings(spark, spark__sql__adaptive__enabled=adaptive):
        df = single_pass.crunched(keyed)
        df.collect()
        text = explain(df)
    final = text[: text.index("== Initial Plan")] if "== Initial Plan" in text else text
    scans = re.findall(r"^\(\d+\) Scan parquet", text, re.M)
    schemas_read = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    narrow = {line for line in schemas_read if line.count(":") < 15}
    wide = {line for line in schemas_read if line.count(":") >= 15}
    assert len(narrow) == 1 and len(wide) >= 1
    assert len(scans) <= 6
    assert "ReusedExchange" in final


# --- the whole job ------------------------------------------------------------------


def test_job_equals_the_single_pass(job, keyed):
    crunched = single_pass.crunched(keyed, as_of=AS_OF)
    assert rows(job.table(schemas.CRUNCHED_TABLE)) == rows(crunched)
    report = job.table(schemas.REPORT_TABLE)
    assert rows(report) == rows(score.graded(crunched))


def test_job_checks(job):
    checks = job.checks()
    assert checks["zip_anomaly"].first()[0] == 13
    assert checks["state_anomaly"].first()[0] == 15
    spread = checks["dti_spread"].first()
    assert round(spread.dti_mean, 6) == 20.328803
    assert round(spread.dti_stddev, 6) == 11.343621
    assert checks["deduplicated"].first()[0] == STAGES["deduplicated"]
    assert checks["joined"].first()[0] == STAGES["joined"]
    assert {r.credit_grade: r.members for r in checks["grades"].collect()} == GRADES
    assert {g: job.grade(g).count() for g in schemas.GRADES} == GRADES


def test_job_writes_one_file_per_bucket(job):
    from pathlib import Path

    for table in (DEDUPED_TABLE, *schemas.SPLITS):
        files = list(Path(job.path("staging", table)).glob("v*/*.parquet"))
        assert 0 < len(files) <= 4, table


def test_tables_can_have_other_names(spark, tmp_path):
    job = Job(spark, str(tmp_path), 4, prefix="db.", names={schemas.CRUNCHED_TABLE: "loans_joined"})
    assert job.name(schemas.CRUNCHED_TABLE) == "db.loans_joined"
    assert job.name(schemas.LOANS_TABLE) == f"db.{schemas.LOANS_TABLE}"


def test_job_can_run_again(spark, job, sf_dir):
    job.run(loan_view(spark, sf_dir))
    assert stats.row_count(job.table(schemas.REPORT_TABLE)).first()[0] == STAGES["scored"]
