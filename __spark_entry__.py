"""

Every query takes the session and a directory of star-schema tables, derives
the loan table from ``orders`` and ``customer`` there, and runs one step of the
credit job over all of it.
"""

from __future__ import annotations

import importlib
import sys
import uuid
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle  # noqa: E402
from loan_view import loan_view  # noqa: E402
from credmill import schemas  # noqa: E402
from credmill.functions import text  # noqa: E402
from credmill.operators import clean, join, keys, quality, score, stats  # noqa: E402
from credmill.plans import single_pass  # noqa: E402
from credmill.plans.batch_job import Job, buckets_for  # noqa: E402
from credmill.schemas import KEY  # noqa: E402
from credmill.sources import readers, writers  # noqa: E402
from credmill.sources.scratch import shared_dir  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

# The time of the run differs every time; a fixed one can be compared.
AS_OF = datetime(2020, 1, 2, 12)
# Fewest buckets of the job's tables.
BUCKETS = 8
# Bytes of a wide loan row in memory, and loans whose wide rows one task computes: a minute of work.
ROW_BYTES = 1 << 10
TASK_ROWS = 100_000
FLAGSHIP_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Members per credit grade."""
    return queries()["grade_counts"](spark, FLAGSHIP_DIR)


# --- inputs of the steps ---------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str) -> int:
    """Number of orders; the footers of the files hold it."""
    return readers.read_parquet(spark, f"{sf_dir}/orders.parquet").count()


def _loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan table; its file cannot be split, so its rows are spread.  The number of
    partitions grows with the rows, so a task computes no more of them from a larger table."""
    tasks = -(-_orders(spark, sf_dir) // TASK_ROWS)
    return loan_view(spark, sf_dir, max(spark.sparkContext.defaultParallelism, tasks))


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.with_member_key(_loans(spark, sf_dir))


def _unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.exclude_duplicates(_keyed(spark, sf_dir))


def _borrower(spark, sf_dir):
    return clean.split_borrower(_unique(spark, sf_dir))


def _loan(spark, sf_dir):
    return clean.split_loan(_unique(spark, sf_dir))


def _payment(spark, sf_dir):
    return clean.split_payment(_unique(spark, sf_dir))


def _risk(spark, sf_dir):
    return clean.split_risk(_unique(spark, sf_dir))


def _dti(spark, sf_dir):
    """Key and dti of the unambiguous rows: numbers only, so one hash aggregate."""
    return keys.unique_values(_keyed(spark, sf_dir).select(KEY, "dti"))


def _dti_mean(spark, sf_dir):
    return single_pass.dti_mean(_keyed(spark, sf_dir))


def _customers(spark, sf_dir):
    unique, means = single_pass.unique_and_means(_keyed(spark, sf_dir))
    borrower = clean.split_borrower(unique)
    return clean.clean_borrower(borrower, average=means["avg_emp_length"]).drop("ingestion_date")


def _clean_loan(spark, sf_dir):
    return clean.clean_loan(_loan(spark, sf_dir))


def _clean_payment(spark, sf_dir):
    return clean.clean_payment(_payment(spark, sf_dir))


def _clean_risk(spark, sf_dir):
    unique, means = single_pass.unique_and_means(_keyed(spark, sf_dir))
    return clean.clean_risk(clean.split_risk(unique), mean=means["dti_mean"], unique_keys=True)


def _filled_risk(spark, sf_dir):
    unique, means = single_pass.unique_and_means(_keyed(spark, sf_dir))
    return clean.fill_risk(clean.split_risk(unique), mean=means["dti_mean"])


def _filled_dti(spark, sf_dir):
    filled = clean.with_mean(_dti(spark, sf_dir), _dti_mean(spark, sf_dir))
    return filled.selectExpr(KEY, f"{clean.filled_dti()} AS dti")


def _crunched(spark, sf_dir):
    return single_pass.crunched(_keyed(spark, sf_dir)).drop("ingestion_date")


def _members(spark, sf_dir):
    return single_pass.score_members(_keyed(spark, sf_dir))


def _eligible(spark, sf_dir):
    return score.valid_utilization(score.drop_critical_nulls(_members(spark, sf_dir)))


def _graded(spark, sf_dir):
    return single_pass.graded(_keyed(spark, sf_dir))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Means differ in the last bits with the order of summation."""
    return df.withColumns({name: F.round(name, 6) for name in names})


# --- queries that write and read back -----------------------------------------------


def _csv_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "csv")
    writers.write_csv(_loans(spark, sf_dir), path, nullValue="NULL")
    return readers.read_loans_csv(spark, path, nullValue="NULL")


def _parquet_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "parquet")
    writers.write_parquet(_loans(spark, sf_dir), path)
    return readers.read_parquet(spark, path)


def _declared_schema_scan(spark, sf_dir):
    path = shared_dir(spark, "borrower_info")
    writers.write_parquet(_borrower(spark, sf_dir), path)
    return readers.read_parquet(spark, path, schemas.BORROWER_SCHEMA)


def _path_scan(spark, sf_dir):
    path = shared_dir(spark, "payment_recovery")
    writers.write_parquet(_payment(spark, sf_dir), path)
    return readers.read_path(spark, path, "parquet")


def _table_roundtrip(spark, sf_dir):
    name = f"keyed_loans_{uuid.uuid4().hex}"
    writers.write_table(_keyed(spark, sf_dir), name, shared_dir(spark, name))
    return readers.read_table(spark, name)


def _temp_view(spark, sf_dir):
    writers.register_view(_unique(spark, sf_dir))
    return spark.sql(f"SELECT * FROM {schemas.DEDUPED_VIEW}")


def _write_grades(spark, sf_dir):
    name = f"graded_{uuid.uuid4().hex}"
    writers.write_graded(_graded(spark, sf_dir), name, shared_dir(spark, name))
    return name


def _grade_partition_read(spark, sf_dir):
    table = readers.read_table(spark, _write_grades(spark, sf_dir))
    return writers.read_grade(table, "good").select(KEY, "credit_score", "credit_grade")


def _grade_views(spark, sf_dir):
    name = _write_grades(spark, sf_dir)
    views = writers.create_grade_views(spark, name, pattern=name + "_{grade}")
    first, *others = (
        readers.read_table(spark, view)
        .groupBy("credit_grade")
        .agg(F.count(F.lit(1)).alias("members"))
        for view in views
    )
    for other in others:
        first = first.unionAll(other)
    return first


def _job(spark, sf_dir) -> Job:
    """A job with as many buckets as the wide rows need."""
    name = f"run_{uuid.uuid4().hex}_"
    buckets = max(BUCKETS, buckets_for(_orders(spark, sf_dir) * ROW_BYTES))
    return Job(spark, shared_dir(spark, "job"), buckets, prefix=name)


def _full_run(spark, sf_dir):
    job = _job(spark, sf_dir)
    job.run(_loans(spark, sf_dir))
    return job.checks()["grades"]


def _stored(table: str, *layers: str) -> Query:
    """Rows that the job stored, from the layers needed for them."""

    def query(spark, sf_dir):
        job = _job(spark, sf_dir)
        job.stage(_loans(spark, sf_dir))
        for layer in layers:
            getattr(job, layer)()
        rows = job.table(table).drop("ingestion_date")
        return _rounded(rows, "dti") if "dti" in rows.columns else rows

    return query


def _stored_report(spark, sf_dir):
    """All report rows, read through the view of each grade."""
    job = _job(spark, sf_dir)
    job.run(_loans(spark, sf_dir))
    first, *others = (job.grade(grade) for grade in schemas.GRADES)
    for other in others:
        first = first.unionByName(other)
    return _rounded(first.drop("ingestion_date"), "dti")


def _csv_inferred(spark, sf_dir):
    """A CSV file read with inferred types."""
    path = shared_dir(spark, "csv")
    orders = readers.read_parquet(spark, f"{sf_dir}/orders.parquet")
    rows = orders.selectExpr("o_orderkey AS k", "o_totalprice AS amount", "o_orderpriority AS label")
    writers.write_csv(rows, path)
    return readers.read_loans_csv(spark, path, schema=None).selectExpr(
        "cast(k AS bigint) AS k", "amount", "label"
    )


def _ingest(spark, sf_dir) -> Job:
    """A job that took in a CSV file in which some loan amounts are no numbers."""
    path = shared_dir(spark, "csv")
    broken = "if(cast(loan_amnt AS bigint) % 40 = 7, 'lots', cast(loan_amnt AS string))"
    lines = _loans(spark, sf_dir).withColumn("loan_amnt", F.expr(broken))
    writers.write_csv(lines, path, nullValue="NULL")
    job = _job(spark, sf_dir)
    job.ingest(path, max_bad_share=0.05, nullValue="NULL")
    return job


def _ingested_loans(spark, sf_dir):
    return _ingest(spark, sf_dir).ingested()


def _quarantined_lines(spark, sf_dir):
    """The lines are whole: fields behind the broken one can still be read from them."""
    fields = F.from_csv(
        "rejected_line",
        ", ".join(f"`{name}` string" for name in _loans(spark, sf_dir).columns),
        {"nullValue": "NULL"},
    )
    lines = _ingest(spark, sf_dir).quarantined().select(fields.alias("line"))
    return lines.selectExpr(
        "count(1) AS lines",
        "sum(cast(cast(line.total_pymnt AS double) AS bigint)) AS total_paid",
        "count(DISTINCT line.purpose) AS purposes",
    )


def _observed_checks(spark, sf_dir):
    """What was observed while the job wrote its tables; nothing is read again."""
    job = _job(spark, sf_dir)
    job.stage(_loans(spark, sf_dir))
    job.land()
    job.crunch()
    found = {
        f"{check}.{name}": value
        for check, values in job.check_values().items()
        for name, value in values.items()
    }
    pairs = ", ".join(f"('{name}', cast({value!r} AS double))" for name, value in found.items())
    return spark.sql(f"SELECT name, round(value, 4) AS value FROM VALUES {pairs} AS t(name, value)")


def _stored_member_lookup(spark, sf_dir):
    job = _job(spark, sf_dir)
    job.stage(_loans(spark, sf_dir))
    smallest = job.table("loan_details").selectExpr(f"min({KEY})").first()[0]
    return job.member("loan_details", smallest)


def _replaced_table(spark, sf_dir):
    """The rows of the second version, which is computed from the first."""
    name = f"replaced_{uuid.uuid4().hex}"
    path = shared_dir(spark, name)
    writers.write_table(_keyed(spark, sf_dir), name, path)
    unique = keys.exclude_duplicates(readers.read_table(spark, name))
    writers.write_table(clean.split_borrower(unique), name, path)
    return readers.read_table(spark, name)


def _rebalanced_files(spark, sf_dir):
    path = shared_dir(spark, "rebalanced")
    writers.write_parquet(_risk(spark, sf_dir), path, rebalance=(), find_by=KEY)
    return readers.read_parquet(spark, path)


# --- the other queries that take more than one call ------------------------------------


def _member_lookup(spark, sf_dir):
    keyed = _keyed(spark, sf_dir)
    return keys.member_lookup(keyed, keys.most_copied_key(keyed).scalar())


def _emp_length_years(spark, sf_dir):
    return _customers(spark, sf_dir).select(KEY, "emp_length_in_years")


def _ingestion_date(spark, sf_dir):
    stamp = clean.ingestion_values(AS_OF)["ingestion_date"]
    return _borrower(spark, sf_dir).selectExpr(KEY, f"date({stamp}) AS ingestion_date")


def _joined(spark, sf_dir):
    """Split, clean and join, over rows that were de-duplicated and stored in buckets."""
    rows = _job(spark, sf_dir).deduplicate(_loans(spark, sf_dir))
    risk = clean.clean_risk(clean.split_risk(rows), unique_keys=True)
    joined = join.crunched(
        clean.known_delinquency(risk),
        clean.clean_borrower(clean.split_borrower(rows)),
        clean.clean_loan(clean.split_loan(rows)),
        clean.clean_payment(clean.split_payment(rows)),
    )
    return _rounded(joined.drop("ingestion_date"), "dti")


def _impute_unfiltered(spark, sf_dir):
    members = _members(spark, sf_dir)
    return score.impute_income(members).select(KEY, "annual_inc")


def _complete_report(spark, sf_dir, *steps):
    rows = _crunched(spark, sf_dir)
    for step in steps:
        rows = step(rows)
    return _rounded(rows, "dti")


def _factor(name: str) -> Query:
    return lambda spark, sf_dir: _graded(spark, sf_dir).select(KEY, name)


def _grade(grade: str) -> Query:
    def query(spark, sf_dir):
        rows = writers.read_grade(_graded(spark, sf_dir), grade)
        return rows.select(KEY, "credit_score", "credit_grade")

    return query


def _llm(name: str) -> dict:
    """What the subpackage and the pipeline add; nothing where they are not installed."""
    try:
        pipeline = importlib.import_module("corpus_pipeline")
        registry = importlib.import_module("credmill.llm.registry")
    except ModuleNotFoundError as missing:
        if str(missing.name).split(".")[:2] in (["credmill", "llm"], ["corpus_pipeline"]):
            return {}
        raise
    return getattr(registry, name)() | getattr(pipeline, name)()


def queries() -> dict[str, Query]:
    table: dict[str, Query] = {
        # sources and sinks
        "csv_roundtrip": _csv_roundtrip,
        "parquet_roundtrip": _parquet_roundtrip,
        "declared_schema_scan": _declared_schema_scan,
        "path_scan": _path_scan,
        "table_roundtrip": _table_roundtrip,
        "temp_view": _temp_view,
        "grade_partition_read": _grade_partition_read,
        "grade_views": _grade_views,
        "full_run": _full_run,
        # keys
        "key_subset": lambda s, d: keys.key_columns(_loans(s, d)),
        "member_key": _keyed,
        "key_counts": lambda s, d: keys.key_counts(_keyed(s, d)),
        "dup_keys": lambda s, d: keys.duplicate_keys(_keyed(s, d)),
        "dup_keys_sorted": lambda s, d: keys.duplicate_keys_sorted(_keyed(s, d)),
        "member_lookup": _member_lookup,
        "dedupe_exclude": _unique,
        "dedupe_numbers": lambda s, d: keys.unique_values(
            single_pass.score_inputs(_keyed(s, d))
        ),
        # splits
        "split_borrower": _borrower,
        "split_loan": _loan,
        "split_payment": _payment,
        "split_risk": _risk,
        # borrowers
        "borrower_clean": _customers,
        "positive_income": lambda s, d: clean.positive_income(_borrower(s, d)),
        "title_case_employer": lambda s, d: _borrower(s, d).selectExpr(
            KEY, f"{text.title_case('emp_title')} AS emp_title"
        ),
        "fill_title": lambda s, d: _borrower(s, d).selectExpr(
            KEY, f"{clean.employer_title()} AS emp_title"
        ),
        "emp_length_digits": lambda s, d: _borrower(s, d).selectExpr(
            KEY, f"{text.digits('emp_length')} AS emp_length"
        ),
        "emp_length_years": _emp_length_years,
        "add_country": lambda s, d: _borrower(s, d).selectExpr(
            KEY, f"{clean.ingestion_values()['country']} AS country"
        ),
        "ingestion_date": _ingestion_date,
        # loans
        "loan_clean": _clean_loan,
        "term_months": lambda s, d: _clean_loan(s, d).select(KEY, "tenure_period_in_month"),
        "int_rate_pct": lambda s, d: _clean_loan(s, d).select(
            KEY, "interest_rate_in_percentage"
        ),
        "issue_date": lambda s, d: _clean_loan(s, d).select(KEY, "issued_date"),
        "title_case_purpose": lambda s, d: _clean_loan(s, d).select(KEY, "purpose"),
        "drop_cols_loan": lambda s, d: _loan(s, d).drop(*schemas.LOAN_DROPS),
        "rename_cols": lambda s, d: _loan(s, d).withColumnsRenamed(schemas.LOAN_RENAMES),
        # payments
        "payment_clean": _clean_payment,
        "payment_dates": lambda s, d: _clean_payment(s, d).select(
            KEY, *schemas.PAYMENT_RENAMES.values()
        ),
        # risk
        "risk_clean": lambda s, d: _rounded(_clean_risk(s, d), "dti"),
        "risk_ultra": lambda s, d: _rounded(
            clean.known_delinquency(_clean_risk(s, d)), "dti"
        ),
        "fill_risk": lambda s, d: _rounded(_filled_risk(s, d), "dti"),
        "credit_line_date": lambda s, d: _clean_risk(s, d).select(KEY, "earliest_cr_line"),
        "distinct_risk": lambda s, d: stats.distinct_rows(_risk(s, d).drop(KEY)),
        "revol_util_pct": lambda s, d: _clean_risk(s, d).select(
            KEY, "revol_util_in_percentage"
        ),
        "drop_cols_risk": lambda s, d: _risk(s, d).drop(*schemas.RISK_DROPS),
        "known_delinquency": lambda s, d: _rounded(
            clean.known_delinquency(_filled_risk(s, d)), "dti"
        ),
        # statistics
        "avg_emp_length": lambda s, d: single_pass.means(_keyed(s, d)).select("avg_emp_length"),
        "dti_mean_raw": lambda s, d: stats.dti_mean(_dti(s, d)),
        "dti_mean": lambda s, d: _rounded(stats.dti_mean(_filled_dti(s, d)), "dti_mean"),
        "dti_stddev": lambda s, d: _rounded(stats.dti_stddev(_filled_dti(s, d)), "dti_stddev"),
        "dti_spread": lambda s, d: _rounded(
            stats.dti_spread(_filled_dti(s, d)), "dti_mean", "dti_stddev"
        ),
        "fill_means": lambda s, d: single_pass.means(_keyed(s, d)),
        "median_income": lambda s, d: stats.median_income(_eligible(s, d)),
        "median_income_customers": lambda s, d: stats.median_income(
            clean.positive_income(
                keys.unique_values(_keyed(s, d).select(KEY, "annual_inc"))
            )
        ),
        "impute_income": lambda s, d: score.impute_income(_eligible(s, d)).select(
            KEY, "annual_inc"
        ),
        "impute_income_unfiltered": _impute_unfiltered,
        "title_frequency": lambda s, d: stats.title_frequency(_customers(s, d)),
        "row_counts": lambda s, d: single_pass.row_counts(_keyed(s, d)),
        # quality
        "zip_anomaly": lambda s, d: quality.zip_anomaly(_customers(s, d)),
        "state_anomaly": lambda s, d: quality.state_anomaly(_customers(s, d)),
        "payment_identity": lambda s, d: quality.payment_identity(_clean_payment(s, d)),
        "investor_gap": lambda s, d: _rounded(
            quality.investor_gap(_clean_payment(s, d)), "mean_gap", "largest_gap"
        ),
        "principal_interest_share": lambda s, d: _rounded(
            quality.principal_interest_share(_clean_payment(s, d)), "share"
        ).selectExpr(
            "round(principal_and_interest, 2) AS principal_and_interest",
            "round(total_paid, 2) AS total_paid",
            "share",
        ),
        # what the job stores
        "landed_customers": _stored(schemas.CUSTOMERS_TABLE, "land"),
        "landed_loans": _stored(schemas.LOANS_TABLE, "land"),
        "landed_payments": _stored(schemas.PAYMENTS_TABLE, "land"),
        "landed_risk": _stored(schemas.RISK_TABLE, "land"),
        "landed_ultra_risk": _stored(schemas.ULTRA_RISK_TABLE, "land"),
        "stored_crunched": _stored(schemas.CRUNCHED_TABLE, "land", "crunch"),
        "stored_report": _stored_report,
        "csv_inferred": _csv_inferred,
        "ingested_loans": _ingested_loans,
        "quarantined_lines": _quarantined_lines,
        "observed_checks": _observed_checks,
        "stored_member_lookup": _stored_member_lookup,
        "replaced_table": _replaced_table,
        "rebalanced_files": _rebalanced_files,
        # join and filters
        "crunched": _joined,
        "crunched_projection": _complete_report,
        "drop_critical_nulls": lambda s, d: _complete_report(s, d, score.drop_critical_nulls),
        "valid_utilization": lambda s, d: _complete_report(
            s, d, score.drop_critical_nulls, score.valid_utilization
        ),
    }
    # scores and grades
    table.update({name: _factor(name) for name in schemas.SCORE_COLUMNS})
    table["total_score"] = _factor("total_score")
    table["credit_score"] = lambda s, d: _graded(s, d).select(
        KEY, "total_score", "credit_score"
    )
    table["credit_grade"] = lambda s, d: _graded(s, d).select(
        KEY, "credit_score", "credit_grade"
    )
    table.update({f"grade_{grade}": _grade(grade) for grade in schemas.GRADES})
    table["graded_report"] = lambda s, d: _complete_report(s, d, score.graded)
    table["grade_counts"] = lambda s, d: score.grade_counts(_graded(s, d))
    return table | _llm("queries")


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql() | _llm("oracle_sql")
