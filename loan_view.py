"""A loan-shaped table derived from the ``orders`` and ``customer`` tables.

It stands in for the loan file wherever only the star-schema tables are at
hand.  The column expressions are plain SQL that means the same in Spark and in
other engines, so an oracle can use the very same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credmill.functions.columns import aliased
from credmill.sources.readers import read_parquet

ORDERS_SCHEMA = """
    o_orderkey bigint, o_custkey bigint, o_orderstatus string,
    o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string
"""
CUSTOMER_SCHEMA = """
    c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string
"""

_MONTHS = "'JanFebMarAprMayJunJulAugSepOctNovDec'"

BASE_COLUMNS = {
    "k": "o_orderkey",
    "c_acctbal": "c_acctbal",
    "c_nationkey": "c_nationkey",
    "c_mktsegment": "c_mktsegment",
    "o_orderstatus": "o_orderstatus",
    "o_orderpriority": "o_orderpriority",
    "o_totalprice": "o_totalprice",
    "o_orderdate": "o_orderdate",
    "h1": "(o_orderkey * 7919) % 104729",
    "h2": "(o_orderkey * 15485863) % 1299709",
    "h3": "(o_orderkey * 32452843) % 2750159",
}

# Every 50th order appears twice; the copies differ in the loan amount only.
COPIED = "k % 50 = 0"

LOAN_EXPRESSIONS = {
    "emp_title": "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 17 = 0 THEN '' "
    "ELSE concat(lower(c_mktsegment), '_', substr(o_orderpriority, 3)) END",
    "emp_length": "CASE WHEN h1 % 13 = 0 THEN 'n/a' WHEN h1 % 13 = 1 THEN '< 1 year' "
    "WHEN h1 % 13 = 2 THEN '1 year' WHEN h1 % 13 = 3 THEN NULL "
    "WHEN h1 % 13 = 12 THEN '10+ years' "
    "ELSE concat(cast(h1 % 13 - 2 AS string), ' years') END",
    "home_ownership": "CASE o_orderstatus WHEN 'O' THEN 'OWN' WHEN 'F' THEN 'RENT' "
    "ELSE 'MORTGAGE' END",
    "annual_inc": "CASE WHEN k % 29 = 0 THEN NULL "
    "ELSE cast(floor(c_acctbal * 12) AS double) END",
    "verification_status": "CASE WHEN h2 % 3 = 0 THEN 'Verified' "
    "WHEN h2 % 3 = 1 THEN 'Source Verified' ELSE 'Not Verified' END",
    "zip_code": "concat(lpad(cast(c_nationkey * 37 AS string), 3, '0'), "
    "CASE WHEN k % 97 = 0 THEN 'xxxx' ELSE 'xx' END)",
    "addr_state": "CASE WHEN k % 89 = 0 THEN 'USA' "
    "ELSE substr('CANYTXFLILPAOHGANCMI', cast(1 + 2 * (c_nationkey % 10) AS int), 2) END",
    "loan_amnt": "cast(floor(o_totalprice / 10) + copy AS double)",
    "funded_amnt": "cast(floor(o_totalprice / 10) + copy AS double)",
    "funded_amnt_inv": "cast(floor(o_totalprice / 10) - (k % 3) AS double)",
    "term": "CASE WHEN h2 % 4 = 0 THEN ' 60 months' ELSE ' 36 months' END",
    "int_rate": "concat(cast(5 + h3 % 20 AS string), '.', "
    "lpad(cast(k % 100 AS string), 2, '0'), '%')",
    "installment": "cast(floor(o_totalprice / 360) AS double)",
    "grade": "substr('ABCDEFG', cast(1 + h3 % 7 AS int), 1)",
    "sub_grade": "concat(substr('ABCDEFG', cast(1 + h3 % 7 AS int), 1), "
    "cast(1 + k % 5 AS string))",
    "issue_d": f"concat(substr({_MONTHS}, cast(3 * month(o_orderdate) - 2 AS int), 3), "
    "'-', substr(cast(year(o_orderdate) + 20 AS string), 3, 2))",
    "loan_status": "CASE WHEN k % 8 = 0 THEN 'Charged Off' "
    "WHEN k % 8 < 3 THEN 'Fully Paid' ELSE 'Current' END",
    "pymnt_plan": "'n'",
    "purpose": "CASE WHEN h1 % 4 = 0 THEN 'debt_consolidation' "
    "WHEN h1 % 4 = 1 THEN 'credit_card' WHEN h1 % 4 = 2 THEN 'home_improvement' "
    "ELSE 'car' END",
    "title": "CASE WHEN h1 % 4 = 0 THEN 'Debt consolidation' ELSE 'Other' END",
    "total_pymnt": "cast(floor(o_totalprice / 20) + floor(o_totalprice / 50) "
    "+ 15 * (k % 4) AS double)",
    "total_pymnt_inv": "cast(floor(o_totalprice / 20) + floor(o_totalprice / 50) AS double)",
    "total_rec_prncp": "cast(floor(o_totalprice / 20) AS double)",
    "total_rec_int": "cast(floor(o_totalprice / 50) AS double)",
    "total_rec_late_fee": "cast(15 * (k % 4) AS double)",
    "recoveries": "CASE WHEN k % 8 = 0 THEN cast(floor(o_totalprice / 100) AS double) "
    "ELSE 0.0E0 END",
    "collection_recovery_fee": "CASE WHEN k % 8 = 0 "
    "THEN cast(floor(o_totalprice / 1000) AS double) ELSE 0.0E0 END",
    "last_pymnt_d": f"CASE WHEN k % 19 = 0 THEN NULL ELSE concat(substr({_MONTHS}, "
    "cast(3 * (1 + h1 % 12) - 2 AS int), 3), '-22') END",
    "last_pymnt_amnt": "cast(floor(o_totalprice / 360) AS double)",
    "next_pymnt_d": f"CASE WHEN k % 8 < 3 THEN NULL ELSE concat(substr({_MONTHS}, "
    "cast(3 * (1 + h2 % 12) - 2 AS int), 3), '-23') END",
    "dti": "CASE WHEN k % 31 = 0 THEN NULL ELSE cast(h1 % 400 AS double) / 10 END",
    "delinq_2yrs": "cast(CASE WHEN k % 37 = 0 THEN NULL WHEN h2 % 10 < 7 THEN 0 "
    "WHEN h2 % 10 < 9 THEN 1 ELSE 2 END AS int)",
    "earliest_cr_line": "concat(lpad(cast(1 + h3 % 12 AS string), 2, '0'), '/', "
    "cast(1985 + h1 % 30 AS string))",
    "inq_last_6mths": "cast(CASE WHEN k % 41 = 0 THEN NULL ELSE h1 % 4 END AS int)",
    "mths_since_last_delinq": "cast(CASE WHEN h3 % 2 = 0 THEN NULL "
    "ELSE h3 % 120 END AS int)",
    "mths_since_last_record": "cast(CASE WHEN h3 % 5 < 4 THEN NULL "
    "ELSE h2 % 120 END AS int)",
    "open_acc": "cast(h1 % 25 AS int)",
    "pub_rec": "cast(CASE WHEN k % 47 = 0 THEN NULL ELSE h2 % 3 END AS int)",
    "revol_bal": "cast((h2 % 200) * (h2 % 200) AS int)",
    "revol_util": "CASE WHEN k % 43 = 0 THEN NULL WHEN k % 53 = 0 THEN '' "
    "ELSE concat(cast(h3 % 108 AS string), '.', cast(k % 10 AS string), '%') END",
    "total_acc": "cast(h3 % 45 AS int)",
    "initial_list_status": "CASE WHEN k % 2 = 0 THEN 'w' ELSE 'f' END",
    "out_prncp": "CASE WHEN h1 % 2 = 0 THEN 0.0E0 ELSE cast(h2 % 8000 AS double) END",
    "out_prncp_inv": "CASE WHEN h1 % 2 = 0 THEN 0.0E0 ELSE cast(h2 % 8000 AS double) END",
}


# These need the copy number; the others are computed before the copies are made.
PER_COPY = ("loan_amnt", "funded_amnt")


def loan_view(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The loan-shaped table over ``orders`` and ``customer`` in ``sf_dir``.

    ``partitions`` spreads the joined rows over so many partitions, for files that cannot be
    split.  They are spread behind the join, whose own shuffle would undo it, and before the
    wide columns are computed.  The copies come from one ``explode`` over the joined rows, so
    both tables are scanned once.  The join carries no hint: Spark broadcasts ``customer``
    while its file size allows it and shuffles beyond that.

    Half of the columns are computed before the ``explode`` and half after it.
    Spark compiles each half to a method of its own; one for all columns would
    exceed the size up to which the JVM compiles a method at all.
    """
    orders = read_parquet(spark, f"{sf_dir}/orders.parquet", ORDERS_SCHEMA)
    customer = read_parquet(spark, f"{sf_dir}/customer.parquet", CUSTOMER_SCHEMA)
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    if partitions:
        joined = joined.repartition(partitions, "o_orderkey")
    early = [name for name in list(LOAN_EXPRESSIONS)[::2] if name not in PER_COPY]
    return (
        joined.selectExpr(*aliased(BASE_COLUMNS))
        .selectExpr("*", *aliased({f"_{name}": LOAN_EXPRESSIONS[name] for name in early}))
        .selectExpr("*", f"explode(if({COPIED}, array(0, 1), array(0))) AS copy")
        .selectExpr(
            *aliased(
                {
                    name: f"_{name}" if name in early else sql
                    for name, sql in LOAN_EXPRESSIONS.items()
                }
            )
        )
    )
