"""Tasks and buckets of the queries grow with the rows of the tables."""

from __future__ import annotations

import re

import __spark_entry__ as entry
import pytest
from plans import explain

from loan_view import loan_view

BASE = 40


@pytest.fixture
def tables(spark, tmp_path):
    """Orders of a few customers, in one file each."""

    def build(orders: int) -> str:
        folder = str(tmp_path / f"of_{orders}")
        spark.range(orders).coalesce(1).selectExpr(
            "id AS o_orderkey", "id % 7 AS o_custkey", "'O' AS o_orderstatus",
            "cast(1000 + id AS double) AS o_totalprice",
            "timestamp_ntz '2020-01-02 00:00:00' AS o_orderdate", "'1-URGENT' AS o_orderpriority",
        ).write.parquet(f"{folder}/orders.parquet")
        spark.range(7).coalesce(1).selectExpr(
            "id AS c_custkey", "cast(id AS int) AS c_nationkey", "cast(100 + id AS double) AS c_acctbal",
            "'BUILDING' AS c_mktsegment",
        ).write.parquet(f"{folder}/customer.parquet")
        return folder

    return build


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_tasks_of_the_loans_grow_with_the_orders(spark, tables, monkeypatch, threshold):
    """Twice the orders, twice the tasks, whether the join is a broadcast or a shuffle."""
    monkeypatch.setattr(entry, "TASK_ROWS", 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for orders in (BASE, 2 * BASE):
            loans = entry._loans(spark, tables(orders))
            assert loans.rdd.getNumPartitions() == orders // 5
            assert loans.count() == orders + -(-orders // 50)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_few_orders_are_spread_over_all_cores(spark, tables):
    loans = entry._loans(spark, tables(BASE))
    assert loans.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_wide_rows_are_computed_behind_the_exchange(spark, tables):
    """One exchange spreads the joined rows before their wide columns are computed."""
    plan = explain(loan_view(spark, tables(BASE), 9))
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1
    spread = plan[plan.index(") Exchange\n") :]
    assert "hashpartitioning(o_orderkey" in spread and "c_mktsegment" in spread[: spread.index("Arguments")]


def test_buckets_of_the_job_grow_with_the_orders(spark, tables, monkeypatch):
    assert entry._job(spark, tables(BASE)).buckets == entry.BUCKETS
    monkeypatch.setattr(entry, "ROW_BYTES", 64 << 20)  # four rows to a bucket
    for orders in (BASE, 2 * BASE):
        assert entry._job(spark, tables(orders + 4)).buckets == orders // 4 + 1


def test_a_job_of_many_buckets_has_the_same_grades(spark, tables, monkeypatch):
    folder = tables(2 * BASE)
    few = sorted(map(tuple, entry._full_run(spark, folder).collect()))
    monkeypatch.setattr(entry, "ROW_BYTES", 64 << 20)
    monkeypatch.setattr(entry, "TASK_ROWS", 5)
    assert sorted(map(tuple, entry._full_run(spark, folder).collect())) == few
