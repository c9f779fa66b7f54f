from __future__ import annotations

import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from credmill.operators import quality, stats

AMOUNTS = st.one_of(
    st.none(),
    st.just(math.nan),
    st.sampled_from([0.0, 5.0, 60000.0]),
    st.floats(-1e12, 1e12),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(AMOUNTS, max_size=40))
def test_lower_median_is_the_exact_lower_element(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    known = [v for v in values if v is not None and not math.isnan(v)]
    expected = statistics.median_low(known) if known else None
    assert stats.lower_median(df, "x", "m").first().m == expected


def test_lower_median_of_four(spark):
    df = spark.createDataFrame([(v,) for v in (4.0, 1.0, 3.0, 2.0)], "annual_inc double")
    assert stats.median_income(df).first().median_annual_inc == 2.0


def test_lower_median_with_a_hot_value(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 7.0D, cast(id AS double)) AS x")
    values = [7.0 if i % 3 == 0 else float(i) for i in range(30_000)]
    assert stats.lower_median(df, "x", "m").first().m == statistics.median_low(values)


def test_title_frequency_breaks_ties_by_title(spark):
    df = spark.createDataFrame([(t,) for t in "baabc"], "emp_title string")
    rows = [tuple(r) for r in stats.title_frequency(df).collect()]
    assert rows == [("a", 2), ("b", 2), ("c", 1)]


def test_dti_spread(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "dti double")
    row = stats.dti_spread(df).first()
    assert row.dti_mean == pytest.approx(7 / 3)
    assert row.dti_stddev == pytest.approx(statistics.stdev([1, 2, 4]))
    assert stats.dti_stddev(df).first()[0] == row.dti_stddev


def test_anomalies(spark):
    df = spark.createDataFrame(
        [("94103", "CA"), ("941xxx", "CAL"), (None, None)], "zip_code string, addr_state string"
    )
    assert quality.zip_anomaly(df).first()[0] == 1
    assert quality.state_anomaly(df).first()[0] == 1


def test_payment_rules(spark):
    df = spark.createDataFrame(
        [(100.0, 100.0, 80.0, 20.0, 0.0), (100.0, 95.0, 80.0, 15.0, 4.0)],
        "total_pymnt double, total_pymnt_inv double, total_rec_prncp double, "
        "total_rec_int double, total_rec_late_fee double",
    )
    assert tuple(quality.payment_identity(df).first()) == (2, 1)
    assert quality.payment_identity(df, tolerance=1.5).first().violations == 0
    assert tuple(quality.investor_gap(df).first()) == (1, 5.0, 2.5)
    assert tuple(quality.principal_interest_share(df).first()) == (195.0, 200.0, 0.975)
    assert quality.principal_interest_share(df.limit(0)).first().share is None
