from __future__ import annotations

import math

import pytest

from credmill import schemas
from credmill.operators import score

# score column -> [(input, points)], both sides of every bound
EDGES = {
    "income_score": [
        (100000.01, 100), (100000, 75), (75000.01, 75), (75000, 50), (50000.01, 50),
        (50000, 25), (25000.01, 25), (25000, 0), (-1, 0), (None, 0),
    ],
    "dti_score": [
        (-1, 100), (9.99, 100), (10, 75), (19.99, 75), (20, 50), (29.99, 50), (30, 0),
        (None, 0), (math.nan, 0),
    ],
    "delinq_score": [(0, 100), (1, 50), (2, 0), (-1, 0), (None, 0)],
    "revol_bal_score": [
        (4999, 100), (5000, 75), (9999, 75), (10000, 50), (19999, 50), (20000, 0), (None, 0),
    ],
    "revol_util_score": [
        (29.9, 100), (30, 75), (49.9, 75), (50, 50), (69.9, 50), (70, 0), (None, 0),
    ],
    "total_acc_score": [
        (21, 100), (20, 75), (11, 75), (10, 50), (6, 50), (5, 0), (None, 0),
    ],
    "out_prncp_score": [
        (0, 100), (0.01, 75), (999.99, 75), (1000, 50), (4999.99, 50), (5000, 0), (None, 0),
    ],
    "out_prncp_inv_score": [
        (0, 100), (0.01, 75), (999.99, 75), (1000, 50), (4999.99, 50), (5000, 0), (None, 0),
    ],
}


def test_every_score_has_edges():
    assert set(EDGES) == set(schemas.SCORE_COLUMNS)


@pytest.mark.parametrize("name", EDGES)
def test_band_edges(spark, name):
    source, _ = schemas.SCORE_BANDS[name]
    rows = [(i, None if v is None else float(v)) for i, (v, _) in enumerate(EDGES[name])]
    df = spark.createDataFrame(rows, f"i int, {source} double")
    scored = df.selectExpr("i", f"{score.factor_values()[name]} AS s").orderBy("i")
    assert [r.s for r in scored.collect()] == [points for _, points in EDGES[name]]
    assert dict(scored.dtypes)["s"] == "int"


@pytest.mark.parametrize(
    ("total", "value", "grade"),
    [
        (800, 850.0, "very_good"), (675, 764.0625, "very_good"), (650, 746.875, "good"),
        (600, 712.5, "good"), (575, 695.3125, "medium"), (525, 660.9375, "medium"),
        (500, 643.75, "bad"), (450, 609.375, "bad"), (425, 592.1875, "very_bad"),
        (0, 300.0, "very_bad"),
    ],
)
def test_scale_and_grade(spark, total, value, grade):
    df = spark.createDataFrame([(total,)], "total_score int")
    row = score.with_credit_grade(score.with_credit_score(df)).first()
    assert (row.credit_score, row.credit_grade) == (value, grade)


@pytest.mark.parametrize("name", schemas.CRITICAL_COLUMNS)
def test_critical_columns_must_be_present(spark, name):
    text = {"member_id"}
    ddl = ", ".join(
        f"{c} {'string' if c in text else 'double'}" for c in schemas.CRITICAL_COLUMNS
    )
    full = {c: "k" if c in text else 1.0 for c in schemas.CRITICAL_COLUMNS}
    rows = [full, {**full, name: None}]
    if name not in text:
        rows.append({**full, name: math.nan})
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ddl)
    assert score.drop_critical_nulls(df).count() == 1


def test_utilization_filter_drops_unknown(spark):
    df = spark.createDataFrame(
        [(100.0,), (100.1,), (None,)], "revol_util_in_percentage float"
    )
    assert [r[0] for r in score.valid_utilization(df).collect()] == [100.0]


def test_impute_income_takes_the_lower_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "annual_inc double")
    assert sorted(r[0] for r in score.impute_income(df).collect()) == [1.0, 2.0, 2.0, 3.0, 4.0]
