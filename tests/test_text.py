from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from credmill.functions import text


def apply(spark, sql, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in rows.selectExpr("i", f"{sql} AS y").orderBy("i").collect()]


def test_title_case_examples(spark):
    cases = {
        None: None,
        "": None,
        "o'neil co-op": "O'Neil Co-Op",
        "debt_consolidation": "Debt_Consolidation",
        "3rd mcDONALD": "3Rd Mcdonald",
        "éCOLE d'été": "École D'Été",
        "ß straße": "Ss Straße",
        "  two  blanks": "  Two  Blanks",
        "x\ty\nz": "X\tY\nZ",
        "中a": "中A",
    }
    assert apply(spark, text.title_case("x"), list(cases)) == list(cases.values())


def test_title_case_is_str_title(spark):
    """Every assigned letter, punctuation mark and digit of the common planes."""
    blocks = [(0x20, 0x17F), (0x370, 0x52F), (0x5D0, 0x6FF), (0x1E00, 0x1FFF), (0x3040, 0x30FF)]
    words = [f"x{chr(c)}y {chr(c)}Q{chr(c)}" for lo, hi in blocks for c in range(lo, hi)]
    assert apply(spark, text.title_case("x"), words) == [w.title() for w in words]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from("abZÉß'-_. 19é\t"), min_size=1), min_size=20, max_size=60))
def test_title_case_on_generated_text(spark, words):
    assert apply(spark, text.title_case("x"), words) == [w.title() for w in words]


@pytest.mark.parametrize(
    ("sql", "cases"),
    [
        (text.digits("x"), {None: None, "n/a": "", "": "", "< 1 year": "1", "10+ years": "10"}),
        (
            text.whole_number("x"),
            {None: None, "": None, " 36 months": 36, "99999999999": None},
        ),
        (
            text.percentage("x"),
            {None: None, "": None, "13.56%": 13.56, "1.2.3": None, " 7 %": 7.0},
        ),
        (
            text.month_date("x", "MMM-yy"),
            {
                None: None,
                "": None,
                "Jun-18": date(2018, 6, 1),
                "18-Jun": None,
                "08/2005": None,
            },
        ),
        (
            text.month_date("x", "MM/yyyy"),
            {"08/2005": date(2005, 8, 1), "Aug-2005": None, "": None},
        ),
    ],
)
def test_parsers(spark, sql, cases):
    assert apply(spark, sql, list(cases)) == list(cases.values())


def test_utilization_is_single_precision(spark):
    df = spark.createDataFrame([("12.3%",)], "x string")
    assert dict(df.selectExpr(f"{text.percentage('x', 'float')} AS y").dtypes) == {"y": "float"}
