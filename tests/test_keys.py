from __future__ import annotations

import hashlib
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from credmill.operators import keys, membership
from credmill.schemas import KEY
from tests.plans import count


def test_fingerprint_is_sha256_of_the_joined_key(spark, loans):
    row = keys.with_member_key(loans({})).first()
    text = "teacher||10+ years||RENT||60000.0||Verified||A|| 36 months||941xx"
    assert row[KEY] == hashlib.sha256(text.encode()).hexdigest()


def test_nulls_are_skipped_so_rows_can_share_a_key(spark, loans):
    rows = keys.with_member_key(
        loans(
            {"emp_title": None, "emp_length": "x"},
            {"emp_title": "x", "emp_length": None},
        )
    )
    assert len({r[KEY] for r in rows.collect()}) == 1
    assert keys.exclude_duplicates(rows).count() == 0


def test_all_null_key_is_a_digest(spark, loans):
    row = keys.with_member_key(loans(dict.fromkeys(keys.schemas.KEY_COLUMNS))).first()
    assert row[KEY] == hashlib.sha256(b"").hexdigest()


def test_no_copy_of_a_duplicate_survives(spark, loans):
    keyed = keys.with_member_key(
        loans(
            *[{"zip_code": "a"}] * 2,
            *[{"zip_code": "b", "loan_amnt": float(i)} for i in range(3)],
            {"zip_code": "c"},
        )
    )
    counts = sorted(r.member_count for r in keys.key_counts(keyed).collect())
    assert counts == [1, 2, 3]
    assert [r.member_count for r in keys.duplicate_keys_sorted(keyed).collect()] == [3, 2]
    assert [r.zip_code for r in keys.exclude_duplicates(keyed).collect()] == ["c"]
    most = keys.most_copied_key(keyed)
    assert keys.member_lookup(keyed, most.scalar()).count() == 3
    assert keys.member_lookup(keyed, most.first()[KEY]).count() == 3


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(0, 12), min_size=1, max_size=60), st.integers(2, 4), st.sampled_from([1, 4, 1 << 19])
)
def test_both_ways_of_deduplication_agree(spark, members, hot_copies, words):
    keyed = spark.createDataFrame(
        [(f"k{m}", i) for i, m in enumerate(members)], f"{KEY} string, value int"
    )
    copies = Counter(members)
    expected = sorted(i for i, m in enumerate(members) if copies[m] == 1)
    joined = keys.exclude_duplicates(keyed, hot_copies, words=words)
    collapsed = keys.unique_values(keyed)
    assert sorted(r.value for r in joined.collect()) == expected
    assert sorted(r.value for r in collapsed.collect()) == expected


def test_a_hot_key_with_a_third_of_all_rows(spark):
    """It is dropped by broadcast and also collapses in the partial aggregate."""
    keyed = spark.range(30_000).selectExpr(
        f"if(id % 3 = 0, 'hot', cast(id AS string)) AS {KEY}", "id AS value"
    )
    assert keys.exclude_duplicates(keyed, hot_copies=1000).count() == 20_000
    assert keys.unique_values(keyed).count() == 20_000


def test_numbers_deduplicate_in_one_hash_aggregate(spark, loans):
    keyed = keys.with_member_key(loans({})).select(KEY, "dti", "annual_inc")
    plan = keys.unique_values(keyed)
    assert count(plan, "HashAggregate") == 2
    assert count(plan, "Exchange") == 1
    assert count(plan, "SortAggregate") == count(plan, "Sort") == 0


def test_the_filter_finds_every_key_and_few_others(spark):
    rows = spark.range(200_000).selectExpr(f"cast(id AS string) AS {KEY}", "id")
    held = rows.where("id < 1000")
    table = membership.condensed(held, KEY, 1 << 12)
    assert table.count() <= 1 << 12
    marked = membership.marked(rows, table, KEY, "found", 1 << 12)
    assert marked.where("found AND id < 1000").count() == 1000
    assert marked.where("found AND id >= 1000").count() < 200
    nothing = membership.condensed(rows.where("id < 0"), KEY)
    assert membership.marked(rows, nothing, KEY, "found").where("found").count() == 0
