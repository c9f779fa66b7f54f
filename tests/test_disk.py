"""The job keeps one copy of the wide rows on the executors' disks, and only while it writes them."""

from __future__ import annotations

import re
import threading
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from plans import explain
from pyspark.sql import functions as F

from credmill import schemas
from credmill.operators import keys
from credmill.plans.batch_job import DEDUPED_TABLE, DUPLICATES_TABLE, LAYERS, Job
from credmill.schemas import KEY
from credmill.session import FREED, WRITING, writing


@pytest.fixture
def no_broadcast(spark):
    """Joins of the size of a large run: no side is small enough to be sent whole."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def rows(loans):
    """Twelve members; three of them twice, with other amounts."""
    members = [{"annual_inc": 30000.0 + n} for n in range(12)]
    return loans(*members, *({**member, "loan_amnt": 7.0} for member in members[:3]))


def shuffle_files(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    return {str(path) for folder in blocks.localDirsString() for path in Path(folder).glob("*/shuffle_*")}


def left_behind(spark, before):
    """Shuffle files that are there now and were not before; Spark deletes in the background."""
    for _ in range(50):
        if not (found := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return found


def wide_exchanges(df, column):
    """Exchanges whose rows hold a column."""
    found = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]$", explain(df), re.M)
    return [columns for columns in found if re.search(rf"\b{column}#", columns)]


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("buckets", [3, 9])
def test_wide_rows_are_shuffled_once(spark, rows, no_broadcast, adaptive, buckets):
    """Whether there are more shuffle partitions than buckets or fewer."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    keyed = keys.with_member_key(rows)
    try:
        for derived in (None, keys.fingerprint()):
            kept = keys.exclude_duplicates(keyed, partitions=buckets, derived=derived).repartition(buckets, KEY)
            assert len(wide_exchanges(kept, "total_pymnt")) == 1
            assert kept.rdd.getNumPartitions() == buckets
            assert kept.columns == [KEY, *rows.columns]
            found = sorted((row.annual_inc, row[KEY]) for row in kept.collect())
            assert [income for income, _ in found] == [30000.0 + n for n in range(3, 12)]
            assert {key for _, key in found} == {
                row[KEY] for row in keyed.where("annual_inc >= 30003").select(KEY).collect()
            }
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_a_key_is_not_shuffled_with_the_columns_it_comes_from(rows, no_broadcast):
    keyed = keys.with_member_key(rows)
    kept = keys.exclude_duplicates(keyed, partitions=3, derived=keys.fingerprint())
    assert not re.search(rf"\b{KEY}#", wide_exchanges(kept, "total_pymnt")[0])


def test_stored_duplicates_are_all_that_the_operator_needs(rows):
    keyed = keys.with_member_key(rows)
    kept = keys.exclude_duplicates(keyed, partitions=3, per_key=keys.duplicate_keys(keyed))
    assert kept.count() == 9


def test_the_job_leaves_no_shuffle_files(spark, rows, tmp_path, no_broadcast):
    before = shuffle_files(spark)
    setting = spark.conf.get(FREED, None)
    job = Job(spark, str(tmp_path), 3, prefix="disk_")
    job.run(rows)
    assert left_behind(spark, before) == set()
    assert spark.conf.get(FREED, None) == setting
    assert job.table(DEDUPED_TABLE).count() == 9
    assert {row.member_count for row in job.table(DUPLICATES_TABLE).collect()} == {2}
    assert sum(job.grade(grade).count() for grade in schemas.GRADES) == 9
    job.drop()
    assert not any(tmp_path.rglob("*.parquet"))


def test_counting_leaves_nothing_for_the_wide_shuffle(spark, rows, tmp_path, no_broadcast, monkeypatch):
    """When the wide rows are written, the shuffle that counted the keys is gone."""
    before, found, save = shuffle_files(spark), {}, Job._save

    def watched(job, df, layer, table, fmt):
        found[table] = left_behind(spark, before)
        save(job, df, layer, table, fmt)

    monkeypatch.setattr(Job, "_save", watched)
    job = Job(spark, str(tmp_path), 3, prefix="counted_")
    job.deduplicate(rows)
    assert list(found) == [DUPLICATES_TABLE, DEDUPED_TABLE]
    assert found[DEDUPED_TABLE] == set()
    job.drop()


@pytest.mark.parametrize("codec", [None, "snappy"])
def test_tables_have_the_codec_of_the_job(spark, rows, tmp_path, codec):
    job = Job(spark, str(tmp_path), 3, prefix="codec_", **({"compression": codec} if codec else {}))
    job.run(rows)
    for layer, tables in LAYERS.items():
        for table in tables:
            files = list(Path(job.path(layer, table)).rglob("*.parquet"))
            assert files or table == schemas.INGESTED_TABLE
            codecs = {
                meta.row_group(group).column(column).compression
                for meta in (pq.ParquetFile(file).metadata for file in files)
                for group in range(meta.num_row_groups)
                for column in range(meta.num_columns)
            }
            assert codecs <= {(codec or "zstd").upper()}, table
    job.drop()


def test_keys_take_half_the_space(spark, tmp_path):
    """Hexadecimal digits hold four bits each; a codec of whole bytes alone keeps eight."""
    size = {}
    many = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias(KEY)).coalesce(1)
    for codec in ("snappy", Job(spark, str(tmp_path), 1).compression):
        job = Job(spark, str(tmp_path / codec), 1, prefix=f"half_{codec}_", compression=codec)
        job._save(many, "staging", DUPLICATES_TABLE, "parquet")
        size[codec] = sum(path.stat().st_size for path in (tmp_path / codec).rglob("*.parquet"))
        job.drop()
    assert size["zstd"] < 0.6 * size["snappy"]


def test_a_setting_outlives_threads_and_failures(spark):
    inside, leave = threading.Event(), threading.Event()

    def other():
        with writing(spark):
            inside.set()
            leave.wait(10)

    before = {name: spark.conf.get(name, None) for name in WRITING}
    spark.conf.set(FREED, "false")
    thread = threading.Thread(target=other)
    try:
        with pytest.raises(RuntimeError), writing(spark):
            thread.start()
            inside.wait(10)
            raise RuntimeError
        assert spark.conf.get(FREED) == "true"  # the other thread is still within
        leave.set()
        thread.join()
        assert spark.conf.get(FREED) == "false"
        assert all(spark.conf.get(name, None) == value for name, value in before.items() if name != FREED)
    finally:
        leave.set()
        spark.conf.unset(FREED) if before[FREED] is None else spark.conf.set(FREED, before[FREED])


def test_a_bucket_is_a_task_of_each_write(spark, rows, tmp_path):
    """However small its file is."""
    job = Job(spark, str(tmp_path), 9, prefix="tasks_")
    tracker, group = spark.sparkContext.statusTracker(), "tasks of a write"
    job.stage(rows)
    spark.sparkContext.setJobGroup(group, "")
    try:
        job._save(job.table("loan_details"), "landing", schemas.LOANS_TABLE, "parquet")
        stages = [
            tracker.getStageInfo(stage)
            for number in tracker.getJobIdsForGroup(group)
            for stage in tracker.getJobInfo(number).stageIds
        ]
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert [stage.numTasks for stage in stages if stage] == [9]
    job.drop()
