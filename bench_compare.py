"""Time the plan-only steps next to the obvious ways to write them.

    anti join        against a list of keys collected to the driver
    native title     against a row-at-a-time Python function
    partitioned write against one filtered write per grade

Takes the same BENCH_* settings as ``bench.py`` and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from credmill import schemas  # noqa: E402
from credmill.functions.text import title_case  # noqa: E402
from credmill.operators import keys, score  # noqa: E402
from credmill.plans import single_pass  # noqa: E402
from credmill.session import build_session  # noqa: E402
from credmill.sources import writers  # noqa: E402
from credmill.sources.scratch import shared_dir  # noqa: E402
from loan_view import loan_view  # noqa: E402


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(
        "compare",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        settings={"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")},
    )
    path = shared_dir(spark, "loans")
    loan_view(spark, sf_dir).write.parquet(path)
    loans = spark.read.parquet(path)
    keyed = keys.with_member_key(loans)
    titled = F.udf(lambda text: text.title() if text else None, "string")

    def listed():
        found = [row[0] for row in keys.duplicate_keys(keyed).select(schemas.KEY).collect()]
        noop(keyed.where(~F.col(schemas.KEY).isin(found)))

    # Both ways of writing the grades begin with the stored joined table.
    stored = shared_dir(spark, "joined")
    single_pass.crunched(keyed).write.parquet(stored)
    joined = spark.read.parquet(stored)

    def one_write():
        writers.write_graded(score.graded(joined), "compare_one", shared_dir(spark, "one"))

    def five_writes():
        for grade in schemas.GRADES:
            rows = writers.read_grade(score.graded(joined), grade)
            writers.write_table(rows, f"compare_{grade}", shared_dir(spark, grade))

    cases = {
        "dedupe: anti join": lambda: noop(keys.exclude_duplicates(keyed)),
        "dedupe: collected list": listed,
        "title: native": lambda: noop(loans.selectExpr(title_case("emp_title"))),
        "title: python function": lambda: noop(loans.select(titled("emp_title"))),
        "grades: one partitioned write": one_write,
        "grades: five filtered writes": five_writes,
    }
    timings = {}
    for name, case in cases.items():
        case()
        samples = []
        for _ in range(runs):
            start = time.perf_counter()
            case()
            samples.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(samples), 3)
    spark.stop()
    print(json.dumps({"unit": "sec", "sf": Path(sf_dir).name, "cases": timings}))


if __name__ == "__main__":
    main()
