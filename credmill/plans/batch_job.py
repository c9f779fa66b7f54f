"""The whole job with all its tables: staging, landing, joined, reporting.

The duplicates cost the one wide shuffle of the job.  Their keys are stored before it; its result is
written once, bucketed on the key, and every later table is bucketed the same way, so
the cleaning and the four-way join read and write in place.  Each written table
also cuts the lineage: a lost executor costs a stage, not the job.  What was shuffled for a table is
deleted once the table is written.

The checks are observed while the tables are written, in the task that writes a row, which counts
once however often an earlier stage is repeated.  A CSV file is parsed once: its rows are stored, those
that do not parse in a partition of their own.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from credmill import schemas
from credmill.functions.columns import aliased
from credmill.operators import clean, join, keys, quality, score, stats
from credmill.schemas import KEY
from credmill.session import writing
from credmill.sources import readers, versions, writers

DUPLICATES_TABLE = "duplicate_keys"
DEDUPED_TABLE = "deduplicated_loans"
BUCKET_BYTES = 256 << 20

# What is observed of the rows of a table while they are written: check, its aggregates by name.
_ROWS = {"row_count": "count(1)"}
CHECKS: dict[str, dict[str, dict[str, str]]] = {
    DEDUPED_TABLE: {"deduplicated": _ROWS},
    schemas.CUSTOMERS_TABLE: {
        "zip_anomaly": quality.ZIP_ANOMALY,
        "state_anomaly": quality.STATE_ANOMALY,
    },
    schemas.PAYMENTS_TABLE: {
        "payment_identity": quality.payment_identity_check(),
        "investor_gap": quality.investor_gap_check(),
        "principal_interest_share": quality.PRINCIPAL_INTEREST_SHARE,
    },
    schemas.RISK_TABLE: {"dti_spread": stats.DTI_SPREAD},
    schemas.CRUNCHED_TABLE: {"joined": _ROWS},
}


# The tables that are joined; the optimizer asks for their row counts.
JOINED = (
    schemas.CUSTOMERS_TABLE, schemas.LOANS_TABLE, schemas.PAYMENTS_TABLE, schemas.ULTRA_RISK_TABLE,
)
LAYERS = {
    "staging": (schemas.INGESTED_TABLE, DUPLICATES_TABLE, DEDUPED_TABLE, *schemas.SPLITS),
    "landing": (
        schemas.CUSTOMERS_TABLE, schemas.LOANS_TABLE, schemas.PAYMENTS_TABLE,
        schemas.RISK_TABLE, schemas.ULTRA_RISK_TABLE, schemas.CRUNCHED_TABLE,
    ),
    "reporting": (schemas.REPORT_TABLE,),
}


class TooManyBadLines(ValueError):
    """A file holds more lines that do not parse than the job accepts."""


def buckets_for(input_bytes: int) -> int:
    """Buckets of some 256 MB for an input of that size."""
    return max(1, -(-input_bytes // BUCKET_BYTES))


@dataclass(frozen=True)
class Job:
    """Where the job writes and how.

    ``root``     directory for all tables, on storage the executors share
    ``prefix``   put before every table and view name, for example ``"db."``
    ``names``    other names for single tables, by their default names
    ``fmt``      table format of the landing and reporting layers
    ``buckets``  buckets per table and partitions of the one wide shuffle; choose it so
                 that a bucket of wide rows has 128 to 512 MB (``buckets_for``).
                 Formats other than Parquet and ORC are written unbucketed.
    ``as_of``    ingestion time; None means the time of the run
    ``statistics``  whether the tables to be joined are analyzed, for sessions that order joins by
                 cost (``session.COST_BASED``)
    ``observed``  values of the checks on the tables that this job wrote, by table and check
    ``compression``  codec of the tables in Parquet and ORC.  Much of every table are its keys, of 64
                 hexadecimal digits, which take half the space in a codec that codes single characters
    """

    spark: SparkSession
    root: str
    buckets: int
    prefix: str = ""
    fmt: str = "parquet"
    as_of: datetime | None = None
    max_records_per_file: int | None = None
    names: dict[str, str] = field(default_factory=dict)
    statistics: bool = False
    observed: dict[str, dict[str, dict]] = field(default_factory=dict, compare=False)
    compression: str = "zstd"

    # -- naming --

    def name(self, table: str) -> str:
        return self.prefix + self.names.get(table, table)

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def __post_init__(self) -> None:
        if self.buckets < 1:
            raise ValueError("buckets must be at least 1; see buckets_for")

    # -- layers --

    def _codec(self, fmt: str) -> str | None:
        return self.compression if fmt in ("parquet", "orc") else None

    def _save(self, df: DataFrame, layer: str, table: str, fmt: str) -> None:
        bucketed = fmt in ("parquet", "orc")
        # Spark drops this exchange where the rows are laid out so already.
        rows = df.repartition(self.buckets, KEY) if bucketed else df
        observation, checks = Observation(), CHECKS.get(table, {})
        if checks:
            named = {f"{check}.{n}": sql for check, values in checks.items() for n, sql in values.items()}
            # Last before the write: a task of the final stage is never repeated once it is done.
            rows = rows.observe(observation, *map(F.expr, aliased(named)))
        with writing(self.spark):
            writers.write_table(
                rows,
                self.name(table),
                self.path(layer, table),
                fmt=fmt,
                buckets=self.buckets if bucketed else None,
                max_records_per_file=self.max_records_per_file,
                compression=self._codec(fmt),
            )
        if checks:
            found = observation.get
            self.observed[table] = {
                check: {name: found[f"{check}.{name}"] for name in values} for check, values in checks.items()
            }
        if self.statistics and table in JOINED:
            self.spark.sql(f"ANALYZE TABLE {self.name(table)} COMPUTE STATISTICS")

    def _save_all(self, frames: dict[str, DataFrame], layer: str, fmt: str) -> None:
        """Write tables that do not need each other at the same time, so that the
        last tasks of one write do not leave the cluster idle."""
        with ThreadPoolExecutor(len(frames)) as pool:
            writes = [
                pool.submit(self._save, df, layer, table, fmt) for table, df in frames.items()
            ]
            for write in writes:
                write.result()

    def ingest(self, path: str, *, max_bad_share: float = 0.01, **options) -> DataFrame:
        """Parse a CSV file once and store its rows; return those that parse.

        Lines with a field that does not parse, or with too few or too many fields, go into a
        partition of their own in the same pass, whole and with the path of their file.  Their number
        is observed.  Beyond ``max_bad_share`` of all lines the job refuses the file; the
        stored lines remain for a look at them.
        """
        rows = readers.read_loans_csv(
            self.spark, path, on_error="keep", corrupt_column=schemas.LINE_COLUMN,
            source_column=schemas.SOURCE_COLUMN, **options,
        )
        bad = f"{schemas.LINE_COLUMN} IS NOT NULL"
        marked = rows.withColumn(schemas.QUARANTINE_COLUMN, F.expr(bad))
        observation = Observation()
        counts = {"lines": "count(1)", "bad_lines": f"count_if({bad})"}
        writers.write_partitioned(
            marked.observe(observation, *map(F.expr, aliased(counts))),
            self.name(schemas.INGESTED_TABLE),
            self.path("staging", schemas.INGESTED_TABLE),
            schemas.QUARANTINE_COLUMN,
            max_records_per_file=self.max_records_per_file,
            compression=self._codec("parquet"),
        )
        found = observation.get
        self.observed[schemas.INGESTED_TABLE] = {"ingested": found}
        if found["bad_lines"] > max_bad_share * found["lines"]:
            raise TooManyBadLines(
                f"{found['bad_lines']} of {found['lines']} lines of {path} do not parse; "
                f"see {self.name(schemas.INGESTED_TABLE)}"
            )
        return self.ingested()

    def _ingested(self, quarantined: bool) -> DataFrame:
        return self.table(schemas.INGESTED_TABLE).where(F.col(schemas.QUARANTINE_COLUMN) == quarantined)

    def ingested(self) -> DataFrame:
        """The stored rows that parse, without the columns on lines."""
        extra = (schemas.QUARANTINE_COLUMN, schemas.LINE_COLUMN, schemas.SOURCE_COLUMN)
        return self._ingested(False).drop(*extra)

    def quarantined(self) -> DataFrame:
        """The lines that do not parse and the files that hold them."""
        return self._ingested(True).select(schemas.SOURCE_COLUMN, schemas.LINE_COLUMN)

    def analyze(self, *tables: str, columns: tuple[str, ...] = (KEY,)) -> None:
        """Gather statistics of columns too, which lets the optimizer order joins by their size."""
        for table in tables:
            self.spark.sql(
                f"ANALYZE TABLE {self.name(table)} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}"
            )

    def deduplicate(self, loans: DataFrame) -> DataFrame:
        """Write the loans with unambiguous keys; the one shuffle of wide rows.

        The duplicate keys are a table of their own.  So what counting them shuffled is deleted before
        the wide rows are shuffled.
        """
        keyed = keys.with_member_key(loans)
        self._save(keys.duplicate_keys(keyed), "staging", DUPLICATES_TABLE, "parquet")
        copied = self.table(DUPLICATES_TABLE)
        unique = keys.exclude_duplicates(
            keyed, partitions=self.buckets, per_key=copied, derived=keys.fingerprint()
        )
        self._save(unique, "staging", DEDUPED_TABLE, "parquet")
        return self.table(DEDUPED_TABLE)

    def stage(self, loans: DataFrame) -> None:
        """Key and de-duplicate the loans, then write the four splits."""
        rows = self.deduplicate(loans)
        splits = {table: clean.split(rows, table) for table in schemas.SPLITS}
        self._save_all(splits, "staging", "parquet")

    def land(self) -> None:
        """Write the four cleaned tables and the known-delinquency risk table."""
        landing = {
            schemas.CUSTOMERS_TABLE: clean.clean_borrower(
                self.table("borrower_info"), as_of=self.as_of
            ),
            schemas.LOANS_TABLE: clean.clean_loan(self.table("loan_details")),
            schemas.PAYMENTS_TABLE: clean.clean_payment(self.table("payment_recovery")),
            schemas.RISK_TABLE: clean.clean_risk(self.table("credit_risk"), unique_keys=True),
        }
        self._save_all(landing, "landing", self.fmt)
        ultra = clean.known_delinquency(self.table(schemas.RISK_TABLE))
        self._save(ultra, "landing", schemas.ULTRA_RISK_TABLE, self.fmt)

    def crunch(self) -> None:
        """Join the landed tables."""
        joined = join.crunched(
            self.table(schemas.ULTRA_RISK_TABLE),
            self.table(schemas.CUSTOMERS_TABLE),
            self.table(schemas.LOANS_TABLE),
            self.table(schemas.PAYMENTS_TABLE),
        )
        self._save(joined, "landing", schemas.CRUNCHED_TABLE, self.fmt)

    def report(self) -> None:
        """Score and grade the joined rows: one write, one view per grade."""
        with writing(self.spark):
            writers.write_graded(
                score.graded(self.table(schemas.CRUNCHED_TABLE)),
                self.name(schemas.REPORT_TABLE),
                self.path("reporting", schemas.REPORT_TABLE),
                fmt=self.fmt,
                max_records_per_file=self.max_records_per_file,
                compression=self._codec(self.fmt),
            )
        writers.create_grade_views(
            self.spark,
            self.name(schemas.REPORT_TABLE),
            names={
                grade: self.name(schemas.GRADE_VIEW.format(grade=grade))
                for grade in schemas.GRADES
            },
        )

    def run(self, loans: DataFrame) -> None:
        self.stage(loans)
        self.land()
        self.crunch()
        self.report()

    # -- reading the results --

    def grade(self, grade: str) -> DataFrame:
        return self.table(schemas.GRADE_VIEW.format(grade=grade))

    def member(self, table: str, key: str) -> DataFrame:
        """The rows of one member in a stored table; of a bucketed one a single bucket is read."""
        return readers.read_member(self.spark, self.name(table), key)

    def checks(self) -> dict[str, DataFrame]:
        """The checks the job reports, over the landed tables."""
        found = {
            check: self.table(table).selectExpr(*aliased(values))
            for table, checks in CHECKS.items()
            for check, values in checks.items()
        }
        return found | {"grades": score.grade_counts(self.table(schemas.REPORT_TABLE))}

    def check_values(self) -> dict[str, dict]:
        """Values of the checks by name, as they were observed in the writes: no further job."""
        return {check: values for found in self.observed.values() for check, values in found.items()}

    # -- cleaning up --

    def drop(self) -> None:
        """Drop all views, tables and files of the job."""
        for grade in schemas.GRADES:
            self.spark.sql(f"DROP VIEW IF EXISTS {self.name(schemas.GRADE_VIEW.format(grade=grade))}")
        for layer, tables in LAYERS.items():
            for table in tables:
                versions.drop_table(self.spark, self.name(table), self.path(layer, table))
