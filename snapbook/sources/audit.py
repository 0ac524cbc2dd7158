"""Run and step logs as frames."""

from __future__ import annotations

import calendar
import re
import uuid
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from snapbook.functions import exprs
from snapbook.session import folder_exists, make_folder, move_new, remove_folder, sub_folders

STEP_SCHEMA = (
    "step_id string, run_id string, start timestamp_ntz, number int, target string, duration decimal(9,3), "
    "status int, record_count bigint, error_number int, error_proc string, error_message string"
)
RAW_STEP_SCHEMA = (
    "run_id string, number int, target string, start timestamp_ntz, finish timestamp_ntz, status int, "
    "error_number int, error_proc string, error_message string"
)
RUN_SCHEMA = "run_id string, event_type int, for_date date, start timestamp_ntz"
# Before any reporting date.
NO_DATE = "1900-01-01"


def append_audit(df: DataFrame, path: str) -> None:
    """Append log rows."""
    df.write.mode("append").parquet(path)


def error_counts(runs: DataFrame, steps: DataFrame) -> DataFrame:
    """Runs with the number of their failed steps; derived, so no log row is ever updated."""
    failed = steps.filter(F.col("status") == 0).groupBy("run_id").agg(F.count(F.lit(1)).alias("error_count"))
    return runs.join(failed, "run_id", "left").withColumn("error_count", F.coalesce("error_count", F.lit(0)))


def retain(df: DataFrame, col: str, months: int, asof: date) -> DataFrame:
    """Rows dated after the day ``months`` months before; that day itself goes too."""
    return df.filter(F.col(col) > F.add_months(F.lit(asof), -months))


def retain_steps(steps: DataFrame, runs: DataFrame) -> DataFrame:
    """Steps of the runs that are kept."""
    return steps.join(runs.select("run_id").distinct(), "run_id", "left_semi")


class RunLog:
    """Run headers and steps by reporting date: ``_run_log/for_date=…/batch=…`` and ``_step_log/for_date=…/batch=…``.

    A batch (one run, or many taken over from elsewhere) is written beside the log and moved in by renames, its steps before its headers. So a
    batch appended twice is there once, also after a stop halfway, and a header never lacks its steps. Runs leave the log by dropping dates: no job, and nothing is
    rewritten. A partition without rows carries the columns.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, table: str) -> str:
        return f"{self.root}/_{table}_log"

    def _move_in(self, df: DataFrame, table: str, batch: str) -> int:
        staged = f"{self.root}/_staging/{uuid.uuid4().hex}"
        df.write.partitionBy("for_date").parquet(staged)
        moved = 0
        for day in sub_folders(self.spark, staged):
            make_folder(self.spark, f"{self._folder(table)}/{day}")
            moved += move_new(self.spark, f"{staged}/{day}", f"{self._folder(table)}/{day}/batch={batch}")
        remove_folder(self.spark, staged)
        return moved

    def append(self, batch: str, runs: DataFrame, steps: DataFrame) -> int:
        """Add runs (columns of RUN_SCHEMA) and their steps (STEP_SCHEMA); how many dates of the batch are new to the log."""
        if not re.fullmatch(r"[A-Za-z0-9_.\-]+", batch):
            raise ValueError(f"batch {batch!r} cannot be a folder name")
        self._begin()
        dated = steps.join(runs.select("run_id", "for_date"), "run_id")
        self._move_in(dated.repartition("for_date"), "step", batch)
        return self._move_in(runs.repartition("for_date"), "run", batch)

    def _begin(self) -> None:
        """Lay down the partitions that carry the columns, once."""
        for table, schema in (("step", STEP_SCHEMA), ("run", RUN_SCHEMA.replace(", for_date date", ""))):
            first = f"{self._folder(table)}/for_date={NO_DATE}/batch=0"
            if not folder_exists(self.spark, first):
                staged = f"{self.root}/_staging/{uuid.uuid4().hex}"
                self.spark.createDataFrame([], schema).write.parquet(staged)
                make_folder(self.spark, f"{self._folder(table)}/for_date={NO_DATE}")
                move_new(self.spark, staged, first)
                remove_folder(self.spark, staged)

    def runs(self) -> DataFrame:
        return self.spark.read.parquet(self._folder("run")).select(*(c.split()[0] for c in RUN_SCHEMA.split(", ")))

    def steps(self) -> DataFrame:
        return self.spark.read.parquet(self._folder("step")).select(*(c.split()[0] for c in STEP_SCHEMA.split(", ")))

    def retain(self, months: int, today: date) -> list[date]:
        """Drop runs for dates ``months`` or more before today, headers first; the dates dropped. A listing and deletions."""
        last = _months_before(today, months)
        days = {table: [d for d in sub_folders(self.spark, self._folder(table)) if d > f"for_date={NO_DATE}" and d <= f"for_date={last}"] for table in ("run", "step")}
        for table in ("run", "step"):
            for day in days[table]:
                remove_folder(self.spark, f"{self._folder(table)}/{day}")
        return [date.fromisoformat(d.removeprefix("for_date=")) for d in days["run"]]


def _months_before(day: date, months: int) -> date:
    """The same day so many months before, or the last one of a shorter month."""
    number = day.year * 12 + day.month - 1 - months
    year, month = divmod(number, 12)
    return date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def error_class(problem: Exception) -> str:
    """Spark's error class of a failed step, or the exception's type."""
    condition = problem.getCondition() if isinstance(problem, PySparkException) else None
    return condition or type(problem).__name__


def last_runs(runs: DataFrame, steps: DataFrame) -> DataFrame:
    """Steps of the last run of every reporting date; runs that share the last start time all count.

    The last start per date is a map-side maximum joined back to the run headers, so a date with very
    many runs is never gathered in one task.
    """
    newest = runs.groupBy("for_date").agg(F.max("start").alias("start"))
    heads = runs.join(newest, ["for_date", "start"]).select("run_id", "for_date")
    return steps.join(heads, "run_id").select(
        "step_id", "run_id", "for_date", "start", "number", "target", "duration", "status", "record_count",
        "error_number", "error_proc", "error_message",
    )


def step_audit(steps: DataFrame, counts: DataFrame) -> DataFrame:
    """Step log rows from raw step times: duration in seconds and the row count of the target.

    ``steps``: run_id, number, target, start, finish, status, and the error columns if there are any. A failed step
    reports no rows.
    """
    joined = steps.join(counts, "target", "left")
    return joined.select(
        exprs.stable_key(F.col("run_id"), F.col("number").cast("string")).alias("step_id"),
        "run_id", "start", "number", "target",
        exprs.seconds_between(F.col("start"), F.col("finish")).alias("duration"),
        "status",
        F.when(F.col("status") == 1, F.coalesce("row_count", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("record_count"),
        *(c for c in ("error_number", "error_proc", "error_message") if c in steps.columns),
    )


def presence_report(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Expected names with 1 where the object was found and 0 where it is missing."""
    seen = found.select(key).distinct().withColumn("_seen", F.lit(True))
    return (
        expected.distinct()
        .join(seen, key, "left")
        .withColumn("present", exprs.flag(F.col("_seen").isNotNull()))
        .drop("_seen")
    )


def missing(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Expected names that were not found."""
    return expected.distinct().join(found.select(key).distinct(), key, "left_anti")
