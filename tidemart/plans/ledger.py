"""Run reporting as tables (R1-R3): run ledger, long-form statistics, stepped loads."""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField,
                               StructType)

from tidemart.functions.columns import change_flag, statistic_payload
from tidemart.operators.aggregate import resume_step
from tidemart.operators.project import conform_schema
from tidemart.plans.mart import Mart
from tidemart.sources.tables import append_rows, run_sql_script, split_statements

# ---------------------------------------------------------------------------
# Ledger layout and statistic ids
# ---------------------------------------------------------------------------
#: columns of the run ledger, in order
RUN_LEDGER_SCHEMA = StructType([
    StructField("calculated_table", StringType()),
    StructField("ctl_loading", IntegerType()),
    StructField("ctl_validfrom", StringType()),
    StructField("relevance_value", StringType()),
    StructField("is_force_load", IntegerType()),
    StructField("count_rows", LongType()),
    StructField("is_change", IntegerType()),
])
#: columns of the step ledger (one row per executed step)
STEP_LEDGER_SCHEMA = StructType([
    StructField("target", StringType()),
    StructField("step", IntegerType()),
    StructField("rows_before", LongType()),
    StructField("rows_after", LongType()),
    StructField("ctl_validfrom", StringType()),
    StructField("relevance_value", StringType()),
])
#: columns of the long-form statistics table
STATISTICS_SCHEMA = StructType([
    StructField("loading_id", IntegerType()),
    StructField("entity_id", IntegerType()),
    StructField("stat_id", IntegerType()),
    StructField("value", StringType()),
    StructField("payload", StringType()),
])
#: statistic ids: application id, load time, change, business date, newest mark
STAT_APPLICATION_ID = 15
STAT_LOAD_TIME = 11
STAT_CHANGE = 2
STAT_BUSINESS_DATE = 5
STAT_MAX_CDC_DATE = 1


# R1 ----------------------------------------------------------------------------
def run_ledger_rows(table_stats: DataFrame, ctl_loading: int, ctl_validfrom: str,
                    relevance_value: str | None, force_load: bool) -> DataFrame:
    """Ledger rows for all targets of a run.

    ``table_stats`` has ``calculated_table``, ``count_rows`` and
    ``last_modified`` (UTC text of the newest file); the change flag is
    ``(load time < last_modified or forced) and rows > 0``.
    """
    rows = table_stats.select(
        "calculated_table",
        F.lit(ctl_loading).alias("ctl_loading"),
        F.lit(ctl_validfrom).alias("ctl_validfrom"),
        F.lit(relevance_value).cast("string").alias("relevance_value"),
        F.lit(int(bool(force_load))).alias("is_force_load"),
        "count_rows",
        change_flag(F.lit(ctl_validfrom), F.col("last_modified"), bool(force_load),
                    F.col("count_rows")).alias("is_change"))
    return conform_schema(rows, RUN_LEDGER_SCHEMA)


def record_run(spark: SparkSession, ledger: Mart, rows: DataFrame) -> Mart:
    return append_rows(spark, rows, ledger)


# R2 ----------------------------------------------------------------------------
def run_statistics(runs: DataFrame) -> DataFrame:
    """Standard statistics of each run in long form with their JSON payloads.

    ``runs`` has ``loading_id, entity_id, application_id, ctl_validfrom,
    change, business_date, max_cdc_date``; the change statistic is only
    emitted when the change flag is set.
    """
    def stat(stat_id: int, value) -> F.Column:
        return F.struct(F.lit(stat_id).alias("stat_id"), value.cast("string").alias("value"))

    long = runs.select(
        "loading_id", "entity_id", "change",
        F.inline(F.array(
            stat(STAT_APPLICATION_ID, F.col("application_id")),
            stat(STAT_LOAD_TIME, F.col("ctl_validfrom")),
            stat(STAT_CHANGE, F.col("change")),
            stat(STAT_BUSINESS_DATE, F.col("business_date")),
            stat(STAT_MAX_CDC_DATE, F.col("max_cdc_date")),
        )))
    long = long.where((F.col("stat_id") != STAT_CHANGE) | (F.coalesce(F.col("change"), F.lit(0)) != 0))
    return long.select(
        F.col("loading_id").cast("int").alias("loading_id"),
        F.col("entity_id").cast("int").alias("entity_id"),
        F.col("stat_id").cast("int").alias("stat_id"),
        "value",
        statistic_payload(F.col("loading_id"), F.col("entity_id"), F.col("stat_id"),
                          F.col("value")).alias("payload"))


# R3 ----------------------------------------------------------------------------
@dataclass(frozen=True)
class Step:
    """One step of a stepped load: ``run(spark, params)`` does the work."""
    number: int
    run: Callable[[SparkSession, Mapping[str, object]], object]
    name: str = ""

    def __post_init__(self):
        if not isinstance(self.number, int) or self.number < 0:
            raise ValueError(f"step must be an int >= 0, got {self.number!r}")


def step_of(file_name: str) -> int:
    """Step number of a script name: its single run of digits (``stat12.sql`` -> 12)."""
    runs = re.findall(r"\d+", file_name)
    if len(runs) != 1:
        raise ValueError(f"expected exactly one number in the file name {file_name!r}")
    return int(runs[0])


def sql_step(number: int, statements: Sequence[str], name: str = "") -> Step:
    """A step that runs SQL statements; step params bind as ``:name`` parameters
    and, under the key ``names``, fill ``{name}`` placeholders."""
    def run(spark: SparkSession, params: Mapping[str, object]):
        params = dict(params)
        names = params.pop("names", None)
        return run_sql_script(spark, statements, params, names)
    return Step(number, run, name)


def steps_from_sql_files(directory: str, pattern: str = "*.sql") -> list[Step]:
    """One SQL step per script found (recursively) under ``directory``; the step
    number comes from the file name, which must hold exactly one number."""
    steps = []
    for path in sorted(Path(directory).rglob(pattern)):
        steps.append(sql_step(step_of(path.name), split_statements(path.read_text(encoding="utf-8")),
                              str(path)))
    return steps


def stepped_load(spark: SparkSession, steps: Sequence[Step], step_ledger: Mart,
                 target: Mart | None, target_name: str, ctl_validfrom: str,
                 relevance_value: str | None, recovery_mode: bool = False,
                 params: Mapping[str, object] | None = None) -> DataFrame:
    """Run the steps in ascending order, skipping those already finished in the
    newest run for this relevance (recovery mode), and record each step's row
    counts before and after in the step ledger (the target is counted once between two
    steps).  Returns this run's rows."""
    def rows_of(mart: Mart | None) -> int:
        return mart.read(spark).count() if mart is not None else 0

    done = -1  # nothing finished yet (so a step 0 still runs)
    if recovery_mode:
        done = resume_step(spark, step_ledger.read(spark), target_name, relevance_value,
                           True, none_value=-1).first()[0]
    recorded, before = [], None
    for step in sorted(steps, key=lambda s: s.number):
        if step.number <= done:
            continue
        if before is None:
            before = rows_of(target)
        step.run(spark, dict(params or {}))
        after = rows_of(target)
        row = (target_name, step.number, before, after, ctl_validfrom, relevance_value)
        append_rows(spark, spark.createDataFrame([row], STEP_LEDGER_SCHEMA), step_ledger)
        recorded.append(row)
        before = after
    return spark.createDataFrame(recorded, STEP_LEDGER_SCHEMA)
