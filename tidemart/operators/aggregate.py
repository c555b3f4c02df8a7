"""Aggregates (A1-A8) and step ordering (T2).

The original job computes each of these as a global scalar per table; here they
are DataFrames (grouped by table or target where that lets one job serve many
tables), so the driver only ever sees the final, tiny result.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.project import filter_condition


# A1 ----------------------------------------------------------------------------
def row_count(df: DataFrame, condition: str | None = None) -> DataFrame:
    """Filtered row count as a one-row frame (``row_count``)."""
    return filter_condition(df, condition).agg(F.count(F.lit(1)).alias("row_count"))


def table_row_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None],
                     condition: str | None = None) -> DataFrame:
    """``(table, row_count)`` for many tables in one job; a table without a
    frame (no target) counts 0."""
    parts = []
    for name, df in tables.items():
        if df is None or not name:
            parts.append(spark.range(1).select(F.lit(name or "").alias("table"),
                                               F.lit(0).cast("bigint").alias("row_count")))
        else:
            parts.append(row_count(df, condition).select(F.lit(name).alias("table"), "row_count"))
    return reduce(DataFrame.unionByName, parts)


# A2 ----------------------------------------------------------------------------
def max_value(df: DataFrame, column: str, condition: str | None = None,
              alias: str = "max_value") -> DataFrame:
    """Filtered maximum of a column; one row, NULL when nothing matches."""
    return filter_condition(df, condition).agg(F.max(F.col(column)).alias(alias))


def max_values(df: DataFrame, specs: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """Several filtered maxima in one pass: ``{alias: (column, condition)}``.

    Each condition becomes a conditional aggregate (``max(CASE WHEN cond THEN
    col END)``), so one scan answers all of them; empty matches give NULL.
    """
    aggs = []
    for alias, (column, condition) in specs.items():
        value = F.col(column)
        if condition and condition.strip():
            value = F.when(F.expr(condition), value)
        aggs.append(F.max(value).alias(alias))
    return df.agg(*aggs)


# A3 ----------------------------------------------------------------------------
def relevance_value(df: DataFrame, column: str = "report_dt") -> DataFrame:
    """Newest value of the business-date column, as text."""
    return df.agg(F.max(F.col(column)).cast("string").alias("relevance_value"))


# A4 ----------------------------------------------------------------------------
def load_delta(spark: SparkSession, target: Callable[[], DataFrame] | None,
               load: Callable[[], object]) -> DataFrame:
    """Row count of the target before and after running ``load`` (0 without a
    target).  ``target`` is a function so the second count sees the new files."""
    before = target().count() if target is not None else 0
    load()
    after = target().count() if target is not None else 0
    return spark.createDataFrame([(int(before), int(after))],
                                 "rows_before bigint, rows_after bigint")


# A5 ----------------------------------------------------------------------------
def run_marks(marks: DataFrame, columns=("business_date", "max_cdc_date")) -> DataFrame:
    """Run-level marks: the minimum over all tables, NULLs ignored."""
    return marks.agg(*[F.min(F.col(c)).alias(c) for c in columns])


# A6 ----------------------------------------------------------------------------
def rows_per_table(entries: DataFrame) -> DataFrame:
    """``(step, table, rows)`` per step and table; ``(0, NULL, 0)`` when empty."""
    grouped = (entries.where(F.col("table").isNotNull())
               .groupBy("step", "table").agg(F.sum("rows").cast("bigint").alias("rows")))
    default = (entries.where(F.col("table").isNotNull()).agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") == 0)
               .select(F.lit(0).cast("int").alias("step"), F.lit(None).cast("string").alias("table"),
                       F.lit(0).cast("bigint").alias("rows")))
    return grouped.select(F.col("step").cast("int").alias("step"), "table", "rows").unionByName(default)


# A7 ----------------------------------------------------------------------------
def computed_tables(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("table").isNotNull()).select("table").distinct()


# A8 ----------------------------------------------------------------------------
def resume_steps(step_ledger: DataFrame, relevance_value: str | None,
                 none_value: int = 0) -> DataFrame:
    """Per target, the last step finished in its newest run for this relevance.

    Among the target's rows with the newest load time, the largest step whose
    relevance equals ``relevance_value``; ``none_value`` (0) when that newest
    run has none.
    One aggregation pass (max over a (load time, step) struct), so a target
    holding most of the ledger is combined map-side like any other.
    """
    matching = F.col("relevance_value").eqNullSafe(F.lit(relevance_value))
    probe = F.struct(F.col("ctl_validfrom").alias("t"),
                     F.when(matching, F.col("step")).otherwise(F.lit(-1)).alias("s"))
    return (step_ledger.groupBy("target").agg(F.max(probe).alias("m"))
            .select("target", F.when(F.col("m.s") >= 0, F.col("m.s"))
                    .otherwise(F.lit(none_value)).cast("int").alias("last_computed_step")))


def resume_step(spark: SparkSession, step_ledger: DataFrame, target: str,
                relevance_value: str | None, recovery_mode: bool,
                none_value: int = 0) -> DataFrame:
    """One-row ``last_computed_step`` for one target (``none_value`` outside
    recovery mode or when nothing matches)."""
    if not recovery_mode:
        return spark.range(1).select(F.lit(none_value).alias("last_computed_step"))
    found = (resume_steps(step_ledger.where(F.col("target") == F.lit(target)), relevance_value,
                          none_value)
             .agg(F.max("last_computed_step").alias("last_computed_step")))
    return found.select(F.coalesce(F.col("last_computed_step"), F.lit(none_value))
                        .alias("last_computed_step"))


# T2 ----------------------------------------------------------------------------
def ordered_steps(steps: DataFrame, step_column: str = "step") -> DataFrame:
    """Steps in ascending order; a negative step is an error."""
    checked = F.when(F.col(step_column) < 0, F.raise_error(
        F.concat(F.lit("step must be >= 0, got "), F.col(step_column).cast("string")))
    ).otherwise(F.col(step_column)).cast("int")
    return steps.withColumn(step_column, checked).orderBy(step_column)
