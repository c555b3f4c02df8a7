"""Whole mart refresh (R4): the flagship run, over one mart or several.

define and recover tables --> relevance of every source --> transfers (dynamic partition
overwrite) --> one inventory of all targets --> compaction of touched partitions and
retention --> newest partition, business date and newest load mark of every target --> change
flags --> ledger rows (appended once, ledger compacted) --> run marks and statistics.

What a run reads of a mart beyond its load: the file listing, and the footers of the folders
that changed since the last run.  Row counts of the others come from the partition table that
the last run kept beside the mart.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, replace
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.columns import (DEFAULT_BLOCK_BYTES, DEFAULT_BLOCKS_PER_FILE,
                                        DEFAULT_LIFETIME_DAYS, now_text, partition_spec_map)
from tidemart.operators.aggregate import (max_value, relevance_value, rows_per_table, run_marks)
from tidemart.operators.partitions import (bytes_per_row, compact, compact_flat, key_columns,
                                           partition_inventory, retention)
from tidemart.operators.project import partition_filter, transfer_projection
from tidemart.plans.ledger import record_run, run_ledger_rows, run_statistics
from tidemart.plans.mart import Mart, path_exists
from tidemart.session import saved
from tidemart.sources.folders import Folder
from tidemart.sources.tables import (append_rows, archive_reload, column_plan, create_mart,
                                     overwrite_partitions, overwrite_partitions_sized,
                                     recover_partitions)


@dataclass(frozen=True)
class RunSettings:
    loading_id: int
    load_time: str | None = None         # 'yyyy-MM-dd HH:mm:ss' (UTC), the run's load mark; None = now
    entity_id: int = 0
    application_id: str | None = None
    relevance: str | None = None          # None = compute max(business date) of the source
    force_load: bool = False
    lifetime_days: int = DEFAULT_LIFETIME_DAYS
    retention_column: str | None = None   # None = by partition modification time
    compaction_column: str | None = None  # None = partitions modified since load_time
    business_date_column: str | None = None  # required, here or in the target
    source_condition: str | None = None  # optional SQL filter on the source (incremental load)
    size_files_on_load: bool = True       # size files from the mart's bytes per row when known
    block_bytes: int = DEFAULT_BLOCK_BYTES
    blocks_per_file: float = DEFAULT_BLOCKS_PER_FILE
    loading_column: str = "ctl_loading"      # the target's columns that a load fills
    load_time_column: str = "ctl_validfrom"


@dataclass(frozen=True)
class Target:
    """One mart of a run; what is None is taken from the run's settings."""
    name: str
    source: DataFrame
    mart: Mart
    relevance: str | None = None
    lifetime_days: int | None = None
    retention_column: str | None = None
    compaction_column: str | None = None
    business_date_column: str | None = None
    source_condition: str | None = None

    def settings(self, run: RunSettings) -> RunSettings:
        own = {k: getattr(self, k) for k in ("relevance", "lifetime_days", "retention_column",
                                             "compaction_column", "business_date_column",
                                             "source_condition")}
        out = replace(run, **{k: v for k, v in own.items() if v is not None})
        if not out.business_date_column:
            raise ValueError(f"{self.name}: business_date_column is not set")
        missing = {out.business_date_column, out.loading_column, out.load_time_column} \
            - set(self.mart.columns)
        if missing:
            raise ValueError(f"{self.name}: the mart has no columns {sorted(missing)}")
        return out


@dataclass(frozen=True)
class RunResult:
    """``summary``: a row per target; ``marks``: the run's business date and newest load mark
    (minimum over the targets); ``rows``: step, table, rows."""
    summary: DataFrame
    marks: DataFrame
    rows: DataFrame


SUMMARY_SCHEMA = ("calculated_table string, ctl_loading int, ctl_validfrom string, "
                  "relevance_value string, is_force_load int, count_rows bigint, is_change int, "
                  "business_date string, max_cdc_date string, rows_kept bigint")

_INVENTORY = ("partition", "location", "files", "bytes", "modified_at", "modified_utc", "rows")


# the partition table kept beside a mart ---------------------------------------------------
def _kept(spark: SparkSession, mart: Mart) -> Folder:
    return Folder(spark, mart.path + "__partitions")


def known_partitions(spark: SparkSession, mart: Mart) -> DataFrame | None:
    """Inventory with rows as the last run left it; None without one.  It may be out of date:
    its user compares files, bytes and modification time of each partition."""
    versions = [f for f in _kept(spark, mart).folders() if f.child("_SUCCESS").exists()]
    if not versions:
        return None
    return spark.read.parquet(max(versions, key=lambda f: f.path).path)


def keep_partitions(spark: SparkSession, mart: Mart, inventory: DataFrame) -> None:
    """Keep ``inventory`` for the next run: a new version first, then the old ones go."""
    old = _kept(spark, mart).folders()
    inventory.write.parquet(_kept(spark, mart).child(f"v{time.time_ns():020d}").path)
    for folder in old:
        folder.delete()


# the run -----------------------------------------------------------------------------------
def define_mart(spark: SparkSession, mart: Mart) -> Mart:
    """The catalog entry of a registered mart: created when it is missing or other than the
    mart says (S7), its partitions made equal to the folders (S10)."""
    if not mart.table:
        return mart
    if spark.catalog.tableExists(mart.table):
        known = [(c.name, c.dataType) for c in spark.catalog.listColumns(mart.table)]
        if known == column_plan(mart.schema):
            if mart.is_partitioned and path_exists(spark, mart.path):
                recover_partitions(spark, mart.table)
            return mart
        mart = mart.located(spark)
    return create_mart(spark, mart.table, mart)


def refresh_mart(spark: SparkSession, source: DataFrame, mart: Mart, ledger: Mart,
                 run: RunSettings, table_name: str | None = None,
                 statistics: Mart | None = None) -> DataFrame:
    """Refresh ``mart`` from ``source`` and record the run; returns a one-row
    summary (the ledger row plus business date, newest mark and kept rows).
    With ``statistics``, the run's long-form statistics are appended there."""
    target = Target(table_name or mart.table or mart.path, source, mart)
    return refresh_marts(spark, [target], ledger, run, statistics).summary


def refresh_marts(spark: SparkSession, targets: Sequence[Target], ledger: Mart,
                  run: RunSettings, statistics: Mart | None = None) -> RunResult:
    """Refresh every target and record the run: one ledger row per target, one set of
    statistics with the run's marks."""
    run = replace(run, load_time=run.load_time or now_text(),
                  application_id=run.application_id or spark.sparkContext.applicationId)
    settings = {t.name: t.settings(run) for t in targets}
    if len(settings) < len(targets):
        raise ValueError("the targets of a run need different names")
    if run.force_load:  # full reload; the ledger keeps its history
        archive_reload(spark, {t.name: t.mart for t in targets}, keep=())
    marts = {t.name: define_mart(spark, t.mart) for t in targets}
    ledger = define_mart(spark, ledger)

    sources = {t.name: t.source.filter(F.expr(settings[t.name].source_condition))
               if settings[t.name].source_condition else t.source for t in targets}
    relevance = {n: s.relevance for n, s in settings.items()} | {r["target"]: r[1] for r in _each(
        {n: relevance_value(sources[n], s.business_date_column)
         for n, s in settings.items() if s.relevance is None})}

    known = {}
    for name, mart in marts.items():
        if mart.is_partitioned:
            known[name] = known_partitions(spark, mart)
            if known[name] is None and not run.force_load:
                known[name] = saved(partition_inventory(spark, mart), "known")
        if relevance[name] is not None:  # nothing to load when the source is empty
            s = settings[name]
            constants = {s.loading_column: s.loading_id, s.load_time_column: s.load_time}
            loaded = transfer_projection(sources[name], mart.schema, constants,
                                         date_column=s.business_date_column)
            write_load(spark, sources[name], loaded, mart, constants,
                       int(s.block_bytes * s.blocks_per_file), s.size_files_on_load,
                       known.get(name))

    before = _inventories(spark, {n: partition_inventory(spark, m, known=known.get(n))
                                  for n, m in marts.items()})
    loads = {r["target"]: r for r in before.groupBy("target").agg(
        F.sum("rows").alias("rows"), F.max("modified_utc").alias("modified")).collect()}

    after = {}
    for name, mart in marts.items():
        s = settings[name]
        own = key_columns(before.filter(F.col("target") == name).drop("target"), mart)
        window = {"column": s.compaction_column} if s.compaction_column else {"lower": s.load_time}
        done = compact(spark, mart, block_bytes=s.block_bytes, blocks_per_file=s.blocks_per_file,
                       inventory=own if mart.is_partitioned else None, **window)
        # by time, partitions that were rewritten by key are dated anew
        dated_anew = s.compaction_column and not s.retention_column
        retention(spark, mart, s.lifetime_days, column=s.retention_column, now=s.load_time,
                  inventory=own if mart.is_partitioned and not dated_anew else None)
        after[name] = partition_inventory(spark, mart, known=own, rewritten=done)
    left = _inventories(spark, after)
    for name, mart in marts.items():
        if mart.is_partitioned:
            keep_partitions(spark, mart, left.filter(F.col("target") == name).drop("target"))

    has_data = (F.col("partition") != "") & (F.col("files") > 0)
    ends = {r["target"]: r for r in left.groupBy("target").agg(
        F.sum("rows").alias("rows"), F.max("modified_utc").alias("modified"),
        F.max(F.when(has_data, F.col("partition"))).alias("last"))
        .withColumn("spec", partition_spec_map("last")).collect()}
    marks = {r["target"]: r for r in _each({
        n: _marks(spark, marts[n], settings[n], dict((ends[n]["spec"] if n in ends else None) or {}))
        for n in marts})}

    rows, summary = None, []
    for name in marts:
        load, end = loads.get(name), ends.get(name)
        # newest file of the run: after the load, or later if compaction rewrote
        # files (retention may have removed everything the load wrote)
        newest = max((x["modified"] for x in (load, end) if x and x["modified"]), default=None)
        count = int(load["rows"] or 0) if load else 0
        stats = spark.createDataFrame(
            [(name, count, newest)],
            "calculated_table string, count_rows bigint, last_modified string")
        line = run_ledger_rows(stats, run.loading_id, run.load_time, relevance[name], run.force_load)
        rows = line if rows is None else rows.unionByName(line)
    record_run(spark, ledger, rows)
    compact_flat(spark, ledger, run.block_bytes, run.blocks_per_file)

    for line in rows.collect():
        name = line["calculated_table"]
        end = ends.get(name)
        summary.append((*line, marks[name]["business_date"], marks[name]["max_cdc_date"],
                        int(end["rows"] or 0) if end else 0))
    summary = spark.createDataFrame(summary, SUMMARY_SCHEMA)
    result = RunResult(summary, run_marks(summary), rows_per_table(summary.select(
        F.lit(1).alias("step"), F.col("calculated_table").alias("table"),
        F.col("count_rows").alias("rows"))))
    if statistics is not None:
        append_rows(spark, refresh_statistics(summary, run), define_mart(spark, statistics))
    return result


def _each(frames: Mapping[str, DataFrame]) -> list:
    """Rows of the targets' one-row frames, tagged with their target, from one job."""
    tagged = [df.select(F.lit(n).alias("target"), "*") for n, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged).collect() if tagged else []


def _inventories(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """The targets' inventories as one saved table (one job), without their key columns."""
    tagged = [df.select(F.lit(n).alias("target"), *_INVENTORY) for n, df in frames.items()]
    return saved(reduce(DataFrame.unionByName, tagged), "inventories")


def _marks(spark: SparkSession, mart: Mart, s: RunSettings, last: Mapping[str, str]) -> DataFrame:
    """business_date and max_cdc_date of a target: from its newest partition where its key
    says the date, else from its rows."""
    current = mart.read(spark)
    newest = max_value(partition_filter(current, last), s.load_time_column, alias="max_cdc_date")
    newest = newest.select(F.col("max_cdc_date").cast("string"))
    if s.business_date_column in last:
        date = F.lit(last[s.business_date_column]).cast("string").alias("business_date")
        return newest.select(date, "max_cdc_date")
    date = max_value(current, s.business_date_column, alias="business_date")
    return date.select(F.col("business_date").cast("string")).crossJoin(newest)  # one row each


# Typical in-memory width of a value per type, used only to split a
# source's stored bytes per row among the columns a load keeps.
_TYPE_WEIGHTS = {"boolean": 1, "byte": 1, "short": 2, "int": 4, "date": 4, "float": 4,
                 "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}
_DEFAULT_WEIGHT = 20  # strings, decimals and nested values


def _type_weight(dt) -> int:
    return _TYPE_WEIGHTS.get(dt.simpleString(), _DEFAULT_WEIGHT)


def write_load(spark: SparkSession, source: DataFrame, loaded: DataFrame, mart: Mart,
               constants: Mapping[str, object], target_file_bytes: int,
               sized: bool = True, inventory: DataFrame | None = None) -> Mart:
    """Write a transferred load into ``mart``, replacing the partitions it covers.

    Files are sized from the mart's measured bytes per row (of ``inventory``, if there is
    one with rows), or, for a first load, from the source files scaled by the (type-weighted)
    share of the source's columns the load keeps; without either (or with ``sized=False``)
    the rebalanced write is used.
    """
    if not (sized and mart.is_partitioned):
        return overwrite_partitions(loaded, mart)
    bpr = bytes_per_row(spark, mart, inventory)
    weights = {f.name: _type_weight(f.dataType) for f in source.schema.fields}
    kept = sum(weights[c] for c in mart.data_columns if c in weights and c not in constants)
    share = max(kept, 1) / max(sum(weights.values()), 1)
    # bpr None (empty mart): estimated from the source files in the counting pass
    return overwrite_partitions_sized(loaded, mart, bpr, target_file_bytes, source_share=share)


def refresh_statistics(summary: DataFrame, run: RunSettings) -> DataFrame:
    """Long-form statistics (R2) of a run from its targets' summary: changed if any target
    is, marks as the minimum over the targets."""
    load_time = F.max("ctl_validfrom").alias("ctl_validfrom")
    one = summary.agg(F.max("is_change").alias("change"), load_time,
                      *[F.min(c).alias(c) for c in ("business_date", "max_cdc_date")])
    runs = one.select(
        F.lit(run.loading_id).alias("loading_id"), F.lit(run.entity_id).alias("entity_id"),
        F.lit(run.application_id).cast("string").alias("application_id"),
        "ctl_validfrom", "change", "business_date", "max_cdc_date")
    return run_statistics(runs)
