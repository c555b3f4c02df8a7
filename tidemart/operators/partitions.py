"""Partition maintenance (M1-M8) and the newest partition (T1).

Everything here works on a *partition inventory*: one row per partition folder
with its file count, bytes, newest modification time and (optionally) rows.
The inventory is a file listing, a listing of folder names (folders without files) and a row
count from the footers.  Spark's file index and the folder names are held on the driver;
plans and counts stay DataFrames, and folders to delete come over in batches.
"""

from __future__ import annotations

import time
from functools import reduce
from itertools import islice
from operator import or_
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (LongType, StringType, StructField, StructType,
                               TimestampType)

from tidemart.functions.columns import (DEFAULT_BLOCK_BYTES, DEFAULT_BLOCKS_PER_FILE,
                                        cutoff_text, file_factor, instant_text,
                                        java_quote, partition_spec_map,
                                        unescape_partition_value)
from tidemart.operators.project import range_predicate
from tidemart.plans.mart import Mart, delete_path, path_exists
from tidemart.sources.folders import (ASIDE, STAGED, Folder, begin_switch, new_version, put_back,
                                      settle, supersede)
from tidemart.session import saved
from tidemart.sources.tables import (alter_partitions, clear_mart, file_plan, key_text,
                                     place_in_files, refresh_catalog, sql_text)

#: input bytes rewritten by one compaction job (bounds one shuffle)
DEFAULT_MAX_JOB_BYTES = 2 * 1024 ** 4
#: parallel folder deletions issued by the driver (metadata calls only)
DELETE_THREADS = 16
#: partitions dropped and deleted together
DELETE_BATCH = 1000


def _relative_partition(path: Column, keys: Sequence[str], root: str) -> Column:
    """``k1=v1/k2=v2`` folder text of a file path, NULL unless the file sits
    exactly in a ``k1=../k2=..`` folder for the mart's keys right below ``root``."""
    if not keys:
        return F.lit("")
    pattern = "^(" + "/".join(java_quote(k) + "=[^/]*" for k in keys) + ")/[^/]+$"
    below = F.substring(path, F.lit(len(root) + 2), F.length(path))
    return F.when(path.startswith(root + "/") & below.rlike(pattern),
                  F.regexp_extract(below, pattern, 1))


def _key_value(part: Column, key: str) -> Column:
    raw = F.regexp_extract(part, "(^|/)" + java_quote(key) + "=([^/]*)", 2)
    return unescape_partition_value(raw)


_LISTING_SCHEMA = StructType([
    StructField("path", StringType()), StructField("modificationTime", TimestampType()),
    StructField("length", LongType())])


# M2 (listing part) -------------------------------------------------------------
def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """Every visible file under ``root`` that has bytes: path, length, modification time.

    Uses the ``binaryFile`` source without its content column, so no file is
    opened; names starting with ``_`` or ``.`` are skipped by Spark's listing.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], _LISTING_SCHEMA)
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(root).select("path", "modificationTime", "length"))


def partition_folders(spark: SparkSession, mart: Mart) -> DataFrame:
    """``partition`` text of every key folder below the mart's location, also of folders
    that hold no file (a listing of folder names, no file is looked at)."""
    names = Folder(spark, mart.path).below([f"{k}=" for k in mart.partition_by])
    return spark.createDataFrame([(n,) for n in names], "partition string")


def rows_per_partition(spark: SparkSession, mart: Mart) -> DataFrame:
    """Key columns and ``rows`` of each partition, from the files' footers: the count is
    pushed into the Parquet reader, so no row is read.  Readers that do not push it give the
    same rows from a scan without columns."""
    keys = list(mart.partition_by)
    if not path_exists(spark, mart.path):
        return spark.createDataFrame(
            [], ", ".join([f"`{k}` string" for k in keys] + ["rows bigint"]))
    # settings of its own: the session of the caller keeps its readers
    counting = spark.newSession()
    counting.conf.set("spark.sql.sources.useV1SourceList", "")
    counting.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    data = counting.read.schema(mart.schema).parquet(mart.path)
    return data.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def _without_scheme(location: Column) -> Column:
    return F.regexp_replace(location, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


# M2 ----------------------------------------------------------------------------
def partition_inventory(spark: SparkSession, mart: Mart, with_rows: bool = True,
                        pattern: str | None = None, known: DataFrame | None = None,
                        levels: int | None = None, rewritten: DataFrame | None = None
                        ) -> DataFrame:
    """One row per partition folder of ``mart``, folders without files included.

    Columns: ``partition`` (folder text, as SHOW PARTITIONS prints it), one column per
    partition key (decoded value, NULL for the NULL folder), ``location``, ``files``,
    ``bytes`` (both 0 for a folder without data), ``modified_at`` (newest file),
    ``modified_utc`` (its UTC text) and, when ``with_rows``, ``rows``.
    An unpartitioned mart gives a single row with ``partition = ''`` if it holds files.

    ``pattern`` keeps only folders whose whole path, without scheme and authority, matches
    it.  ``known`` (an earlier inventory with rows) saves counting: only folders whose files,
    bytes or newest modification differ from it are counted, except those in ``rewritten``
    (``partition``), whose rows are known to be the same.  ``levels`` rolls the folders up to
    the first so many keys (1: first-level listing).
    """
    keys = list(mart.partition_by)
    files = file_listing(spark, mart.path)
    part = _relative_partition(F.col("path"), keys, Folder(spark, mart.path).qualified())
    # the folder is a function of the partition text, so grouping by both keeps
    # a hash aggregate (no string aggregation buffer)
    inv = (files.select(part.alias("partition"),
                        F.regexp_replace("path", "/[^/]+$", "").alias("location"),
                        "length", "modificationTime")
           .where(F.col("partition").isNotNull())
           .groupBy("partition", "location")
           .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                F.max("modificationTime").alias("modified_at")))
    if keys:
        every = partition_folders(spark, mart).withColumnRenamed("partition", "__folder")
        inv = (inv.join(every, F.col("partition") == F.col("__folder"), "full_outer")
               .select(F.coalesce("partition", "__folder").alias("partition"),
                       F.coalesce("location", F.concat(F.lit(Folder(spark, mart.path).qualified()),
                                                       F.lit("/"), F.col("__folder")))
                       .alias("location"),
                       F.coalesce("files", F.lit(0).cast("bigint")).alias("files"),
                       F.coalesce("bytes", F.lit(0).cast("bigint")).alias("bytes"),
                       "modified_at"))
    if pattern:
        inv = inv.where(_without_scheme(F.col("location")).rlike("^(?:" + pattern + ")$"))
    inv = key_columns(inv, mart).select(
        "partition", *keys, "location", "files", "bytes", "modified_at",
        instant_text("modified_at").alias("modified_utc"))
    if with_rows:
        inv = _with_rows(spark, mart, inv, known, rewritten)
    if levels is not None and levels < len(keys):
        inv = _rolled_up(inv, keys[:levels], with_rows)
    return inv


def key_columns(inv: DataFrame, mart: Mart) -> DataFrame:
    """``inv`` with the decoded key values of its partition texts."""
    return inv.withColumns({k: _key_value(F.col("partition"), k) for k in mart.partition_by}) \
        if mart.partition_by else inv


def _with_rows(spark: SparkSession, mart: Mart, inv: DataFrame, known: DataFrame | None,
               rewritten: DataFrame | None) -> DataFrame:
    keys = list(mart.partition_by)
    if known is not None and keys:
        same = ("files", "bytes", "modified_at")
        seen = known.select(F.col("partition").alias("__part"),
                            *[F.col(c).alias(f"__{c}") for c in same],
                            F.col("rows").alias("__rows"))
        inv = saved(inv, "inventory").join(seen, F.col("partition") == F.col("__part"), "left")
        fresh = F.col("__rows").isNotNull()
        for c in same:
            fresh &= F.col(c).eqNullSafe(F.col(f"__{c}"))
        if rewritten is not None:
            done = rewritten.select(F.col("partition").alias("__done")).distinct()
            inv = inv.join(done, F.col("partition") == F.col("__done"), "left")
            fresh |= F.col("__done").isNotNull() & F.col("__rows").isNotNull()
        inv = inv.withColumn("__rows", F.when(fresh | (F.col("files") == 0),
                                              F.coalesce("__rows", F.lit(0).cast("bigint"))))
        inv = inv.drop("__part", "__done", *[f"__{c}" for c in same])
        changed = [r["location"] for r in
                   inv.filter("__rows is null").select("location").toLocalIterator()]
        rows = _rows_of_folders(spark, mart, changed)
    else:
        inv = inv.withColumn("__rows", F.lit(None).cast("bigint"))
        rows = rows_per_partition(spark, mart)
    if keys:
        rows = rows.select(*[F.col(k).cast("string").alias(f"__r_{k}") for k in keys], "rows")
        cond = [inv[k].eqNullSafe(rows[f"__r_{k}"]) for k in keys]
        inv = inv.join(rows, cond, "left").drop(*[f"__r_{k}" for k in keys])
    else:
        inv = inv.join(rows.withColumn("partition", F.lit("")), "partition", "left")
    return inv.withColumn("rows", F.coalesce("__rows", "rows", F.lit(0).cast("bigint"))).drop("__rows")


def _rows_of_folders(spark: SparkSession, mart: Mart, locations: Sequence[str]) -> DataFrame:
    """:func:`rows_per_partition` that opens the footers of these folders only."""
    if not locations:
        return spark.createDataFrame(
            [], ", ".join([f"`{k}` string" for k in mart.partition_by] + ["rows bigint"]))
    data = (spark.read.schema(mart.schema).option("basePath", mart.path).parquet(*locations))
    return data.groupBy(*mart.partition_by).agg(F.count(F.lit(1)).alias("rows"))


def _rolled_up(inv: DataFrame, keys: Sequence[str], with_rows: bool) -> DataFrame:
    part = F.regexp_extract("partition", "^" + "/".join(["[^/]*"] * len(keys)), 0)
    above = F.expr("substr(location, 1, length(location) - length(partition) + length(__part))")
    sums = [F.sum(c).alias(c) for c in ("files", "bytes")]
    return (inv.withColumn("__part", part).withColumn("__loc", above)
            .groupBy(F.col("__part").alias("partition"), *keys, F.col("__loc").alias("location"))
            .agg(*sums, F.max("modified_at").alias("modified_at"),
                 F.max("modified_utc").alias("modified_utc"),
                 *([F.sum("rows").alias("rows")] if with_rows else [])))


# A9 ----------------------------------------------------------------------------
def directory_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Total ``bytes`` of the visible files below a folder (0 when there are none)."""
    return file_listing(spark, path).agg(
        F.coalesce(F.sum("length"), F.lit(0).cast("bigint")).alias("bytes"))


def bytes_per_row(spark: SparkSession, mart: Mart, inventory: DataFrame | None = None
                  ) -> float | None:
    """Stored bytes per row of the whole mart (a listing and a count from the footers, or an
    ``inventory`` that has them); None when the mart holds no rows yet."""
    inv = partition_inventory(spark, mart) if inventory is None else inventory
    total = inv.agg(F.sum("bytes"), F.sum("rows")).first()
    return float(total[0]) / float(total[1]) if total[1] else None


# P8 ----------------------------------------------------------------------------
def partitions_with_data(inventory: DataFrame) -> DataFrame:
    return inventory.filter(F.col("bytes") > 0)


# M3 ----------------------------------------------------------------------------
def compaction_plan(inventory: DataFrame, block_bytes: int = DEFAULT_BLOCK_BYTES,
                    blocks_per_file: float = DEFAULT_BLOCKS_PER_FILE) -> DataFrame:
    """Target file count per partition and whether a rewrite would reduce it."""
    factor = file_factor(F.col("bytes"), block_bytes, blocks_per_file)
    return (inventory.withColumn("factor", factor)
            .withColumn("needs_rewrite", (F.col("factor") > 0) & (F.col("files") > F.col("factor")))
            .withColumn("target_bytes", F.lit(int(block_bytes * blocks_per_file)).cast("bigint")))


# M4 ----------------------------------------------------------------------------
def compaction_candidates(inventory: DataFrame, mart: Mart, column: str | None = None,
                          lower: str | None = None, upper: str | None = None) -> DataFrame:
    """Partitions whose key value (``column``) or, by default, newest
    modification time (UTC text) lies in the inclusive window."""
    return inventory.filter(range_predicate(_window_value(mart, column), lower, upper))


def _window_value(mart: Mart, column: str | None) -> Column:
    if not column:
        return F.col("modified_utc")
    if column not in mart.partition_by:
        raise ValueError(f"{column!r} is not a partition column of the mart "
                         f"(keys: {list(mart.partition_by)})")
    return F.col(column)


# M5 ----------------------------------------------------------------------------
def compact_partitions(spark: SparkSession, mart: Mart, plan: DataFrame,
                       max_job_bytes: int = DEFAULT_MAX_JOB_BYTES) -> DataFrame:
    """Rewrite every planned partition into ``factor`` files of about equal size.

    The plan stays a DataFrame: it is joined with the mart on the partition keys, which prunes
    the folders to read (dynamic partition pruning), and numbers the files, so one shuffle
    sends each row to its file.  Rows take turns over a partition's files by their position,
    so a large partition spreads over many tasks and identical rows do too; a repeated task
    does the same.  A dynamic-overwrite path write then replaces exactly those folders.

    Partitions are grouped into jobs of about ``max_job_bytes`` input, which bounds the
    shuffle of one job however much of the mart is compacted; small runs are a single job.
    Returns the rewritten partitions with their file counts.
    """
    keys = list(mart.partition_by)
    if not keys:
        raise ValueError("compact_partitions needs a partitioned mart; use compact_flat")
    todo = plan_jobs(mart, plan, max_job_bytes)
    renamed = [F.col(f"__k{i}") != key_text(F.col(k)) for i, k in enumerate(keys)]
    if odd := todo.filter(reduce(or_, renamed)).first():
        raise ValueError(f"{odd['partition']} would be written to another folder: its value is "
                         "not how the key's type prints it; give the key type string")
    for job in todo.select("__group").distinct().orderBy("__group").toLocalIterator():
        out = compaction_frame(spark, mart, todo.filter(F.col("__group") == job["__group"]))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*keys).parquet(mart.path))
    refresh_catalog(spark, mart, "none")  # same partitions, new files
    return todo.select("partition", F.col("files").alias("files_before"), "factor")


def plan_jobs(mart: Mart, plan: DataFrame, max_job_bytes: int = DEFAULT_MAX_JOB_BYTES
              ) -> DataFrame:
    """The partitions to rewrite with their job (``__group``) and the numbers of their files;
    a saved table."""
    before = F.sum("bytes").over(
        Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1))
    chosen = plan.filter(F.col("needs_rewrite")).withColumn(
        "__job", F.floor(F.coalesce(before, F.lit(0)) / F.lit(int(max_job_bytes))))
    typed = [F.col(k).cast(mart.schema[k].dataType) for k in mart.partition_by]
    return file_plan(chosen, typed, F.col("factor"), F.col("__job"))


def compaction_frame(spark: SparkSession, mart: Mart, todo: DataFrame) -> DataFrame:
    """The rows of the planned partitions (:func:`plan_jobs`), placed for the rewrite."""
    sums = todo.agg(F.sum("bytes"), F.max("target_bytes")).first()
    src = spark.read.schema(mart.schema).parquet(mart.path)
    # rows of a file belong to one partition: positions that take turns give even files
    turn = F.shiftrightunsigned(F.xxhash64(src["_metadata.file_path"]), 16) \
        + src["_metadata.row_index"]
    # the comparison marks the plan as selective, so that its keys prune the scan
    return place_in_files(src, todo.filter(F.col("files") > F.col("factor")), mart.partition_by,
                          mart.columns, turn, float(sums[0] or 0), float(sums[1] or 1))


def compact(spark: SparkSession, mart: Mart, column: str | None = None,
            lower: str | None = None, upper: str | None = None,
            block_bytes: int = DEFAULT_BLOCK_BYTES,
            blocks_per_file: float = DEFAULT_BLOCKS_PER_FILE,
            inventory: DataFrame | None = None,
            max_job_bytes: int = DEFAULT_MAX_JOB_BYTES) -> DataFrame:
    """Inventory -> window -> plan -> rewrite (M2 + M4 + M3 + M5, or M6 when flat).

    A current ``inventory`` of the mart may be passed to skip the listing.
    """
    if not mart.is_partitioned:
        compact_flat(spark, mart, block_bytes, blocks_per_file)
        return spark.createDataFrame([], "partition string, files_before bigint, factor bigint")
    inv = inventory if inventory is not None else partition_inventory(spark, mart, with_rows=False)
    chosen = compaction_candidates(inv, mart, column, lower, upper)
    return compact_partitions(spark, mart, compaction_plan(chosen, block_bytes, blocks_per_file),
                              max_job_bytes)


# M6 ----------------------------------------------------------------------------
def compact_flat(spark: SparkSession, mart: Mart, block_bytes: int = DEFAULT_BLOCK_BYTES,
                 blocks_per_file: float = DEFAULT_BLOCKS_PER_FILE) -> dict:
    """Rewrite an unpartitioned mart into ``factor`` files of about equal size.

    A verified copy is written first; then

    * a registered mart is switched to the copy's folder by one change of its ``LOCATION``:
      readers see the old files or the new ones, never none.  Files that reach the old folder
      before the switch are moved over after it; address such a mart by its table, its folder
      changes (``location`` in the result);
    * a mart without a catalog entry is switched by two moves, between which its folder is
      missing.  The second one refuses to move into a folder that someone has recreated.

    If files were added since the mart was read, nothing is switched and a RuntimeError says
    so.  Wherever a run is cut off, the next writer or compaction ends the switch
    (:func:`tidemart.sources.folders.settle`) with every row, those appended meanwhile
    included, and with none that was cleared.
    """
    mart = settle(spark, mart)
    root = Folder(spark, mart.path)
    inv = compaction_plan(partition_inventory(spark, mart, with_rows=False),
                          block_bytes, blocks_per_file).first()
    if inv is None or not inv["needs_rewrite"]:
        return {"rewritten": False, "files_before": inv["files"] if inv else 0,
                "location": mart.path}
    factor, files_before = int(inv["factor"]), int(inv["files"])
    copy = new_version(root) if mart.table else root.beside(STAGED)
    read = root.files()
    written = _write_copy(spark, mart, copy, factor)
    if root.files() != read:
        copy.delete()
        raise RuntimeError(f"files were added to {mart.path} while it was compacted; "
                           "it was left as it is")
    if mart.table:
        supersede(copy, root, read)
        spark.sql(f"ALTER TABLE {mart.table} SET LOCATION {sql_text(copy.path)}")
    else:
        _switch_folder(root, copy, read)
    mart = settle(spark, mart)
    refresh_catalog(spark, mart, "none")
    return {"rewritten": True, "files_before": files_before, "factor": factor, "rows": written,
            "location": mart.path}


def _write_copy(spark: SparkSession, mart: Mart, copy: Folder, factor: int) -> int:
    """Write the mart's rows to ``copy`` in ``factor`` even files.  The rows are counted by
    the tasks that write them (once for each, also when tasks are repeated) and compared with
    the footers of the files they came from, so nothing is read twice."""
    seen = Observation()
    rows = spark.read.schema(mart.schema).parquet(mart.path).select(*mart.columns)
    expected = rows.count()
    (rows.repartition(factor).observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.mode("errorifexists").parquet(copy.path))
    written = int(seen.get["rows"]) if expected else 0
    if written != expected:
        raise RuntimeError(f"compacted copy has {written} rows, {expected} were read; "
                           f"{mart.path} was left as it is")
    return written


def _switch_folder(root: Folder, copy: Folder, read: set[str]) -> None:
    begin_switch(root, read)
    aside = root.beside(ASIDE)
    root.move(aside)
    try:
        if aside.files() != read:
            raise RuntimeError(f"files were added to {root.path} while it was compacted")
        copy.move(root)
    except RuntimeError:
        put_back(root)
        raise


# M1 ----------------------------------------------------------------------------
def list_partitions(spark: SparkSession, mart: Mart) -> DataFrame:
    """Partition texts: from the catalog when registered, else from the folders."""
    if mart.table:
        return spark.sql(f"SHOW PARTITIONS {mart.table}")
    return (partition_inventory(spark, mart, with_rows=False)
            .where(F.col("partition") != "").select("partition"))


# T1 ----------------------------------------------------------------------------
def last_partition(spark: SparkSession, mart: Mart, column: str | None = None) -> DataFrame:
    """The greatest partition text (string order of the whole ``k=v/...`` text)
    as ``partition`` plus its decoded ``spec`` map (only ``column`` if given).
    Partitions whose folder is gone do not count, whatever the catalog says.
    Empty result when the mart has no partitions (or none at all)."""
    if not mart.is_partitioned:
        return spark.createDataFrame([], "partition string, spec map<string,string>")
    newest = _newest_on_disk(spark, mart)
    top = spark.createDataFrame([(newest,)] if newest is not None else [], "partition string")
    spec = partition_spec_map(F.col("partition"))
    if column:
        spec = F.map_filter(spec, lambda k, _v: k == F.lit(column))
    return top.select("partition", spec.alias("spec"))


def _newest_on_disk(spark: SparkSession, mart: Mart) -> str | None:
    """Greatest partition text whose folder exists: partitions that only the catalog still
    knows are passed over, from the greatest down (usually the first one exists)."""
    if not mart.table:
        return (partition_inventory(spark, mart, with_rows=False)
                .agg(F.max("partition")).first()[0])
    ordered = list_partitions(spark, mart).orderBy(F.col("partition").desc())
    for row in ordered.toLocalIterator():
        if path_exists(spark, f"{mart.path.rstrip('/')}/{row['partition']}"):
            return row["partition"]
    return None


def partition_state(spark: SparkSession, mart: Mart, inventory: DataFrame | None = None
                    ) -> DataFrame:
    """The inventory with ``on_disk`` and ``in_catalog``: partitions that only the catalog of
    a registered mart knows appear without files, those that only the disk knows are not
    ``in_catalog``.  A mart without a catalog entry is as its disk says."""
    inv = inventory if inventory is not None else partition_inventory(spark, mart, with_rows=False)
    inv = inv.withColumn("on_disk", F.lit(True))
    if not mart.table:
        return inv.withColumn("in_catalog", F.lit(False))
    listed = list_partitions(spark, mart).withColumnRenamed("partition", "__listed")
    joined = inv.join(listed, F.col("partition") == F.col("__listed"), "full_outer")
    root = F.lit(Folder(spark, mart.path).qualified())
    return (joined.withColumn("in_catalog", F.col("__listed").isNotNull())
            .withColumn("on_disk", F.coalesce("on_disk", F.lit(False)))
            .withColumn("location", F.coalesce("location", F.concat(root, F.lit("/"), "__listed")))
            .withColumn("partition", F.coalesce("partition", "__listed"))
            .withColumns({k: _key_value(F.col("partition"), k) for k in mart.partition_by})
            .withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("files", "bytes")})
            .drop("__listed"))


def last_partition_spec(spark: SparkSession, mart: Mart, column: str | None = None) -> dict:
    row = last_partition(spark, mart, column).first()
    return {} if row is None else dict(row["spec"])


# M7 ----------------------------------------------------------------------------
def delete_partitions(spark: SparkSession, mart: Mart, column: str | None = None,
                      lower: str | None = None, upper: str | None = None,
                      allow_full_delete: bool = False,
                      inventory: DataFrame | None = None) -> DataFrame:
    """Remove partitions whose key (``column``) or newest modification time lies
    in ``[lower, upper]``; returns the removed partitions.

    Unknown key columns raise, NULL keys never match, and an unpartitioned mart
    is emptied, and a window without bounds taken, only with ``allow_full_delete=True``.
    Catalog and disk are both looked at: partitions whose folder is gone leave the catalog,
    folders that the catalog does not know or that hold no files (by their own time) go too.
    A current ``inventory`` may be passed to skip the listing.
    """
    out_schema = "partition string, location string"
    if not mart.is_partitioned:
        if not allow_full_delete:
            raise ValueError("the mart has no partitions: deleting would empty it; "
                             "pass allow_full_delete=True to do so")
        clear_mart(spark, mart)
        return spark.createDataFrame([("", mart.path)], out_schema)
    if lower is None and upper is None and not allow_full_delete:
        raise ValueError("without bounds every partition would go; "
                         "pass allow_full_delete=True to do so")
    value = _window_value(mart, column)
    state = partition_state(spark, mart, inventory)
    if not column:
        state = _dated_folders(spark, state)
    doomed = saved(state.filter(range_predicate(value, lower, upper)).select(
        "partition", "location", *mart.partition_by, "on_disk", "in_catalog"), "doomed")
    rows = doomed.toLocalIterator()
    while batch := list(islice(rows, DELETE_BATCH)):
        listed = [r for r in batch if r["in_catalog"]]
        if listed:
            alter_partitions(spark, mart.table, mart.partition_by, listed, "DROP IF EXISTS")
        _delete_folders(spark, [r["location"] for r in batch if r["on_disk"]])
    refresh_catalog(spark, mart, "none")
    return doomed.select("partition", "location")


def _dated_folders(spark: SparkSession, state: DataFrame) -> DataFrame:
    """``state`` with the folders' own modification time for folders without files (only
    those are asked for, one metadata call each)."""
    bare = [(r["location"], Folder(spark, r["location"]).modified_ms()) for r in
            state.filter("on_disk and files = 0").select("location").toLocalIterator()]
    if not bare:
        return state
    times = spark.createDataFrame(bare, "__bare string, __ms bigint")
    return (state.join(times, F.col("location") == F.col("__bare"), "left")
            .withColumn("modified_utc", F.coalesce("modified_utc",
                                                   instant_text(F.timestamp_millis("__ms"))))
            .drop("__bare", "__ms"))


def _delete_folders(spark: SparkSession, locations: Sequence[str]) -> None:
    """Delete partition folders with a few parallel metadata calls; any failure
    is raised (after the others finished), never dropped."""
    if not locations:
        return
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(DELETE_THREADS, len(locations))) as pool:
        results = list(pool.map(lambda loc: _try_delete(spark, loc), locations))
    failed = [loc for loc, err in zip(locations, results) if err is not None]
    if failed:
        raise RuntimeError(f"could not delete {len(failed)} partition folders, e.g. {failed[0]}: "
                           f"{results[locations.index(failed[0])]}")


def _try_delete(spark: SparkSession, location: str):
    try:
        delete_path(spark, location)
        return None
    except Exception as exc:  # noqa: BLE001 - reported together by the caller
        return exc


# M8 ----------------------------------------------------------------------------
def retention(spark: SparkSession, mart: Mart, lifetime_days: int, column: str | None = None,
              now: str | None = None, allow_full_delete: bool = False,
              inventory: DataFrame | None = None) -> DataFrame:
    """Delete partitions older than ``now - lifetime_days`` (0 days = keep all).

    The bound is inclusive and compared as text, so a day key equal to the
    cutoff's date is removed even when the cutoff has a later time of day.
    """
    if not lifetime_days:
        return spark.createDataFrame([], "partition string, location string")
    cutoff = cutoff_text(now, int(lifetime_days))
    return delete_partitions(spark, mart, column, upper=cutoff,
                             allow_full_delete=allow_full_delete, inventory=inventory)


def run_stamp() -> str:
    return time.strftime("%Y%m%d%H%M%S", time.gmtime())
