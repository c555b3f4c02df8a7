"""Scans, sinks and table definitions (S1-S13).

Writes go to paths, never through ``insertInto``: a path write honours
``partitionOverwriteMode=dynamic`` per write, so only the partitions present in
the new data are replaced and no session setting is changed.
"""

from __future__ import annotations

import glob as _glob
from itertools import islice
from typing import Iterable, Mapping, Sequence
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.operators.project import conform_columns, conform_schema, rename_by_position
from tidemart.plans.mart import Mart, path_exists
from tidemart.session import saved
from tidemart.sources.folders import Folder, settle
from tidemart.sources.statements import one_statement, parameters, split_statements

#: write tasks for the bytes of one target file, when a task writes several smaller files
TASKS_PER_TARGET = 8
#: partitions in one ALTER TABLE statement
SPEC_BATCH = 200
# fixed value: the folder of NULL and empty partition values
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spread_key(df: DataFrame) -> Column:
    """A deterministic per-row hash used to split a group over several files.

    It hashes the row's file and position in that file, so copies of the same
    row (a hot group of duplicates) still spread evenly, and a retried task
    reproduces the same assignment.  ``df`` must come straight from a file scan.
    """
    return F.xxhash64(df["_metadata.file_path"], df["_metadata.row_index"])


# S1 ----------------------------------------------------------------------------
def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


# S2 ----------------------------------------------------------------------------
def scan_parquet_dir(spark: SparkSession, path: str, schema: StructType | str | None = None
                     ) -> DataFrame:
    """All files under one directory; partition folders above it are not seen."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


# S3 ----------------------------------------------------------------------------
def scan_partitions(spark: SparkSession, mart: Mart, partition_dirs: Sequence[str]) -> DataFrame:
    """Rows of the given partition folders with the partition columns recovered
    from the paths, typed by the mart's schema (no inference)."""
    if not partition_dirs:
        return spark.createDataFrame([], mart.schema)
    return (spark.read.schema(mart.schema).option("basePath", mart.path)
            .parquet(*partition_dirs))


# S10 ---------------------------------------------------------------------------
def recover_partitions(spark: SparkSession, table: str) -> None:
    """Make the catalog's partition list equal to the folders on disk (adds the
    new folders and forgets the vanished ones)."""
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


def refresh_catalog(spark: SparkSession, mart: Mart, partitions: str = "add",
                    specs: Iterable[Mapping[str, object]] | None = None) -> None:
    """Tell a registered mart's catalog entry about a change on disk.

    ``partitions``: ``"add"`` registers new partition folders (after a write),
    ``"sync"`` also forgets vanished ones, ``"none"`` only refreshes the file
    cache (the partition set did not change).  When the written partitions are
    known (``specs``, taken in batches), those are added instead of listing every
    folder.  NULL and empty values share a folder that no statement can name: it is
    found by the listing.
    """
    if not mart.table:
        return
    if mart.is_partitioned:
        unnamed = specs is None
        rows = iter(specs or ())
        while batch := list(islice(rows, SPEC_BATCH)):
            named = [r for r in batch if all(r[k] not in (None, "") for k in mart.partition_by)]
            unnamed |= len(named) < len(batch)
            if named:
                alter_partitions(spark, mart.table, mart.partition_by, named, "ADD IF NOT EXISTS")
        if partitions == "sync" or partitions == "add" and unnamed:
            spark.sql(f"MSCK REPAIR TABLE {mart.table} {partitions.upper()} PARTITIONS")
    spark.sql(f"REFRESH TABLE {mart.table}")


def alter_partitions(spark: SparkSession, table: str, keys: Sequence[str],
                     specs: Sequence[Mapping[str, object]], action: str) -> None:
    """``ALTER TABLE t <action> PARTITION (...), ...`` in batches."""
    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    specs = list(specs)
    for i in range(0, len(specs), SPEC_BATCH):
        joiner = ", " if action.startswith("DROP") else " "
        parts = joiner.join("PARTITION (" + ", ".join(f"`{k}` = {lit(r[k])}" for k in keys) + ")"
                            for r in specs[i:i + SPEC_BATCH])
        spark.sql(f"ALTER TABLE {table} {action} {parts}")


def _check_not_reading(df: DataFrame, path: str) -> None:
    """Refuse to replace a folder with rows read from it (its files would be gone first)."""
    def plain(uri: str) -> str:
        return unquote(urlsplit(uri).path)
    root = plain(Folder(df.sparkSession, path).qualified()) + "/"
    if any(plain(f).startswith(root) for f in df.inputFiles()):
        raise ValueError(f"refusing to replace {path} with data read from it; "
                         "write a new copy instead (compact_flat)")


# S5 ----------------------------------------------------------------------------
def overwrite_partitions(df: DataFrame, mart: Mart, by_position: bool = False) -> Mart:
    """Replace the partitions present in ``df``; all other partitions stay.

    Rows are rebalanced on the partition columns before the write so that each
    partition lands in few files, while AQE splits a hot partition over several
    tasks.  For an unpartitioned mart the whole table is replaced (refused when
    ``df`` reads from that same folder).
    """
    mart = settle(df.sparkSession, mart)
    out = rename_by_position(df, mart.schema) if by_position else conform_schema(df, mart.schema)
    if mart.is_partitioned:
        (out.hint("rebalance", *mart.partition_by)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*mart.partition_by).parquet(mart.path))
    else:
        _check_not_reading(df, mart.path)
        out.write.mode("overwrite").parquet(mart.path)
    refresh_catalog(df.sparkSession, mart)
    return mart


# exact file counts ---------------------------------------------------------------
def key_text(key: Column) -> Column:
    """A partition value as its folder names it; NULL and '' share one folder."""
    return F.coalesce(F.nullif(key.cast("string"), F.lit("")), F.lit(NULL_FOLDER))


def file_plan(partitions: DataFrame, keys: Sequence[Column], files: Column,
              group: Column | None = None) -> DataFrame:
    """Saved plan of a write: key texts ``__k0...``, ``__files`` and ``__first``, the number
    of files planned before (within ``group``), so that every file has a number of its own.
    ``partitions`` has one row per partition; the running sum is one task over those rows."""
    named = partitions.select("*", *[key_text(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                              files.cast("bigint").alias("__files"),
                              (F.lit(0) if group is None else group).alias("__group"))
    order = Window.partitionBy("__group").orderBy(*[f"__k{i}" for i in range(len(keys))])
    before = F.sum("__files").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return saved(named.withColumn("__first", F.coalesce(before, F.lit(0))), "file-plan")


def place_in_files(rows: DataFrame, plan: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   spread: Column, total_bytes: float, target_file_bytes: float) -> DataFrame:
    """``columns`` of ``rows``, shuffled once so that the write gives each partition as many
    files as ``plan`` says: a row goes to the task ``__first + spread mod __files``.  Files
    that share a task belong to different partitions, so each stays a file of its own."""
    totals = plan.agg(F.sum("__files"), F.max("__files")).first()
    total, most = int(totals[0] or 0), int(totals[1] or 0)
    tasks = write_tasks(total, total_bytes, target_file_bytes, _shuffle_partitions(rows))
    slim = plan.select("__first", "__files", *[f"__k{i}" for i in range(len(keys))])
    cond = [key_text(rows[k]) == slim[f"__k{i}"] for i, k in enumerate(keys)]
    numbered = rows.withColumn("__spread", spread).join(slim, cond)
    n = max(tasks, most, 1)
    file = (F.col("__first") + F.pmod(F.col("__spread"), F.col("__files"))) % n
    return (numbered.select(*columns, file.cast("int").alias("__file"))
            .repartitionById(n, "__file").drop("__file"))


def overwrite_partitions_sized(df: DataFrame, mart: Mart, bytes_per_row: float | None,
                               target_file_bytes: int, source_share: float = 1.0) -> Mart:
    """:func:`overwrite_partitions` that writes each partition straight into
    ``rows * bytes_per_row / target_file_bytes`` files.

    A first, cheap pass counts rows per partition (only the key inputs are read, combined
    map-side); each row is then sent by the hash of its source file and position to one of
    its partition's files.  Large partitions are thereby split and small ones are not, so no
    compaction rewrite is needed afterwards.  Falls back to the rebalanced write when ``df``
    is not a projection of a file scan (no per-row file position to hash).
    ``bytes_per_row=None`` estimates it from the source files in the counting pass (see
    :func:`sized_write_frame`).
    """
    sized = sized_write_frame(df, mart, bytes_per_row, target_file_bytes, source_share)
    if sized is None:
        return overwrite_partitions(df, mart)
    out, plan = sized
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*mart.partition_by).parquet(mart.path))
    specs = plan.select(*[F.nullif(f"__k{i}", F.lit(NULL_FOLDER)).alias(k)
                          for i, k in enumerate(mart.partition_by)])
    refresh_catalog(df.sparkSession, mart, specs=specs.toLocalIterator())
    return mart


def sized_write_frame(df: DataFrame, mart: Mart, bytes_per_row: float | None,
                      target_file_bytes: int, source_share: float = 1.0):
    """``(frame, plan)``: the placed rows of a sized write and its saved file plan; None when
    not applicable.

    With ``bytes_per_row=None`` the same pass also groups by source file: a file's stored
    bytes count by the share of its rows that reach ``df`` (a filter drops some), times
    ``source_share``, the part of a row that the load keeps.
    """
    from pyspark.errors import AnalysisException
    keys = list(mart.partition_by)
    if not keys:
        return None
    try:
        path, size, index = (df[f"_metadata.{c}"] for c in ("file_path", "file_size", "row_index"))
        hidden = [path.alias("__path"), size.alias("__size"), index.alias("__index")]
        out = df.select(*conform_columns(df, mart.schema), *hidden)
    except AnalysisException:
        return None
    texts = [f"__t{i}" for i in range(len(keys))]
    narrow = out.select(*[key_text(out[k]).alias(t) for k, t in zip(keys, texts)],
                        "__path", "__size", "__index")
    n_rows = F.count(F.lit(1)).alias("n")
    if bytes_per_row is None:
        counted = saved(
            narrow.groupingSets([texts, ["__path"]], *texts, "__path")
            .agg(n_rows, F.max("__size").alias("size"), F.max("__index").alias("last"),
                 F.grouping("__path").alias("by_key")), "load-counts")
        counts = counted.filter("by_key = 1")
        stored = counted.filter("by_key = 0").agg(
            F.sum(F.col("size") * F.col("n") / (F.col("last") + 1)), F.sum("n")).first()
        bytes_per_row = (float(stored[0]) / stored[1] if stored[1] else 1.0) * max(source_share, 1e-6)
    else:
        counts = narrow.groupBy(*texts).agg(n_rows)
    per_file = max(float(target_file_bytes) / max(float(bytes_per_row), 1e-9), 1.0)
    plan = file_plan(counts.select(*texts, "n"), [F.col(t) for t in texts],
                     F.ceil(F.col("n") / F.lit(per_file)))
    rows = int(plan.agg(F.sum("n")).first()[0] or 0)
    spread = F.xxhash64("__path", "__index")
    return place_in_files(out, plan, keys, mart.columns, spread, rows * float(bytes_per_row),
                          target_file_bytes), plan


def write_tasks(files: int, total_bytes: float, target_file_bytes: float,
                parallelism: int = 1) -> int:
    """Shuffle partitions for a write of ``files`` files: at most one each, about
    ``TASKS_PER_TARGET * total / target`` for big writes (a task sorts its rows by partition, and
    they take several times their stored bytes) and at least ``parallelism`` (the session's
    shuffle partitions) so small writes still use the cluster."""
    import math
    needed = (math.ceil(TASKS_PER_TARGET * total_bytes / max(float(target_file_bytes), 1.0))
              if total_bytes else 1)
    return max(1, min(int(files), max(needed, int(parallelism))))


def source_bytes_per_row(df: DataFrame) -> float | None:
    """Stored bytes per row of the files behind ``df`` (None unless ``df`` is a
    projection or filter of a file scan).  Reads only footers: per file the
    size and the number of rows that reach ``df``."""
    from pyspark.errors import AnalysisException
    try:
        path, size = df["_metadata.file_path"], df["_metadata.file_size"]
    except AnalysisException:
        return None
    per_file = (df.select(path.alias("f"), size.alias("z")).groupBy("f")
                .agg(F.count(F.lit(1)).alias("n"), F.max("z").alias("z")))
    total = per_file.agg(F.sum("z").alias("bytes"), F.sum("n").alias("rows")).first()
    return float(total["bytes"]) / total["rows"] if total and total["rows"] else None


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# S4 ----------------------------------------------------------------------------
def load_from_dir(spark: SparkSession, source_dir: str | Sequence[str], mart: Mart,
                  n_files: int, overwrite: bool = True, base_dir: str | None = None) -> Mart:
    """Read parquet from a folder (optionally keeping partition columns via ``base_dir``),
    spread it over ``n_files`` files per partition (a flat mart: over ``n_files`` files) and
    write it into ``mart`` by position, replacing the partitions it covers or appending."""
    mart = settle(spark, mart)
    dirs = [source_dir] if isinstance(source_dir, str) else list(source_dir)
    n = max(int(n_files), 1)
    if base_dir is not None:
        src = spark.read.schema(mart.schema).option("basePath", base_dir).parquet(*dirs)
        names = None
    else:
        src = spark.read.parquet(*dirs)
        names = src.columns
    out = src.select(*conform_columns(src, mart.schema, source_names=names),
                     src["_metadata.file_path"].alias("__path"),
                     src["_metadata.row_index"].alias("__index"))
    if mart.is_partitioned:
        keys = mart.partition_by
        plan = file_plan(out.select(*[key_text(out[k]).alias(k) for k in keys]).distinct(),
                         [F.col(k) for k in keys], F.lit(n))
        placed = place_in_files(out, plan, keys, mart.columns, F.xxhash64("__path", "__index"),
                                0, 1)
        writer = placed.write.partitionBy(*keys)
        writer = (writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                  if overwrite else writer.mode("append"))
    else:
        if overwrite:
            _check_not_reading(src, mart.path)
        writer = out.select(*mart.columns).repartition(n).write
        writer = writer.mode("overwrite" if overwrite else "append")
    writer.parquet(mart.path)
    refresh_catalog(spark, mart)
    return mart


# S6 ----------------------------------------------------------------------------
def append_rows(spark: SparkSession, rows: DataFrame | Iterable[Mapping[str, object]],
                mart: Mart, strict: bool = True) -> Mart:
    """Append rows conformed to the mart's schema: missing values are NULL,
    unknown names are rejected (``strict``) or dropped."""
    mart = settle(spark, mart)
    if isinstance(rows, DataFrame):
        df = conform_schema(rows, mart.schema, strict=strict)
    else:
        records = []
        names = mart.columns
        for r in rows:
            unknown = [k for k in r if k not in names]
            if unknown and strict:
                raise ValueError(f"unknown columns for {mart.table or mart.path}: {unknown}")
            records.append(tuple(r.get(n) for n in names))
        df = spark.createDataFrame(records, mart.schema)
    writer = df.write.mode("append")
    if mart.is_partitioned:
        writer = writer.partitionBy(*mart.partition_by)
    writer.parquet(mart.path)
    refresh_catalog(spark, mart)
    return mart


# S7 / S8 / S9 ------------------------------------------------------------------
def column_plan(schema: StructType) -> list[tuple[str, str]]:
    """Ordered ``(name, type)`` list of a schema (what ``DataFrame.dtypes`` gives)."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def table_ddl(name: str, columns: Sequence[tuple[str, str]], location: str,
              partition_by: Sequence[str] = ()) -> list[str]:
    """``DROP`` + ``CREATE TABLE ... USING PARQUET [PARTITIONED BY] LOCATION``."""
    cols = ",\n  ".join(f"{_q(n)} {t}" for n, t in columns)
    parts = f"\nPARTITIONED BY ({', '.join(_q(k) for k in partition_by)})" if partition_by else ""
    return [f"DROP TABLE IF EXISTS {name}",
            f"CREATE TABLE {name} (\n  {cols}\n) USING PARQUET{parts}\nLOCATION {sql_text(location)}"]


def create_mart(spark: SparkSession, name: str, mart: Mart) -> Mart:
    """(Re)define a catalog table over the mart's location; data there survives
    and existing partition folders are registered."""
    for stmt in table_ddl(name, column_plan(mart.schema), mart.path, mart.partition_by):
        spark.sql(stmt)
    registered = mart.with_table(name)
    if mart.is_partitioned and path_exists(spark, mart.path):
        recover_partitions(spark, name)
    return registered


def recreate_flat_table(spark: SparkSession, name: str, columns: Sequence[tuple[str, str]],
                        location: str) -> Mart:
    """Re-create an unpartitioned table from an ordered ``(name, type)`` plan."""
    for stmt in table_ddl(name, columns, location):
        spark.sql(stmt)
    return Mart(location, spark.table(name).schema, (), name)


# S11 ---------------------------------------------------------------------------
def clear_mart(spark: SparkSession, mart: Mart) -> Mart:
    """Remove every row of a mart by overwriting it with an empty frame, whatever the
    session's partition overwrite mode is."""
    mart = settle(spark, mart)
    empty = spark.createDataFrame([], mart.schema)
    writer = empty.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if mart.is_partitioned:
        writer = writer.partitionBy(*mart.partition_by)
    writer.parquet(mart.path)
    refresh_catalog(spark, mart, "sync")
    return mart


def archive_reload(spark: SparkSession, marts: Mapping[str, Mart],
                   keep: Sequence[str] = ("ledger",)) -> list[str]:
    """Empty every target of a full reload except the ones in ``keep``."""
    cleared = []
    for key, mart in marts.items():
        if key in keep:
            continue
        clear_mart(spark, mart)
        cleared.append(key)
    return cleared


# S12 ---------------------------------------------------------------------------
def run_sql_script(spark: SparkSession, statements: Sequence[str],
                   args: Mapping[str, object] | None = None,
                   names: Mapping[str, str] | None = None) -> DataFrame | None:
    """Run statements in order; returns the last statement's result.

    Values are bound as named parameters (``:name``, ``IDENTIFIER(:table)``).
    ``names`` fills ``{name}`` placeholders in the text first, for the places
    SQL does not accept a parameter (a DDL ``LOCATION``, for instance).
    """
    result = None
    for stmt in statements:
        if names:
            stmt = stmt.format_map(dict(names))
        if not stmt.strip():
            continue
        named = parameters(stmt)
        used = {k: v for k, v in (args or {}).items() if k in named}
        result = spark.sql(stmt, args=used or None)
    return result


def run_sql_files(spark: SparkSession, pattern: str,
                  args: Mapping[str, object] | None = None,
                  names: Mapping[str, str] | None = None) -> DataFrame | None:
    """Run every script matching a glob, in sorted file order."""
    paths = sorted(_glob.glob(pattern))
    if not paths:
        raise FileNotFoundError(f"no SQL script matches {pattern}")
    result = None
    for path in paths:
        with open(path, encoding="utf-8") as fh:
            result = run_sql_script(spark, split_statements(fh.read()), args, names) or result
    return result


# S13 ---------------------------------------------------------------------------
def scalar_query(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None,
                 alias: str = "value", names: Mapping[str, str] | None = None) -> DataFrame:
    """First cell of a query as text (NULL stays NULL), as a one-row frame.  ``sql`` holds one
    statement."""
    df = run_sql_script(spark, [one_statement(sql)], args, names)
    return df.select(F.col(df.columns[0]).cast("string").alias(alias)).limit(1)


def scalar_value(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None,
                 names: Mapping[str, str] | None = None) -> str | None:
    row = scalar_query(spark, sql, args, names=names).first()
    return None if row is None else row[0]


def scalar_from_file(spark: SparkSession, pattern: str, args: Mapping[str, object] | None = None,
                     names: Mapping[str, str] | None = None) -> str | None:
    """First cell of the query in the first (sorted) script matching a glob; the script holds
    one statement."""
    paths = sorted(_glob.glob(pattern))
    if not paths:
        raise FileNotFoundError(f"no SQL script matches {pattern}")
    with open(paths[0], encoding="utf-8") as fh:
        return scalar_value(spark, fh.read(), args, names)


def exists(spark: SparkSession, mart: Mart) -> bool:
    return path_exists(spark, mart.path)


# folded helpers ------------------------------------------------------------------
def table_location(spark: SparkSession, table: str) -> str:
    """Storage location of a catalog table (``DESC FORMATTED`` → Location)."""
    row = (spark.sql(f"DESC FORMATTED {table}")
           .where(F.col("col_name") == "Location").select("data_type").first())
    if row is None:
        raise ValueError(f"{table} has no location")
    return row[0]


def mart_for_table(spark: SparkSession, table: str) -> Mart:
    """A :class:`Mart` for a registered table: location, schema in positional
    order (partition columns last) and partition columns."""
    cols = spark.catalog.listColumns(table)
    keys = tuple(c.name for c in cols if c.isPartition)
    schema = spark.table(table).schema
    return Mart(table_location(spark, table), schema, keys, table)


def parquet_column_plan(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Ordered ``(name, type)`` list of the parquet data under a folder."""
    return column_plan(spark.read.parquet(path).schema)


def block_size(spark: SparkSession, default: int = 128 * 1024 * 1024) -> int:
    """The file system block size from the Hadoop configuration."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for key in ("dfs.blocksize", "dfs.block.size"):
        value = conf.get(key)
        if value:
            try:
                return int(value)
            except ValueError:
                return int(conf.getLongBytes(key, default))
    return default
