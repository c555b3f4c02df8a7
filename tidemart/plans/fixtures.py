"""Turn the shared test tables into sources and marts.

orders   -> a monthly mart keyed by ``report_dt`` (the transfer target)
events   -> a daily mart keyed by ``event_type`` / ``dt``
lineitem -> a monthly mart keyed by ``ship_month`` written as many small files,
            or with one file per return flag
nation   -> a tiny flat table
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

from tidemart.functions.columns import TIME_FORMAT
from tidemart.plans.mart import Mart
from tidemart.session import work_path
from tidemart.sources.folders import Folder
from tidemart.sources.tables import overwrite_partitions

LOADING_ID = 1001
RUN_TS = "2001-09-01 00:00:00"
#: rows that one task of an unclustered write sorts by partition, about
WRITER_ROWS = 2_000_000

ORDERS_MART_SCHEMA = StructType([
    StructField("ctl_loading", LongType()),
    StructField("ctl_validfrom", StringType()),
    StructField("o_orderkey", LongType()),
    StructField("o_custkey", IntegerType()),
    StructField("o_orderstatus", StringType()),
    StructField("o_totalprice", DoubleType()),
    StructField("o_orderdate", DateType()),
    StructField("o_orderpriority", StringType()),
    StructField("report_dt", StringType()),
])

EVENTS_MART_SCHEMA = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
    StructField("event_type", StringType()),
    StructField("dt", StringType()),
])

LINEITEM_MART_SCHEMA = StructType([
    StructField("l_orderkey", LongType()),
    StructField("l_partkey", LongType()),
    StructField("l_suppkey", LongType()),
    StructField("l_linenumber", IntegerType()),
    StructField("l_quantity", DoubleType()),
    StructField("l_extendedprice", DoubleType()),
    StructField("l_discount", DoubleType()),
    StructField("l_tax", DoubleType()),
    StructField("l_returnflag", StringType()),
    StructField("l_linestatus", StringType()),
    StructField("l_shipdate", TimestampNTZType()),
    StructField("ship_month", StringType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with a source-side ``report_dt`` text (month start, with time)."""
    o = table(spark, sf_dir, "orders")
    return o.withColumn("report_dt", F.concat(F.date_format("o_orderdate", "yyyy-MM"),
                                              F.lit("-01 00:00:00")))


def orders_mart(spark: SparkSession, label: str) -> Mart:
    return Mart(work_path(spark, label), ORDERS_MART_SCHEMA, ("report_dt",))


def events_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))


def events_mart(spark: SparkSession, sf_dir: str, label: str) -> Mart:
    mart = Mart(work_path(spark, label), EVENTS_MART_SCHEMA, ("event_type", "dt"))
    overwrite_partitions(events_rows(spark, sf_dir), mart)
    return mart


def lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("ship_month",
                                                       F.date_format("l_shipdate", "yyyy-MM"))


def lineitem_small_files(spark: SparkSession, sf_dir: str, label: str,
                         writers: int = 8) -> Mart:
    """lineitem by ship month, written by ``writers`` tasks without clustering (more, if a
    task would sort over ``WRITER_ROWS`` rows), so every month ends up with up to as many
    small files."""
    mart = Mart(work_path(spark, label), LINEITEM_MART_SCHEMA, ("ship_month",))
    rows = lineitem_rows(spark, sf_dir)
    writers = max(writers, -(-rows.count() // WRITER_ROWS))  # counted from the footers
    (rows.repartition(writers, F.xxhash64(*[F.col(c) for c in rows.columns]))
     .write.mode("overwrite").partitionBy("ship_month").parquet(mart.path))
    return mart


def lineitem_file_per_flag(spark: SparkSession, sf_dir: str, label: str) -> Mart:
    """lineitem by ship month with exactly one file per return flag present in
    the month (one append per flag, clustered by month), so file counts are known."""
    mart = Mart(work_path(spark, label), LINEITEM_MART_SCHEMA, ("ship_month",))
    rows = lineitem_rows(spark, sf_dir)
    flags = [r[0] for r in rows.select("l_returnflag").distinct().collect()]  # a handful of codes
    for flag in sorted(flags, key=str):
        (rows.where(F.col("l_returnflag").eqNullSafe(F.lit(flag))).repartition("ship_month")
         .write.mode("append").partitionBy("ship_month").parquet(mart.path))
    return mart


SHIPMENTS_MART_SCHEMA = StructType([
    StructField("ctl_loading", LongType()),
    StructField("ctl_validfrom", StringType()),
    StructField("l_orderkey", LongType()),
    StructField("l_linenumber", IntegerType()),
    StructField("l_quantity", DoubleType()),
    StructField("report_dt", StringType()),
])


def shipments_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with a source-side ``report_dt`` text (month of shipment, with time)."""
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn("report_dt", F.concat(F.date_format("l_shipdate", "yyyy-MM"),
                                               F.lit("-01 00:00:00")))


def flat_copy(spark: SparkSession, df: DataFrame, label: str, files: int = 8) -> str:
    """Write ``df`` as an unpartitioned parquet folder of ``files`` files."""
    path = work_path(spark, label)
    df.repartition(files, F.xxhash64(*[F.col(c) for c in df.columns])).write.parquet(path)
    return path


def empty_folder(spark: SparkSession, mart: Mart, partition: str, empty_file: str | None = None
                 ) -> None:
    """A partition folder without data: no file, or one of no bytes."""
    Folder(spark, f"{mart.path}/{partition}").make(empty_file)


def time_text(c: str):
    return F.date_format(c, TIME_FORMAT)
