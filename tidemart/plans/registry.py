"""Registered checks: one Spark query per operator plus its DuckDB twin.

Each query reads the shared test tables (whole tables), builds whatever mart it
needs under the shared folder, runs the operator and returns data re-read from
what it wrote, so the SQL twin proves the write as well as the logic.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType, IntegerType, LongType, DoubleType

from tidemart.functions import columns as fn
from tidemart.operators import aggregate as agg
from tidemart.operators import partitions as parts
from tidemart.operators import project as proj
from tidemart.plans import fixtures as fx
from tidemart.plans.ledger import (RUN_LEDGER_SCHEMA, STEP_LEDGER_SCHEMA, Step, record_run,
                                   run_ledger_rows, run_statistics, stepped_load)
from tidemart.plans.mart import Mart, delete_path
from tidemart.plans.refresh import RunSettings, Target, refresh_mart, refresh_marts
from tidemart.session import unique_name, work_path
from tidemart.sources import tables as src

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

RUN_TS = fx.RUN_TS
LOADING_ID = fx.LOADING_ID
CUTOFF_730 = fn.cutoff_text(RUN_TS, 730)  # '1999-09-02 00:00:00'


def register(key: str, sql: str | None = None):
    def deco(f: Query) -> Query:
        QUERIES[key] = f
        if sql is not None:
            ORACLE[key] = sql.strip()
        return f
    return deco


# shared SQL fragments --------------------------------------------------------
_EV = "(SELECT *, strftime(ts, '%Y-%m-%d') AS dt FROM events)"
_EV_PARTS = f"(SELECT DISTINCT event_type, dt FROM {_EV})"
_LI = "(SELECT *, strftime(l_shipdate, '%Y-%m') AS ship_month FROM lineitem)"
_ORDERS_MART_SQL = f"""
SELECT CAST({LOADING_ID} AS BIGINT) AS ctl_loading, '{RUN_TS}' AS ctl_validfrom, o_orderkey,
       TRY_CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
       strftime(o_orderdate, '%Y-%m') || '-01' AS report_dt
FROM orders"""


def _load_orders(spark: SparkSession, sf: str, mart: Mart) -> Mart:
    loaded = proj.transfer_projection(fx.orders_source(spark, sf), mart.schema,
                                      {"ctl_loading": LOADING_ID, "ctl_validfrom": RUN_TS})
    return src.overwrite_partitions(loaded, mart)


# ============================================================================
# F: column helpers
# ============================================================================
@register("partition_value", f"""
SELECT event_id, dt, event_type, CAST(NULL AS VARCHAR) AS hour FROM {_EV}""")
def q_partition_value(spark, sf):
    mart = fx.events_mart(spark, sf, "partition_value")
    df = spark.read.schema(mart.schema).parquet(mart.path)
    fp = df["_metadata.file_path"]
    return df.select("event_id",
                     fn.partition_value(fp, "dt").alias("dt"),
                     fn.partition_value(fp, "event_type").alias("event_type"),
                     fn.partition_value(fp, "hour").alias("hour"))


@register("partition_spec_map", f"""
SELECT 'event_type=' || event_type || '/dt=' || dt AS partition, 'event_type' AS key, event_type AS value
FROM {_EV_PARTS}
UNION ALL
SELECT 'event_type=' || event_type || '/dt=' || dt AS partition, 'dt' AS key, dt AS value
FROM {_EV_PARTS}""")
def q_partition_spec_map(spark, sf):
    mart = src.create_mart(spark, unique_name("spec"), fx.events_mart(spark, sf, "spec_map"))
    return (parts.list_partitions(spark, mart)
            .select("partition", F.explode(fn.partition_spec_map("partition")).alias("key", "value")))


_NAMES_SQL = """
SELECT 'dm_' || lower(n_name) || '_stg.t' || CAST(n_nationkey AS VARCHAR) AS table_name FROM nation
UNION ALL SELECT 'dm_' || lower(n_name) || '.t' || CAST(n_nationkey AS VARCHAR) FROM nation
UNION ALL SELECT 'ext_' || lower(n_name) || '.t' || CAST(n_nationkey AS VARCHAR) FROM nation"""


@register("default_location", f"""
SELECT table_name,
  CASE WHEN regexp_full_match(table_name, 'dm_(.*)_stg\\.(.*)')
         THEN '/data/marts/' || regexp_extract(table_name, '^dm_(.*)_stg\\.(.*)$', 1) || '/stg/'
              || regexp_extract(table_name, '^dm_(.*)_stg\\.(.*)$', 2)
       WHEN regexp_full_match(table_name, 'dm_(.*)\\.(.*)')
         THEN '/data/marts/' || regexp_extract(table_name, '^dm_(.*)\\.(.*)$', 1) || '/pa/'
              || regexp_extract(table_name, '^dm_(.*)\\.(.*)$', 2)
       ELSE '' END AS location
FROM ({_NAMES_SQL})""")
def q_default_location(spark, sf):
    n = fx.table(spark, sf, "nation")
    key = n["n_nationkey"].cast("string")
    low = F.lower("n_name")
    names = (n.select(F.concat(F.lit("dm_"), low, F.lit("_stg.t"), key).alias("table_name"))
             .unionByName(n.select(F.concat(F.lit("dm_"), low, F.lit(".t"), key).alias("table_name")))
             .unionByName(n.select(F.concat(F.lit("ext_"), low, F.lit(".t"), key).alias("table_name"))))
    return names.select("table_name",
                        fn.default_location("table_name", "dm_", "/data/marts").alias("location"))


@register("json_map", """
SELECT event_id, json_extract_string(props, '$.k') AS k FROM events""")
def q_json_map(spark, sf):
    ev = fx.table(spark, sf, "events")
    return ev.select("event_id", fn.json_map("props").getItem("k").alias("k"))


@register("map_default", """
SELECT event_id, COALESCE(json_extract_string(props, '$.k'), '730') AS k,
       COALESCE(json_extract_string(props, '$.lifetime'), '730') AS lifetime FROM events""")
def q_map_default(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", fn.json_map("props").alias("m"))
    return ev.select("event_id", fn.map_default("m", "k", "730").alias("k"),
                     fn.map_default("m", "lifetime", "730").alias("lifetime"))


@register("step_number", """
SELECT c_custkey, CAST(regexp_extract(c_name, '(\\d+)', 1) AS INTEGER) AS step FROM customer""")
def q_step_number(spark, sf):
    c = fx.table(spark, sf, "customer")
    return c.select("c_custkey", fn.step_number("c_name").alias("step"))


@register("safe_cast", """
SELECT c_custkey, TRY_CAST(substr(c_name, 10) AS BIGINT) AS name_number,
       TRY_CAST(c_name AS BIGINT) AS name_as_bigint, TRY_CAST(c_mktsegment AS INTEGER) AS segment_as_int,
       CAST(c_nationkey AS VARCHAR) AS nation_text
FROM customer""")
def q_safe_cast(spark, sf):
    c = fx.table(spark, sf, "customer")
    return c.select("c_custkey",
                    fn.safe_cast(F.expr("substring(c_name, 10)"), "bigint").alias("name_number"),
                    fn.safe_cast("c_name", "bigint").alias("name_as_bigint"),
                    fn.safe_cast("c_mktsegment", "int").alias("segment_as_int"),
                    fn.safe_cast("c_nationkey", "string").alias("nation_text"))


@register("retention_cutoff", """
SELECT event_id, strftime(date_trunc('second', ts) - INTERVAL 730 DAY, '%Y-%m-%d %H:%M:%S') AS cutoff
FROM events""")
def q_retention_cutoff(spark, sf):
    ev = fx.table(spark, sf, "events")
    return ev.select("event_id", fn.retention_cutoff(fx.time_text("ts"), 730).alias("cutoff"))


@register("epoch_format", """
SELECT event_id, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS millis, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events""")
def q_epoch_format(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", fn.ntz_epoch_millis("ts").alias("millis"))
    return ev.select("event_id", "millis", fn.epoch_text("millis").alias("ts_text"))


@register("file_factor", """
SELECT source, CAST(SUM(n_chars) AS BIGINT) AS bytes,
       CASE WHEN SUM(n_chars) = 0 THEN CAST(0 AS BIGINT)
            ELSE CAST(floor(CAST(SUM(n_chars) AS DOUBLE) / (CAST(16384 AS DOUBLE) * CAST(1.85 AS DOUBLE))) AS BIGINT) + 1
       END AS factor
FROM documents GROUP BY source""")
def q_file_factor(spark, sf):
    d = fx.table(spark, sf, "documents")
    sizes = d.groupBy("source").agg(F.sum("n_chars").cast("bigint").alias("bytes"))
    return sizes.select("source", "bytes", fn.file_factor("bytes", 16384, 1.85).alias("factor"))


@register("change_flag", f"""
SELECT event_type, dt, COUNT(*) AS rows,
       CAST(('2024-01-15 00:00:00' < max(strftime(ts, '%Y-%m-%d %H:%M:%S')) OR false) AND COUNT(*) > 0 AS INTEGER) AS changed
FROM {_EV} GROUP BY event_type, dt""")
def q_change_flag(spark, sf):
    ev = fx.events_rows(spark, sf)
    g = ev.groupBy("event_type", "dt").agg(F.count(F.lit(1)).alias("rows"),
                                           F.max(fx.time_text("ts")).alias("last_mod"))
    return g.select("event_type", "dt", "rows",
                    fn.change_flag(F.lit("2024-01-15 00:00:00"), "last_mod", False, "rows")
                    .alias("changed"))


# ============================================================================
# P: projections and predicates
# ============================================================================
@register("transfer_projection", _ORDERS_MART_SQL)
def q_transfer_projection(spark, sf):
    mart = _load_orders(spark, sf, fx.orders_mart(spark, "transfer"))
    return mart.read_files(spark)


@register("conform_schema", """
SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_comment, o_totalprice, o_orderstatus,
       CAST(NULL AS INTEGER) AS o_shippriority FROM orders""")
def q_conform_schema(spark, sf):
    target = StructType([StructField("o_orderkey", LongType()), StructField("o_comment", StringType()),
                         StructField("o_totalprice", DoubleType()),
                         StructField("o_orderstatus", StringType()),
                         StructField("o_shippriority", IntegerType())])
    return proj.conform_schema(fx.table(spark, sf, "orders"), target)


@register("filter_condition", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity >= 25""")
def q_filter_condition(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return (proj.filter_condition(li, "l_returnflag = 'R' AND l_quantity >= 25")
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"))


@register("partition_filter", f"""
WITH p AS (SELECT event_id, event_type, dt, 'event_type=' || event_type || '/dt=' || dt AS part FROM {_EV})
SELECT event_id, event_type, dt FROM p WHERE part = (SELECT max(part) FROM p)""")
def q_partition_filter(spark, sf):
    mart = fx.events_mart(spark, sf, "partition_filter")
    spec = parts.last_partition_spec(spark, mart)
    return proj.partition_filter(mart.read(spark), spec).select("event_id", "event_type", "dt")


@register("range_filter", f"""
SELECT event_id, dt FROM {_EV} WHERE dt >= '2024-01-10' AND dt <= '2024-01-20'""")
def q_range_filter(spark, sf):
    mart = fx.events_mart(spark, sf, "range_filter")
    return proj.range_filter(mart.read(spark), "dt", "2024-01-10", "2024-01-20").select("event_id", "dt")


@register("visible_paths", """
SELECT page_id, url FROM pages
WHERE NOT regexp_matches(substr(url, length(regexp_extract(url, '^(https?://[^/]+)', 1)) + 1), '/[_.]')
  AND regexp_full_match(url, '.*/(en|fr)/.*')""")
def q_visible_paths(spark, sf):
    pages = fx.table(spark, sf, "pages")
    root = F.regexp_extract("url", r"^(https?://[^/]+)", 1)
    return proj.visible_paths(pages, "url", root, ".*/(en|fr)/.*").select("page_id", "url")


@register("partitions_with_data", f"""
SELECT 'event_type=' || event_type || '/dt=' || dt AS partition FROM {_EV_PARTS}""")
def q_partitions_with_data(spark, sf):
    mart = fx.events_mart(spark, sf, "with_data")
    # two folders without data: only the filter keeps them out of the result
    fx.empty_folder(spark, mart, "event_type=none/dt=2024-01-01")
    fx.empty_folder(spark, mart, "event_type=none/dt=2024-01-02", empty_file="part-0.parquet")
    return parts.partitions_with_data(parts.partition_inventory(spark, mart, with_rows=False)) \
        .select("partition")


@register("empty_partitions", f"""
SELECT 'event_type=' || event_type || '/dt=' || dt AS partition, dt,
       CAST(COUNT(*) AS BIGINT) AS rows, true AS has_data FROM {_EV} GROUP BY event_type, dt
UNION ALL SELECT 'event_type=none/dt=' || dt, dt, 0, false FROM (SELECT DISTINCT dt FROM {_EV})""")
def q_empty_partitions(spark, sf):
    mart = fx.events_mart(spark, sf, "empty_folders")
    for r in mart.read(spark).select("dt").distinct().toLocalIterator():
        fx.empty_folder(spark, mart, f"event_type=none/dt={r['dt']}")
    inv = parts.partition_inventory(spark, mart)
    return inv.select("partition", "dt", "rows", (F.col("bytes") > 0).alias("has_data"))


@register("directory_bytes", """
SELECT 'source=' || source AS partition, CAST(SUM(strlen(coalesce(text, '')) + 1) AS BIGINT) AS bytes
FROM documents GROUP BY source
UNION ALL SELECT '', SUM(strlen(coalesce(text, '')) + 1) FROM documents""")
def q_directory_bytes(spark, sf):
    # lines of text have a known size: the bytes of a text and its line end
    mart = Mart(work_path(spark, "bytes"), StructType([StructField("value", StringType()),
                                                       StructField("source", StringType())]),
                ("source",))
    docs = fx.table(spark, sf, "documents").select(
        F.coalesce("text", F.lit("")).alias("value"), "source")
    docs.write.partitionBy("source").text(mart.path)
    per_key = parts.partition_inventory(spark, mart, with_rows=False).select("partition", "bytes")
    return per_key.unionByName(parts.directory_bytes(spark, mart.path)
                               .select(F.lit("").alias("partition"), "bytes"))


@register("partition_state", f"""
SELECT 'event_type=' || event_type || '/dt=' || dt AS partition, dt < '2024-01-20' AS on_disk,
       true AS in_catalog FROM {_EV_PARTS}
UNION ALL SELECT 'event_type=none/dt=2024-01-01', true, false""")
def q_partition_state(spark, sf):
    mart = src.create_mart(spark, unique_name("state"), fx.events_mart(spark, sf, "state"))
    late = parts.partition_inventory(spark, mart, with_rows=False).where("dt >= '2024-01-20'")
    for r in late.select("location").toLocalIterator():
        delete_path(spark, r["location"])  # behind the catalog
    fx.empty_folder(spark, mart, "event_type=none/dt=2024-01-01")
    return parts.partition_state(spark, mart).select("partition", "on_disk", "in_catalog")


# ============================================================================
# A / T: aggregates and ordering
# ============================================================================
@register("row_count", """
SELECT 'lineitem' AS "table", CAST(COUNT(*) AS BIGINT) AS row_count FROM lineitem
UNION ALL SELECT 'orders', COUNT(*) FROM orders
UNION ALL SELECT 'customer', COUNT(*) FROM customer
UNION ALL SELECT '', 0
UNION ALL SELECT 'lineitem_returned', COUNT(*) FROM lineitem WHERE l_returnflag = 'R'""")
def q_row_count(spark, sf):
    t = {n: fx.table(spark, sf, n) for n in ("lineitem", "orders", "customer")}
    t[""] = None
    counts = agg.table_row_counts(spark, t)
    returned = agg.row_count(t["lineitem"], "l_returnflag = 'R'").select(
        F.lit("lineitem_returned").alias("table"), "row_count")
    return counts.unionByName(returned)


@register("max_value", """
SELECT (SELECT strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') FROM lineitem) AS max_shipdate,
       (SELECT max(l_extendedprice) FROM lineitem WHERE l_returnflag = 'N') AS max_price,
       (SELECT max(l_tax) FROM lineitem WHERE 1 = 0) AS max_empty""")
def q_max_value(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    m = agg.max_values(li, {"m": ("l_shipdate", None),
                            "max_price": ("l_extendedprice", "l_returnflag = 'N'"),
                            "max_empty": ("l_tax", "1 = 0")})
    return m.select(fx.time_text("m").alias("max_shipdate"), "max_price", "max_empty")


@register("relevance_value", """
SELECT max(strftime(o_orderdate, '%Y-%m') || '-01 00:00:00') AS relevance_value FROM orders""")
def q_relevance_value(spark, sf):
    return agg.relevance_value(fx.orders_source(spark, sf))


@register("load_delta", """
SELECT 1 AS step, CAST(0 AS BIGINT) AS rows_before, CAST(COUNT(*) AS BIGINT) AS rows_after FROM orders
UNION ALL SELECT 2, COUNT(*), COUNT(*) FROM orders""")
def q_load_delta(spark, sf):
    mart = fx.orders_mart(spark, "load_delta")
    first = agg.load_delta(spark, lambda: mart.read(spark), lambda: _load_orders(spark, sf, mart))
    second = agg.load_delta(spark, lambda: mart.read(spark), lambda: _load_orders(spark, sf, mart))
    return (first.select(F.lit(1).alias("step"), "*")
            .unionByName(second.select(F.lit(2).alias("step"), "*")))


_MARKS_SQL = """
SELECT 'orders' AS "table", max(strftime(o_orderdate, '%Y-%m-%d')) AS business_date,
       max(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) AS max_cdc_date FROM orders
UNION ALL SELECT 'lineitem', max(strftime(l_shipdate, '%Y-%m-%d')), max(strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')) FROM lineitem
UNION ALL SELECT 'events', max(strftime(ts, '%Y-%m-%d')), max(strftime(ts, '%Y-%m-%d %H:%M:%S')) FROM events
UNION ALL SELECT 'empty', max(strftime(ts, '%Y-%m-%d')), max(strftime(ts, '%Y-%m-%d %H:%M:%S')) FROM events WHERE 1 = 0"""


def _marks(spark, sf) -> DataFrame:
    def one(name, df, col, cond=None):
        d = proj.filter_condition(df, cond)
        return d.agg(F.max(F.date_format(col, "yyyy-MM-dd")).alias("business_date"),
                     F.max(fx.time_text(col)).alias("max_cdc_date")).select(
            F.lit(name).alias("table"), "business_date", "max_cdc_date")
    ev = fx.table(spark, sf, "events")
    return (one("orders", fx.table(spark, sf, "orders"), "o_orderdate")
            .unionByName(one("lineitem", fx.table(spark, sf, "lineitem"), "l_shipdate"))
            .unionByName(one("events", ev, "ts"))
            .unionByName(one("empty", ev, "ts", "1 = 0")))


@register("run_marks", f"""
SELECT min(business_date) AS business_date, min(max_cdc_date) AS max_cdc_date FROM ({_MARKS_SQL})""")
def q_run_marks(spark, sf):
    return agg.run_marks(_marks(spark, sf))


_ENTRIES_SQL = """
SELECT 1 AS step, 'orders' AS "table", COUNT(*) AS rows FROM orders
UNION ALL SELECT 1, 'lineitem', COUNT(*) FROM lineitem
UNION ALL SELECT 2, 'orders', COUNT(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 2, 'customer', COUNT(*) FROM customer
UNION ALL SELECT 2, 'customer', COUNT(*) FROM customer"""


def _entries(spark, sf) -> DataFrame:
    def e(step, name, df):
        return df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(step).alias("step"), F.lit(name).alias("table"), "rows")
    o, c = fx.table(spark, sf, "orders"), fx.table(spark, sf, "customer")
    return (e(1, "orders", o).unionByName(e(1, "lineitem", fx.table(spark, sf, "lineitem")))
            .unionByName(e(2, "orders", o.where("o_orderstatus = 'F'")))
            .unionByName(e(2, "customer", c)).unionByName(e(2, "customer", c)))


@register("rows_per_table", f"""
SELECT CAST(step AS INTEGER) AS step, "table", CAST(SUM(rows) AS BIGINT) AS rows
FROM ({_ENTRIES_SQL}) GROUP BY step, "table" """)
def q_rows_per_table(spark, sf):
    return agg.rows_per_table(_entries(spark, sf))


@register("computed_tables", f"""SELECT DISTINCT "table" FROM ({_ENTRIES_SQL})""")
def q_computed_tables(spark, sf):
    return agg.computed_tables(_entries(spark, sf))


_STEP_LEDGER_SQL = """
SELECT event_type AS target, CAST(hour(ts) AS INTEGER) AS step, strftime(ts, '%Y-%m-%d') AS ctl_validfrom,
       strftime(ts, '%Y-%m') AS relevance_value FROM events"""


def _step_ledger(spark, sf) -> DataFrame:
    ev = fx.table(spark, sf, "events")
    return ev.select(F.col("event_type").alias("target"), F.hour("ts").cast("int").alias("step"),
                     F.date_format("ts", "yyyy-MM-dd").alias("ctl_validfrom"),
                     F.date_format("ts", "yyyy-MM").alias("relevance_value"))


@register("resume_step", f"""
WITH l AS ({_STEP_LEDGER_SQL}),
     n AS (SELECT target, max(ctl_validfrom) AS t FROM l GROUP BY target),
     r AS (SELECT '2024-01' AS rel UNION ALL SELECT '2023-12')
SELECT n.target, r.rel AS relevance_value,
       CAST(COALESCE(max(CASE WHEN l.relevance_value = r.rel THEN l.step END), 0) AS INTEGER) AS last_computed_step
FROM n JOIN l ON l.target = n.target AND l.ctl_validfrom = n.t, r
GROUP BY n.target, r.rel""")
def q_resume_step(spark, sf):
    ledger = _step_ledger(spark, sf)
    out = None
    for rel in ("2024-01", "2023-12"):
        part = agg.resume_steps(ledger, rel).select(
            "target", F.lit(rel).alias("relevance_value"), "last_computed_step")
        out = part if out is None else out.unionByName(part)
    return out


@register("ordered_steps", """
SELECT c_custkey, CAST(regexp_extract(c_name, '(\\d+)', 1) AS INTEGER) AS step FROM customer""")
def q_ordered_steps(spark, sf):
    c = fx.table(spark, sf, "customer").select("c_custkey", fn.step_number("c_name").alias("step"))
    return agg.ordered_steps(c)


@register("last_partition", f"""
WITH p AS (SELECT max('event_type=' || event_type || '/dt=' || dt) AS partition FROM {_EV})
SELECT partition, 'event_type' AS key, split_part(split_part(partition, '/', 1), '=', 2) AS value FROM p
UNION ALL
SELECT partition, 'dt' AS key, split_part(split_part(partition, '/', 2), '=', 2) AS value FROM p""")
def q_last_partition(spark, sf):
    mart = src.create_mart(spark, unique_name("last"), fx.events_mart(spark, sf, "last_partition"))
    return parts.last_partition(spark, mart).select(
        "partition", F.explode("spec").alias("key", "value"))


# ============================================================================
# S: scans, sinks, definitions
# ============================================================================
@register("scan_table", "SELECT * FROM orders")
def q_scan_table(spark, sf):
    name = unique_name("orders_view")
    fx.table(spark, sf, "orders").createOrReplaceTempView(name)
    return src.scan_table(spark, name)


@register("scan_parquet_dir", "SELECT * FROM lineitem")
def q_scan_parquet_dir(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    path = fx.flat_copy(spark, li, "scan_dir")
    return src.scan_parquet_dir(spark, path, li.schema)


@register("scan_partition", f"SELECT event_id, event_type, dt, value FROM {_EV}")
def q_scan_partition(spark, sf):
    mart = fx.events_mart(spark, sf, "scan_partition")
    dirs = [r["location"] for r in
            parts.partition_inventory(spark, mart, with_rows=False).select("location").collect()]
    return src.scan_partitions(spark, mart, dirs).select("event_id", "event_type", "dt", "value")


@register("load_from_dir", f"SELECT * FROM {_LI}")
def q_load_from_dir(spark, sf):
    path = fx.flat_copy(spark, fx.lineitem_rows(spark, sf), "load_src")
    mart = Mart(work_path(spark, "load_dst"), fx.LINEITEM_MART_SCHEMA, ("ship_month",))
    src.load_from_dir(spark, path, mart, n_files=2)
    return mart.read_files(spark)


@register("overwrite_partitions", f"""
SELECT event_id, event_type, dt, CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value
FROM {_EV}""")
def q_overwrite_partitions(spark, sf):
    mart = fx.events_mart(spark, sf, "overwrite")
    clicks = (fx.events_rows(spark, sf).where(F.col("event_type") == "click")
              .withColumn("value", F.col("value") * 2))
    # the mart holds data, so the load is sized from its measured bytes per row
    src.overwrite_partitions_sized(clicks, mart, parts.bytes_per_row(spark, mart),
                                   target_file_bytes=64 * 1024)
    return mart.read_files(spark).select("event_id", "event_type", "dt", "value")


_LEDGER_COUNTS_SQL = """
SELECT 'lineitem' AS calculated_table, CAST(NULL AS INTEGER) AS ctl_loading, CAST(NULL AS VARCHAR) AS ctl_validfrom,
       CAST(NULL AS VARCHAR) AS relevance_value, CAST(NULL AS INTEGER) AS is_force_load,
       CAST(COUNT(*) AS BIGINT) AS count_rows, CAST(NULL AS INTEGER) AS is_change FROM lineitem
UNION ALL SELECT 'orders', NULL, NULL, NULL, NULL, COUNT(*), NULL FROM orders
UNION ALL SELECT 'customer', NULL, NULL, NULL, NULL, COUNT(*), NULL FROM customer"""


def _count_rows(spark, sf) -> DataFrame:
    out = None
    for n in ("lineitem", "orders", "customer"):
        part = fx.table(spark, sf, n).agg(F.count(F.lit(1)).alias("count_rows")).select(
            F.lit(n).alias("calculated_table"), "count_rows")
        out = part if out is None else out.unionByName(part)
    return out


@register("append_rows", f"{_LEDGER_COUNTS_SQL} UNION ALL {_LEDGER_COUNTS_SQL}")
def q_append_rows(spark, sf):
    ledger = Mart(work_path(spark, "append"), RUN_LEDGER_SCHEMA)
    rows = _count_rows(spark, sf)
    src.append_rows(spark, rows, ledger)
    src.append_rows(spark, rows, ledger)
    return ledger.read_files(spark)


@register("create_mart", _ORDERS_MART_SQL)
def q_create_mart(spark, sf):
    mart = _load_orders(spark, sf, fx.orders_mart(spark, "create_mart"))
    registered = src.create_mart(spark, unique_name("orders_mart"), mart)
    return src.scan_table(spark, registered.table)


@register("create_ledger", _LEDGER_COUNTS_SQL)
def q_create_ledger(spark, sf):
    ledger = src.create_mart(spark, unique_name("ledger"),
                             Mart(work_path(spark, "ledger"), RUN_LEDGER_SCHEMA))
    src.append_rows(spark, _count_rows(spark, sf), ledger)
    return ledger.read(spark)


@register("recreate_flat_table", "SELECT * FROM nation")
def q_recreate_flat_table(spark, sf):
    nation = fx.table(spark, sf, "nation")
    path = fx.flat_copy(spark, nation, "nation", files=2)
    t = src.recreate_flat_table(spark, unique_name("nation"), src.column_plan(nation.schema), path)
    return src.scan_table(spark, t.table)


@register("recover_partitions", f"SELECT event_id, event_type, dt FROM {_EV}")
def q_recover_partitions(spark, sf):
    empty = Mart(work_path(spark, "recover"), fx.EVENTS_MART_SCHEMA, ("event_type", "dt"))
    registered = src.create_mart(spark, unique_name("recover"), empty)
    # files arrive behind the catalog's back, then the partitions are recovered
    src.overwrite_partitions(fx.events_rows(spark, sf), empty)
    src.recover_partitions(spark, registered.table)
    return spark.table(registered.table).select("event_id", "event_type", "dt")


@register("archive_reload", f"""
SELECT 'mart' AS target, CAST(0 AS BIGINT) AS rows
UNION ALL SELECT 'ledger', CAST(COUNT(*) AS BIGINT) FROM ({_LEDGER_COUNTS_SQL})""")
def q_archive_reload(spark, sf):
    mart = _load_orders(spark, sf, fx.orders_mart(spark, "reload_mart"))
    ledger = Mart(work_path(spark, "reload_ledger"), RUN_LEDGER_SCHEMA)
    src.append_rows(spark, _count_rows(spark, sf), ledger)
    src.archive_reload(spark, {"mart": mart, "ledger": ledger}, keep=("ledger",))
    return (agg.row_count(mart.read_files(spark)).select(F.lit("mart").alias("target"),
                                                         F.col("row_count").alias("rows"))
            .unionByName(agg.row_count(ledger.read_files(spark)).select(
                F.lit("ledger").alias("target"), F.col("row_count").alias("rows"))))


@register("run_sql_script", """
SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n FROM orders WHERE o_totalprice >= 1000 GROUP BY o_orderstatus""")
def q_run_sql_script(spark, sf):
    view, staged = unique_name("orders_src"), unique_name("orders_staged")
    fx.table(spark, sf, "orders").createOrReplaceTempView(view)
    # a two-statement script: names fill the DDL, values bind as parameters
    return src.run_sql_script(spark, [
        "CREATE OR REPLACE TEMPORARY VIEW {staged} AS "
        "SELECT o_orderstatus, o_totalprice FROM {src}",
        "SELECT o_orderstatus, COUNT(*) AS n FROM IDENTIFIER(:staged) "
        "WHERE o_totalprice >= :min_price GROUP BY o_orderstatus",
    ], {"staged": staged, "min_price": 1000}, names={"staged": staged, "src": view})


@register("scalar_query", """
SELECT 'newest' AS kind, max(strftime(o_orderdate, '%Y-%m') || '-01 00:00:00') AS value FROM orders
UNION ALL SELECT 'empty', CAST(NULL AS VARCHAR)""")
def q_scalar_query(spark, sf):
    view = unique_name("orders_source")
    fx.orders_source(spark, sf).createOrReplaceTempView(view)
    newest = src.scalar_query(spark, "SELECT MAX(report_dt) FROM IDENTIFIER(:t)", {"t": view})
    empty = src.scalar_query(spark, "SELECT MAX(report_dt) FROM IDENTIFIER(:t) WHERE 1 = 0",
                             {"t": view})
    return (newest.select(F.lit("newest").alias("kind"), "value")
            .unionByName(empty.select(F.lit("empty").alias("kind"), "value")))


# ============================================================================
# M: partition maintenance
# ============================================================================
@register("list_partitions", f"""
SELECT 'event_type=' || event_type || '/dt=' || dt AS partition FROM {_EV_PARTS}""")
def q_list_partitions(spark, sf):
    mart = src.create_mart(spark, unique_name("list"), fx.events_mart(spark, sf, "list"))
    return parts.list_partitions(spark, mart)


@register("partition_inventory", f"""
SELECT 'event_type=' || event_type || '/dt=' || dt AS partition, event_type, dt,
       CAST(COUNT(*) AS BIGINT) AS rows, true AS has_files
FROM {_EV} GROUP BY event_type, dt""")
def q_partition_inventory(spark, sf):
    mart = fx.events_mart(spark, sf, "inventory")
    inv = parts.partition_inventory(spark, mart)
    return inv.select("partition", "event_type", "dt", "rows",
                      ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files"))


@register("compaction_plan", f"""
SELECT 'ship_month=' || ship_month AS partition, CAST(COUNT(DISTINCT l_returnflag) AS BIGINT) AS files,
       CAST(1 AS BIGINT) AS factor, COUNT(DISTINCT l_returnflag) > 1 AS needs_rewrite
FROM {_LI} GROUP BY ship_month""")
def q_compaction_plan(spark, sf):
    # one file per return flag and month; every month is far below one target file
    mart = fx.lineitem_file_per_flag(spark, sf, "plan")
    inv = parts.partition_inventory(spark, mart, with_rows=False)
    return parts.compaction_plan(inv).select("partition", "files", "factor", "needs_rewrite")


@register("compaction_candidates", f"""
SELECT DISTINCT 'ship_month=' || ship_month AS partition, ship_month FROM {_LI}
WHERE ship_month >= '1996-01' AND ship_month <= '1997-12'""")
def q_compaction_candidates(spark, sf):
    mart = fx.lineitem_small_files(spark, sf, "candidates")
    inv = parts.partition_inventory(spark, mart, with_rows=False)
    return parts.compaction_candidates(inv, mart, "ship_month", "1996-01", "1997-12") \
        .select("partition", "ship_month")


@register("compact_partitions", f"SELECT * FROM {_LI}")
def q_compact_partitions(spark, sf):
    mart = fx.lineitem_small_files(spark, sf, "compact")
    parts.compact(spark, mart)
    return mart.read_files(spark)


@register("compact_flat", "SELECT * FROM lineitem")
def q_compact_flat(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    mart = Mart(fx.flat_copy(spark, li, "compact_flat", files=16), li.schema)
    parts.compact_flat(spark, mart)
    return mart.read_files(spark)


@register("delete_partitions", f"""
SELECT event_id, event_type, dt FROM {_EV} WHERE NOT (dt >= '2024-01-10' AND dt <= '2024-01-20')""")
def q_delete_partitions(spark, sf):
    mart = src.create_mart(spark, unique_name("delete"), fx.events_mart(spark, sf, "delete"))
    parts.delete_partitions(spark, mart, "dt", "2024-01-10", "2024-01-20")
    return mart.read(spark).select("event_id", "event_type", "dt")


@register("retention", f"""
SELECT o_orderkey, report_dt FROM ({_ORDERS_MART_SQL}) WHERE report_dt > '{CUTOFF_730}'""")
def q_retention(spark, sf):
    mart = _load_orders(spark, sf, fx.orders_mart(spark, "retention"))
    parts.retention(spark, mart, 730, column="report_dt", now=RUN_TS)
    return mart.read_files(spark).select("o_orderkey", "report_dt")


# ============================================================================
# R: run reporting
# ============================================================================
@register("run_ledger", f"""
SELECT 'orders_mart' AS calculated_table, {LOADING_ID} AS ctl_loading, '{RUN_TS}' AS ctl_validfrom,
       (SELECT max(strftime(o_orderdate, '%Y-%m') || '-01 00:00:00') FROM orders) AS relevance_value,
       0 AS is_force_load, CAST((SELECT COUNT(*) FROM orders) AS BIGINT) AS count_rows, 1 AS is_change
UNION ALL
SELECT 'events_mart', {LOADING_ID}, '{RUN_TS}',
       (SELECT max(strftime(o_orderdate, '%Y-%m') || '-01 00:00:00') FROM orders),
       0, CAST((SELECT COUNT(*) FROM events) AS BIGINT), 1""")
def q_run_ledger(spark, sf):
    om = _load_orders(spark, sf, fx.orders_mart(spark, "ledger_orders"))
    em = fx.events_mart(spark, sf, "ledger_events")
    relevance = agg.relevance_value(fx.orders_source(spark, sf)).first()[0]
    stats = None
    for name, m in (("orders_mart", om), ("events_mart", em)):
        inv = parts.partition_inventory(spark, m).agg(
            F.sum("rows").cast("bigint").alias("count_rows"),
            F.max("modified_utc").alias("last_modified"))
        part = inv.select(F.lit(name).alias("calculated_table"), "count_rows", "last_modified")
        stats = part if stats is None else stats.unionByName(part)
    ledger = Mart(work_path(spark, "run_ledger"), RUN_LEDGER_SCHEMA)
    record_run(spark, ledger, run_ledger_rows(stats, LOADING_ID, RUN_TS, relevance, False))
    return ledger.read_files(spark)


_RUNS_SQL = """
SELECT CAST(COUNT(*) AS INTEGER) AS loading_id, 77 AS entity_id, o_orderstatus AS application_id,
       max(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) AS ctl_validfrom,
       CAST(o_orderstatus = 'F' AS INTEGER) AS change,
       max(strftime(o_orderdate, '%Y-%m-%d')) AS business_date,
       min(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) AS max_cdc_date
FROM orders GROUP BY o_orderstatus"""


@register("run_statistics", f"""
WITH r AS ({_RUNS_SQL}),
s AS (
  SELECT loading_id, entity_id, change, 15 AS stat_id, application_id AS value FROM r
  UNION ALL SELECT loading_id, entity_id, change, 11, ctl_validfrom FROM r
  UNION ALL SELECT loading_id, entity_id, change, 2, CAST(change AS VARCHAR) FROM r
  UNION ALL SELECT loading_id, entity_id, change, 5, business_date FROM r
  UNION ALL SELECT loading_id, entity_id, change, 1, max_cdc_date FROM r)
SELECT loading_id, entity_id, stat_id, value,
       '{{"loading_id":' || loading_id || ',"entity_id":' || entity_id || ',"stat_id":' || stat_id
       || ',"avalue":["' || value || '"]}}' AS payload
FROM s WHERE stat_id <> 2 OR change <> 0""")
def q_run_statistics(spark, sf):
    o = fx.table(spark, sf, "orders")
    runs = o.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).cast("int").alias("loading_id"),
        F.max(fx.time_text("o_orderdate")).alias("ctl_validfrom"),
        F.max(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("business_date"),
        F.min(fx.time_text("o_orderdate")).alias("max_cdc_date"))
    runs = runs.select("loading_id", F.lit(77).alias("entity_id"),
                       F.col("o_orderstatus").alias("application_id"), "ctl_validfrom",
                       (F.col("o_orderstatus") == "F").cast("int").alias("change"),
                       "business_date", "max_cdc_date")
    return run_statistics(runs)


@register("stepped_load", f"""
SELECT 'orders_mart' AS target, 1 AS step, CAST(0 AS BIGINT) AS rows_before,
       CAST(COUNT(*) AS BIGINT) AS rows_after, '{RUN_TS}' AS ctl_validfrom, 'r1' AS relevance_value FROM orders
UNION ALL
SELECT 'orders_mart', 2, COUNT(*), COUNT(*), '{RUN_TS}', 'r1' FROM orders""")
def q_stepped_load(spark, sf):
    mart = fx.orders_mart(spark, "stepped")
    step_ledger = Mart(work_path(spark, "step_ledger"), STEP_LEDGER_SCHEMA)
    steps = [Step(2, lambda s, p: _load_orders(s, sf, mart), "reload"),
             Step(1, lambda s, p: _load_orders(s, sf, mart), "load")]
    stepped_load(spark, steps, step_ledger, mart, "orders_mart", RUN_TS, "r1")
    # a recovery run of the same relevance finds both steps done and runs nothing
    stepped_load(spark, steps, step_ledger, mart, "orders_mart", RUN_TS, "r1", recovery_mode=True)
    return step_ledger.read_files(spark)


_REFRESH_SQL = f"""
WITH s AS (SELECT strftime(o_orderdate, '%Y-%m') || '-01 00:00:00' AS report_src FROM orders)
SELECT 'orders_mart' AS calculated_table, {LOADING_ID} AS ctl_loading, '{RUN_TS}' AS ctl_validfrom,
       (SELECT max(report_src) FROM s) AS relevance_value, 0 AS is_force_load,
       CAST((SELECT COUNT(*) FROM s) AS BIGINT) AS count_rows, 1 AS is_change,
       (SELECT max(substr(report_src, 1, 10)) FROM s) AS business_date,
       '{RUN_TS}' AS max_cdc_date,
       CAST((SELECT COUNT(*) FROM s WHERE substr(report_src, 1, 10) > '{CUTOFF_730}') AS BIGINT) AS rows_kept"""


def run_refresh(spark: SparkSession, sf: str) -> DataFrame:
    mart = fx.orders_mart(spark, "refresh")
    ledger = Mart(work_path(spark, "refresh_ledger"), RUN_LEDGER_SCHEMA)
    settings = RunSettings(loading_id=LOADING_ID, load_time=RUN_TS, entity_id=77,
                           application_id="fixed-app", lifetime_days=730,
                           retention_column="report_dt", business_date_column="report_dt")
    return refresh_mart(spark, fx.orders_source(spark, sf), mart, ledger, settings,
                        table_name="orders_mart")


@register("refresh_mart", _REFRESH_SQL)
def q_refresh_mart(spark, sf):
    return run_refresh(spark, sf)


def _summary_sql(name: str, dates: str, lifetime: str) -> str:
    return f"""
SELECT '{name}' AS calculated_table, {LOADING_ID} AS ctl_loading, '{RUN_TS}' AS ctl_validfrom,
       max(d) || ' 00:00:00' AS relevance_value, 0 AS is_force_load,
       CAST(COUNT(*) AS BIGINT) AS count_rows, 1 AS is_change, max(d) AS business_date,
       '{RUN_TS}' AS max_cdc_date,
       CAST(COUNT(*) FILTER (WHERE d > '{lifetime}') AS BIGINT) AS rows_kept FROM ({dates})"""


_TWO_MARTS_SQL = (
    _summary_sql("orders_mart", "SELECT strftime(o_orderdate, '%Y-%m') || '-01' AS d FROM orders",
                 CUTOFF_730) + " UNION ALL " +
    _summary_sql("shipments_mart",
                 "SELECT strftime(l_shipdate, '%Y-%m') || '-01' AS d FROM lineitem",
                 fn.cutoff_text(RUN_TS, 365)))


@register("refresh_marts", f"""
WITH s AS ({_TWO_MARTS_SQL})
SELECT s.*, (SELECT min(business_date) FROM s) AS run_business_date,
       (SELECT min(max_cdc_date) FROM s) AS run_max_cdc_date FROM s""")
def q_refresh_marts(spark, sf):
    """Two registered marts and their registered ledger, refreshed twice in the same way."""
    targets = [Target("orders_mart", fx.orders_source(spark, sf),
                      fx.orders_mart(spark, "two_orders").with_table(unique_name("two_orders"))),
               Target("shipments_mart", fx.shipments_source(spark, sf),
                      Mart(work_path(spark, "two_shipments"), fx.SHIPMENTS_MART_SCHEMA,
                           ("report_dt",), unique_name("two_shipments")), lifetime_days=365)]
    ledger = Mart(work_path(spark, "two_ledger"), RUN_LEDGER_SCHEMA, (), unique_name("two_ledger"))
    run = RunSettings(loading_id=LOADING_ID, load_time=RUN_TS, application_id="fixed-app",
                      business_date_column="report_dt", retention_column="report_dt")
    refresh_marts(spark, targets, ledger, run)
    result = refresh_marts(spark, targets, ledger, run)
    marks = result.marks.select(F.col("business_date").alias("run_business_date"),
                                F.col("max_cdc_date").alias("run_max_cdc_date"))
    lines = ledger.read(spark).distinct()  # the second run's lines equal the first's
    return (lines.join(result.summary.select("calculated_table", "business_date", "max_cdc_date",
                                             "rows_kept"), "calculated_table")
            .crossJoin(marks))  # one row
