"""Plan-shape guards: the properties that matter at scale, checked on small data."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from tidemart.operators import partitions as P
from tidemart.operators import project as proj
from tidemart.plans import fixtures as fx
from tidemart.sources.tables import sized_write_frame

from conftest import SF_SMALL


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def exchanges(text: str) -> list[str]:
    return [line for line in text.splitlines() if "Exchange" in line and "Broadcast" not in line
            and "ReusedExchange" not in line]


def test_transfer_prunes_columns_and_shuffles_once(spark):
    src = fx.orders_source(spark, SF_SMALL).withColumn("unused", F.lit(1))
    out = proj.transfer_projection(src, fx.ORDERS_MART_SCHEMA, {"ctl_loading": 1, "ctl_validfrom": "x"})
    text = plan_text(out.hint("rebalance", "report_dt"))
    assert len(exchanges(text)) == 1 and "REBALANCE_PARTITIONS_BY_COL" in text
    schema = re.search(r"ReadSchema: (struct<[^\n]*)", text).group(1)
    assert "o_orderkey" in schema and "unused" not in schema


def test_compaction_is_one_shuffle_with_a_broadcast_plan(spark):
    mart = fx.lineitem_small_files(spark, SF_SMALL, "test-plan-compact", writers=3)
    todo = P.plan_jobs(mart, P.compaction_plan(P.partition_inventory(spark, mart, with_rows=False)))
    text = plan_text(P.compaction_frame(spark, mart, todo))
    ex = exchanges(text)
    assert len(ex) == 1 and "REPARTITION_BY_NUM" in ex[0]
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "dynamicpruning" in text  # only planned folders are read


def test_inventory_row_count_reads_no_column(spark):
    mart = fx.events_mart(spark, SF_SMALL, "test-plan-inventory")
    text = plan_text(P.partition_inventory(spark, mart))
    assert "PushedAggregation: [COUNT(*)]" in text  # from footers, no row is read
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in text
    assert "SortAggregate" not in text


def test_sized_write_is_one_shuffle(spark):
    src = fx.orders_source(spark, SF_SMALL)
    loaded = proj.transfer_projection(src, fx.ORDERS_MART_SCHEMA, {"ctl_loading": 1, "ctl_validfrom": "x"})
    frame, plan = sized_write_frame(loaded, fx.orders_mart(spark, "test-plan-sized"), 40.0, 4096)
    text = plan_text(frame)
    ex = exchanges(text)
    assert len(ex) == 1 and "REPARTITION_BY_NUM" in ex[0] and plan.count()


def test_partition_reads_are_pruned(spark):
    mart = fx.events_mart(spark, SF_SMALL, "test-plan-prune")
    spec = P.last_partition_spec(spark, mart)
    text = plan_text(proj.partition_filter(mart.read(spark), spec).select("event_id"))
    assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ = ", text)
    text = plan_text(proj.range_filter(mart.read(spark), "dt", "2024-01-10", "2024-01-20"))
    assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ >= 2024-01-10", text)
