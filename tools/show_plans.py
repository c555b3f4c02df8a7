"""Print the physical plans of the heavy operators (for plan review).

usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemart.operators import partitions as P  # noqa: E402
from tidemart.operators import project as proj  # noqa: E402
from tidemart.plans import fixtures as fx  # noqa: E402
from tidemart.session import local_session  # noqa: E402


def show(title, df):
    print(f"\n### {title}\n\n```")
    df.explain()
    print("```")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    loaded = proj.transfer_projection(fx.orders_source(spark, sf), fx.ORDERS_MART_SCHEMA,
                                      {"ctl_loading": 1, "ctl_validfrom": fx.RUN_TS})
    show("transfer: projection + rebalance on the partition key (first load)",
         loaded.hint("rebalance", "report_dt"))
    mart = fx.lineitem_small_files(spark, sf, "plans")
    show("partition inventory (listing + counts pushed into the footers)", P.partition_inventory(spark, mart))
    plan = P.compaction_plan(P.partition_inventory(spark, mart, with_rows=False))
    show("compaction of all planned partitions (one job)",
         P.compaction_frame(spark, mart, P.plan_jobs(mart, plan)))
    from tidemart.sources.tables import sized_write_frame
    show("sized write of a new load (mart already holds data)",
         sized_write_frame(loaded, fx.orders_mart(spark, "plans_sized"), 40.0, 64 * 1024)[0])
    ev = fx.events_mart(spark, sf, "plans_events")
    spec = P.last_partition_spec(spark, ev)
    show("newest-partition read (partition pruning)",
         proj.partition_filter(ev.read(spark), spec).agg(F.max("ts")))
    show("range filter on a key (partition pruning)",
         proj.range_filter(ev.read(spark), "dt", "2024-01-10", "2024-01-20").select("event_id"))


if __name__ == "__main__":
    main()
