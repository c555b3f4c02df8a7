import json

import pytest

from tidemart.plans import fixtures as fx
from tidemart.plans.ledger import (RUN_LEDGER_SCHEMA, STEP_LEDGER_SCHEMA, Step,
                                   run_statistics, stepped_load)
from tidemart.plans.mart import Mart
from tidemart.plans.refresh import RunSettings, refresh_mart, refresh_statistics
from tidemart.sources import tables as S

from conftest import SF_SMALL


def test_run_statistics_long_form(spark):
    runs = spark.createDataFrame([(5, 7, "app-1", "2024-01-01 00:00:00", 0, "2024-01-01", None)],
                                 "loading_id int, entity_id int, application_id string, "
                                 "ctl_validfrom string, change int, business_date string, max_cdc_date string")
    out = {r["stat_id"]: r for r in run_statistics(runs).collect()}
    assert sorted(out) == [1, 5, 11, 15]  # no change statistic when nothing changed
    assert json.loads(out[15]["payload"]) == {"loading_id": 5, "entity_id": 7, "stat_id": 15,
                                              "avalue": ["app-1"]}
    assert json.loads(out[1]["payload"])["avalue"] == [None]


def test_append_rows_unknown_column_rejected(spark, scratch):
    ledger = Mart(scratch("ledger"), RUN_LEDGER_SCHEMA)
    S.append_rows(spark, [{"calculated_table": "t", "count_rows": 3}], ledger)
    r = ledger.read(spark).first()
    assert r["calculated_table"] == "t" and r["count_rows"] == 3 and r["is_change"] is None
    with pytest.raises(ValueError):
        S.append_rows(spark, [{"calculated_table": "t", "nope": 1}], ledger)


def test_stepped_load_resumes_after_last_finished_step(spark, scratch):
    target = Mart(scratch("target"), RUN_LEDGER_SCHEMA)
    steps_ledger = Mart(scratch("steps"), STEP_LEDGER_SCHEMA)
    calls = []

    def step(n, fail=False):
        def run(s, params):
            calls.append(n)
            if fail:
                raise RuntimeError("boom")
            S.append_rows(s, [{"calculated_table": f"s{n}"}], target)
        return Step(n, run)

    with pytest.raises(RuntimeError):
        stepped_load(spark, [step(1), step(2), step(3, fail=True)], steps_ledger, target, "t",
                     "2024-01-01 00:00:00", "r1")
    assert calls == [1, 2, 3]
    calls.clear()
    rows = stepped_load(spark, [step(3), step(1), step(2)], steps_ledger, target, "t",
                        "2024-01-01 00:00:00", "r1", recovery_mode=True)
    assert calls == [3]
    assert [(r["step"], r["rows_before"], r["rows_after"]) for r in rows.collect()] == [(3, 2, 3)]
    with pytest.raises(ValueError):
        Step(-1, lambda s, p: None)


def test_refresh_mart_end_to_end_and_force_reload(spark, scratch):
    mart = fx.orders_mart(spark, "test-refresh")
    ledger = S.create_mart(spark, "tm_test_ledger", Mart(scratch("ledger"), RUN_LEDGER_SCHEMA))
    source = fx.orders_source(spark, SF_SMALL)
    n = source.count()
    run = RunSettings(loading_id=1, load_time="2001-09-01 00:00:00", retention_column="report_dt",
                      application_id="app",
                      business_date_column="report_dt")
    s1 = refresh_mart(spark, source, mart, ledger, run, "orders_mart").first()
    assert s1["count_rows"] == n and s1["is_change"] == 1 and s1["relevance_value"] == "2001-08-01 00:00:00"
    assert s1["business_date"] == "2001-08-01" and s1["max_cdc_date"] == "2001-09-01 00:00:00"
    kept = source.where("substr(report_dt, 1, 10) > '1999-09-02 00:00:00'").count()
    assert s1["rows_kept"] == kept == mart.read(spark).count()
    # a forced reload empties the mart first but the ledger keeps its history
    run2 = RunSettings(loading_id=2, load_time="2001-09-02 00:00:00", retention_column="report_dt",
                       force_load=True,
                      business_date_column="report_dt")
    s2 = refresh_mart(spark, source, mart, ledger, run2, "orders_mart").first()
    assert s2["is_force_load"] == 1 and s2["count_rows"] == n
    assert sorted(r["ctl_loading"] for r in ledger.read(spark).collect()) == [1, 2]
    stats = {r["stat_id"] for r in refresh_statistics(
        spark.createDataFrame([s2], s2.__fields__ if hasattr(s2, "__fields__") else None), run2).collect()}
    assert stats == {1, 2, 5, 11, 15}


def test_refresh_appends_statistics(spark, scratch):
    from tidemart.plans.ledger import STATISTICS_SCHEMA
    mart = fx.orders_mart(spark, "test-stats")
    ledger = Mart(scratch("ledger"), RUN_LEDGER_SCHEMA)
    stats = Mart(scratch("stats"), STATISTICS_SCHEMA)
    run = RunSettings(9, "2001-09-01 00:00:00", entity_id=3, application_id="app-9",
                      retention_column="report_dt",
                      business_date_column="report_dt")
    refresh_mart(spark, fx.orders_source(spark, SF_SMALL), mart, ledger, run, "m", statistics=stats)
    got = {r["stat_id"]: r["value"] for r in stats.read(spark).collect()}
    assert got == {15: "app-9", 11: "2001-09-01 00:00:00", 2: "1", 5: "2001-08-01",
                   1: "2001-09-01 00:00:00"}


def test_refresh_defaults_load_time_and_application_id(spark, scratch):
    from tidemart.plans.ledger import STATISTICS_SCHEMA
    mart = fx.orders_mart(spark, "test-defaults")
    stats = Mart(scratch("stats"), STATISTICS_SCHEMA)
    s = refresh_mart(spark, fx.orders_source(spark, SF_SMALL), mart,
                     Mart(scratch("ledger"), RUN_LEDGER_SCHEMA), RunSettings(7, lifetime_days=0,
                      business_date_column="report_dt"),
                     statistics=stats).first()
    assert s["ctl_validfrom"] and len(s["ctl_validfrom"]) == 19
    got = {r["stat_id"]: r["value"] for r in stats.read(spark).collect()}
    assert got[15] == spark.sparkContext.applicationId


def test_refresh_with_empty_source_skips_transfer(spark, scratch):
    mart = fx.orders_mart(spark, "test-empty")
    ledger = Mart(scratch("ledger"), RUN_LEDGER_SCHEMA)
    empty = fx.orders_source(spark, SF_SMALL).where("1 = 0")
    s = refresh_mart(spark, empty, mart, ledger, RunSettings(1, "2001-09-01 00:00:00",
                      business_date_column="report_dt")).first()
    assert s["count_rows"] == 0 and s["is_change"] == 0 and s["relevance_value"] is None


def test_table_ops_by_name(spark, scratch):
    from tidemart.plans.by_name import TableOps
    from tidemart.plans.fixtures import ORDERS_MART_SCHEMA
    src_view = "tm_test_orders_src"
    fx.orders_source(spark, SF_SMALL).createOrReplaceTempView(src_view)
    target = S.create_mart(spark, "tm_test_orders_mart",
                           Mart(scratch("bynamemart"), ORDERS_MART_SCHEMA, ("report_dt",)))
    ops = TableOps(spark)
    assert ops.count("") == 0
    ops.transfer(src_view, target.table, ctl_loading=5, ctl_validfrom="2001-09-01 00:00:00")
    n = spark.table(src_view).count()
    assert ops.count(target.table) == n
    assert ops.columns(target.table)[-1] == ("report_dt", "string")
    assert ops.location(target.table).rstrip("/").endswith(target.path.rstrip("/").split("/")[-1])
    assert ops.last_partition(target.table) == {"report_dt": "2001-08-01"}
    assert ops.max_value(target.table, "ctl_validfrom", "report_dt = '2001-08-01'") == "2001-09-01 00:00:00"
    assert ops.scalar("SELECT max(report_dt) FROM IDENTIFIER(:t)", {"t": target.table}) == "2001-08-01"
    ops.compact(target.table)
    gone = ops.expire(target.table, 730, "report_dt", "2001-09-01 00:00:00").count()
    assert gone > 0 and ops.count(target.table) < n
    assert ops.last_modified(target.table) is not None
    ledger = S.create_mart(spark, "tm_test_bn_ledger", Mart(scratch("bnledger"), RUN_LEDGER_SCHEMA))
    ops.append(ledger.table, calculated_table="x", count_rows=1)
    assert ops.count(ledger.table) == 1


def test_sql_files_sorted_with_names(spark, scratch, local_dir):
    import os
    loc = scratch("sqlfiles")
    with open(os.path.join(local_dir, "b_select.sql"), "w") as fh:
        fh.write("SELECT count(*) AS n FROM IDENTIFIER(:t);\n")
    with open(os.path.join(local_dir, "a_create.sql"), "w") as fh:
        fh.write("DROP TABLE IF EXISTS tm_test_sqlfiles;\n"
                 "CREATE TABLE tm_test_sqlfiles (id bigint) USING PARQUET LOCATION '{loc}';\n"
                 "INSERT INTO tm_test_sqlfiles VALUES (1), (2);")
    out = S.run_sql_files(spark, os.path.join(local_dir, "*.sql"), {"t": "tm_test_sqlfiles"},
                          {"loc": loc})
    assert out.first()["n"] == 2


def test_steps_from_sql_files(spark, scratch, local_dir):
    import os
    from tidemart.plans.ledger import step_of, steps_from_sql_files
    assert step_of("stat12.sql") == 12 and step_of("1stat.sql") == 1
    for bad in ("stat.sql", "stat1_1.sql", "12stat1.sql"):
        with pytest.raises(ValueError):
            step_of(bad)
    target = S.create_mart(spark, "tm_test_steps_target", Mart(scratch("st"), RUN_LEDGER_SCHEMA))
    sub = os.path.join(local_dir, "nested")
    os.makedirs(sub)
    with open(os.path.join(local_dir, "step2.sql"), "w") as fh:
        fh.write("INSERT INTO IDENTIFIER(:t) (calculated_table) VALUES ('two');")
    with open(os.path.join(sub, "step10.sql"), "w") as fh:
        fh.write("INSERT INTO {table} (calculated_table) VALUES ('ten');")
    steps = steps_from_sql_files(local_dir)
    assert sorted(s.number for s in steps) == [2, 10]
    ledger = Mart(scratch("steps_ledger"), STEP_LEDGER_SCHEMA)
    rows = stepped_load(spark, steps, ledger, target, "t", "2024-01-01 00:00:00", "r",
                        params={"t": target.table, "names": {"table": target.table}})
    assert [(r["step"], r["rows_before"], r["rows_after"]) for r in rows.collect()] == [(2, 0, 1), (10, 1, 2)]


def test_recovery_runs_step_zero_when_nothing_finished(spark, scratch):
    ledger = Mart(scratch("steps0"), STEP_LEDGER_SCHEMA)
    calls = []
    steps = [Step(0, lambda s, p: calls.append(0)), Step(1, lambda s, p: calls.append(1))]
    stepped_load(spark, steps, ledger, None, "t", "2024-01-01 00:00:00", "r", recovery_mode=True)
    assert calls == [0, 1]
    calls.clear()
    stepped_load(spark, steps, ledger, None, "t", "2024-01-01 00:00:00", "r", recovery_mode=True)
    assert calls == []


def test_refresh_source_condition_limits_the_load(spark, scratch):
    mart = fx.orders_mart(spark, "test-incremental")
    ledger = Mart(scratch("ledger"), RUN_LEDGER_SCHEMA)
    source = fx.orders_source(spark, SF_SMALL)
    run = RunSettings(1, "2001-09-01 00:00:00", lifetime_days=0,
                      source_condition="report_dt >= '2001-01-01'",
                      business_date_column="report_dt")
    s = refresh_mart(spark, source, mart, ledger, run).first()
    expected = source.where("report_dt >= '2001-01-01'").count()
    assert s["count_rows"] == expected == mart.read(spark).count()
    assert min(r[0] for r in mart.read(spark).select("report_dt").distinct().collect()) >= "2001-01-01"


def test_refresh_registered_mart_keeps_catalog_in_step(spark, scratch):
    from tidemart.operators import partitions as P
    mart = S.create_mart(spark, "tm_test_refresh_reg", fx.orders_mart(spark, "test-refresh-reg"))
    ledger = S.create_mart(spark, "tm_test_refresh_reg_ledger", Mart(scratch("l"), RUN_LEDGER_SCHEMA))
    source = fx.orders_source(spark, SF_SMALL)
    for i in (1, 2):  # the second run is sized from the first run's bytes per row
        run = RunSettings(i, "2001-09-01 00:00:00", retention_column="report_dt",
                      business_date_column="report_dt")
        s = refresh_mart(spark, source, mart, ledger, run).first()
        shown = sorted(r[0] for r in spark.sql("SHOW PARTITIONS tm_test_refresh_reg").collect())
        on_disk = sorted(r["partition"] for r in
                         P.partition_inventory(spark, mart, with_rows=False).collect())
        assert shown == on_disk and all(p > "report_dt=1999-09-02" for p in shown)
        assert spark.table(mart.table).count() == s["rows_kept"]
    assert spark.table(ledger.table).count() == 2


def test_change_flag_when_retention_removes_everything(spark, scratch):
    import datetime as dt
    mart = fx.orders_mart(spark, "test-all-expired")
    ledger = Mart(scratch("ledger"), RUN_LEDGER_SCHEMA)
    # a load time safely before the files are written (second-granularity texts)
    started = (dt.datetime.now(dt.timezone.utc) - dt.timedelta(minutes=1)).strftime("%Y-%m-%d %H:%M:%S")
    s = refresh_mart(spark, fx.orders_source(spark, SF_SMALL), mart, ledger,
                     RunSettings(1, started, retention_column="report_dt", lifetime_days=1,
                      business_date_column="report_dt")).first()
    # every loaded partition is older than a day: all expire, yet the run did change the mart
    assert s["rows_kept"] == 0 and s["count_rows"] > 0 and s["is_change"] == 1


def test_first_load_is_sized_from_the_source(spark, scratch):
    import os
    from conftest import SF_CHECK
    mart = fx.orders_mart(spark, "test-first-sized")
    ledger = Mart(scratch("ledger"), RUN_LEDGER_SCHEMA)
    run = RunSettings(1, "2001-09-01 00:00:00", lifetime_days=0, block_bytes=1024, blocks_per_file=1.0,
                      business_date_column="report_dt")
    refresh_mart(spark, fx.orders_source(spark, SF_CHECK), mart, ledger, run)
    root = mart.path[len("file:"):] if mart.path.startswith("file:") else mart.path
    counts = [len([f for f in os.listdir(os.path.join(root, d)) if f.endswith(".parquet")])
              for d in os.listdir(root) if d.startswith("report_dt=")]
    # ~190 rows a month at ~1 kB per file: several files per month, written once
    assert len(counts) == 80 and sum(c > 1 for c in counts) > 40
    assert mart.read(spark).count() == fx.orders_source(spark, SF_CHECK).count()
