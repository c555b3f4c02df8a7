"""Runs over several marts, and what a run reads of a mart it knows."""

import time
import uuid

import pytest

from conftest import SF_SMALL
from tidemart.operators import partitions as P
from tidemart.plans import fixtures as fx
from tidemart.plans import refresh as R
from tidemart.plans.ledger import RUN_LEDGER_SCHEMA, STATISTICS_SCHEMA
from tidemart.plans.mart import Mart
from tidemart.sources import tables as S

RUN = R.RunSettings(1, "2001-09-01 00:00:00", lifetime_days=0, business_date_column="report_dt")


def orders(spark, scratch, table=None):
    return Mart(scratch("orders"), fx.ORDERS_MART_SCHEMA, ("report_dt",), table)


def two(spark, scratch, registered=False):
    def name(x):
        return f"tm_{x}_{uuid.uuid4().hex[:8]}" if registered else None
    older = fx.shipments_source(spark, SF_SMALL).where("report_dt < '1997-01-01'")
    return [R.Target("orders", fx.orders_source(spark, SF_SMALL), orders(spark, scratch, name("o"))),
            R.Target("shipments", older, Mart(scratch("ship"), fx.SHIPMENTS_MART_SCHEMA,
                                              ("report_dt",), name("s")))]


@pytest.mark.parametrize("registered", [False, True])
def test_two_marts_one_ledger_and_the_minimum_of_their_marks(spark, scratch, registered):
    targets = two(spark, scratch, registered)
    tables = [f"tm_{x}_{uuid.uuid4().hex[:8]}" if registered else None for x in ("l", "st")]
    ledger = Mart(scratch("ledger"), RUN_LEDGER_SCHEMA, (), tables[0])
    statistics = Mart(scratch("stats"), STATISTICS_SCHEMA, (), tables[1])
    result = R.refresh_marts(spark, targets, ledger, RUN, statistics)
    lines = {r["calculated_table"]: r for r in result.summary.collect()}
    assert {n: r["count_rows"] for n, r in lines.items()} == {t.name: t.source.count() for t in targets}
    assert {n: r["business_date"] for n, r in lines.items()} == {
        "orders": "2001-08-01", "shipments": "1996-12-01"}
    assert result.marks.first().asDict() == {"business_date": "1996-12-01",
                                             "max_cdc_date": "2001-09-01 00:00:00"}
    assert sorted(tuple(r) for r in result.rows.collect()) == sorted(
        (1, n, r["count_rows"]) for n, r in lines.items())
    assert sorted(r["calculated_table"] for r in ledger.read(spark).collect()) == sorted(lines)
    values = {r["stat_id"]: r["value"] for r in statistics.read(spark).collect()}
    assert values[5] == "1996-12-01" and values[2] == "1" and len(values) == 5
    for t in targets:
        assert t.mart.read(spark).count() == lines[t.name]["rows_kept"]
        if registered:
            assert P.list_partitions(spark, t.mart).count() > 0


def test_unchanged_folders_are_not_counted_again(spark, scratch, monkeypatch):
    mart, ledger = orders(spark, scratch), Mart(scratch("ledger"), RUN_LEDGER_SCHEMA)
    source = fx.orders_source(spark, SF_SMALL)
    first = R.refresh_mart(spark, source, mart, ledger, RUN).first()
    opened, whole = [], []
    real, real_all = P._rows_of_folders, P.rows_per_partition
    monkeypatch.setattr(P, "_rows_of_folders",
                        lambda s, m, loc: (opened.extend(loc), real(s, m, loc))[1])
    monkeypatch.setattr(P, "rows_per_partition",
                        lambda s, m: (whole.append(m.path), real_all(s, m))[1])
    time.sleep(1.1)
    run = R.replace(RUN, loading_id=2, source_condition="report_dt >= '2001-08-01'")
    second = R.refresh_mart(spark, source, mart, ledger, run).first()
    assert second["count_rows"] == first["count_rows"] == mart.read(spark).count()
    assert {p.rsplit("/", 1)[-1] for p in opened} == {"report_dt=2001-08-01"}
    assert mart.path not in whole
    opened.clear()
    run = R.replace(RUN, loading_id=3, source_condition="report_dt > '9999'", relevance=None)
    third = R.refresh_mart(spark, source, mart, ledger, run).first()
    assert opened == [] and mart.path not in whole
    assert third["rows_kept"] == first["count_rows"] and third["relevance_value"] is None
    assert len(R._kept(spark, mart).folders()) == 1


def test_a_folder_changed_by_another_writer_is_counted(spark, scratch):
    mart, ledger = orders(spark, scratch), Mart(scratch("ledger"), RUN_LEDGER_SCHEMA)
    source = fx.orders_source(spark, SF_SMALL)
    n = R.refresh_mart(spark, source, mart, ledger, RUN).first()["rows_kept"]
    time.sleep(1.1)
    S.append_rows(spark, mart.read(spark).where("report_dt = '1996-03-01'"), mart)
    more = mart.read(spark).count() - n
    assert more > 0
    run = R.replace(RUN, loading_id=2, source_condition="report_dt > '9999'")
    assert R.refresh_mart(spark, source, mart, ledger, run).first()["rows_kept"] == n + more
    # a broken or missing partition table only costs a count
    for f in R._kept(spark, mart).folders():
        f.child("_SUCCESS").delete()
    assert R.known_partitions(spark, mart) is None
    assert R.refresh_mart(spark, source, mart, ledger, run).first()["rows_kept"] == n + more


def test_compacted_partitions_keep_their_counts(spark, scratch, monkeypatch):
    mart, ledger = orders(spark, scratch), Mart(scratch("ledger"), RUN_LEDGER_SCHEMA)
    source = fx.orders_source(spark, SF_SMALL)
    n = R.refresh_mart(spark, source, mart, ledger, RUN).first()["rows_kept"]
    S.append_rows(spark, mart.read(spark).where("report_dt < '1996-01-01'").repartition(3), mart)
    total = mart.read(spark).count()
    files = mart.read(spark).select("_metadata.file_path").distinct().count()
    run = R.replace(RUN, loading_id=2, source_condition="report_dt > '9999'",
                    compaction_column="report_dt")
    got = R.refresh_mart(spark, source, mart, ledger, run).first()
    assert got["rows_kept"] == total > n
    assert mart.read(spark).select("_metadata.file_path").distinct().count() < files
    kept = R.known_partitions(spark, mart)
    assert kept.agg({"rows": "sum"}).first()[0] == total
    assert R.known_partitions(spark, mart).join(
        P.partition_inventory(spark, mart, False).select("partition", "files", "bytes", "modified_at"),
        ["partition", "files", "bytes", "modified_at"]).count() == kept.count()


def test_force_load_clears_every_target_but_the_ledger(spark, scratch):
    targets = two(spark, scratch)
    ledger = Mart(scratch("ledger"), RUN_LEDGER_SCHEMA)
    R.refresh_marts(spark, targets, ledger, RUN)
    small = [R.replace(t, source_condition="report_dt = '1996-05-01 00:00:00'") for t in targets]
    result = R.refresh_marts(spark, small, ledger, R.replace(RUN, loading_id=2, force_load=True))
    for r in result.summary.collect():
        target = next(t for t in targets if t.name == r["calculated_table"])
        assert r["rows_kept"] == r["count_rows"] == target.mart.read(spark).count() \
            == target.source.where("report_dt = '1996-05-01 00:00:00'").count() > 0
    assert ledger.read(spark).count() == 4


def test_settings_that_must_be_given(spark, scratch):
    mart, ledger = orders(spark, scratch), Mart(scratch("ledger"), RUN_LEDGER_SCHEMA)
    source = fx.orders_source(spark, SF_SMALL)
    for bad in ({"business_date_column": None}, {"business_date_column": "typo"},
                {"load_time_column": "typo"}, {"loading_column": "typo"}):
        with pytest.raises(ValueError):
            R.refresh_mart(spark, source, mart, ledger, R.replace(RUN, **bad))
    twice = [R.Target("same", source, mart)] * 2
    with pytest.raises(ValueError):
        R.refresh_marts(spark, twice, ledger, RUN)
    assert mart.read(spark).count() == 0 and ledger.read(spark).count() == 0


def test_define_mart_creates_recreates_and_recovers(spark, scratch):
    mart = orders(spark, scratch, f"tm_def_{uuid.uuid4().hex[:8]}")
    R.define_mart(spark, mart)
    assert spark.table(mart.table).count() == 0
    rows = fx.orders_source(spark, SF_SMALL).where("o_orderkey < 100")
    S.overwrite_partitions(S.conform_schema(rows, mart.schema, strict=False), mart.with_table(None))
    R.define_mart(spark, mart)  # folders written behind the catalog are found
    assert spark.table(mart.table).count() == rows.count() > 0
    spark.sql(f"DROP TABLE {mart.table}")
    spark.sql(f"CREATE TABLE {mart.table} (x int) USING PARQUET")
    R.define_mart(spark, mart)
    assert spark.table(mart.table).count() == rows.count()
