"""Folders without files, partitions without folders, and counts from footers."""

import os
import shutil
import time
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemart.operators import partitions as P
from tidemart.plans.mart import Mart
from tidemart.sources import tables as S
from tidemart.sources.folders import Folder

SCHEMA = StructType([StructField("id", LongType()), StructField("v", StringType()),
                     StructField("dt", StringType())])
TWO = StructType([*SCHEMA.fields, StructField("hh", StringType())])


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def made(spark, scratch, keys=("2024-01-01", "2024-01-02", None), registered=False):
    mart = Mart(scratch("mart"), SCHEMA, ("dt",))
    spark.createDataFrame([(i, "v", k) for i, k in enumerate([*keys] * 4)], SCHEMA) \
        .repartition(2).write.partitionBy("dt").parquet(mart.path)
    Folder(spark, mart.path + "/dt=2024-01-09").make()
    Folder(spark, mart.path + "/dt=2024-01-08").make("part-0.parquet")
    Folder(spark, mart.path + "/_temporary/dt=2024-01-07").make()
    Folder(spark, mart.path + "/other").make()
    if not registered:
        return mart
    return S.create_mart(spark, f"tm_state_{uuid.uuid4().hex[:8]}", mart)


def by_partition(df):
    return {r["partition"]: r for r in df.collect()}


@pytest.mark.parametrize("with_rows", [False, True])
def test_empty_and_zero_byte_folders_have_no_bytes(spark, scratch, with_rows):
    mart = made(spark, scratch)
    inv = by_partition(P.partition_inventory(spark, mart, with_rows))
    assert set(inv) == {"dt=2024-01-01", "dt=2024-01-02", "dt=__HIVE_DEFAULT_PARTITION__",
                        "dt=2024-01-08", "dt=2024-01-09"}
    assert [(inv[p]["files"], inv[p]["bytes"]) for p in ("dt=2024-01-08", "dt=2024-01-09")] \
        == [(0, 0), (0, 0)]  # files of no bytes are no data files
    assert all(os.path.isdir(local(r["location"])) for r in inv.values())
    assert inv["dt=2024-01-09"]["dt"] == "2024-01-09" and inv["dt=2024-01-09"]["modified_at"] is None
    if with_rows:
        assert {p: r["rows"] for p, r in inv.items() if r["rows"]} == dict.fromkeys(
            ("dt=2024-01-01", "dt=2024-01-02", "dt=__HIVE_DEFAULT_PARTITION__"), 4)
    kept = P.partitions_with_data(P.partition_inventory(spark, mart, False))
    assert set(by_partition(kept)) == set(inv) - {"dt=2024-01-08", "dt=2024-01-09"}
    plan = by_partition(P.compaction_plan(P.partition_inventory(spark, mart, False)))
    assert plan["dt=2024-01-08"]["factor"] == plan["dt=2024-01-09"]["factor"] == 0


def test_only_folders_right_below_the_root_are_partitions(spark, scratch):
    mart = made(spark, scratch)
    before = set(by_partition(P.partition_inventory(spark, mart, False)))
    spark.createDataFrame([(1, "v", "2024-01-01")], SCHEMA).write.partitionBy("dt") \
        .parquet(mart.path + "/other/copy")
    inv = by_partition(P.partition_inventory(spark, mart, False))
    assert set(inv) == before
    assert inv["dt=2024-01-01"]["location"].endswith(mart.path.rsplit("/", 1)[-1] + "/dt=2024-01-01")


def test_a_neighbour_with_a_longer_name_is_not_the_same_folder(spark, scratch):
    flat = Mart(scratch("f"), StructType(SCHEMA.fields[:2]))
    rows = spark.createDataFrame([(1, "a")], flat.schema)
    rows.write.parquet(flat.path)
    rows.write.parquet(flat.path + "_more")
    near = spark.read.parquet(flat.path + "_more")
    S.overwrite_partitions(near, flat)
    with pytest.raises(ValueError):
        S.overwrite_partitions(spark.read.parquet(flat.path), flat)
    assert flat.read(spark).count() == 1


def test_folder_names_with_marks(spark, scratch):
    keys = ["a, b", "x=y/z", "[1]*?", "{q}", "é", "c:d", "%41", None]
    schema = StructType([SCHEMA.fields[0], StructField("k", StringType())])
    mart = Mart(scratch("marks"), schema, ("k",))
    spark.createDataFrame(list(enumerate(keys)), schema).write.partitionBy("k").parquet(mart.path)
    inv = P.partition_inventory(spark, mart).collect()
    assert {r["k"] for r in inv} == set(keys)
    assert all(r["files"] == 1 and r["rows"] == 1 for r in inv)
    assert P.partition_folders(spark, Mart(scratch("absent"), SCHEMA, ("dt",))).count() == 0


def test_two_levels_roll_up_and_pattern_without_scheme(spark, scratch):
    mart = Mart(scratch("two"), TWO, ("dt", "hh"))
    spark.createDataFrame([(i, "v", f"d{i % 2}", f"{i % 3:02}") for i in range(12)], TWO) \
        .write.partitionBy("dt", "hh").parquet(mart.path)
    Folder(spark, mart.path + "/dt=d9/hh=00").make()
    Folder(spark, mart.path + "/dt=d8").make()  # no folder of the second key: no partition
    inv = P.partition_inventory(spark, mart)
    assert len(by_partition(inv)) == 7
    top = by_partition(P.partition_inventory(spark, mart, levels=1))
    assert {p: r["rows"] for p, r in top.items()} == {"dt=d0": 6, "dt=d1": 6, "dt=d9": 0}
    assert all(r["location"].endswith("/" + p) for p, r in top.items())
    assert sum(r["bytes"] for r in top.values()) == inv.agg(F.sum("bytes")).first()[0]
    root = local(mart.path)
    found = P.partition_inventory(spark, mart, False, pattern=f"{root}/dt=d[01]/hh=0[12]")
    assert sorted(by_partition(found)) == [f"dt=d{d}/hh=0{h}" for d in "01" for h in "12"]
    assert not by_partition(P.partition_inventory(spark, mart, False, pattern="file:.*"))


def test_directory_bytes(spark, scratch):
    mart = made(spark, scratch)
    on_disk = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(local(mart.path))
                  for f in names if not f.startswith((".", "_")))
    assert P.directory_bytes(spark, mart.path).first()["bytes"] == on_disk > 0
    assert P.directory_bytes(spark, mart.path + "/dt=2024-01-09").first()["bytes"] == 0
    assert P.directory_bytes(spark, scratch("absent")).first()["bytes"] == 0


def test_counts_are_pushed_into_the_footers(spark, scratch):
    mart = made(spark, scratch)
    plan = P.rows_per_partition(spark, mart)._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [dt]" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""  # ours is untouched
    scan = spark.read.schema(mart.schema).parquet(mart.path).groupBy("dt").count()
    assert sorted(map(str, P.rows_per_partition(spark, mart).collect())) == sorted(
        str(r).replace("count", "rows") for r in scan.collect())


def test_known_partitions_are_not_counted_again(spark, scratch, monkeypatch):
    mart = made(spark, scratch)
    known = P.saved(P.partition_inventory(spark, mart), "known")
    opened = []
    real = P._rows_of_folders
    monkeypatch.setattr(P, "_rows_of_folders", lambda s, m, loc: (opened.append(sorted(loc)),
                                                                  real(s, m, loc))[1])
    again = P.partition_inventory(spark, mart, known=known)
    assert opened == [[]]
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, known.collect()), key=str)
    time.sleep(1.1)
    spark.createDataFrame([(99, "new", "2024-01-02"), (99, "new", "2024-03-01")], SCHEMA) \
        .write.mode("append").partitionBy("dt").parquet(mart.path)
    rows = {p: r["rows"] for p, r in
            by_partition(P.partition_inventory(spark, mart, known=known)).items()}
    assert [p.rsplit("/", 1)[-1] for p in opened[1]] == ["dt=2024-01-02", "dt=2024-03-01"]
    assert rows["dt=2024-01-02"] == 5 and rows["dt=2024-03-01"] == 1 and rows["dt=2024-01-01"] == 4
    assert rows["dt=2024-01-09"] == 0


def test_state_of_ghosts_and_unknown_folders(spark, scratch):
    mart = made(spark, scratch, registered=True)
    shutil.rmtree(local(mart.path) + "/dt=2024-01-02")
    Folder(spark, mart.path + "/dt=2024-02-01").make()
    state = by_partition(P.partition_state(spark, mart))
    assert {p: (r["on_disk"], r["in_catalog"]) for p, r in state.items()} == {
        "dt=2024-01-01": (True, True), "dt=__HIVE_DEFAULT_PARTITION__": (True, True),
        "dt=2024-01-08": (True, True), "dt=2024-01-09": (True, True),
        "dt=2024-01-02": (False, True), "dt=2024-02-01": (True, False)}
    assert state["dt=2024-01-02"]["dt"] == "2024-01-02" and state["dt=2024-01-02"]["files"] == 0


def test_last_partition_passes_over_ghosts(spark, scratch):
    mart = made(spark, scratch, keys=("2024-01-01", "2024-01-02"), registered=True)
    for day in ("09", "08"):
        shutil.rmtree(local(mart.path) + f"/dt=2024-01-{day}")
    assert "dt=2024-01-09" in [r[0] for r in P.list_partitions(spark, mart).collect()]
    assert P.last_partition_spec(spark, mart) == {"dt": "2024-01-02"}
    shutil.rmtree(local(mart.path))
    assert P.last_partition_spec(spark, mart) == {}


def shown(spark, mart):
    return sorted(r[0] for r in P.list_partitions(spark, mart).collect())


def test_delete_clears_ghosts_and_empty_folders(spark, scratch):
    mart = made(spark, scratch, registered=True)
    shutil.rmtree(local(mart.path) + "/dt=2024-01-02")
    Folder(spark, mart.path + "/dt=2024-01-03").make()
    gone = P.delete_partitions(spark, mart, "dt", "2024-01-02", "2024-01-08")
    assert sorted(by_partition(gone)) == ["dt=2024-01-02", "dt=2024-01-03", "dt=2024-01-08"]
    assert shown(spark, mart) == ["dt=2024-01-01", "dt=2024-01-09", "dt=__HIVE_DEFAULT_PARTITION__"]
    folders = [d for d in os.listdir(local(mart.path)) if d.startswith("dt=")]
    assert sorted(folders) == shown(spark, mart)
    assert mart.read(spark).count() == 8


def test_retention_removes_empty_folders_by_key_and_by_time(spark, scratch):
    mart = made(spark, scratch, registered=True)
    P.retention(spark, mart, 1, column="dt", now="2024-01-09 10:00:00")
    assert [p for p in shown(spark, mart) if p < "dt=_"] == ["dt=2024-01-09"]
    Folder(spark, mart.path + "/dt=2024-05-01").make()
    os.utime(local(mart.path) + "/dt=2024-01-09", (0, 0))
    gone = P.retention(spark, mart, 1, now="2001-01-02 00:00:00")
    assert list(by_partition(gone)) == ["dt=2024-01-09"]
    assert os.path.isdir(local(mart.path) + "/dt=2024-05-01")
    assert mart.read(spark).count() == 4  # the NULL partition stays
