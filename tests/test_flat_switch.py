"""Flat compaction cut off at every point, with appends and clears in between."""

import glob
import os
import uuid

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemart.operators import partitions as P
from tidemart.plans.by_name import TableOps
from tidemart.plans.mart import Mart
from tidemart.sources import folders
from tidemart.sources import tables as S

SCHEMA = StructType([StructField("id", LongType()), StructField("v", StringType())])
N = 60


class Cut(Exception):
    pass


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def made(spark, scratch, registered, files=5):
    mart = Mart(scratch("flat"), SCHEMA)
    rows(spark, range(N)).repartition(files).write.parquet(mart.path)
    return S.create_mart(spark, f"tm_flat_{uuid.uuid4().hex[:8]}", mart) if registered else mart


def rows(spark, ids):
    return spark.createDataFrame([(i, "v") for i in ids], SCHEMA)


def ids(spark, mart):
    return sorted(r["id"] for r in mart.read(spark).collect())


def cut_at(monkeypatch, point):
    """The ``point``-th change of a folder or record raises, as if the run had died there."""
    calls = []

    def guarded(name):
        real = getattr(folders.Folder, name)

        def run(self, *args):
            if name == "delete" and not self.exists():
                return None
            calls.append(name)
            if len(calls) == point:
                raise Cut(name)
            return real(self, *args)
        monkeypatch.setattr(folders.Folder, name, run)
    for name in ("move", "delete", "write_text"):
        guarded(name)
    return calls


def act(spark, mart, action):
    """What another run does before the next compaction; returns the ids then expected."""
    if action == "append":
        S.append_rows(spark, rows(spark, [1000]), mart)
    elif action == "raw append":
        rows(spark, [1000]).write.mode("append").parquet(mart.located(spark).path)
    elif action == "clear":
        S.clear_mart(spark, mart)
        return []
    elif action == "clear, append":
        S.clear_mart(spark, mart)
        S.append_rows(spark, rows(spark, [1000]), mart)
        return [1000]
    elif action == "overwrite":
        S.overwrite_partitions(rows(spark, [7, 8]), mart)
        return [7, 8]
    return [*range(N)] + ([1000] if "append" in action else [])


ACTIONS = ["nothing", "append", "raw append", "clear", "clear, append", "overwrite"]


@pytest.mark.parametrize("registered", [False, True])
def test_cut_off_at_every_point(spark, scratch, registered):
    points = 0
    for point in range(1, 12):
        for action in ACTIONS:
            mart = made(spark, scratch, registered)
            with pytest.MonkeyPatch.context() as patch:
                calls = cut_at(patch, point)
                try:
                    P.compact_flat(spark, mart)
                    cut = False
                except Cut:
                    cut = True
            if not cut:
                assert point > len(calls) and ids(spark, mart) == [*range(N)]
                break
            if action == "nothing":
                assert ids(spark, mart) == [*range(N)], (point, calls)
            expected = act(spark, mart, action)
            P.compact_flat(spark, mart)
            assert ids(spark, mart) == expected, (point, calls, action)
            assert ids(spark, mart.with_table(None).with_path(mart.located(spark).path)) == expected
            points = point
        if not cut:
            break
    assert points >= (3 if registered else 5)


@pytest.mark.parametrize("moment", ["before the check", "before the first move",
                                    "between the moves"])
def test_append_while_a_folder_is_switched(spark, scratch, monkeypatch, moment):
    """An outside append at each moment of a running compaction: refused, nothing lost."""
    mart = made(spark, scratch, False)
    append = lambda: rows(spark, [1000]).write.mode("append").parquet(mart.path)
    if moment == "before the check":
        real = P._write_copy
        monkeypatch.setattr(P, "_write_copy", lambda *a: (real(*a), append())[0])
    else:
        real_move, moves = folders.Folder.move, []

        def move(self, target):
            moves.append(target.path)
            if len(moves) == (1 if moment == "before the first move" else 2):
                append()
            return real_move(self, target)
        monkeypatch.setattr(folders.Folder, "move", move)
    with pytest.raises(RuntimeError):
        P.compact_flat(spark, mart)
    monkeypatch.undo()
    assert ids(spark, mart) == [*range(N), 1000]
    assert P.compact_flat(spark, mart)["rewritten"]
    assert ids(spark, mart) == [*range(N), 1000]
    assert glob.glob(local(mart.path) + "__*") == []


def test_another_run_settles_while_a_folder_is_switched(spark, scratch, monkeypatch):
    """A library append between the moves of a running compaction ends that switch."""
    mart = made(spark, scratch, False)
    real_move, moves = folders.Folder.move, []

    def move(self, target):
        moves.append(target.path)
        if len(moves) == 2:
            S.append_rows(spark, rows(spark, [1000]), mart)
        return real_move(self, target)
    monkeypatch.setattr(folders.Folder, "move", move)
    with pytest.raises(RuntimeError):
        P.compact_flat(spark, mart)
    monkeypatch.undo()
    P.compact_flat(spark, mart)
    assert ids(spark, mart) == [*range(N), 1000]


def test_registered_mart_is_never_missing_and_keeps_late_files(spark, scratch, monkeypatch):
    mart = made(spark, scratch, True)
    old = mart.path
    real = S.refresh_catalog
    seen = []

    def supersede(copy, root, files):
        folders.supersede(copy, root, files)
        seen.append(ids(spark, mart))  # just before the switch
        rows(spark, [1000]).write.mode("append").parquet(old)  # too late to be read
    monkeypatch.setattr(P, "supersede", supersede)
    monkeypatch.setattr(P, "refresh_catalog", lambda *a: (seen.append(1), real(*a)))
    out = P.compact_flat(spark, mart)
    assert seen[0] == [*range(N)] and out["rewritten"] and out["location"] != old
    assert not os.path.exists(local(old))
    assert ids(spark, mart) == ids(spark, mart.with_table(None).with_path(out["location"])) \
        == [*range(N), 1000]
    S.append_rows(spark, rows(spark, [2000]), mart)  # the old handle finds the new folder
    assert ids(spark, mart)[-1] == 2000
    assert TableOps(spark).count(mart.table) == N + 2
    again = P.compact_flat(spark, mart)
    assert again["location"].count("__v") == 1 and ids(spark, mart)[-1] == 2000
    assert folders.unused_versions(spark, mart) == []


def test_even_files_exact_count_and_no_second_scan(spark, scratch):
    mart = Mart(scratch("even"), SCHEMA)
    spark.createDataFrame([(i, "same") for i in range(4000)], SCHEMA).repartition(23) \
        .write.parquet(mart.path)
    size = P.partition_inventory(spark, mart, with_rows=False).first()["bytes"]
    out = P.compact_flat(spark, mart, block_bytes=size // 7, blocks_per_file=1.0)
    per_file = [r["count"] for r in mart.read(spark).groupBy("_metadata.file_path").count().collect()]
    assert len(per_file) == out["factor"] and max(per_file) < 1.5 * min(per_file)
    assert out["rows"] == sum(per_file) == 4000


def test_empty_files_are_compacted(spark, scratch):
    mart = Mart(scratch("none"), SCHEMA)
    for _ in range(3):
        spark.createDataFrame([], SCHEMA).coalesce(1).write.mode("append").parquet(mart.path)
    P.compact_flat(spark, mart)
    assert mart.read(spark).count() == 0


def test_move_refuses_an_existing_target(spark, scratch):
    a, b = (folders.Folder(spark, scratch(x)) for x in "ab")
    for f in (a, b):
        rows(spark, [1]).write.parquet(f.path)
    with pytest.raises(RuntimeError):
        a.move(b)
    assert a.exists() and not b.child(a.path.rsplit("/", 1)[-1]).exists()
