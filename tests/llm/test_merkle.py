"""The Merkle manifest against brute force."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from tidemart.llm import merkle_manifest as mm  # noqa: E402
from tidemart.llm.queries import op11_merkle_manifest, tampered_leaf  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la, s, n, "x") for i, s, la, n, t in rows],
                                 SCHEMA).repartition(5)


def answers(docs):
    found = mm.verify(mm.build_manifest(docs, tampered_leaf(docs)))
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(map(repr, (tuple(r) for r in found.select(*columns).collect())))


def expected(rows):
    return sorted(map(repr, brute.merkle(rows)))


def made(sizes, seed=1):
    rng, rows, i = random.Random(seed), [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i += rng.randint(1, 3)
            text = rng.choice(["Aa b", "plain", "É ß 😀", "", None, "x" * 5000])
            rows.append((i, source, rng.choice(["en", None]), rng.choice([5, None]), text))
    rng.shuffle(rows)
    return rows


def test_position_is_the_place_of_completion():
    for n in (1, 2, 15, 16, 17, 255, 256, 257, 300, 4096, 4097, 5000):
        log = []

        def complete(level, index, n=n, log=log):
            if level:
                for c in mm.run_of(level - 1, index * mm.FAN, n):
                    complete(level - 1, c)
            log.append((level, index))

        complete(mm.height(n), 0)
        level, index = zip(*log)
        assert mm.position(level, index, n).tolist() == list(range(len(log)))


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 16}, {"a": 17, "b": 1}, {None: 20, "": 3, "é": 256, "z": 257, "a": 700},
    {f"s{k}": 1 + k % 3 for k in range(300)}])
def test_proofs_equal_brute_force(spark, sizes):
    rows = made(sizes)
    assert answers(frame(spark, rows)) == expected(rows)


def test_three_tiers_and_a_hot_source(spark):
    rows = [(i, "hot" if i % 99 else f"s{i % 7}", None, i % 3, "Aa") for i in range(68_000)]
    assert mm.BLOCK ** 2 < sum(r[1] == "hot" for r in rows)
    assert answers(frame(spark, rows)) == expected(rows)


def test_nulls_repeated_rows_and_ids(spark):
    rows = [(None, None, None, None, None)] * 3 + [(7, "s", "en", 1, "Same")] * 40
    rows += [(7, "s", "en", 1, "Other"), (None, "s", "en", 2, "T"), (9, None, "de", 0, "")]
    assert answers(frame(spark, rows)) == expected(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    manifest = mm.build_manifest(docs)
    assert manifest.root is None and mm.verify(manifest).count() == 0


def test_one_proof_is_looked_up_and_tampering_is_seen(spark):
    rows = made({"a": 300, None: 20, "b": 2})
    manifest = mm.build_manifest(frame(spark, rows))
    everything = mm.verify(manifest)
    assert everything.filter("not verified").count() == 0
    for source, index in (("a", 0), ("a", 299), (None, 17), ("b", 1)):
        leaf = manifest.leaves.filter(manifest.leaves["tree"].eqNullSafe(source)
                                      & (manifest.leaves["index"] == index)).first()
        path = mm.proof(manifest, source, index)
        assert mm.fold(leaf["digest"], path) == manifest.root
        assert mm.fold(brute.sha("forged"), path) != manifest.root
    with pytest.raises(KeyError):
        mm.proof(manifest, "a", 300)


def test_log_holds_every_place_once(spark):
    manifest = mm.build_manifest(frame(spark, made({"a": 700, "b": 16, "c": 1})))
    log = manifest.log[0]
    for tier in manifest.log[1:]:
        log = log.unionByName(tier)
    for r in log.groupBy("tree").agg({"position": "max", "n": "max", "*": "count"}).collect():
        assert r["max(position)"] + 1 == r["count(1)"]
    assert log.select("tree", "position").distinct().count() == log.count()


def test_query(spark):
    from conftest import SF_SMALL
    found = op11_merkle_manifest(spark, SF_SMALL)
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text)
            for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected(rows)
