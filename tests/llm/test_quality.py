"""The quality classifier: its fit on known scores, held-out accuracy, awkward rows."""

import numpy as np
import pytest

from conftest import SF_CHECK
from tidemart.llm import quality_ranking as qr
from tidemart.llm.queries import op13_quality_ranking

DOCS = "doc_id long, text string, quality int, score double, source string"


def test_pairs_meet_everyone():
    for n_good, n_bad in ((40, 7), (7, 40), (1, 1), (5, 1)):
        good, bad = qr.pairs(n_good, n_bad)
        assert len(good) == qr.OPPONENTS * max(n_good, n_bad)
        for side, n in ((good, n_good), (bad, n_bad)):
            met = np.bincount(side, minlength=n)
            assert met.min() >= 1 and met.max() - met.min() <= qr.OPPONENTS


def test_bradley_terry_is_the_minimum_of_the_pair_loss():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0.4, 1, (300, 3)), rng.normal(0, 1, (80, 3))
    winner, loser = qr.pairs(len(good), len(bad))
    diff = good[winner] - bad[loser]

    def loss(w):
        return np.log1p(np.exp(-diff @ w)).sum() + qr.RIDGE * len(diff) * (w @ w) / 2

    w = qr.bradley_terry(good, bad)
    least = loss(w)
    for k in range(3):
        for step in (-1e-3, 1e-3):
            moved = w.copy()
            moved[k] += step
            assert loss(moved) > least
    assert (w > 0).all()


def test_bradley_terry_recovers_the_direction_of_known_scores():
    rng = np.random.default_rng(4)
    true = np.array([2.0, -1.0, 0.0, 0.5])
    x = rng.normal(size=(6000, 4))
    won = x @ true + rng.logistic(size=6000) > 0
    w = qr.bradley_terry(x[won], x[~won])
    assert w @ true / np.linalg.norm(w) / np.linalg.norm(true) > 0.99


def test_best_quantile():
    raw = np.array([3.0, 1.0, 2.0, 10.0, 11.0, 12.0])
    good = np.array([False, False, False, True, True, True])
    assert qr.best_quantile(raw, good, np.ones(6)) == (0.5, 6.5)
    noisy = np.array([False, True, False, True, True, True])  # one good row among the bad
    level, at = qr.best_quantile(raw, noisy, np.ones(6))
    assert (level, at) == (0.5, 6.5)
    assert qr.best_quantile(raw, np.ones(6, bool), np.ones(6))[0] == 0.0
    # by brute force: no cut between neighbours has fewer errors
    rng = np.random.default_rng(0)
    raw, good = rng.normal(size=200), rng.random(200) < 0.7
    raw[good] += 1
    weight = np.where(good, 2.0, 0.5)
    at = qr.best_quantile(raw, good, weight)[1]
    errors = {t: weight[(raw < t) & good].sum() + weight[(raw >= t) & ~good].sum()
              for t in [at, *np.sort(raw)]}
    assert errors[at] == pytest.approx(min(errors.values()))


def test_features_of_awkward_texts():
    for text in ("", " ", "\n\n", "a", "é", "日本", "\x00", "!!", "x" * 200_000):
        x = qr.features(text)
        assert x.shape == (qr.N_FEATURES,) and np.isfinite(x).all()


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").filter("quality is not null")
    found = op13_quality_ranking(spark, SF_CHECK)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert found.count() == spark.read.parquet(f"{SF_CHECK}/documents.parquet").count()
    rows = found.filter("held_out").join(labels, "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1]
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(r["predicted"] == 1 for r in good) >= 0.97 * len(good)
    assert sum(r["predicted"] == 0 for r in bad) >= 0.9 * len(bad)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_nulls_repeated_ids_and_missing_classes(spark):
    rows = [(None, None, 1, 0.1, "s"), (1, "", 1, 0.1, "s"), (1, None, 1, 0.1, "s"),
            (2, "Good words stand here.", 1, 0.1, "s"), (3, "BAD!! BAD!!", 1, 0.1, "s"),
            (3, "BAD!! BAD!! x", 1, 0.1, "s"), (4, "More good words.", 1, 0.1, "s")]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame(
        [(2, 1), (4, 1), (4, None), (3, 0), (3, 1), (None, 0), (77, 1)],
        "doc_id long, quality int")
    scores = qr.rank_quality(docs, qr.fit_ranker(docs, labels)).collect()
    assert len(scores) == len(rows) and all(0 <= r["score"] <= 1 for r in scores)
    by_id = {r["doc_id"]: r["score"] for r in scores}
    assert by_id[3] < 0.7 <= by_id[2]
    empty = labels.limit(0)
    assert {r["score"] for r in qr.rank_quality(docs, qr.fit_ranker(docs, empty)).collect()} == {0.5}
    only = labels.filter("quality = 1 and doc_id <> 3")
    assert {r["score"] for r in qr.rank_quality(docs, qr.fit_ranker(docs, only)).collect()} == {1.0}
    assert qr.rank_quality(docs.limit(0), qr.Ranker()).count() == 0


def test_labels_of_held_out_rows_are_not_read(spark, scratch):
    """Turning the labels of every held-out row round changes no score."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    path = scratch("turned")
    docs.write.parquet(f"{path}/documents.parquet")
    labels.withColumn("quality", qr.F.when(qr.held_out_quality(), 1 - qr.F.col("quality"))
                      .otherwise(qr.F.col("quality"))).write.parquet(f"{path}/labels.parquet")
    a = {r["doc_id"]: r["score"] for r in op13_quality_ranking(spark, SF_CHECK).collect()}
    b = {r["doc_id"]: r["score"] for r in op13_quality_ranking(spark, path).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def brute_fit(x, good):
    """The fit of one block, in plain numpy: weights, mean, spread, (level, threshold)."""
    order = sorted(range(len(x)), key=lambda i: (x[i].astype("<f8").tobytes(), good[i]))
    x, good = x[order], good[order]
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread < 1e-9] = 1.0
    z, fold, raw = (x - mean) / spread, np.zeros(len(x), dtype=int), np.zeros(len(x))
    for k in (False, True):
        fold[good == k] = np.arange((good == k).sum()) % qr.FOLDS
    for k in range(qr.FOLDS):
        rest = fold != k
        raw[~rest] = z[~rest] @ qr.bradley_terry(z[rest & good], z[rest & ~good])
    return qr.bradley_terry(z[good], z[~good]), mean, spread, qr.best_quantile(
        raw, good, np.ones(len(x)))


def made_texts(spark, n):
    """Texts whose quality shows in capitals and marks, three good ones for a bad one."""
    rng, rows = np.random.default_rng(7), []
    for i in range(n):
        words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 8)))
                 for _ in range(rng.integers(3, 12))]
        good = i % 4 > 0
        loud = rng.random(len(words)) < (0.2 if good else 0.5)
        rows.append((i, " ".join(w.upper() + "!" if s else w for w, s in zip(words, loud)),
                     int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_one_block_is_the_plain_fit(spark):
    docs = made_texts(spark, 300)
    rows = docs.collect()
    x = np.array([qr.features(r["text"]) for r in rows])
    w, mean, spread, (level, threshold) = brute_fit(x, np.array([r["quality"] > 0 for r in rows]))
    made = qr.fit_ranker(docs, docs)
    assert np.allclose(made.weights, w, atol=1e-8) and np.allclose(made.mean, mean)
    assert np.allclose(made.spread, spread)
    assert made.threshold == pytest.approx(threshold, abs=1e-8)
    assert made.quantile == pytest.approx(level)


def test_many_blocks_use_every_row(spark, monkeypatch):
    monkeypatch.setattr(qr, "BLOCK_ROWS", 40)
    docs = made_texts(spark, 300)
    rows = docs.select(qr.F.col("doc_id").alias("label_id"), qr.F.col("quality").alias("good"),
                       "text").mapInArrow(qr._feature_rows, qr._ROW)
    blocks, n = qr.block_rows(qr.numbered(rows), 225, 75)
    assert n == 8 and blocks.count() == blocks.filter("own").count() == 300
    mean, spread = qr.mean_and_spread(rows)
    sums = {k: np.zeros(1 + qr.N_FEATURES * (qr.N_FEATURES + 1)) for k in range(qr.FOLDS + 1)}
    held = {}
    for r in blocks.collect():
        held.setdefault(r["block"], []).append(r)
    fits = [np.zeros(qr.N_FEATURES) for _ in sums]
    for _ in range(qr.STEPS):
        for k in sums:
            total = 0
            for block in held.values():
                z = (np.array([np.frombuffer(r["x"]) for r in block]) - mean) / spread
                good, fold = (np.array([r[c] for r in block]) for c in ("good", "fold"))
                total = total + qr.pair_sums(z[(fold != k) & (good == 1)],
                                             z[(fold != k) & (good == 0)], fits[k])
            assert total[0] > 0
            fits[k], _ = qr.newton_step(fits[k], total)
    found = qr.fit_blocks(blocks, n, mean, spread)
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(found, fits, strict=True))
    made = qr.fit_ranker(docs, docs)
    assert np.allclose(made.weights, fits[-1], atol=1e-6)
    right = (qr.rank_quality(docs, made).join(docs.select("doc_id", "quality"), "doc_id")
             .filter("(score >= 0.7) = (quality = 1)").count())
    assert right >= 240


def test_a_rare_class_stands_in_every_block(spark, monkeypatch):
    monkeypatch.setattr(qr, "BLOCK_ROWS", 20)
    docs = made_texts(spark, 200).withColumn("quality", qr.F.expr("int(doc_id % 64 > 0)"))
    rows = docs.select(qr.F.col("doc_id").alias("label_id"), qr.F.col("quality").alias("good"),
                       "text").mapInArrow(qr._feature_rows, qr._ROW)
    blocks, n = qr.block_rows(qr.numbered(rows), 196, 4)
    assert n == 10 and blocks.filter("own").groupBy("good").count().orderBy("good").collect() \
        == [(0, 4), (1, 196)]
    assert blocks.filter("good = 0").groupBy("block").count().count() == 10
    assert blocks.filter("good = 0").groupBy("x").agg(qr.F.count_distinct("fold").alias("n")) \
        .filter("n > 1").count() == 0
    scores = qr.rank_quality(docs, qr.fit_ranker(docs, docs)).collect()
    assert len(scores) == 200 and len({r["score"] for r in scores}) > 100


def test_best_level_is_the_best_quantile(spark):
    rng = np.random.default_rng(3)
    raw, good = np.round(rng.normal(size=3000), 2), rng.random(3000) < 0.7
    raw[good] += 1
    rows = spark.createDataFrame([(float(r), int(g)) for r, g in zip(raw, good)],
                                 "raw double, good int").repartition(5)
    for weight in ((1.0, 1.0), (3.0, 0.5)):
        order = np.lexsort((good, raw))
        level, at = qr.best_quantile(raw[order], good[order],
                                     np.where(good[order], weight[1], weight[0]))
        found = qr.best_level(rows, weight)
        assert found == (pytest.approx(level), pytest.approx(at))


def test_rows_beyond_the_first_thousands_are_learnt_from(spark):
    """Good rows that shout: only labelled ids with a large hash are such rows."""
    rows = spark.range(16000).select(qr.F.col("id").alias("doc_id"),
                                     (qr.F.col("id") % 2).cast("int").alias("quality"))
    place = qr.F.row_number().over(qr.Window.partitionBy("quality").orderBy(
        qr.F.xxhash64("doc_id"), "doc_id"))
    docs = rows.withColumn("text", qr.F.when(qr.F.col("quality") == 0, "bad ### words ##")
                           .when(place <= 6144, "plain words stand here")
                           .otherwise("#1 #2 #3 SHOUTED #4 #5")).localCheckpoint()
    found = qr.rank_quality(docs, qr.fit_ranker(docs, docs)).join(docs, "doc_id")
    assert found.filter("(score >= 0.7) <> (quality = 1)").count() == 0
