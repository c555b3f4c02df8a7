"""Quality classifier: Bradley-Terry ranking learnt from preference pairs.

A labelled good document is preferred to a labelled bad one.  The chance that a document wins
against another is the logistic function of the difference of their scores, and a score is a
weighted sum of features of the whole text: how bytes of different kinds (letters, capitals,
digits, marks, symbols, blanks) follow each other, and how words repeat, shout, or end in
marks.  The weights are fitted by logistic loss on the features' differences over the pairs.
Every labelled row takes part: rows are dealt into blocks, the tasks form the pairs of their
blocks, and the sums that a step of the fit needs are added up over all blocks.

Raw scores only rank.  The threshold is a quantile of the raw scores that the labelled rows get
from fits without them: the level at which it parts good from bad rows best, both weighted as
they occur among all labelled rows.  A raw score at that quantile is mapped to THRESHOLD.

Null and empty texts have no bytes and no words and get the score of such a text.  An id
labelled twice is good only if every label says so.  Without both classes every text gets the
same score: 0.5 without labels, else the share of good rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.shared import (
    arrow_schema, discard, if_small, record_batch, saved, ship_package, text_of,
)

#: Labelled rows of a block, about; the pairs of a block are formed in one task.
BLOCK_ROWS = 8192
#: Rows of each class in a block, at least (if there are as many).
FEW = 8
#: Labels are broadcast up to this many bytes.
BROADCAST_BYTES = 32 << 20
#: Opponents that each row of the larger class of a block meets.
OPPONENTS = 2
#: Newton's steps of a fit, at most.
STEPS = 25
#: Parts of the labelled rows, each scored by a fit on the others.
FOLDS = 4
#: Weight of the squared weights in the loss, for each pair.
RIDGE = 1e-3
#: Score of a document at the chosen quantile.
THRESHOLD = 0.7

# fixed values: kinds of bytes
_KINDS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t",
          b"\n\r", b".", b",", b";:!?'\"()-", b"#$%&*+/<=>@[\\]^_`{|}~")
_N = len(_KINDS) + 3
_KIND = np.full(256, _N - 1, dtype=np.int64)  # control bytes
_KIND[0x80:0xC0], _KIND[0xC0:] = _N - 3, _N - 2  # rest and start of longer characters
for _k, _bytes in enumerate(_KINDS):
    _KIND[list(_bytes)] = _k
_LETTERS, _CAPITALS, _DIGITS = 0, 1, 2
N_FEATURES = _N * _N + 9


def features(text: str) -> np.ndarray:
    """Features of one whole text; shares, so that length does not matter, and its logarithm."""
    data = _KIND[np.frombuffer(text.encode(), dtype=np.uint8)]
    follow = np.bincount(data[:-1] * _N + data[1:], minlength=_N * _N) if len(data) else (
        np.zeros(_N * _N))
    kinds = np.bincount(data, minlength=_N)
    words = text.split()
    n = max(len(words), 1)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    marked = sum(1 for w in words if len(w) > 2 and not w[-1].isalnum() and not w[-2].isalnum())
    shouted = sum(1 for w in words if len(w) > 1 and w.isupper())
    same = sum(a == b for a, b in zip(words, words[1:]))
    letters = kinds[_LETTERS] + kinds[_CAPITALS]
    extra = (math.log1p(len(words)), len(counts) / math.sqrt(n), len(counts) / n,
             max(counts.values(), default=0) / n, marked / n, shouted / n, same / n,
             1 - len(set(lines)) / max(len(lines), 1), kinds[_CAPITALS] / max(letters, 1))
    return np.concatenate([np.sqrt(follow / max(len(data) - 1, 1)), extra])


@dataclass
class Ranker:
    """Raw score ``(features - mean) / spread @ weights`` and the raw score at the quantile;
    without weights every text gets ``base``."""
    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    threshold: float = 0.0
    quantile: float = 0.0
    base: float = 0.5

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.spread @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.base)
        margin = self.raw(x) - self.threshold + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def pairs(n_good: int, n_bad: int) -> tuple[np.ndarray, np.ndarray]:
    """Preference pairs (good, bad): every row of the larger class meets OPPONENTS of the
    other, all rows of which are met about equally often."""
    larger, smaller = max(n_good, n_bad), min(n_good, n_bad)
    own = np.tile(np.arange(larger), OPPONENTS)
    rival = (own + np.repeat(np.arange(OPPONENTS), larger) * (larger // 2 + 1)) % smaller
    return (own, rival) if n_good >= n_bad else (rival, own)


def pair_sums(good: np.ndarray, bad: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number of the pairs, gradient and Hessian of their logistic loss at ``w``, in one row;
    sums of blocks add up."""
    if not len(good) or not len(bad):
        return np.zeros(1 + len(w) + len(w) ** 2)
    winner, loser = pairs(len(good), len(bad))
    diff = good[winner] - bad[loser]
    lost = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
    hess = (diff * (lost * (1 - lost))[:, None]).T @ diff
    return np.concatenate([[len(diff)], -(diff.T @ lost), hess.ravel()])


def newton_step(w: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, bool]:
    """Weights after one step with the sums of all pairs, and whether it was the last."""
    n = len(w)
    penalty = RIDGE * sums[0]
    step = np.linalg.solve(sums[1 + n:].reshape(n, n) + penalty * np.eye(n),
                           penalty * w + sums[1:1 + n])
    return w - step, bool(np.abs(step).max() < 1e-6)


def bradley_terry(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Weights of the least logistic loss on the differences of the pairs (Newton's steps)."""
    w, done = np.zeros(good.shape[1]), False
    for _ in range(STEPS):
        w, done = newton_step(w, pair_sums(good, bad, w))
        if done:
            break
    return w


def best_cut(raw: np.ndarray, good: np.ndarray, weight: np.ndarray, kept_bad: float = 0.0,
             before: float = 0.0, below: float | None = None, above: float | None = None
             ) -> tuple[float, float, float]:
    """(errors, weight below, raw score) of the cut with the least weight of errors in a run of
    rows sorted by raw score; of equal cuts the lowest.  ``kept_bad`` and ``before`` are the
    errors and the weight of the rows before the run, ``below`` and ``above`` the raw scores
    next to it.  Errors are counted from those of a cut below all rows."""
    errors = kept_bad + np.concatenate([[0.0], np.cumsum(np.where(good, weight, -weight))])
    cut = int(np.argmin(np.round(errors, 12)))
    below = raw[cut - 1] if cut else raw[0] - 1 if below is None else below
    above = raw[cut] if cut < len(raw) else raw[-1] + 1 if above is None else above
    return float(errors[cut]), before + float(weight[:cut].sum()), float((below + above) / 2)


def best_quantile(raw: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(level, raw score) that parts good from bad rows with the least weight of errors: the
    middle of the gap between the two raw scores next to it; of equal levels the lowest."""
    order = np.argsort(raw, kind="stable")
    _, before, threshold = best_cut(raw[order], good[order], weight[order])
    return float(before / weight.sum()), threshold


_ROW = "label_id long, good int, x binary"


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_ROW)
    for batch in batches:
        rows = [features(t).astype("<f8").tobytes() for t in batch.column(2).to_pylist()]
        yield record_batch(schema, batch.num_rows, label_id=batch.column(0),
                           good=batch.column(1), x=rows)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, N_FEATURES)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number, mean and summed squared deviations of the rows of a task."""
    total = None
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column(0))
            total = merge_moments(total, (len(x), x.mean(axis=0), x.var(axis=0) * len(x)))
    if total:
        yield record_batch(arrow_schema("n long, mean binary, m2 binary"), 1, n=total[0],
                           mean=total[1].tobytes(), m2=total[2].tobytes())


def merge_moments(a, b):
    if a is None:
        return b
    n, delta = a[0] + b[0], b[1] - a[1]
    return (n, a[1] + delta * (b[0] / n), a[2] + b[2] + delta ** 2 * (a[0] * b[0] / n))


def mean_and_spread(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each feature; one small row of each task comes to the driver."""
    total = None
    for r in rows.select("x").mapInArrow(_moments, "n long, mean binary, m2 binary").collect():
        total = merge_moments(total, (r["n"], np.frombuffer(r["mean"]), np.frombuffer(r["m2"])))
    spread = np.sqrt(total[2] / total[0])
    spread[spread < 1e-9] = 1.0
    return total[1], spread


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (label_id, good, x) with ``idx``, the place within its class by the features."""
    ordered = saved(rows.orderBy("good", "x", "label_id")
                    .withColumn("pos", F.monotonically_increasing_id())
                    .withColumn("part", F.shiftright("pos", 33)), "quality-order")
    parts = ordered.groupBy("good", "part").agg(F.count(F.lit(1)).alias("n"),
                                                F.min("pos").alias("low"))
    # one row for each class and part: the window over them stays small
    before = (Window.partitionBy("good").orderBy("part")
              .rowsBetween(Window.unboundedPreceding, -1))
    shifts = parts.select("good", "part", (F.coalesce(F.sum("n").over(before), F.lit(0))
                                           - F.col("low")).alias("shift"))
    return (ordered.join(F.broadcast(shifts), ["good", "part"])
            .select("label_id", "good", (F.col("pos") + F.col("shift")).alias("idx"), "x"))


def block_rows(rows: DataFrame, n_good: int, n_bad: int) -> tuple[DataFrame, int]:
    """(saved rows, number of blocks): the numbered ``rows`` dealt in turn into blocks of about
    BLOCK_ROWS.  Each row is in a block; rows of a class with fewer than FEW for each block are
    in several blocks (``own``: the first of them).  A row has one fold wherever it is.  A
    block is one file in one row group, sorted, so that one task reads it whole."""
    m = max(1, math.ceil((n_good + n_bad) / BLOCK_ROWS))
    idx = F.col("idx")

    def places(n: int):
        if m == 1 or n >= m * FEW:
            return F.array((idx % m).cast("int"))
        seats = F.sequence(idx, F.lit(m * FEW - 1).cast("long"), F.lit(n).cast("long"))
        return F.array_distinct(F.transform(seats, lambda p: F.floor(p / FEW).cast("int")))

    blocks = F.when(F.col("good") == 1, places(n_good)).otherwise(places(n_bad))
    return saved(
        rows.select("good", "idx", "x", F.posexplode(blocks).alias("again", "block"))
        .repartitionById(m, "block").sortWithinPartitions("block", "good", "idx")
        .select("block", "good", (idx % FOLDS).cast("int").alias("fold"),
                (F.col("again") == 0).alias("own"), "x"), "quality-blocks"), m


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        ids = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if held and ids[a] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = ids[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


_SUMS = "fit int, blocks long, sums binary"


def _task_sums(weights: dict[int, np.ndarray], mean: np.ndarray, spread: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, blocks = {}, 0
        for block in _whole_blocks(batches):
            blocks += 1
            good, fold = (block.column(c).to_numpy() for c in ("good", "fold"))
            z = (_matrix(block.column("x")) - mean) / spread
            for k, w in weights.items():
                rest = fold != k
                found = pair_sums(z[rest & (good == 1)], z[rest & (good == 0)], w)
                sums[k] = sums[k] + found if k in sums else found
        if sums:
            yield record_batch(arrow_schema(_SUMS), len(sums), fit=list(sums),
                               blocks=blocks, sums=[s.tobytes() for s in sums.values()])
    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of a fit: the tasks' sums, a batch of them in memory at a time."""
    fit, blocks, total = None, 0, 0
    for batch in batches:
        for row in batch.to_pylist():
            fit, blocks = row["fit"], blocks + row["blocks"]
            total = total + np.frombuffer(row["sums"])
    yield record_batch(arrow_schema(_SUMS), 1, fit=fit, blocks=blocks, sums=[total.tobytes()])


def fit_blocks(blocks: DataFrame, n_blocks: int, mean: np.ndarray, spread: np.ndarray
               ) -> list[np.ndarray | None]:
    """Weights of the fits without fold 0, 1, ... and of the fit on all rows (None: no pair).
    Each of Newton's steps is one pass over all blocks, for all fits together; the driver gets
    one row for each fit."""
    fits: list[np.ndarray | None] = [np.zeros(N_FEATURES) for _ in range(FOLDS + 1)]
    going = set(range(FOLDS + 1))
    for _ in range(STEPS):
        tasks = blocks.mapInArrow(_task_sums({k: fits[k] for k in going}, mean, spread), _SUMS)
        found = tasks.groupBy("fit").applyInArrow(_add, _SUMS).collect()
        if any(r["blocks"] != n_blocks for r in found):
            raise RuntimeError(f"a block of {n_blocks} was not read whole by one task")
        sums = {r["fit"]: np.frombuffer(r["sums"]) for r in found}
        for k in sorted(going):
            if not sums[k][0]:
                fits[k], done = None, True
            else:
                fits[k], done = newton_step(fits[k], sums[k])
            if done:
                going.discard(k)
        if not going:
            break
    return fits


def _raw_scores(fits: list[np.ndarray | None], mean: np.ndarray, spread: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("raw double, good int")
        for batch in batches:
            z = (_matrix(batch.column(2)) - mean) / spread
            fold, raw = batch.column(1).to_numpy(), np.zeros(batch.num_rows)
            for k in range(FOLDS):
                if fits[k] is not None:
                    raw[fold == k] = z[fold == k] @ fits[k]
            yield record_batch(schema, batch.num_rows, raw=raw, good=batch.column(0))
    return run


def _part_cuts(parts: list, weight: tuple[float, float]):
    """``parts``: part, goods, bads, low, high in the order of the raw scores."""
    before, at = {}, np.zeros(2)
    for i, p in enumerate(parts):
        before[p["part"]] = (at.copy(), parts[i - 1]["high"] if i else None,
                             parts[i + 1]["low"] if i + 1 < len(parts) else None)
        at += (p["bads"], p["goods"])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        n, low, high = before[table.column("part")[0].as_py()]
        bad_before, good_before = n * weight
        good = table.column("good").to_numpy() == 1
        cut = best_cut(table.column("raw").to_numpy(), good,
                       table.column("n").to_numpy() * np.where(good, weight[1], weight[0]),
                       good_before - bad_before, good_before + bad_before, low, high)
        batch = record_batch(arrow_schema(_CUT), 1, errors=cut[0], below=cut[1], at=cut[2])
        return pa.Table.from_batches([batch])
    return run


_CUT = "errors double, below double, at double"


def best_level(scored: DataFrame, weight: tuple[float, float]) -> tuple[float, float]:
    """:func:`best_quantile` of all rows of ``scored`` (raw, good), whose classes (bad, good)
    weigh ``weight`` a row: equal rows are counted, sorted over the cluster, and each part
    finds its best cut."""
    ordered = saved(scored.groupBy("raw", "good").agg(F.count(F.lit(1)).alias("n"))
                    .orderBy("raw", "good").withColumn("pos", F.monotonically_increasing_id())
                    .withColumn("part", F.shiftright("pos", 33)), "quality-raw")
    parts = (ordered.groupBy("part")
             .agg(F.sum(F.col("n") * F.col("good")).alias("goods"),
                  F.sum(F.col("n") * (1 - F.col("good"))).alias("bads"),
                  F.min("raw").alias("low"), F.max("raw").alias("high"))
             .orderBy("part").collect())  # one row for each part
    cuts = ordered.groupBy("part").applyInArrow(_part_cuts(parts, np.array(weight)), _CUT)
    best = min(cuts.collect(), key=lambda r: (round(r["errors"], 12), r["below"]))
    total = sum(p["bads"] * weight[0] + p["goods"] * weight[1] for p in parts)
    return best["below"] / total, best["at"]


def fit_ranker(docs: DataFrame, labels: DataFrame) -> Ranker:
    """Ranker of all labelled rows: ``labels`` has doc_id and quality (null: unlabelled).  The
    features of every labelled row are computed, dealt into blocks and read in each step of
    the fits; only sums come to the driver."""
    ship_package(docs.sparkSession)
    known = saved(labels.filter("quality is not null and doc_id is not null")
                  .groupBy("doc_id").agg(F.min(F.when(F.col("quality") > 0, 1).otherwise(0))
                                         .alias("good"))
                  .select(F.col("doc_id").cast("long").alias("label_id"), "good"),
                  "quality-labels")
    totals = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    rows = saved(docs.select(F.col("doc_id").cast("long"), text_of(docs).alias("text"))
                 .join(if_small(known, F.lit(12), BROADCAST_BYTES),
                       F.col("doc_id") == F.col("label_id"))
                 .groupBy("label_id", "good").agg(F.min("text").alias("text"))
                 .mapInArrow(_feature_rows, _ROW), "quality-rows")
    found = {r["good"]: r["count"] for r in rows.groupBy("good").count().collect()}
    n_good, n_bad = found.get(1, 0), found.get(0, 0)
    all_good, all_bad = totals.get(1, 0), totals.get(0, 0)
    if not n_good or not n_bad:
        return Ranker(base=all_good / (all_good + all_bad) if totals else 0.5)
    mean, spread = mean_and_spread(rows)
    blocks, n_blocks = block_rows(numbered(rows), n_good, n_bad)
    discard(rows)
    fits = fit_blocks(blocks, n_blocks, mean, spread)
    raw = blocks.filter("own").select("good", "fold", "x").mapInArrow(
        _raw_scores(fits, mean, spread), "raw double, good int")
    level, threshold = best_level(raw, (all_bad / n_bad, all_good / n_good))
    discard(blocks)
    return Ranker(fits[FOLDS], mean, spread, threshold, level, all_good / (all_good + all_bad))


def _scores(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("doc_id long, score double")
        for batch in batches:
            x = np.array([features(t) for t in batch.column(1).to_pylist()])
            yield record_batch(schema, batch.num_rows, doc_id=batch.column(0),
                               score=held.value.score(x.reshape(-1, N_FEATURES)))
    return run


def rank_quality(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """doc_id, score (0 to 1) of each row of ``docs`` (doc_id, text)."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(ranker)
    return (docs.select(F.col("doc_id").cast("long"), text_of(docs).alias("text"))
            .mapInArrow(_scores(held), "doc_id long, score double"))


def held_out_quality(doc_id: str = "doc_id"):
    """A quarter of the documents by the checksum of their ids: never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
