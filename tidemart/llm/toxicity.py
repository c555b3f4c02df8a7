"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

The lexicon is learnt from labelled documents.  Its terms are whole words and word
beginnings; a term's weight is its smoothed log odds.  Texts and terms are folded alike:
lower case, look-alike letters of other scripts to Latin, zero-width and combining marks
removed, digits and signs that stand for letters replaced.  A document's hits outside the
exception phrases are summed and normalised by its length in words; a logistic curve, fitted on
rows that the terms used for them were not learnt from, maps both figures to 0..1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.shared import arrow_schema, record_batch, saved, ship_package, text_of

#: Labelled rows that a fit reads, at most, of each class (those whose hashed ids are smallest).
MAX_TOXIC, MAX_CLEAN = 4096, 12288
#: Terms of a lexicon, at most (the strongest).
MAX_TERMS = 5000
#: Evidence (G statistic) and share of toxic documents that make a term.
MIN_EVIDENCE, MIN_PRECISION = 20.0, 0.9
#: Documents of doubt that shrink a term's weight.
DOUBT = 2.0
#: Parts of the labelled rows, each scored with terms learnt from the others.
FOLDS = 5
#: Lengths of the word beginnings that may become terms.
STEMS = (4, 5, 6)
#: Phrases whose words are harmless together.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pond scum", "sore loser", "scum line")

_LOOK_ALIKE = {
    # fixed values: letters of other scripts that look like Latin ones
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "3", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a",
    "ɡ": "g", "ʟ": "l", "ꜱ": "s", "ᴏ": "o",
}
#: Digits that stand for letters.
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}

_FOLD = {ord(k): _DIGITS.get(v, v) for k, v in _LOOK_ALIKE.items()}
_FOLD |= {ord(k): v for k, v in _DIGITS.items()}
_FOLD |= {0xFF41 + i: chr(97 + i) for i in range(26)}  # full-width a-z
_FOLD |= dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370)])
_PLAIN = bytes(ord(_DIGITS.get(chr(b), chr(b))) for b in range(128)) + bytes(range(128, 256))
_ODD = re.compile("[\xadıɑɡʟ̀-ϿЀ-ӿԀ-ԯ"
                  "ᴏ​-‍⁠ꜱ﻿ａ-ｚ]")
#: Signs used as letters, where a letter follows.
_SIGNS = re.compile(r"[@$!](?=\w)")
_SIGN = {"@": "a", "$": "s", "!": "i"}
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    text = text.lower()
    if text.isascii():
        text = text.encode().translate(_PLAIN).decode()
    elif _ODD.search(text):
        text = text.translate(_FOLD)
    else:
        for digit, letter in _DIGITS.items():
            text = text.replace(digit, letter)
    return _SIGNS.sub(lambda m: _SIGN[m[0]], text)


@dataclass
class Model:
    """Terms with weights (``*`` at the end: a word beginning) and the logistic curve."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    base: float = 0.0  # share of toxic rows among the labelled ones


def build_automaton(model: Model):
    found: dict[str, dict[str, float]] = {}
    for term, weight in model.terms.items():
        kind = "stem" if term.endswith("*") else "word"
        found.setdefault(term.rstrip("*"), {})[kind] = weight
    for phrase in model.exceptions:
        found.setdefault(fold(phrase), {})["exception"] = 0.0
    if not found:
        return None
    automaton = ahocorasick.Automaton()
    for text, kinds in found.items():
        automaton.add_word(text, (len(text), kinds))
    automaton.make_automaton()
    return automaton


def hits(text: str, automaton) -> list[tuple[int, float]]:
    """(place in the folded text, weight) of each matched word, exceptions taken out."""
    if automaton is None:
        return []
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for last, (n, kinds) in automaton.iter(text):
        first, after = last - n + 1, text[last + 1:last + 2]
        if first and text[first - 1].isalpha():
            continue
        whole = not after.isalpha()
        if "exception" in kinds and whole:
            spared.append((first, last))
        weight = max(kinds.get("stem", 0.0), kinds.get("word", 0.0) if whole else 0.0)
        if weight > 0:
            best[first] = max(best.get(first, 0.0), weight)
    return [(at, w) for at, w in best.items()
            if not any(a <= at <= b for a, b in spared)]


def features(text: str, automaton) -> tuple[float, float]:
    """Logarithms of the summed weight, and of that sum for each 100 words."""
    folded = fold(text)
    total = sum(w for _, w in hits(folded, automaton))
    if not total:
        return 0.0, 0.0
    words = folded.count(" ") + folded.count("\n") + 1
    return float(np.log1p(total)), float(np.log1p(100.0 * total / (words + 10.0)))


def score(x: tuple[float, float], model: Model) -> float:
    a, b, c = model.curve
    z = a + b * x[0] + c * x[1]
    return 1.0 / (1.0 + float(np.exp(-min(max(z, -40.0), 40.0))))


_TERMS = "term string, fold int, toxic int"


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_TERMS)
    for batch in batches:
        for text, fold_, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = set(_WORD.findall(fold(text)))
            terms = words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}
            yield record_batch(schema, len(terms), term=sorted(terms), fold=fold_, toxic=toxic)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the smallest hash of three consecutive words: near copies mostly share it."""
    for batch in batches:
        marks = []
        for text in batch.column("text").to_pylist():
            w = _WORD.findall(fold(text)) or [""]
            marks.append(min(xxhash.xxh3_64_intdigest(" ".join(w[i:i + 3])) >> 1
                             for i in range(max(1, len(w) - 2))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.int64())],
                                         names=[*batch.schema.names, "mark"])


def _evidence(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """G statistic of a term's count in toxic and clean documents."""
    n, total = pos + neg, n_pos + n_neg

    def part(x, expected):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    return 2 * (part(pos, n * n_pos / total) + part(neg, n * n_neg / total)
                + part(n_pos - pos, (total - n) * n_pos / total)
                + part(n_neg - neg, (total - n) * n_neg / total))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model of the labelled rows: ``labels`` has doc_id and toxic (null: unlabelled; an
    id labelled twice is toxic if either row says so).  The fit reads at most MAX_TOXIC
    toxic and MAX_CLEAN clean rows, one of each group of near copies.  Without both
    classes the model scores every text with 0.5 or its share of toxic rows."""
    spark = docs.sparkSession
    ship_package(spark)
    known = (labels.filter("toxic is not null and doc_id is not null")
             .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0))
                                    .alias("toxic"))
             .select(F.col("doc_id").cast("long").alias("label_id"), "toxic"))
    order = [F.xxhash64("label_id"), F.col("label_id")]
    bounded = [known.filter(f"toxic = {k}").orderBy(*order).limit(n)
               for k, n in ((1, MAX_TOXIC), (0, MAX_CLEAN))]
    chosen = saved(bounded[0].unionByName(bounded[1]), "labelled")
    texts = (docs.select(F.col("doc_id").cast("long"), text_of(docs).alias("text"))
             .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
             .select("text", "toxic"))
    texts = texts.mapInArrow(_sketch, "text string, toxic int, mark long")
    sample = saved(texts.groupBy("mark", "toxic").agg(F.min("text").alias("text")).select(
        "text", (F.col("mark") % FOLDS).cast("int").alias("fold"), "toxic"), "training")
    sizes = np.zeros((FOLDS, 2))
    for r in sample.groupBy("fold", "toxic").count().collect():
        sizes[r.fold, r.toxic] = r["count"]
    n_neg, n_pos = sizes.sum(axis=0)
    if not n_pos or not n_neg:
        return Model(base=0.5 if not n_pos and not n_neg else float(n_pos > 0))
    spread = sample.repartition(max(1, spark.sparkContext.defaultParallelism))
    by_fold = [F.count(F.when((F.col("fold") == k) & (F.col("toxic") == y), 1)).alias(f"f{k}_{y}")
               for k in range(FOLDS) for y in (0, 1)]
    counts = (spread.mapInArrow(_terms, _TERMS).groupBy("term")
              .agg(F.sum("toxic").alias("pos"), F.count(F.lit(1)).alias("n"), *by_fold)
              .filter(f"pos >= 3 and pos >= n * {MIN_PRECISION}")
              .orderBy(F.desc("pos"), "n", "term").limit(20 * MAX_TERMS).toPandas())
    terms = counts["term"].to_numpy()
    cells = counts[[f"f{k}_{y}" for k in range(FOLDS) for y in (0, 1)]].to_numpy(float)
    cells = cells.reshape(len(terms), FOLDS, 2)
    held = spark.sparkContext.broadcast(
        [_lexicon(terms, cells.sum(axis=1) - cells[:, k], sizes.sum(axis=0) - sizes[k])
         for k in range(FOLDS)])
    rows = np.array([(r.x, r.y, r.toxic) for r in spread.mapInArrow(
        _features(held), "x double, y double, toxic int").collect()], dtype=float)
    return Model(_lexicon(terms, cells.sum(axis=1), sizes.sum(axis=0)),
                 curve=_logistic(rows[:, :2], rows[:, 2]), base=n_pos / (n_pos + n_neg))


def _lexicon(terms: np.ndarray, cells: np.ndarray, sizes: np.ndarray) -> dict[str, float]:
    """Terms with enough evidence; columns of ``cells`` and ``sizes``: clean, toxic."""
    (neg, pos), (n_neg, n_pos) = cells.T, sizes
    if not len(terms) or not n_pos or not n_neg:
        return {}
    prior = n_pos / n_neg
    weight = np.log((pos + DOUBT * prior) / (neg + DOUBT)) - np.log(prior)
    evidence = _evidence(pos, neg, n_pos, n_neg)
    good = np.flatnonzero((evidence >= MIN_EVIDENCE) & (pos >= MIN_PRECISION * (pos + neg)))
    best = good[np.argsort(-evidence[good], kind="stable")][:MAX_TERMS]
    return {str(terms[i]): float(weight[i]) for i in best}


def _features(lexicons):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [build_automaton(Model(terms)) for terms in lexicons.value]
        schema = arrow_schema("x double, y double, toxic int")
        for batch in batches:
            found = [features(t, made[k]) for t, k in
                     zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield record_batch(schema, batch.num_rows, x=[f[0] for f in found],
                               y=[f[1] for f in found], toxic=batch.column(2))
    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Newton steps of a ridge logistic regression on two features."""
    design = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    penalty = np.diag([1e-6, ridge, ridge])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + penalty @ w
        hess = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + penalty
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1]), float(w[2])


def _score(model):
    made = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("doc_id long, score double, n_hits int")
        if not made:
            made.append(build_automaton(model.value))
        for batch in batches:
            scores, counts = [], []
            for text in batch.column(1).to_pylist():
                x = features(text, made[0])
                scores.append(score(x, model.value) if any(model.value.curve)
                              else model.value.base)
                counts.append(len(hits(fold(text), made[0])) if x[0] else 0)
            yield record_batch(schema, batch.num_rows, doc_id=batch.column(0), score=scores,
                               n_hits=counts)
    return run


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), n_hits for each row of ``docs`` (doc_id, text).  Null and
    empty texts have no hits and get the score of a text without hits."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    return (docs.select(F.col("doc_id").cast("long"), text_of(docs).alias("text"))
            .mapInArrow(_score(held), "doc_id long, score double, n_hits int"))


def held_out(doc_id: str = "doc_id"):
    """Every fifth document by the checksum of its id: never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
