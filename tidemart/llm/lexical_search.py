"""Ranked lexical search: MaxScore with bounds of term pairs.

The index holds every document of the corpus in segments.  A segment has, for each term of
the queries, the documents that hold it with their impacts (parts of a score) and the largest
impact; and, for the pairs of terms that the queries name (rare terms are paired with each
other), the intersection list of the two terms with the largest joint impact.

A document holds a, b or both, so no document gets more from the two than the largest of a's
maximum, b's maximum and their joint maximum.  A query takes its terms by their maxima,
smallest first, joins each with the free term before it with which it saves most, and adds up
these bounds: the first terms whose joint bound stays under the score of the k-th best document
so far need not bring candidates, a segment whose whole bound stays under it is skipped, and a
candidate is dropped as soon as its score and the bound of the terms that are left stay under
it.  A document that could only tie is kept, so results are
exact, ties included.

Terms are runs of digits, letters and all characters beyond ASCII, with A-Z in lower case.
A null text has no terms.  A null doc_id comes last among equal scores; rows that repeat an
id are documents of their own.  Each row of the queries is a query; without terms it finds
nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm.shared import arrow_schema, record_batch, saved, ship_package

#: A segment is closed at this many postings or documents.
SEGMENT_POSTINGS, SEGMENT_DOCS = 250_000, 4096
#: Words that are looked up at once.
LOOKUP_WORDS = 400_000
#: Bytes of query terms that are held by every task at once; more queries go in blocks.
BLOCK_BYTES = 4 << 20
#: Rank of the impact whose size seeds the thresholds of searches for that many or fewer.
SEED_RANK = 10

#: All bytes that are no part of a term become a space, A-Z become a-z.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else
                    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_LAST = np.iinfo(np.int64).max

_POSTINGS = ("doc_ids array<long>, lengths array<int>, terms array<int>, dfs array<int>, "
             "docs array<int>, tfs array<int>")
_INDEX = ("doc_ids array<long>, terms array<int>, dfs array<int>, docs array<int>, "
          "impacts array<long>, term_max array<long>, term_seed array<long>, pairs array<int>, "
          "pair_dfs array<int>, pair_docs array<int>, pair_max array<long>, "
          "pair_seed array<long>")
_FOUND = "query long, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


# queries -------------------------------------------------------------------------------
def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("query long, terms array<binary>, size long")
    for batch in batches:
        terms = [sorted(set(terms_of(t or b""))) for t in
                 batch.column(1).cast(pa.binary()).to_pylist()]
        yield record_batch(schema, batch.num_rows, query=batch.column(0), terms=terms,
                           size=[sum(map(len, t)) + 64 * len(t) for t in terms])


@dataclass
class Queries:
    """A block of queries: the number of each, its terms (places in ``vocabulary``) and the
    pairs (places in ``pairs``) whose terms it holds."""
    numbers: list[int]
    vocabulary: list[bytes]
    terms: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    held: list[list[tuple[int, int, int]]] = field(default_factory=list)

    def choose_pairs(self, df: dict[int, int]) -> None:
        """Pairs neighbours in the order of document frequency of each query's terms: rare
        terms seldom meet, so their joint bound is far below the sum of their maxima."""
        place: dict[tuple[int, int], int] = {}
        for terms in self.terms:
            ordered = sorted((t for t in terms.tolist() if df.get(t)), key=lambda t: (df[t], t))
            for a, b in zip(ordered[::2], ordered[1::2]):
                place.setdefault((min(a, b), max(a, b)), len(place))
        self.pairs = list(place)
        partners: dict[int, list[tuple[int, int]]] = {}
        for (a, b), k in place.items():
            partners.setdefault(a, []).append((b, k))
        self.held = []
        for terms in self.terms:
            own = set(terms.tolist())
            self.held.append([(a, b, k) for a in sorted(own) for b, k in partners.get(a, ())
                              if b in own])


def _read_block(rows: list) -> Queries:
    vocabulary = sorted({bytes(t) for r in rows for t in r["terms"]})
    place = {t: k for k, t in enumerate(vocabulary)}
    return Queries([r["query"] for r in rows], vocabulary,
                   [np.array([place[bytes(t)] for t in r["terms"]], dtype=np.int64) for r in rows])


# the index -----------------------------------------------------------------------------
def _postings(held):
    """Segments of (doc_id, text): postings of the queries' terms, by term and document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: k for k, t in enumerate(held.value.vocabulary)}
        ids, lengths, found, words, owners = [], [], [], [], []

        def look_up():
            if words:
                term = np.fromiter((place.get(w, -1) for w in words), np.int64, len(words))
                owner = np.repeat(np.array([o for o, _ in owners]), [n for _, n in owners])
                key = (term << 32 | owner)[term >= 0]
                found.append(np.unique(key, return_counts=True))
                words.clear()
                owners.clear()

        def closed():
            key = np.concatenate([k for k, _ in found] or [np.zeros(0, np.int64)])
            tf = np.concatenate([c for _, c in found] or [np.zeros(0, np.int64)])
            order = np.argsort(key, kind="stable")
            key, tf = key[order], tf[order]
            terms, dfs = np.unique(key >> 32, return_counts=True)
            batch = record_batch(
                arrow_schema(_POSTINGS), 1, doc_ids=[list(ids)], lengths=[list(lengths)],
                terms=[terms], dfs=[dfs], docs=[key & 0xFFFFFFFF], tfs=[tf])
            ids.clear(), lengths.clear(), found.clear()
            return batch

        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                own = terms_of(text or b"")
                owners.append((len(ids), len(own)))
                words += own
                ids.append(doc_id)
                lengths.append(len(own))
                if len(words) >= LOOKUP_WORDS:
                    look_up()
                if (len(ids) >= SEGMENT_DOCS
                        or sum(len(k) for k, _ in found) >= SEGMENT_POSTINGS):
                    look_up()
                    yield closed()
        look_up()
        if ids:
            yield closed()
    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _lists(batch: pa.RecordBatch, k: int) -> dict[str, np.ndarray]:
    return {name: batch.column(i)[k].values.to_numpy(zero_copy_only=False)
            for i, name in enumerate(batch.schema.names) if name != "doc_ids"}


def _kth(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 0


def _impacts(held, weights, n_docs: int, n_terms: int):
    """The postings with impacts, maxima and the lists of the pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, pairs, w = arrow_schema(_INDEX), held.value.pairs, weights.value
        for batch in batches:
            for k in range(batch.num_rows):
                x = _lists(batch, k)
                m = 10 + 90 * x["lengths"].astype(np.int64) * n_docs // max(n_terms, 1)
                tf, docs, terms = x["tfs"].astype(np.int64), x["docs"], x["terms"]
                parts = 10 ** 9 * tf // (1000 * tf + 8 * m[docs])
                impacts = np.repeat(w[terms], x["dfs"]) * parts
                ends = np.cumsum(x["dfs"])
                lists = {t: slice(e - n, e) for t, n, e in
                         zip(terms.tolist(), x["dfs"].tolist(), ends.tolist())}
                tops = {t: (int(impacts[s].max()), _kth(impacts[s], SEED_RANK))
                        for t, s in lists.items()}
                met = []
                for p, (a, b) in enumerate(pairs):
                    if a in lists and b in lists:
                        a, b = lists[a], lists[b]
                        if a.stop - a.start > b.stop - b.start:
                            a, b = b, a
                        at = np.searchsorted(docs[b], docs[a])
                        both = np.flatnonzero(docs[b][np.minimum(at, b.stop - b.start - 1)]
                                              == docs[a])
                        if len(both):
                            joint = impacts[a][both] + impacts[b][at[both]]
                            met.append((p, docs[a][both], int(joint.max()),
                                        _kth(joint, SEED_RANK)))
                yield record_batch(
                    schema, 1, doc_ids=batch.column(0).slice(k, 1), terms=[terms],
                    dfs=[x["dfs"]], docs=[docs], impacts=[impacts],
                    term_max=[[tops[t][0] for t in lists]], term_seed=[[tops[t][1] for t in lists]],
                    pairs=[[p for p, *_ in met]], pair_dfs=[[len(d) for _, d, *_ in met]],
                    pair_docs=[np.concatenate([d for _, d, *_ in met] or [docs[:0]])],
                    pair_max=[[j for *_, j, _ in met]], pair_seed=[[s for *_, s in met]])
    return run


@dataclass
class Index:
    """``segments``: a saved table, a row for each segment; ``queries`` and the scores that
    the k-th best document of each of them surely reaches."""
    segments: DataFrame
    queries: Queries
    seeds: list[int]


def build_index(docs: DataFrame, queries: Queries) -> Index:
    """Index of all rows of ``docs`` (doc_id, text) for a block of queries; one scan of the
    texts.  To the driver come two sums, and a count and two figures for each term or pair."""
    spark = docs.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(queries)
    postings = saved(docs.select(F.col("doc_id").cast("long"), F.col("text"))
                     .mapInArrow(_postings(held), _POSTINGS), "search-postings")
    sums = postings.select(
        F.size(F.filter("lengths", lambda n: n > 0)).alias("n"),
        F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n).alias("terms"))
    n_docs, n_terms = (int(x or 0) for x in sums.agg(F.sum("n"), F.sum("terms")).first())
    zipped = F.inline(F.arrays_zip("terms", "dfs"))
    df = {r["terms"]: r["df"] for r in postings.select(zipped).groupBy("terms")
          .agg(F.sum("dfs").alias("df")).collect()}
    weights = np.array([weight(n_docs, df[t]) if t in df else 0
                        for t in range(len(queries.vocabulary))], dtype=np.int64)
    queries.choose_pairs(df)
    held = spark.sparkContext.broadcast(queries)
    weights = spark.sparkContext.broadcast(weights)
    index = saved(postings.mapInArrow(_impacts(held, weights, n_docs, n_terms), _INDEX),
                  "search-index")
    seeds = {}
    for names in (("terms", "term_seed"), ("pairs", "pair_seed")):
        rows = index.select(F.inline(F.arrays_zip(*names))).groupBy(names[0]).agg(
            F.max(names[1]).alias("seed")).collect()
        seeds[names[0]] = {r[0]: r["seed"] for r in rows}
    least = [max([seeds["terms"].get(t, 0) for t in terms.tolist()]
                 + [seeds["pairs"].get(k, 0) for *_, k in held_pairs], default=0)
             for terms, held_pairs in zip(queries.terms, queries.held)]
    return Index(index, queries, least)


# search --------------------------------------------------------------------------------
class _Segment:
    """One row of the index and the work of a query on it."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        x = _lists(batch, k)
        ids = batch.column(0)[k].values
        self.null_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(_LAST).to_numpy(zero_copy_only=False)
        self.docs, self.impacts = x["docs"], x["impacts"]
        ends = np.cumsum(x["dfs"]).tolist()
        self.lists = {t: slice(e - n, e) for t, n, e in
                      zip(x["terms"].tolist(), x["dfs"].tolist(), ends)}
        self.top = dict(zip(x["terms"].tolist(), x["term_max"].tolist()))
        self.joint = dict(zip(x["pairs"].tolist(), x["pair_max"].tolist()))
        self.score = np.zeros(len(self.ids), dtype=np.int64)

    def bounds(self, terms: np.ndarray, pairs: list) -> tuple[list[int], np.ndarray]:
        """Terms of a query by their maxima, smallest first, and a bound on what the first 0,
        1, ... of them give one document: each term joins the free term before it with which
        it saves most."""
        own = {t: self.top[t] for t in terms.tolist() if self.top.get(t)}
        partners: dict[int, list[tuple[int, int]]] = {}
        for a, b, k in pairs:
            if a in own and b in own:
                saving = own[a] + own[b] - max(own[a], own[b], self.joint.get(k, 0))
                if saving > 0:
                    partners.setdefault(a, []).append((saving, b))
                    partners.setdefault(b, []).append((saving, a))
        ordered = sorted(own, key=lambda t: (own[t], t))
        free, below = set(), [0]
        for t in ordered:
            saving, partner = max((x for x in partners.get(t, ()) if x[1] in free),
                                  default=(0, None))
            if partner is None:
                free.add(t)
            else:
                free.remove(partner)
            below.append(below[-1] + own[t] - saving)
        return ordered, np.array(below)

    def search(self, terms: np.ndarray, pairs: list, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (places in the segment) that reach ``least``, and their scores."""
        ordered, below = self.bounds(terms, pairs)
        if below[-1] < max(least, 1):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        skipped = int(np.searchsorted(below, least, side="left")) - 1 if least else 0
        score = self.score
        for t in ordered[skipped:]:
            score[self.docs[self.lists[t]]] += self.impacts[self.lists[t]]
        found = np.flatnonzero(score)
        points = score[found]
        score[found] = 0
        for k in range(skipped, 0, -1):
            kept = points + below[k] >= least
            found, points = found[kept], points[kept]
            if not len(found):
                break
            here = self.lists[ordered[k - 1]]
            docs, impacts = self.docs[here], self.impacts[here]
            at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            points = points + np.where(docs[at] == found, impacts[at], 0)
        kept = points >= max(least, 1)
        return found[kept], points[kept]


def _search(held, seeds, k: int):
    """The k best documents of each query among a task's segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = held.value
        best = [(np.zeros(0, np.int64),) * 3 for _ in queries.numbers]  # score, id, null
        least = list(seeds.value)
        for batch in batches:
            for row in range(batch.num_rows):
                segment = _Segment(batch, row)
                for q, (terms, pairs) in enumerate(zip(queries.terms, queries.held)):
                    found, points = segment.search(terms, pairs, least[q])
                    if not len(found):
                        continue
                    if len(found) > k:
                        bar = _kth(points, k)
                        found, points = found[points >= bar], points[points >= bar]
                    score, doc, null = (np.concatenate(x) for x in zip(best[q], (
                        points, segment.ids[found], segment.null_id[found])))
                    order = np.lexsort((null, doc, -score))[:k]
                    best[q] = score[order], doc[order], null[order]
                    if len(order) == k:
                        least[q] = max(least[q], int(score[order[-1]]))
        numbers = np.repeat(np.array(queries.numbers, np.int64), [len(b[0]) for b in best])
        if len(numbers):
            score, doc, null = (np.concatenate(x) for x in zip(*best))
            yield record_batch(arrow_schema(_FOUND), len(numbers), query=numbers, score=score,
                               doc_id=pa.array(doc, mask=null.astype(bool)))
    return run


def search(index: Index, k: int) -> DataFrame:
    """query, doc_id, score: the k best documents of each query in each task's segments."""
    context = index.segments.sparkSession.sparkContext
    held = context.broadcast(index.queries)
    seeds = context.broadcast(index.seeds if k <= SEED_RANK else [0] * len(index.seeds))
    return index.segments.mapInArrow(_search(held, seeds, k), _FOUND)


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score, query of the ``k`` highest-scoring documents of each row
    of ``queries`` (item_id, text); equal scores by ascending doc_id, none of score 0.
    ``query`` tells rows that repeat an item_id apart."""
    spark = docs.sparkSession
    ship_package(spark)
    numbered = saved(queries.select("item_id", "text").withColumn(
        "query", F.monotonically_increasing_id()), "search-items")
    terms = saved(numbered.select("query", "text").mapInArrow(
        _query_terms, "query long, terms array<binary>, size long"), "search-terms")
    size = terms.agg(F.sum("size")).first()[0] or 0
    n_blocks = -(-size * 2 // BLOCK_BYTES) or 1
    found = None
    for b in range(n_blocks):
        rows = terms.filter(F.pmod(F.xxhash64("query"), F.lit(n_blocks)) == b).select(
            "query", "terms").orderBy("query").collect()
        part = saved(search(build_index(docs, _read_block(rows)), k), "search-found")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return (ranked.join(numbered.select("query", "item_id"), "query")
            .select("item_id", "rank", "doc_id", "score", "query"))
