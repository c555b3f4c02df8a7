"""Ranked lexical search against brute force."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from tidemart.llm import lexical_search as ls  # noqa: E402

DOCS = "doc_id long, text string, score long, terms string, query long, item_id long"
ITEMS = "item_id long, text string, doc_id long, rank int"


def made(n_docs=700, n_items=25, seed=2):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)] + ["É", "ß2", "日本", "The", "the"]
    weights = [1 / (k + 1) for k in range(len(vocab))]

    def prose(n):
        return rng.choice([" ", ", ", "\n", "--"]).join(rng.choices(vocab, weights, k=n))

    docs = [(i, prose(rng.randint(1, 60))) for i in range(n_docs)]
    docs += [(n_docs + i, docs[5][1]) for i in range(30)]  # ties
    docs += [(None, docs[5][1]), (3, docs[5][1]), (3, docs[5][1]), (9000, None), (9001, ""),
             (9002, "._-"), (9003, prose(20_000)), (-4, "THE the The")]
    items = [(i, prose(rng.randint(1, 25))) for i in range(n_items)]
    items += [(100, docs[5][1]), (101, None), (102, ""), (103, "unknown words"), (104, "the"),
              (1, "w3 w4 w5"), (None, "w7 w9")]
    rng.shuffle(docs)
    return docs, items


def frames(spark, docs, items, parts=6):
    return (spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in docs], DOCS).repartition(parts),
            spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS))


def found(df):
    return sorted(map(repr, (tuple(r) for r in
                             df.select("item_id", "rank", "doc_id", "score").collect())))


@pytest.mark.parametrize("k", [1, 10, 40])
def test_ranking_equals_brute_force(spark, k):
    docs, items = made()
    got = ls.rank_documents(*frames(spark, docs, items), k=k)
    assert found(got) == sorted(map(repr, brute.ranking(docs, items, k)))


def test_queries_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ls, "BLOCK_BYTES", 8000)
    docs, items = made(200, 30, seed=5)
    got = ls.rank_documents(*frames(spark, docs, items))
    assert found(got) == sorted(map(repr, brute.ranking(docs, items)))


def test_empty_tables(spark):
    docs, items = made(20, 3)
    d, q = frames(spark, docs, items)
    assert ls.rank_documents(d.limit(0), q).count() == 0
    assert ls.rank_documents(d, q.limit(0)).count() == 0
    assert ls.rank_documents(d.select("doc_id", "text"),
                             q.filter("item_id between 101 and 103")).count() == 0


def index_of(spark, docs, items, parts):
    d, q = frames(spark, docs, items, parts)
    batches = [r for r in q.select("item_id", "text").toArrow().to_batches()]
    terms = [sorted(set(ls.terms_of((t or "").encode()))) for b in batches
             for t in b.column(1).to_pylist()]
    rows = [{"query": k, "terms": t} for k, t in enumerate(terms)]
    return ls.build_index(d, ls._read_block(rows))


def test_pair_lists_hold_the_intersections_and_joint_maxima(spark):
    docs, items = made(300, 12, seed=7)
    index = index_of(spark, docs, items, 3)
    assert index.queries.pairs
    seen = 0
    for batch in index.segments.toArrow().to_batches():
        for k in range(batch.num_rows):
            x = ls._lists(batch, k)
            ends = np.cumsum(x["dfs"])
            lists = {t: dict(zip(x["docs"][e - n:e].tolist(), x["impacts"][e - n:e].tolist()))
                     for t, n, e in zip(x["terms"].tolist(), x["dfs"].tolist(), ends.tolist())}
            at = 0
            for p, n, top in zip(x["pairs"].tolist(), x["pair_dfs"].tolist(),
                                 x["pair_max"].tolist()):
                a, b = (lists[t] for t in index.queries.pairs[p])
                both = sorted(set(a) & set(b))
                assert x["pair_docs"][at:at + n].tolist() == both
                assert top == max(a[d] + b[d] for d in both)
                at, seen = at + n, seen + 1
    assert seen


def test_pair_bounds_skip_more_than_maxima_of_terms(spark):
    docs, items = made(600, 20, seed=9)
    index = index_of(spark, docs, items, 2)
    best = {}
    for r in ls.search(index, 10).collect():
        best.setdefault(r["query"], []).append(r["score"])
    with_pairs = without = 0
    for batch in index.segments.toArrow().to_batches():
        for k in range(batch.num_rows):
            segment = ls._Segment(batch, k)
            for q, (terms, pairs) in enumerate(zip(index.queries.terms, index.queries.held)):
                bar = sorted(best.get(q, [0]))[-10:][0]
                paired, alone = segment.bounds(terms, pairs)[1], segment.bounds(terms, [])[1]
                assert (paired <= alone).all()
                with_pairs += int((paired < bar).sum())
                without += int((alone < bar).sum())
                a = segment.search(terms, pairs, bar)
                b = segment.search(terms, [], 0)
                kept = b[1] >= max(bar, 1)
                assert a[0].tolist() == b[0][kept].tolist()
                assert a[1].tolist() == b[1][kept].tolist()
    assert with_pairs > without
