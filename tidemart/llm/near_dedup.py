"""Near duplicates by an LSH forest over MinHash signatures.

1. One pass over the texts hashes the word shingles of each document and keeps a digest of
   its set, the signature orders of TREES trees and a bit sketch.  Documents with one and the
   same set are one class from here on.
2. Each tree sorts the classes by its own order of the signature (range partitions, so
   a crowded prefix spreads over several of them).  Neighbours with a common prefix of
   MIN_DEPTH hashes form a region; within it, sketches tell which ones may be similar.
   A region is walked in blocks, the leaders of earlier blocks going along.  Where leaders
   become too many or a region reaches the edge of its partition, they are set aside and
   meet in pairs of blocks, each pair a task's group of its own: none is dropped.  Only
   where a prefix has more than CROWD leaders the common prefix must be one hash longer,
   up to DEPTH: the depth adapts to the region.
3. The candidates' connected components are clusters.  Each document of a cluster sends its
   text once, and its full set is compared within the cluster; large clusters are
   dealt into blocks, and each pair of blocks is a group of its own.
4. The components of the confirmed links are the result.

A pair of similarity 0.8 shares a prefix of 3 hashes in a tree with probability 0.51.  20
independent trees would miss it with probability 6e-7; they draw on one signature, so the
miss is about 1e-5 (2.5e-5 for sets of 5 and 4 shingles).  The sketch loses under 1e-6 more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.components import connected_components
from tidemart.llm.shared import (
    LOWER, arrow_schema, if_small, record_batch, roots, saved, ship_package, shuffle_parts,
    text_of,
)

TREES, DEPTH, MIN_DEPTH, BINS = 20, 6, 3, 128
#: Share of sketch bits that possible neighbours have in common: at similarity 0.8 it is 0.9
#: on average, with a deviation of about 0.03, in small sets too: each bin has a bit of its own.
SKETCH_SHARE = 0.70
#: A row goes along as a leader unless it has this share with one that does.  What is similar to
#: the row (0.85 or more) has then SKETCH_SHARE with that leader, whatever bits differ.
LEADER_SHARE = 0.85
#: Rows of a region that are compared at once, and leaders that go along.
BLOCK = 1024
#: Leaders of a prefix that are compared; of more, a prefix that is one hash longer decides.
CROWD = 16 * BLOCK
#: Rows of the forest in a sorted partition, about.
PARTITION_ROWS = 500_000
#: Shingles of a cluster that are compared in one group; more are dealt into blocks.
GROUP_SHINGLES = 2_000_000
#: Ids of the members of clusters are broadcast up to this many bytes.
BROADCAST_BYTES = 32 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so its powers have inverses modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, 1 << 16)
        _POWERS[:] = [np.concatenate([[_U(1)], np.cumprod(np.full(n - 1, b, dtype=_U))])
                      for b in (_BASE, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word (run of anything but ASCII white space), A-Z lowered."""
    data = np.frombuffer(b" " + text.translate(LOWER) + b" ", dtype=np.uint8)
    edge = np.flatnonzero(np.diff(_SPACE[data].view(np.int8)))
    first, last = edge[0::2] + 1, edge[1::2] + 1
    power, inverse = _powers(len(data))
    # prefix sums of a polynomial; a word's part, moved to its own start
    sums = np.concatenate([[_U(0)], np.cumsum((data.astype(_U) + _U(1)) * power[:len(data)])])
    return _mix((sums[last] - sums[first]) * inverse[first] + (last - first).astype(_U))


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; all words if there are fewer."""
    h = word_hashes(text)
    if not len(h):
        return h
    k = min(words, len(h))
    runs = np.full(len(h) - k + 1, k, dtype=_U)
    for j in range(k):
        runs = _mix(runs * _U(0xD6E8FEB86659FD93) + h[j:len(h) - k + 1 + j])
    return np.unique(runs)


# for an empty bin, bins to borrow from, in the same random order in every document
_DONORS = np.random.default_rng(7).integers(0, BINS, (64, BINS))
_EDGES = np.arange(BINS, dtype=_U) << _U(57)


def signature(values: np.ndarray) -> np.ndarray:
    """One-permutation MinHash: the smallest hash in each of BINS ranges, empty ranges
    borrowing from others."""
    at = np.searchsorted(values, _EDGES)
    near = values[np.minimum(at, len(values) - 1)]
    full = (at < len(values)) & ((near >> _U(57)) == np.arange(BINS, dtype=_U))
    found = near.copy()
    for donors in _DONORS:
        empty = np.flatnonzero(~full)
        if not len(empty):
            return _mix(found)
        lender = donors[empty]
        ok = np.flatnonzero(full[lender] & (near[lender] >> _U(57) == lender.astype(_U)))
        found[empty[ok]] = near[lender[ok]]
        full[empty[ok]] = True
    own = np.flatnonzero((at < len(values)) & ((near >> _U(57)) == np.arange(BINS, dtype=_U)))
    rest = np.flatnonzero(~full)
    found[rest] = near[own[np.searchsorted(own, rest) % len(own)]]
    return _mix(found)


_BIN_KEYS = _mix(np.arange(1, BINS + 1, dtype=_U))


def sketch_of(signed: np.ndarray) -> np.ndarray:
    """A bit of each bin; bins that borrowed one and the same hash differ by their keys."""
    return np.packbits((_mix(signed + _BIN_KEYS) & _U(1)).astype(np.uint8))


_SIGNED = "doc_id long, n_shingles long, class binary, orders binary, sketch binary"


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_SIGNED)
        for batch in batches:
            sizes, classes, orders, sketches = [], [], [], []
            for text in batch.column(1).to_pylist():
                values = shingles(text, words)
                sizes.append(len(values))
                if not len(values):
                    classes.append(None)
                    orders.append(None)
                    sketches.append(None)
                    continue
                classes.append(xxhash.xxh3_128_digest(values.tobytes()))
                signed = signature(values)
                orders.append((signed[:TREES * DEPTH] >> _U(32)).astype(">u4").tobytes())
                sketches.append(sketch_of(signed).tobytes())
            yield record_batch(schema, batch.num_rows, doc_id=batch.column(0), n_shingles=sizes,
                               **{"class": classes}, orders=orders, sketch=sketches)
    return run


_WALKED = "a long, b long, place binary, sketch binary, origin long"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (place, node, sketch) rows to links (a, b), and to leaders (a, place, sketch,
    origin) that have yet to meet those of the same prefix with another origin."""
    schema = arrow_schema(_WALKED)
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    width, short = 1 + 4 * DEPTH, 1 + 4 * MIN_DEPTH
    places = np.frombuffer(b"".join(rows["place"].to_pylist()), dtype=np.uint8).reshape(-1, width)
    nodes = rows["node"].to_numpy()
    sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), dtype=_U).reshape(-1, BINS // 64)
    n = len(nodes)
    cuts = np.flatnonzero((places[1:, :short] != places[:-1, :short]).any(axis=1)) + 1
    starts = np.concatenate([[0], cuts])
    ends = np.concatenate([cuts, [n]])
    # a row alone has neighbours only beyond the partition's edge
    some = (ends - starts > 1) | (starts == 0) | (ends == n)
    a, b, aside, origins = [], [], [], []
    origin = TaskContext.get().partitionId() << 32
    for lo, hi in zip(starts[some], ends[some], strict=True):
        leaders = np.zeros(0, dtype=np.int64)
        goes_on = lo == 0 or hi == n
        for at in range(lo, hi, BLOCK):
            here = np.concatenate([leaders, np.arange(at, min(at + BLOCK, hi))])
            found = _groups(sketch[here])
            moved = np.flatnonzero(found != np.arange(len(here)))
            a += nodes[here[found[moved]]].tolist()
            b += nodes[here[moved]].tolist()
            last = at + BLOCK >= hi
            if last and not goes_on:
                break
            leaders = here[_leaders(sketch[here], found)]
            if last or len(leaders) > BLOCK:
                aside.append(leaders)
                origins += [origin] * len(leaders)
                origin += 1
                leaders, goes_on = leaders[:0], True
    yield record_batch(schema, len(a), a=a, b=b)
    for at in range(0, len(aside), 16):
        some = np.concatenate(aside[at:at + 16])
        begin = sum(map(len, aside[:at]))
        yield record_batch(schema, len(some), a=nodes[some], origin=origins[begin:begin + len(some)],
                           place=[p.tobytes() for p in places[some]],
                           sketch=[s.tobytes() for s in sketch[some]])


def _leaders(sketch: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The rows that go along: the first of each group, and of the others those that have less
    than LEADER_SHARE with each one of their group that goes along."""
    far = BINS - int(np.ceil(LEADER_SHARE * BINS))
    goes = found == np.arange(len(found))
    away = np.bitwise_count(sketch ^ sketch[found]).sum(axis=1) > far
    along = {}
    for i in np.flatnonzero(away):
        others = along.setdefault(found[i], [])
        if not others or (np.bitwise_count(sketch[others] ^ sketch[i]).sum(axis=1) > far).all():
            others.append(i)
            goes[i] = True
    return np.flatnonzero(goes)


def _groups(sketch: np.ndarray) -> np.ndarray:
    """For each row the first row that sketches connect it to."""
    m, need = len(sketch), int(np.ceil(SKETCH_SHARE * BINS))
    if m == 2:
        alike = BINS - int(np.bitwise_count(sketch[0] ^ sketch[1]).sum()) >= need
        return np.array([0, 0 if alike else 1])
    found = np.full(m, -1)
    for i in range(m):
        if found[i] >= 0:
            continue
        found[i] = i
        front = np.array([i])
        while len(front):  # breadth first, over rows that have no group yet
            rest = np.flatnonzero(found < 0)
            if not len(rest):
                return found
            far = np.bitwise_count(sketch[front][:, None] ^ sketch[rest][None]).sum(axis=2)
            front = rest[(BINS - far >= need).any(axis=0)]
            found[front] = i
    return found


_LINKS = "a long, b long"


def _meet(group: pa.Table) -> pa.Table:
    """Links of the leaders in a pair of blocks, by their sketches."""
    nodes = group["a"].to_numpy()
    found = _groups(np.frombuffer(b"".join(group["sketch"].to_pylist()), dtype=_U)
                    .reshape(-1, BINS // 64))
    moved = np.flatnonzero(found != np.arange(len(nodes)))
    return pa.table({"a": pa.array(nodes[found[moved]], pa.int64()),
                     "b": pa.array(nodes[moved], pa.int64())})


def in_block_pairs(rows: DataFrame, id_col: str) -> DataFrame:
    """Rows with ``blocks``, the blocks of their group, to rows with ``pair``: a row of block x
    meets those of each block y in the pair (min(x, y), max(x, y))."""
    return (rows.withColumn("block", F.expr(f"cast(pmod(xxhash64({id_col}), blocks) as int)"))
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .withColumn("pair", F.expr("struct(least(block, other) as x, "
                                       "greatest(block, other) as y)"))
            .drop("block", "other", "blocks"))


def forest_links(forest: DataFrame, parts: int, crowd: int = CROWD) -> DataFrame:
    """(place, node, sketch) rows, a place being a tree's number and DEPTH hashes of four bytes,
    to links (a, b) that connect the nodes which sketches call alike within a region."""
    walked = saved(forest.repartitionByRange(parts, "place", "node")
                   .sortWithinPartitions("place", "node").mapInArrow(_walk, _WALKED), "walked")
    links = walked.filter("b is not null").select("a", "b")
    aside = walked.filter("b is null").select("a", "place", "sketch", "origin").withColumn(
        "prefix", F.substring("place", 1, 1 + 4 * MIN_DEPTH))
    for depth in range(MIN_DEPTH + 1, DEPTH + 1):
        crowded = saved(aside.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
                        .filter(F.col("n") > crowd).select(F.col("prefix").alias("crowded")),
                        "crowded")
        if crowded.isEmpty():
            break
        longer = F.substring("place", 1, 1 + 4 * depth)
        aside = aside.join(crowded, F.col("prefix") == F.col("crowded"), "left").withColumn(
            "prefix", F.when(F.col("crowded").isNull(), F.col("prefix")).otherwise(longer)
        ).drop("crowded")
    sizes = (aside.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"),
                                         F.min("origin").alias("least"),
                                         F.max("origin").alias("most"))
             .filter("least < most")
             .select(F.col("prefix").alias("met"),
                     F.ceil(F.col("n") / (2 * BLOCK)).cast("int").alias("blocks")))
    # up to two blocks' rows are one group
    aside = aside.join(sizes, F.col("prefix") == F.col("met")).withColumn(
        "blocks", F.expr("if(blocks = 1, 1, 2 * blocks)"))
    met = (in_block_pairs(aside, "a").select("prefix", "pair", "a", "sketch")
           .groupBy("prefix", "pair").applyInArrow(_meet, _LINKS))
    return links.unionByName(met)


def _confirm(words: int, percent: int):
    def run(group: pa.Table) -> pa.Table:
        """Links that connect the similar documents of a group, by their full sets."""
        nodes = group["node"].to_numpy()
        sets = [shingles(t, words) for t in group["text"].to_pylist()]
        m = len(sets)
        sizes = np.array([len(s) for s in sets])
        values, place = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(m), sizes)
        ends = np.cumsum(sizes)
        order = np.argsort(place, kind="stable")
        members = owner[order]  # the documents of each shingle, one after another
        begin = np.searchsorted(place[order], np.arange(len(values) + 1))
        held = np.diff(begin)
        # the document whose shingles are the most common first: the others hang on it
        weight = np.add.reduceat(held[place], ends - sizes) / sizes
        up = np.arange(m)
        links = []
        done = np.zeros(m, dtype=bool)
        while True:
            # a link between two components has an end outside the largest one
            component, count = np.unique(up, return_counts=True)
            if len(component) == 1:
                break
            largest = component[np.argmax(count)]
            rest = np.flatnonzero(~done & ((up != largest) | (not links)))
            if not len(rest):
                break
            d = rest[np.argmax(weight[rest])]
            done[d] = True
            own = place[ends[d] - sizes[d]:ends[d]]
            own = own[held[own] > 1]
            if not len(own):
                continue
            at = np.repeat(begin[own] - np.concatenate([[0], np.cumsum(held[own])[:-1]]),
                           held[own]) + np.arange(held[own].sum())
            common = np.bincount(members[at], minlength=m)
            similar = 100 * common >= percent * (sizes + sizes[d] - common)
            for other in np.flatnonzero(similar & (up != up[d])):
                if up[other] != up[d]:
                    links.append((int(nodes[d]), int(nodes[other])))
                    up[up == up[other]] = up[d]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                         "b": pa.array([y for _, y in links], pa.int64())})
    return run


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked if the Jaccard similarity of their sets of ``words``-word shingles
    is at least ``percent`` per cent (of fewer words the whole sequence is the one
    shingle); component_id is the smallest doc_id reachable.  Null, empty and blank texts
    have no shingles and stand alone.  Rows with the same doc_id are one node; a null
    doc_id stands for the smallest number and is returned as null.
    """
    spark = docs.sparkSession
    ship_package(spark)
    none = -(1 << 63)
    ids = F.coalesce(docs["doc_id"].cast("long"), F.lit(none))
    texts = docs.select(ids.alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    signed = saved(texts.mapInArrow(_sign(words), _SIGNED), "signed")
    classes = saved(signed.filter("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("node"), F.first("orders").alias("orders"),
        F.first("sketch").alias("sketch"), F.max("n_shingles").alias("size")), "classes")

    n_classes = classes.count()
    parts = max(shuffle_parts(spark), -(-n_classes * TREES // PARTITION_ROWS))
    forest = classes.select("node", "sketch", "orders", F.explode(
        F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).select(
        F.expr(f"concat(unhex(lpad(hex(tree), 2, '0')), "
               f"substring(orders, tree * {4 * DEPTH} + 1, {4 * DEPTH}))").alias("place"),
        "node", "sketch")
    clusters = connected_components(forest_links(forest, parts))

    members = saved(clusters.join(classes.groupBy("node").agg(F.max("size").alias("size")), "node"),
                    "members")
    weights = members.groupBy("root").agg(F.sum("size").alias("weight")).select(
        "root", F.ceil(F.col("weight") / F.lit(GROUP_SHINGLES / 2)).cast("int").alias("blocks"))
    members = members.join(weights, "root").select(
        "node", "root", F.when(F.col("blocks") <= 2, 1).otherwise(F.col("blocks")).alias("blocks"))
    members = if_small(saved(members.withColumnRenamed("node", "member"), "blocks"),
                       F.lit(32), BROADCAST_BYTES)
    sent = in_block_pairs(texts.join(members, F.col("doc_id") == F.col("member"))
                          .select(F.col("doc_id").alias("node"), "text", "root", "blocks"), "node")
    links = sent.select("root", "pair", "node", "text").groupBy("root", "pair").applyInArrow(
        _confirm(words, percent), _LINKS)
    found = connected_components(links).select(F.col("node").alias("linked"), "root")

    of_class = (classes.select("class", "node")
                .join(found, F.col("node") == F.col("linked"), "left")
                .select("class", F.coalesce("root", "node").alias("root")))
    return (signed.select("doc_id", "n_shingles", "class").join(of_class, "class", "left")
            .select(F.expr(f"nullif(doc_id, {none})").alias("doc_id"), "n_shingles",
                    F.expr(f"nullif(coalesce(root, doc_id), {none})").alias("component_id"),
                    (F.coalesce("root", "doc_id") == F.col("doc_id")).alias("kept")))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (all columns) with one document, the smallest doc_id, of each component."""
    dropped = saved(near_dedup(docs, words, percent).filter("not kept")
                    .select(F.col("doc_id").alias("drop_id")).distinct(), "near-copies")
    dropped = if_small(dropped, F.lit(16), BROADCAST_BYTES)
    return docs.join(dropped, F.col("doc_id").cast("long") == F.col("drop_id"), "left_anti")
