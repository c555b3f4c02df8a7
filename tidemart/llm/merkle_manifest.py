"""Merkle manifest of a dataset: a postorder append log and proofs read from it.

Every row is a leaf.  The leaves of a source, in ascending order of their ids, are joined in
aligned runs of 16 until one node remains, its subroot; the subroots, in the order of their
sources, are joined alike into the root.

Aligned builders work on blocks of 256 leaves (two levels of 16) and append the nodes of
their block in the order in which they are completed, children before their parent; the
roots of the blocks are the leaves of the next tier.  A node's place in the log of its tree
follows from the sizes of the subtrees before it (:func:`position`), so the siblings of a
proof are addressed by arithmetic: nothing points from one node to another.

Rows: a null id, source or other field is a field of its own kind (``-``); null sources make
one source of their own, first in order; rows that repeat an id are ordered by their leaves,
equal rows are equal leaves side by side.  An empty table gives an empty manifest.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm.shared import arrow_schema, record_batch, saved, ship_package, shuffle_parts

#: Nodes that are joined into one.
FAN = 16
#: Levels that one builder completes: a block is FAN ** TIER leaves.
TIER = 2
BLOCK = FAN ** TIER

_LOG = "tree string, level int, index long, position long, n long, digest string"
_PATH = "tree string, index long, path array<string>, top string"
_PROOF = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    up = 0
    while FAN ** up < n:
        up += 1
    return up


def position(level, index, n):
    """Place (from 0) of the node ``index`` of ``level`` in the postorder log of a tree of
    ``n`` leaves.  With e leaves up to the node's last one, the log then holds, of each level
    not above its own, every node that starts among them, and of each higher level those
    that were complete before its last leaf came.  Numbers or arrays."""
    level, index, n = (np.asarray(x, dtype=np.int64) for x in (level, index, n))
    end = np.minimum(n, (index + 1) * FAN ** level)
    before = np.zeros(np.broadcast(level, index, n).shape, dtype=np.int64)
    for k in range(height(int(n.max(initial=1))) + 1):
        size = FAN ** k
        before += np.where(k <= level, -(-end // size), (end - 1) // size)
    return before - 1


def run_of(level: int, index: int, n: int) -> range:
    """Indexes of the nodes joined with this one (itself included)."""
    first = index - index % FAN
    return range(first, min(first + FAN, -(-n // FAN ** level)))


# leaves --------------------------------------------------------------------------------
def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(docs: DataFrame, text: Column | None = None) -> Column:
    """Digest of a row's doc_id, source, lang, n_chars and text (or another ``text``)."""
    fields = [docs["doc_id"], docs["source"], docs["lang"], docs["n_chars"],
              docs["text"] if text is None else text]
    return F.sha2(F.concat(*map(_field, fields)).cast("binary"), 256)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` (a saved table) with ``index``, the place from 0 by ``order`` among the rows
    of the same ``tree``, and ``n``, their number.  Rows are dealt by range over tree and
    order, so a large tree spreads; only the counts of trees and ranges are joined."""
    kept = [c for c in rows.columns if c != tree]
    parts = shuffle_parts(rows.sparkSession)
    dealt = (rows.repartitionByRange(parts, tree, *order)
             .withColumn("part", F.spark_partition_id()))
    dealt = saved(dealt, "merkle-ranges")
    inside = Window.partitionBy("part", tree).orderBy(*order)
    counts = dealt.groupBy(F.col(tree).alias("of_tree"), F.col("part").alias("of_part")).count()
    whole = Window.partitionBy("of_tree")
    before = whole.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("of_tree", "of_part", F.sum("count").over(whole).alias("n"),
                           F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ranked = dealt.withColumn("inside", F.row_number().over(inside))
    return (ranked.join(counts, ranked[tree].eqNullSafe(counts["of_tree"])
                        & (ranked["part"] == counts["of_part"]))
            .select(F.col(tree).alias("tree"), *kept, "n",
                    (F.col("before") + F.col("inside") - 1).alias("index")))


# the log -------------------------------------------------------------------------------
def _complete(digests: list[str], level: int, index: int, out: list[tuple[int, int, str]]) -> str:
    """Digest of a node of a block; appends the nodes under it and itself as they complete."""
    if level == 0:
        digest = digests[index]
    else:
        under = -(-len(digests) // FAN ** (level - 1))
        digest = sha("".join(_complete(digests, level - 1, c, out)
                             for c in range(index * FAN, min(index * FAN + FAN, under))))
    out.append((level, index, digest))
    return digest


def _builder(base: int):
    """Nodes of one block over nodes of level ``base``, in completion order."""
    def build(block: pa.Table) -> pa.Table:
        block = block.sort_by("index")
        first, n = block["index"][0].as_py(), block["n"][0].as_py()
        levels, done = min(TIER, height(n) - base), []
        _complete(block["digest"].to_pylist(), levels, 0, done)
        if base:  # the nodes of level base are in the log of the tier below
            done = [x for x in done if x[0]]
        level = np.array([x[0] for x in done])
        index = first // FAN ** level + np.array([x[1] for x in done])
        schema = arrow_schema(_LOG)
        return pa.Table.from_batches([record_batch(
            schema, len(done), tree=block["tree"][0].as_py(), level=level + base, index=index,
            position=position(level + base, index, n), n=n, digest=[x[2] for x in done])])
    return build


def append_log(leaves: DataFrame, label: str) -> list[DataFrame]:
    """The log of the trees over ``leaves`` (tree, index, n, digest), a table for each tier:
    tree, level, index, position, n, digest."""
    spark, tiers = leaves.sparkSession, []
    ship_package(spark)
    tallest = height(int(leaves.agg(F.max("n")).first()[0] or 0))
    nodes = leaves.select("tree", "index", "n", "digest")
    for base in range(0, max(tallest, 1), TIER):
        tiers.append(saved(nodes.groupBy("tree", F.floor(F.col("index") / BLOCK)).applyInArrow(
            _builder(base), _LOG), f"merkle-{label}-{base}"))
        nodes = (tiers[-1].filter((F.col("level") == base + TIER)
                                  & (F.col("n") > FAN ** (base + TIER)))
                 .select("tree", "index", "n", "digest"))
    return tiers


def tops(tiers: list[DataFrame]) -> DataFrame:
    """tree, n, digest of each tree's last node: the last of its log."""
    every = None
    for tier in tiers:
        last = tier.groupBy("tree").agg(F.max(F.struct("position", "digest", "n")).alias("last"))
        every = last if every is None else every.unionByName(last)
    return (every.groupBy("tree").agg(F.max("last").alias("last"))
            .select("tree", "last.n", "last.digest"))


# proofs --------------------------------------------------------------------------------
class _Block:
    """The log rows of one block and the path above it, by their places in the log."""

    def __init__(self, rows: pa.Table, base: int):
        above = rows.filter(pc.equal(rows["kind"], "path"))
        log = rows.filter(pc.equal(rows["kind"], "log"))
        self.above = above["path"][0].as_py() if above.num_rows else []
        self.top = above["top"][0].as_py() if above.num_rows else None
        self.nodes = dict(zip(log["position"].to_pylist(), log["digest"].to_pylist()))
        self.n, self.base, self.shared = log["n"][0].as_py(), base, {}
        self.levels = min(TIER, height(self.n) - base)

    def path(self, index: int) -> list[str]:
        """Digests left and right of a node of the block's lowest level, in its run and in
        those above it."""
        out = []
        for up in range(self.levels):
            level, at = self.base + up, index // FAN ** up
            if (level, at) not in self.shared:
                run = run_of(level, at, self.n)
                found = [self.nodes[p] for p in
                         position(level, np.arange(run.start, run.stop), self.n).tolist()]
                self.shared[level, at] = ["".join(found[:at - run.start]),
                                          "".join(found[at - run.start + 1:])]
            out += self.shared[level, at]
        return out + self.above


def _paths(base: int):
    """The path of each node of level ``base`` in a block."""
    def read(rows: pa.Table) -> pa.Table:
        block = _Block(rows, base)
        at = rows.filter((pc.field("kind") == "log") & (pc.field("level") == base))
        indexes = at["index"].to_pylist()
        return pa.Table.from_batches([record_batch(
            arrow_schema(_PATH), len(indexes), tree=rows["tree"][0].as_py(), index=indexes,
            path=[block.path(i) for i in indexes], top=block.top)])
    return read


def fold(digest: str, path: list[str]) -> str:
    """The root that a leaf and the digests left and right of it on each level lead to."""
    for left, right in zip(path[::2], path[1::2]):
        digest = sha(left + digest + right)
    return digest


def _proofs(rows: pa.Table) -> pa.Table:
    """Proof of each document of a block, and the root recomputed from its claimed leaf."""
    block = _Block(rows, 0)
    asked = rows.filter(pc.equal(rows["kind"], "doc"))
    paths = [block.path(i) for i in asked["index"].to_pylist()]
    claimed = pc.coalesce(asked["claimed"], asked["digest"]).to_pylist()
    return pa.Table.from_batches([record_batch(
        arrow_schema(_PROOF), len(paths), doc_id=asked["doc_id"], leaf=asked["digest"],
        subroot=block.top, proof_sha256=[sha("".join(p)) for p in paths],
        folded_root=[fold(d, p) for d, p in zip(claimed, paths)])])


def _tier_rows(tiers: list[DataFrame], k: int, paths: DataFrame | None,
               above: DataFrame | None) -> DataFrame:
    """The log rows that the blocks of tier ``k`` address, and the path above each block:
    from the tier above, or ``above`` (tree, n, path, top) for trees that end in this tier."""
    base = k * TIER
    log = tiers[k].filter(F.col("level").isin(*range(base, base + TIER)))
    if k:
        log = log.unionByName(tiers[k - 1].filter((F.col("level") == base)
                                                  & (F.col("n") > FAN ** base)))
    size = F.pow(F.lit(FAN), F.lit(base + TIER) - F.col("level"))
    rows = log.select("*", F.lit("log").alias("kind"),
                      F.floor(F.col("index") / size).cast("long").alias("block"))
    known = []
    if paths is not None:
        known.append(paths.withColumnRenamed("index", "block"))
    if above is not None:
        ends = (F.col("n") <= FAN ** (base + TIER)) & (F.col("n") > (FAN ** base if k else 0))
        known.append(above.filter(ends).select("tree", F.lit(0).cast("long").alias("block"),
                                               "path", "top"))
    for more in known:
        rows = rows.unionByName(more.withColumn("kind", F.lit("path")), allowMissingColumns=True)
    if not known:
        rows = rows.withColumns({"path": F.lit(None).cast("array<string>"),
                                 "top": F.lit(None).cast("string")})
    return rows


def sibling_paths(tiers: list[DataFrame], above: DataFrame | None, label: str,
                  lowest: int = 0) -> DataFrame | None:
    """tree, index, path, top of the nodes at the foot of tier ``lowest``: the digests left
    and right of them on each level up to the tree's top and on along ``above``."""
    paths = None
    for k in reversed(range(lowest, len(tiers))):
        rows = _tier_rows(tiers, k, paths, above)
        paths = saved(rows.groupBy("tree", "block").applyInArrow(_paths(k * TIER), _PATH),
                      f"merkle-paths-{label}-{k}")
    return paths


# the manifest ---------------------------------------------------------------------------
@dataclass
class Manifest:
    """``leaves``: tree (the source), index, n, doc_id, digest and claimed leaf of every row;
    ``log``: the trees of the sources; ``top_log``: the tree over their subroots, whose leaf
    ``index`` belongs to the source in ``sources``; ``root``: null for an empty table."""
    leaves: DataFrame
    log: list[DataFrame]
    sources: DataFrame
    top_log: list[DataFrame]
    root: str | None


def build_manifest(docs: DataFrame, claimed: Column | None = None) -> Manifest:
    """Manifest of every row of ``docs`` (doc_id, source, lang, n_chars, text; other columns
    are not part of a leaf).  ``claimed``: leaf that someone else states for a row, kept
    beside the true one for :func:`verify` (null: the true one)."""
    ship_package(docs.sparkSession)
    claimed = F.lit(None).cast("string") if claimed is None else claimed
    rows = saved(docs.select(
        F.col("source").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(docs).alias("digest"), claimed.alias("claimed"),
        F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    leaves = saved(numbered(rows, "tree", ["doc_id", "digest", "row"]).drop("row"),
                   "merkle-numbered")
    log = append_log(leaves, "log")
    subroots = saved(tops(log).select(F.lit(None).cast("string").alias("tree"),
                                      F.col("tree").alias("source"), "digest",
                                      F.col("n").alias("leaves")), "merkle-subroots")
    sources = saved(numbered(subroots, "tree", ["source"]), "merkle-sources")
    top_log = append_log(sources, "top")
    top = tops(top_log).first()
    return Manifest(leaves, log, sources, top_log, None if top is None else top["digest"])


def verify(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row: its
    proof, read from the log, and whether the claimed leaf leads to the root by it."""
    over = sibling_paths(manifest.top_log, None, "top")
    above = (manifest.sources.join(over.select("index", "path"), "index")
             .select(F.col("source").alias("tree"), F.col("leaves").alias("n"), "path",
                     F.col("digest").alias("top")))
    above = saved(above, "merkle-above")
    paths = sibling_paths(manifest.log, above, "log", 1)
    rows = _tier_rows(manifest.log, 0, paths, above).unionByName(
        manifest.leaves.withColumns({"kind": F.lit("doc"),
                                     "block": F.floor(F.col("index") / BLOCK)}),
        allowMissingColumns=True)
    return (rows.groupBy("tree", "block").applyInArrow(_proofs, _PROOF)
            .select("doc_id", "leaf", "subroot", F.lit(manifest.root).alias("root"),
                    "proof_sha256", "folded_root",
                    (F.col("folded_root") == F.lit(manifest.root)).alias("verified")))


def proof(manifest: Manifest, source: str | None, index: int) -> list[str]:
    """Digests left and right of one leaf on each level up to the root: a lookup of their
    places in the log, which reads no other block (row groups hold ranges of places)."""
    out, at = [], (manifest.log, source, index)
    while at:
        tiers, tree, index = at
        asked = F.col("tree").eqNullSafe(F.lit(tree).cast("string"))
        first = tiers[0].filter(asked).select("n").first()
        if first is None or not 0 <= index < first["n"]:
            raise KeyError(f"no leaf {index} in {tree!r}")
        n = first["n"]
        places = [[int(p) for p in position(level, np.array(run_of(level, index // FAN ** level,
                                                                   n)), n)]
                  for level in range(height(n))]
        found = {}
        for tier in tiers:
            for r in tier.filter(asked & F.col("position").isin(sum(places, []))).collect():
                found[r["position"]] = r["digest"]
        for level, run in enumerate(places):
            here = index // FAN ** level % FAN
            out += ["".join(found[p] for p in run[:here]),
                    "".join(found[p] for p in run[here + 1:])]
        at = None
        if tiers is manifest.log:
            top = manifest.sources.filter(F.col("source").eqNullSafe(
                F.lit(source).cast("string"))).first()
            at = (manifest.top_log, None, top["index"])
    return out
