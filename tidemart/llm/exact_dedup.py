"""Exact duplicates through an exchange of Golomb-coded fingerprints.

1. Each partition hashes its texts, keeps its distinct fingerprints and sends them,
   sorted and Golomb-Rice coded, to the owners of their ranges.  A text repeated
   inside the partition is sent once, so a hot text costs one code per partition.
2. Each owner returns to each partition a bitmap over the codes it had sent: set
   where another partition has sent the same fingerprint.
3. Only the rows whose bit is set (or that repeat inside their partition) shuffle
   their texts, which are grouped by their bytes, with map-side partial aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.shared import (
    arrow_schema, if_small, record_batch, saved, ship_package, shuffle_parts, text_of,
)

#: Bits of a fingerprint that travel.  Chance matches only add suspects.
FINGERPRINT_BITS = 48
#: Suspect ids are broadcast up to this many bytes; beyond it their join shuffles.
BROADCAST_BYTES = 32 << 20

#: kind 0: a row of the input; kind 1: the codes that its partition sends to one owner.
_SENT = ("kind int, part int, owner int, slot int, multi boolean, rid long, doc_id long, "
    "sha string, codes int, first long, low_bits int, high binary, low binary")


def golomb_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Golomb-Rice code of a sorted uint64 array, relative to its first value: bits per
    remainder, then the unary quotients and the remainders as two bit streams."""
    gaps = np.diff(values, prepend=values[:1])
    low_bits = max(0, int(np.log2(max(float(gaps.mean()) * 0.6931, 1.0)))) if len(gaps) else 0
    quotients = (gaps >> np.uint64(low_bits)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    high = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, dtype=np.uint8)
    high[ends] = 1
    bits = np.unpackbits(gaps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    low = bits[:, 64 - low_bits:].ravel()
    return low_bits, np.packbits(high).tobytes(), np.packbits(low).tobytes()


def golomb_decode(n: int, first: int, low_bits: int, high: bytes, low: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(high, dtype=np.uint8)))[:n]
    quotients = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    bits = np.zeros((n, 64), dtype=np.uint8)
    bits[:, 64 - low_bits:] = np.unpackbits(
        np.frombuffer(low, dtype=np.uint8))[:n * low_bits].reshape(n, low_bits)
    gaps = np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return np.cumsum(gaps + (quotients << np.uint64(low_bits)), dtype=np.uint64) + np.uint64(first)


def _send(owners: int):
    """Rows of (doc_id, sha) to the rows and the codes of their partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_SENT)
        part = TaskContext.get().partitionId()
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        prints = np.array([int(s[:FINGERPRINT_BITS // 4], 16) for s in rows["sha"].to_pylist()],
                          dtype=np.uint64)
        distinct, place, count = np.unique(prints, return_inverse=True, return_counts=True)
        # owners hold ranges, so the codes of each one are a run of the sorted list
        owner = (((distinct >> np.uint64(FINGERPRINT_BITS - 32)) * np.uint64(owners))
                 >> np.uint64(32)).astype(np.int64)
        starts = np.searchsorted(owner, np.arange(owners + 1))
        slot = np.arange(len(distinct)) - starts[owner]
        n = rows.num_rows
        yield record_batch(schema, n, kind=0, part=part, owner=owner[place], slot=slot[place],
                           multi=count[place] > 1, rid=(np.int64(part) << 33) + np.arange(n),
                           doc_id=rows["doc_id"], sha=rows["sha"])
        sent = [(o, distinct[starts[o]:starts[o + 1]]) for o in np.unique(owner)]
        coded = [golomb_encode(values) for _, values in sent]
        yield record_batch(schema, len(sent), kind=1, part=part, owner=[o for o, _ in sent],
                           codes=[len(v) for _, v in sent], first=[int(v[0]) for _, v in sent],
                           low_bits=[c[0] for c in coded], high=[c[1] for c in coded],
                           low=[c[2] for c in coded])
    return run


def _answer(codes: pa.Table) -> pa.Table:
    """One owner: a bitmap for each sender, set where another one has the fingerprint too."""
    codes = codes.to_pylist()
    lists = [golomb_decode(c["codes"], c["first"], c["low_bits"], c["high"], c["low"]) for c in codes]
    values, place, count = np.unique(np.concatenate(lists), return_inverse=True,
                                     return_counts=True)
    repeated = np.split(count[place] > 1, np.cumsum([len(x) for x in lists])[:-1])
    return pa.table({"part": pa.array([c["part"] for c in codes], pa.int32()),
                     "owner": pa.array([c["owner"] for c in codes], pa.int32()),
                     "bitmap": pa.array([np.packbits(r).tobytes() for r in repeated], pa.binary())})


def exact_dedup(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text; other columns are not read):
    doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty.  Of equal texts the
    row with the largest doc_id stays (null is the smallest; of rows that repeat an
    id and its text, one stays).  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    owners = owners or shuffle_parts(spark)
    hashed = docs.select(F.col("doc_id").cast("long"), F.sha2(text_of(docs), 256).alias("sha"))
    sent = saved(hashed.mapInArrow(_send(owners), _SENT), "fingerprints")
    rows = sent.filter("kind = 0").select("part", "owner", "slot", "multi", "rid", "doc_id", "sha")
    bitmaps = (sent.filter("kind = 1").groupBy("owner")
               .applyInArrow(_answer, "part int, owner int, bitmap binary"))
    byte = F.expr("cast(conv(hex(substring(bitmap, slot div 8 + 1, 1)), 16, 10) as int)")
    suspects = saved(
        rows.join(bitmaps, ["part", "owner"])
        .filter(F.col("multi") | (byte.bitwiseAND(F.expr("shiftright(128, slot % 8)")) != 0))
        .select("rid", "doc_id", "sha"), "suspects")

    ids = if_small(suspects.select(F.col("doc_id").alias("suspect")).distinct(), F.lit(8),
                   BROADCAST_BYTES)
    texts = docs.select(F.col("doc_id").cast("long"), text_of(docs).alias("text"))
    groups = (texts.join(ids, F.col("doc_id").eqNullSafe(F.col("suspect")), "left_semi")
              .groupBy("text").agg(F.max("doc_id").alias("keep_id"),
                                   F.count(F.lit(1)).alias("group_size"))
              .filter("group_size > 1")
              .select(F.sha2("text", 256).alias("sha"), "keep_id", "group_size"))
    # of rows that repeat one doc_id and text, the first stays
    keepers = (suspects.groupBy("sha")
               .agg(F.max(F.struct("doc_id", (-F.col("rid")).alias("rid"))).alias("top"))
               .select("sha", (-F.col("top.rid")).alias("keep_rid")))
    groups = saved(groups.join(keepers, "sha"), "text-groups")
    return (rows.join(groups, "sha", "left")
            .select("doc_id",
                    F.when(F.col("keep_rid").isNull(), F.col("doc_id"))
                    .otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    (F.col("keep_rid").isNull() | (F.col("keep_rid") == F.col("rid")))
                    .alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the rows that ``exact_dedup`` drops."""
    found = saved(exact_dedup(docs), "copies")
    key = [F.col("doc_id").cast("long").eqNullSafe(F.col("drop_id")),
           F.sha2(text_of(docs), 256) == F.col("drop_sha")]
    size = F.lit(72)

    def keys(rows: DataFrame, label: str) -> DataFrame:
        return if_small(saved(rows.select(F.col("doc_id").alias("drop_id"),
                                          F.col("text_sha256").alias("drop_sha")).distinct(),
                              label), size, BROADCAST_BYTES)

    dropped = found.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = docs.join(keys(dropped, "dropped"), key, "left_anti")
    # rows that repeat an id and its text: one of them stays
    again = keys(found.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")) & ~F.col("kept")),
                 "repeated-rows")
    once = kept.join(again, key, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, key, "left_anti").unionByName(once)
