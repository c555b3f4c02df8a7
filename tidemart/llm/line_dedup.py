"""Repeated lines through two Bloom filters.

1. Each partition hashes the lines of its documents into two filters, *once seen* and
   *twice seen*; the filters are merged segment by segment in two levels (a bit set in
   both once-filters goes to the twice-filter).  They never miss a repeated line.
2. Only lines that the twice-seen filter holds shuffle, as whole keys, for the exact
   count of documents and the choice of the document that keeps them.
3. The line numbers to drop go back to their documents.

The filter's size follows the number of documents up to ``MAX_BITS``, which bounds the
broadcast; a fuller filter only lets more lines through to the exact step.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.shared import (
    LOWER, SPACES, arrow_schema, if_small, record_batch, saved, ship_package, text_of,
)

#: Lines expected in a document and bits of filter for a line, before MAX_BITS.
LINES_A_DOCUMENT, BITS_A_LINE, HASHES = 16, 8, 4
MIN_BITS, MAX_BITS, SEGMENTS = 1 << 20, 1 << 30, 64
#: Line numbers to drop are broadcast up to this many bytes; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20


def line_keys(text: bytes, min_chars: int) -> dict[bytes, list[int]]:
    """Keys of at least ``min_chars`` code points, each with its line numbers."""
    keys: dict[bytes, list[int]] = {}
    for i, line in enumerate(text.split(b"\n")):
        if len(line) >= min_chars:
            key = line.strip(SPACES).translate(LOWER)
            if len(key) >= 4 * min_chars or len(key.decode("utf-8")) >= min_chars:
                keys.setdefault(key, []).append(i)
    return keys


def _bit_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """One column for each of HASHES bit numbers; ``bits`` is a power of two."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    k = np.arange(HASHES, dtype=np.uint64)
    mixed = (hashes[:, None] + k * step[:, None]) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)


_SEGMENT = "segment int, part int, once binary, twice binary"


def _filters(bits: int, min_chars: int):
    """A partition's texts to its two filters, cut into compressed segments."""
    width = bits // 8 // SEGMENTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # bits rather than hashes are held: the memory is bounded by the filter's size
        once, twice = np.zeros(bits // 8, dtype=np.uint8), np.zeros(bits // 8, dtype=np.uint8)
        used = False
        for batch in batches:
            hashes = [xxhash.xxh3_64_intdigest(k) for text in batch.column(0).to_pylist()
                      for k in line_keys(text, min_chars)]
            if not hashes:
                continue
            used = True
            values, count = np.unique(np.array(hashes, dtype=np.uint64), return_counts=True)
            places = _bit_places(values, bits)
            again = (count > 1) | _held(once, places)
            _set(twice, places[again])
            _set(once, places)
        if not used:
            return
        part = TaskContext.get().partitionId()
        schema = arrow_schema(_SEGMENT)
        for s in range(SEGMENTS):
            cut = slice(s * width, (s + 1) * width)
            if once[cut].any():
                yield record_batch(schema, 1, segment=s, part=part,
                                   once=zlib.compress(once[cut].tobytes(), 1),
                                   twice=zlib.compress(twice[cut].tobytes(), 1))
    return run


def _bit(places: np.ndarray) -> np.ndarray:
    return np.uint8(128) >> (places & 7).astype(np.uint8)


def _set(filter_: np.ndarray, places: np.ndarray) -> None:
    places = places.ravel()
    np.bitwise_or.at(filter_, places >> 3, _bit(places))


def _held(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Rows of ``places`` all of whose bits are set."""
    return ((filter_[places >> 3] & _bit(places)) != 0).all(axis=1)


def _merge(rows: pa.Table) -> pa.Table:
    """Filters of one segment to one: twice = either twice, or both once."""
    once = twice = None
    for a, b in zip(rows["once"], rows["twice"], strict=True):
        a, b = (np.frombuffer(zlib.decompress(x.as_py()), dtype=np.uint8) for x in (a, b))
        if once is None:
            once, twice = a.copy(), b.copy()
        else:
            twice |= b | (once & a)
            once |= a
    return pa.table({"segment": rows["segment"][:1].combine_chunks(),
                     "part": rows["part"][:1].combine_chunks(),
                     "once": pa.array([zlib.compress(once.tobytes(), 1)], pa.binary()),
                     "twice": pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())})


_LINES = "doc_id long, version long, key binary, lines array<int>"


def _suspects(twice, bits: int, min_chars: int):
    """The lines of (doc_id, version, text) that the twice-seen filter holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_LINES)
        filter_ = np.frombuffer(twice.value, dtype=np.uint8)
        for batch in batches:
            found = [line_keys(t, min_chars) for t in batch.column(2).to_pylist()]
            row = np.repeat(np.arange(len(found)), [len(k) for k in found])
            keys = [k for d in found for k in d]
            lines = [n for d in found for n in d.values()]
            if not keys:
                continue
            places = _bit_places(np.array([xxhash.xxh3_64_intdigest(k) for k in keys],
                                          dtype=np.uint64), bits)
            hit = np.flatnonzero(_held(filter_, places))
            yield record_batch(schema, len(hit), doc_id=batch.column(0).take(pa.array(row[hit])),
                               version=batch.column(1).take(pa.array(row[hit])),
                               key=[keys[i] for i in hit], lines=[lines[i] for i in hit])
    return run


def repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Lines to drop: doc_id, version (hash of the text), lines (their numbers from 0).

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased.  A
    key of at least ``min_chars`` code points in at least ``min_docs`` documents keeps
    its lines only in the largest doc_id that holds it.  Rows with the same doc_id are
    one document; null is a document too, the smallest.
    """
    spark = docs.sparkSession
    ship_package(spark)
    lines_about = max(1, docs.count()) * LINES_A_DOCUMENT * BITS_A_LINE
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (lines_about - 1).bit_length()))
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of(docs)).alias("version"),
                        text_of(docs).cast("binary").alias("text"))
    parts = texts.select("text").mapInArrow(_filters(bits, min_chars), _SEGMENT)
    merged = (parts.withColumn("part", F.col("part") % 32)
              .groupBy("segment", "part").applyInArrow(_merge, _SEGMENT)
              .groupBy("segment").applyInArrow(_merge, _SEGMENT))
    held = np.zeros(bits // 8, dtype=np.uint8)  # at most MAX_BITS / 8 bytes
    width = bits // 8 // SEGMENTS
    for r in merged.select("segment", "twice").collect():
        held[r.segment * width:(r.segment + 1) * width] = np.frombuffer(
            zlib.decompress(r.twice), dtype=np.uint8)
    twice = spark.sparkContext.broadcast(held.tobytes())

    suspects = saved(texts.mapInArrow(_suspects(twice, bits, min_chars), _LINES), "lines")
    repeats = (suspects.select("key", "doc_id").distinct()
               .groupBy("key").agg(F.count(F.lit(1)).alias("docs"),
                                   F.max("doc_id").alias("keep_id"))
               .filter(F.col("docs") >= min_docs).select("key", "keep_id"))
    # a common line is one row here: where these fit, its many lines need not meet in a task
    repeats = if_small(saved(repeats, "repeats"), 16 + F.length("key"), BROADCAST_BYTES)
    return (suspects.join(repeats, "key")
            .filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .groupBy("doc_id", "version")
            .agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines")))


_CLEAN = "doc_id long, n_lines long, n_dropped long, text string, kept_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_CLEAN)
    for batch in batches:
        n_lines, n_dropped, texts, shas = [], [], [], []
        for text, drop in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                              strict=True):
            n = text.count(b"\n") + 1
            if drop:
                gone = set(drop)
                text = b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in gone)
            n_lines.append(n)
            n_dropped.append(len(drop or ()))
            texts.append(text)
            shas.append(hashlib.sha256(text).hexdigest())
        yield record_batch(schema, batch.num_rows, doc_id=batch.column(0), n_lines=n_lines,
                           n_dropped=n_dropped, kept_sha256=shas,
                           text=pa.array(texts, pa.binary()).cast(pa.string()))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text; other columns are not read):
    doc_id, n_lines (before), n_dropped, text (lines that stay, joined by \\n),
    kept_sha256.  A null or empty text is one empty line.  See ``repeated_lines``.
    """
    drops = saved(repeated_lines(docs, min_chars, min_docs), "drops")
    drops = if_small(drops, 32 + 8 * F.size("lines"), BROADCAST_BYTES).select(
        F.col("doc_id").alias("drop_id"), F.col("version").alias("drop_version"), "lines")
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of(docs)).alias("version"),
                        text_of(docs).cast("binary").alias("text"))
    return (texts.join(drops, F.col("doc_id").eqNullSafe(F.col("drop_id"))
                       & (F.col("version") == F.col("drop_version")), "left")
            .select("doc_id", "text", "lines").mapInArrow(_cut, _CLEAN))
