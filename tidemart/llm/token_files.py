"""Token ids in Parquet files, in document order.

Documents are range-partitioned and sorted by doc_id, encoded, and written by Spark as
Parquet: the ids are a list column with a dictionary (a byte-pair vocabulary fits one
dictionary page), the ordered numbers are delta-encoded, row groups and pages have set
sizes, and page indexes let a reader fetch the tokens of a range of documents, or the
metadata without any token.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemart.llm.shared import (
    arrow_schema, if_small, record_batch, saved, ship_package, shuffle_parts, text_of,
)

#: Bytes of a row group and of a page, rows of a page at most.
ROW_GROUP, PAGE, PAGE_ROWS = 32 << 20, 256 << 10, 1000
WRITE_OPTIONS = {
    "parquet.writer.version": "PARQUET_2_0",  # delta encoding where there is no dictionary
    "parquet.block.size": str(ROW_GROUP),
    "parquet.page.size": str(PAGE),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.dictionary.page.size": str(1 << 20),
}
#: Pieces of text whose ids a worker remembers, and their length.
MEMORY, MEMORY_CHARS = 480_000, 40
#: New pieces that make up one text for the tokenizer: long texts cost it more a byte.
TOGETHER = 300

_BOUNDARY = re.compile(r" (?=\S)")


class Encoder:
    """Ids of texts as little-endian 32-bit integers.

    A byte-level tokenizer with the usual pattern never joins characters across a space
    that a non-space follows, so the pieces between such spaces are encoded once each
    and remembered.  Any other tokenizer encodes whole texts.
    """

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        known = json.loads(spec)
        pre = known.get("pre_tokenizer") or {}
        self.splits = (known.get("normalizer") is None and known.get("post_processor") is None
                       and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                       and not pre.get("add_prefix_space", True))
        self.special = [t["content"] for t in known.get("added_tokens") or ()]
        self.memory: dict[str, bytes] = {}
        # a byte-level vocabulary writes each byte as one character
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.lengths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that each follow a space: encoded some hundred together, cut by
        their bytes."""
        if not pieces:
            return []
        texts = [" " + " ".join(pieces[k:k + TOGETHER]) for k in range(0, len(pieces), TOGETHER)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.array(list(chain.from_iterable(e.ids for e in found)), dtype="<u4")
        ends = np.cumsum([len(p) + 1 if p.isascii() else len(p.encode()) + 1 for p in pieces])
        cuts = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
        found, at = ids.tobytes(), 0
        out = []
        for cut in (4 * cuts).tolist():
            out.append(found[at:cut])
            at = cut
        return out

    def _known(self, parts: list[str]) -> tuple[list[str], list[bytes | None], list[int]]:
        """``parts`` with their remembered ids and the places of those not remembered; the
        first part counts as remembered, as its ids depend on its place."""
        ids = list(map(self.memory.get, parts))
        ids[0] = b"0"  # a mark
        return parts, ids, ([] if all(ids) else [k for k, x in enumerate(ids) if x is None])

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.splits:
            return self._encode(texts)
        memory = self.memory
        whole: list[int] = []
        cut: list[list[str]] = []
        found: list[list[bytes | None]] = []
        gaps: list[list[int]] = []
        new: dict[str, bytes] = {}
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                whole.append(i)
                text = ""
            parts, ids, gap = self._known(text.split(" "))
            # remembered pieces start with a non-space: other starts are among the gaps
            if any(not parts[k] or parts[k][0].isspace() for k in gap):
                parts, ids, gap = self._known(_BOUNDARY.split(text))
            for k in gap:
                new[parts[k]] = b""
            gaps.append(gap)
            cut.append(parts)
            found.append(ids)
        new = dict(zip(new, self._pieces(list(new)), strict=True))
        # the first piece of a text has no space before it
        out = []
        firsts = self._encode([p[0] for p in cut])
        for parts, ids, gap, first in zip(cut, found, gaps, firsts, strict=True):
            for k in gap:
                ids[k] = new[parts[k]]
            ids[0] = first
            out.append(b"".join(ids))
        for p, ids in new.items():
            if len(memory) >= MEMORY:
                break
            if len(p) <= MEMORY_CHARS:
                memory[p] = ids
        for i, ids in zip(whole, self._encode([texts[i] for i in whole]), strict=True):
            out[i] = ids
        return out


#: One encoder in each worker process, kept from task to task.
_ENCODERS: dict[int, Encoder] = {}


def encoder(spec: str) -> Encoder:
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task keeps to its core
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


_FILE = "part int, seq long, doc_id long, start long, n_tokens long, ids array<int>"
#: A row of two numbers for each file is broadcast up to this many bytes.
BROADCAST_BYTES = 32 << 20
#: Texts that are encoded together.
BATCH = 256


def _encode(spec, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, part = arrow_schema(_FILE), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        made, seq, start = encoder(spec.value), 0, 0
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                ids = [x + end for x in made.encode(batch.column(1).to_pylist())]
                sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                ends = np.cumsum(sizes)
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                yield record_batch(
                    schema, len(ids), part=part, seq=seq + np.arange(len(ids)),
                    doc_id=batch.column(0), start=start + ends - sizes, n_tokens=sizes,
                    ids=pa.ListArray.from_arrays(offsets, values))
                seq, start = seq + len(ids), start + int(ends[-1])
    return run


def write_tokens(docs: DataFrame, path: str, spec: str, end_id: int = 0,
                 parts: int | None = None) -> None:
    """Encode the whole text of each row of ``docs`` (doc_id, text; null text: empty) with
    the tokenizer of JSON ``spec``, append ``end_id`` and write the rows to ``path`` in
    ascending doc_id order (null first; rows with one id by their text).

    Columns of the files: part and seq (file and row in it, in order), doc_id, start (ids
    before the row in its part), n_tokens (with the end id), ids.
    """
    spark = docs.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(spec)
    (docs.select(F.col("doc_id").cast("long"), text_of(docs).alias("text"))
     .repartitionByRange(parts or shuffle_parts(spark), "doc_id")
     .sortWithinPartitions("doc_id", "text")
     .mapInArrow(_encode(held, end_id), _FILE)
     .write.options(**WRITE_OPTIONS).parquet(path))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        sums = [zlib.crc32(values[a:b].tobytes())
                for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())],
                                         names=[*batch.schema.names[:-1], "ids_crc32"])


def token_index(files: DataFrame) -> DataFrame:
    """Metadata of written files, no token read: doc_id, start (ids of all documents
    before it), n_tokens, part, seq."""
    # one row for each file: the window over them stays small
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"), F.min("doc_id").alias("low"))
    before = Window.orderBy("low", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = if_small(saved(totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")),
                           "token-parts"), F.lit(16), BROADCAST_BYTES)
    return files.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "part", "seq",
        *(["ids"] if "ids" in files.columns else []))


def token_checksums(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian 32-bit integers)."""
    return (token_index(files).select("doc_id", "start", "n_tokens", "ids")
            .mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long"))
