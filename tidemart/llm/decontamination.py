"""Benchmark decontamination with one Aho-Corasick automaton.

Every window of benchmark words becomes a pattern over normalised text (lower-case words
joined by single spaces, one at each end, so that matches are whole words).  A document
is scanned once; match offsets are mapped to word numbers and, on request, to the
character span in the original text.

The automaton goes to every task, so its patterns are bounded: a benchmark of more than
``CHUNK_CHARS`` characters is dealt into chunks by item, one scan for each chunk, and
the hits of a document are united.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.shared import arrow_schema, record_batch, ship_package, text_of

WINDOW = 13
#: Characters of benchmark text whose windows make one automaton.
CHUNK_CHARS = 4 << 20
#: Bytes that are no part of a word become a space; A-Z become a-z.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
              else 32 for b in range(256))

_HITS = ("doc_id long, version string, n_words long, starts array<int>, ends array<int>, "
         "items array<binary>")


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def windows(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """All runs of ``size`` words; all the words where there are fewer; none for none."""
    if not words:
        return []
    return [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


def build_automaton(items: list[tuple[str, bytes]], size: int = WINDOW):
    """Pattern -> (number of words, items that have it); None without patterns."""
    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        for w in windows(normal_words(text), size):
            owners.setdefault(w, set()).add(item)
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for w, ids in owners.items():
        automaton.add_word(f" {w.decode('latin-1')} ",
                           (w.count(b" ") + 1, len(w) + 2, sorted(ids)))
    automaton.make_automaton()
    return automaton


def scan(text: bytes, automaton) -> tuple[int, list[int], list[int], list[str]]:
    """Number of words, disjoint runs of hit words (starts, ends) and the items found."""
    words = normal_words(text)
    starts: list[int] = []
    ends: list[int] = []
    items: set[str] = set()
    if words and automaton is not None:
        # one character for each byte; UTF-8 sequences are matched byte by byte
        line = f" {b' '.join(words).decode('latin-1')} "
        at = word = 0
        for last, (n, chars, ids) in automaton.iter(line):
            first = last - chars + 1
            if first >= at:
                word += line.count(" ", at, first)
            else:
                word -= line.count(" ", first, at)
            at = first
            items.update(ids)
            # matches come by their ends: a new run may swallow earlier ones
            begin, end = word, word + n
            while ends and ends[-1] >= begin:
                begin, end = min(begin, starts.pop()), max(end, ends.pop())
            starts.append(begin)
            ends.append(end)
    return len(words), starts, ends, sorted(items)


def original_spans(text: str, starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Character spans in the original text of runs of its normalised words."""
    edges, inside = [], False
    for i, c in enumerate(text + " "):
        b = ord(c)
        is_word = b >= 128 or WORDS[b] != 32
        if is_word != inside:
            edges.append(i)
            inside = is_word
    return [(edges[2 * s], edges[2 * e - 1]) for s, e in zip(starts, ends, strict=True)]


def _scan(items, size: int):
    made = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_HITS)
        if not made:
            made.append(build_automaton(items.value, size))
        for batch in batches:
            found = [scan(t, made[0]) for t in batch.column(2).to_pylist()]
            yield record_batch(schema, batch.num_rows, doc_id=batch.column(0),
                               version=batch.column(1), n_words=[f[0] for f in found],
                               starts=[f[1] for f in found], ends=[f[2] for f in found],
                               items=[[i.encode() for i in f[3]] for f in found])
    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_RESULT)
    for batch in batches:
        n_words = batch.column(1).to_pylist()
        runs = []
        for s, e in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            merged: list[list[int]] = []
            for a, b in sorted(zip(s, e, strict=True)):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            runs.append(merged)
        n_hit = [sum(b - a for a, b in r) for r in runs]
        items = [sorted({i.decode() for i in ids}) for ids in batch.column(4).to_pylist()]
        yield record_batch(
            schema, batch.num_rows, doc_id=batch.column(0), n_words=n_words, n_hit=n_hit,
            n_items=[len(i) for i in items],
            items_sha256=[hashlib.sha256(",".join(i).encode()).hexdigest() for i in items],
            contaminated=[h > 0 and 20 * h >= n for h, n in zip(n_hit, n_words, strict=True)],
            starts=[[a for a, _ in r] for r in runs], ends=[[b for _, b in r] for r in runs])


_RESULT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
           "contaminated boolean, starts array<int>, ends array<int>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                  chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, n_items,
    items_sha256 (sorted item ids, comma-joined), contaminated, starts and ends (runs of
    hit words; ``original_spans`` maps them to the text).

    ``benchmark`` has item_id and text.  Null texts have no words; a null item_id is
    the empty string; repeated items count once; with an empty benchmark nothing is hit.
    A document is contaminated if at least a twentieth of its words are hit, and one is.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col("doc_id").cast("long"), text_of(docs).cast("binary").alias("text"))
    items = benchmark.select(
        F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("item_id"),
        text_of(benchmark).cast("binary").alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = max(1, -(-chars // chunk_chars))
    scans = []
    for k in range(chunks):
        chunk = items.filter(F.expr(f"pmod(xxhash64(item_id), {chunks}) = {k}"))
        patterns = spark.sparkContext.broadcast(  # chunk_chars on average
            [(r.item_id, bytes(r.text)) for r in chunk.toLocalIterator()])
        version = F.lit("") if chunks == 1 else F.sha2("text", 256)
        scans.append(texts.select("doc_id", version.alias("version"), "text")
                     .mapInArrow(_scan(patterns, size), _HITS))
    found = scans[0]
    if chunks > 1:
        for other in scans[1:]:
            found = found.unionByName(other)
        found = (found.groupBy("doc_id", "version")
                 .agg(F.first("n_words").alias("n_words"),
                      F.flatten(F.collect_list("starts")).alias("starts"),
                      F.flatten(F.collect_list("ends")).alias("ends"),
                      F.flatten(F.collect_list("items")).alias("items"),
                      F.count(F.lit(1)).alias("rows"))
                 # rows that repeat an id and its text: as many as there were
                 .withColumn("copy", F.explode(F.expr(f"sequence(1, rows div {chunks})"))))
    return (found.select("doc_id", "n_words", "starts", "ends", "items")
            .mapInArrow(_digest, _RESULT))
