"""Repeated passages by suffix sorting with difference covers.

1. Whole copies of a text are set aside by hash.  Of the other texts, winnowed 32-byte
   fingerprints (every 100-byte string holds at least one, the same in each of its copies)
   travel Golomb-coded to the owners of their ranges; only the surroundings of repeated
   ones can hold repeated strings and go on.
2. These segments are range-partitioned by document and dealt into blocks.  Each block is
   suffix-sorted by difference cover: sample suffixes by triples, recursion on their
   names, the remaining suffixes merged in; the recursion ends once the names cover 100
   bytes.  Adjacent suffixes with equal prefixes are the block's repeats.
3. Blocks send the names of their distinct prefixes, sorted and Golomb-coded, to owners,
   which mark those that another block has as well.  Of the marked ones the blocks send a
   second, independent 64-bit hash with the name; only an earlier string that agrees in
   both counts as equal.
4. A string that starts earlier in the order (doc_id, place) removes its later copies.

A suffix array over all blocks at once would move each suffix several times for each of its
five levels of names; here a suffix is sorted where it lies and moves once, as a name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.exact_dedup import golomb_decode, golomb_encode
from tidemart.llm.shared import (
    arrow_schema, discard, if_small, record_batch, saved, ship_package, shuffle_parts, text_of,
)

#: Length of a repeated string; bytes of a fingerprint.
LENGTH, GRAM = 100, 32
#: Bytes of a block, at most (but for one segment's end).
BLOCK = 1 << 20
#: Strings whose names go to one owner, about; more strings have more owners.
OWNER_STRINGS = 16 << 20
#: Bits of the names that travel; strings of one name are told apart by a second hash of 64
#: bits.  Both have to agree: 112 bits, of which 2.5e10 strings (30 GB) share one by chance with
#: a probability of 6e-14.  Strings that share a name only are sent on and found different.
NAME_BITS = 48
#: Repeated fingerprints go to all tasks up to this many bytes; beyond it they are joined.
FILTER_BYTES = 64 << 20
#: Spans and ids of copies are broadcast up to this many bytes; beyond it joins shuffle.
BROADCAST_BYTES = 32 << 20

_U = np.uint64


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


#: Multipliers of the names and of the second hash.
_NAME = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_SECOND = 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F


#: Places that are named at once: their numbers stay in the processor's cache.
PLACES = 1 << 14


def prefix_names(data: np.ndarray, length: int, by: tuple[int, int] = _NAME,
                 start: int = 1) -> np.ndarray:
    """A 64-bit name of the ``length`` bytes from each place on, by doubling."""
    n = len(data) - length + 1
    if n <= PLACES:
        return _prefix_names(data, length, by, start)
    return np.concatenate([_prefix_names(data[k:k + PLACES + length - 1], length, by, start)
                           for k in range(0, n, PLACES)])


def _prefix_names(data: np.ndarray, length: int, by: tuple[int, int], start: int) -> np.ndarray:
    if len(data) < length:
        return np.zeros(0, dtype=_U)
    power, size = _mixed(data.astype(_U) + _U(start)), 1
    whole, done = None, 0
    while True:
        if length & size:
            if whole is None:
                whole = power
            else:
                n = len(data) - done - size + 1
                whole = _mixed(whole[:n] * _U(by[0]) + power[done:done + n])
            done += size
        if done == length:
            return whole[:len(data) - length + 1]
        power = _mixed(power[:-size] * _U(by[1]) + power[size:])
        size *= 2


def _sliding(f: np.ufunc, values: np.ndarray, width: int, fill: int) -> np.ndarray:
    """``f`` over every window of ``width`` values, from two runs over blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, fill, dtype=_U)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = f.accumulate(grid, axis=1).ravel()
    back = f.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(back[:n - width + 1], ahead[width - 1:n])


def winnow(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and names of the fingerprints that are the smallest in some LENGTH bytes."""
    if len(text) < LENGTH:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=_U)
    names = prefix_names(np.frombuffer(text, dtype=np.uint8), GRAM) >> _U(64 - NAME_BITS)
    width = LENGTH - GRAM + 1
    least = _sliding(np.minimum, names, width, (1 << 64) - 1)
    edge = np.zeros(width - 1, dtype=_U)
    highest = _sliding(np.maximum, np.concatenate([edge, least, edge]), width, 0)
    places = np.flatnonzero(names == highest)
    return places, names[places]


def suffix_array(symbols: np.ndarray, covered: int = 1) -> np.ndarray:
    """Places in the order of their suffixes, by difference cover modulo 3.  ``symbols`` are
    at least 1; suffixes that agree on LENGTH bytes may come in any order."""
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: tuple(symbols[i:])), dtype=np.int64)
    s = np.concatenate([symbols, np.zeros(3, dtype=np.int64)])
    bits = int(s.max()).bit_length()
    if 3 * bits > 62:
        raise ValueError("a block has too many names")
    rests, ones, twos = (n + 2) // 3, (n + 1) // 3, n // 3  # suffixes at 0, 1, 2 modulo 3

    def third(x: np.ndarray, start: int, count: int) -> np.ndarray:
        return x[start:start + 3 * count:3]

    def pair(start: int, count: int) -> np.ndarray:
        return (third(s, start, count) << bits) | third(s, start + 1, count)

    sample = np.concatenate([np.arange(1, n, 3), np.arange(2, n, 3)])
    triples = np.concatenate([(pair(k, count) << bits) | third(s, k + 2, count)
                              for k, count in ((1, ones), (2, twos))])
    order = np.argsort(triples)
    new = np.diff(triples[order], prepend=-1) != 0
    names = np.empty(len(sample), dtype=np.int64)
    names[order] = np.cumsum(new)
    if not new.all() and 3 * covered < LENGTH:
        again = np.concatenate([names[:ones], [1], names[ones:] + 1])
        again[:ones] += 1  # 1 ends the first half: smaller than any name
        order = suffix_array(again, 3 * covered)
        order = order[order != ones]
        order = np.where(order > ones, order - 1, order)
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    rank_bits = int(len(sample) + 1).bit_length()

    def one(start: int, count: int) -> np.ndarray:
        return (third(s, start, count) << rank_bits) | third(rank, start + 1, count)

    def two(start: int, count: int) -> np.ndarray:
        return (pair(start, count) << rank_bits) | third(rank, start + 2, count)

    firsts = one(0, rests)
    order_of_rest = np.argsort(firsts)
    rest = 3 * order_of_rest
    # how many sample suffixes come before each of the rest
    behind = np.searchsorted(np.sort(one(1, ones)), firsts[order_of_rest]) + np.searchsorted(
        np.sort(two(2, twos)), two(0, rests)[order_of_rest])
    # falls only among suffixes that agree on LENGTH bytes: kept in one order
    behind = np.maximum.accumulate(behind)
    place = np.concatenate([
        np.arange(len(rest)) + behind,
        np.arange(len(sample)) + np.searchsorted(behind, np.arange(len(sample)), side="right")])
    merged = np.empty(n, dtype=np.int64)
    merged[place] = np.concatenate([rest, sample[order]])
    return merged


def local_firsts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For the strings at ``starts`` (ascending) of a block: is it the first of its kind?"""
    first = np.ones(len(data), dtype=bool)
    wanted = np.zeros(len(data), dtype=bool)
    wanted[starts] = True
    order = suffix_array(data.astype(np.int64) + 1)
    order = order[wanted[order]]
    # adjacent prefixes, eight bytes at a time, where all before were equal
    packed = np.lib.stride_tricks.sliding_window_view(data, 8).copy().view(_U).ravel()
    same = np.arange(1, len(order))
    for at in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        same = same[packed[order[same] + at] == packed[order[same - 1] + at]]
    joined = np.zeros(len(order), dtype=bool)
    joined[same] = True
    runs = np.flatnonzero(~joined)
    if len(runs):
        least = np.minimum.reduceat(order, runs)
        first[order] = order == np.repeat(least, np.diff(np.append(runs, len(order))))
    return first[starts]


def _codes(schema: pa.Schema, block: int, names: np.ndarray, owners: int) -> pa.RecordBatch:
    """Sorted distinct names, cut at the owners' ranges and coded."""
    owner = (((names >> _U(NAME_BITS - 32)) * _U(owners)) >> _U(32)).astype(np.int64)
    cuts = np.searchsorted(owner, np.arange(owners + 1))
    sent = [(o, names[cuts[o]:cuts[o + 1]]) for o in np.unique(owner)]
    coded = [golomb_encode(v) for _, v in sent]
    return record_batch(schema, len(sent), block=block, owner=[o for o, _ in sent],
                        codes=[len(v) for _, v in sent], first=[int(v[0]) for _, v in sent],
                        low_bits=[c[0] for c in coded], high=[c[1] for c in coded],
                        low=[c[2] for c in coded])


_CODES = "block long, owner int, codes int, first long, low_bits int, high binary, low binary"


def _decoded(table: pa.Table) -> tuple[list[dict], list[np.ndarray]]:
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    return rows, [golomb_decode(r["codes"], r["first"], r["low_bits"], r["high"], r["low"])
                  for r in rows]


def _fingerprints(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, part = arrow_schema(_CODES), TaskContext.get().partitionId()
        names = [winnow(t)[1] for b in batches for t in b.column(0).to_pylist()]
        names = [x for x in names if len(x)]
        if names:
            values, count = np.unique(np.concatenate(names), return_counts=True)
            yield _codes(schema, 2 * part, values, owners)
            if (count > 1).any():  # sent twice: repeated here
                yield _codes(schema, 2 * part + 1, values[count > 1], owners)
    return run


def _repeated(table: pa.Table) -> pa.Table:
    """One owner: the fingerprints that it was sent more than once."""
    values, count = np.unique(np.concatenate(_decoded(table)[1]), return_counts=True)
    values = values[count > 1]
    coded = golomb_encode(values) if len(values) else (0, b"", b"")
    return pa.table({"codes": pa.array([len(values)], pa.int32()),
                     "first": pa.array([int(values[0]) if len(values) else 0], pa.int64()),
                     "low_bits": pa.array([coded[0]], pa.int32()),
                     "high": pa.array([coded[1]], pa.binary()),
                     "low": pa.array([coded[2]], pa.binary())})


_PRINTS = "doc_id long, name long"


def _doc_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct fingerprints of each document."""
    schema = arrow_schema(_PRINTS)
    for batch in batches:
        names = [np.unique(winnow(t)[1]) for t in batch.column(1).to_pylist()]
        rows = pa.array(np.repeat(np.arange(len(names)), [len(x) for x in names]), pa.int32())
        yield record_batch(schema, len(rows), doc_id=batch.column(0).take(rows),
                           name=np.concatenate([np.zeros(0, dtype=_U), *names]).view(np.int64))


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Golomb-coded fingerprints, one by one."""
    schema = arrow_schema("name long")
    for batch in batches:
        for r in batch.to_pylist():
            if r["codes"]:
                names = golomb_decode(r["codes"], r["first"], r["low_bits"], r["high"], r["low"])
                yield record_batch(schema, len(names), name=names.astype(np.int64))


_SEGMENTS = "doc_id long, sha string, at long, bytes binary, strings int"


def _segments(repeated):
    """Surroundings of repeated fingerprints, in pieces that start at most BLOCK strings;
    a fourth column has each document's repeated fingerprints if they are not broadcast."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_SEGMENTS)
        every = None if repeated is None else np.frombuffer(repeated.value, dtype=_U)
        for batch in batches:
            rows, at, cut, strings = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                if len(text) < LENGTH:
                    continue
                known = every if every is not None else np.sort(
                    np.array(batch.column(3)[i].as_py(), dtype=np.int64)).view(_U)
                places, names = winnow(text)
                found = np.searchsorted(known, names)
                hit = places[(found < len(known))
                             & (known[np.minimum(found, len(known) - 1)] == names)
                             ] if len(known) else places[:0]
                if not len(hit):
                    continue
                lo = np.maximum(hit - (LENGTH - GRAM), 0)
                hi = np.minimum(hit + LENGTH, len(text))
                new = np.concatenate([[True], lo[1:] > hi[:-1]])
                lo, hi = lo[new], hi[np.append(np.flatnonzero(new)[1:] - 1, len(hi) - 1)]
                for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
                    for start in range(a, b - LENGTH + 1, BLOCK):
                        end = min(b, start + BLOCK + LENGTH - 1)
                        rows.append(i)
                        at.append(start)
                        cut.append(text[start:end])
                        strings.append(end - start - LENGTH + 1)
            rows = pa.array(rows, pa.int32())
            yield record_batch(schema, len(rows), doc_id=batch.column(0).take(rows),
                               sha=batch.column(1).take(rows), at=at, bytes=cut, strings=strings)
    return run


_BLOCKS = ("block long, doc_ids array<long>, shas array<binary>, ats array<long>, "
           "sizes array<int>, bytes binary, firsts binary")


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Places of a block's strings: none goes over the end of its segment."""
    ends = np.cumsum(sizes)
    inside = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
    return np.flatnonzero(inside <= np.repeat(sizes, sizes) - LENGTH)


def _sorted_block(number: int, rows: list[dict]) -> pa.RecordBatch:
    sizes = np.array([len(r["bytes"]) for r in rows])
    text = b"".join(r["bytes"] for r in rows)
    data = np.frombuffer(text, dtype=np.uint8)
    first = local_firsts(data, _starts(sizes))
    return record_batch(
        arrow_schema(_BLOCKS), 1, block=number, doc_ids=[[r["doc_id"] for r in rows]],
        shas=[[r["sha"].encode() for r in rows]], ats=[[r["at"] for r in rows]],
        sizes=[sizes.tolist()], bytes=text, firsts=np.packbits(first).tobytes())


def _sort_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered segments to suffix-sorted blocks, numbered in the same order."""
    number = TaskContext.get().partitionId() << 24
    rows, size, last = [], 0, None
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["doc_id"], row["sha"], row["at"])
            if key == last:
                continue  # a repeated row of the input
            last = key
            if rows and size + len(row["bytes"]) > BLOCK:
                yield _sorted_block(number, rows)
                number, rows, size = number + 1, [], 0
            rows.append(row)
            size += len(row["bytes"])
    if rows:
        yield _sorted_block(number, rows)


def _block_strings(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: the bytes, the strings' places, and which ones are firsts."""
    data, starts = np.frombuffer(row["bytes"], dtype=np.uint8), _starts(np.array(row["sizes"]))
    first = np.unpackbits(np.frombuffer(row["firsts"], dtype=np.uint8))[:len(starts)].astype(bool)
    return data, starts, first


def _firsts(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``_block_strings`` and the names of the firsts."""
    data, starts, first = _block_strings(row)
    names = (prefix_names(data, LENGTH) >> _U(64 - NAME_BITS))[starts[first]]
    return data, starts, first, names


def _distinct(names: np.ndarray) -> np.ndarray:
    """Sorted and each once (np.unique deals integers by hash first, which takes longer)."""
    names = np.sort(names)
    return names[np.diff(names, prepend=~names[:1]) != 0]


def _block_names(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_CODES)
        for batch in batches:
            for row in batch.to_pylist():
                yield _codes(schema, row["block"], _distinct(_firsts(row)[3]), owners)
    return run


def _bitmaps(rows: list[dict], marked: np.ndarray) -> pa.Table:
    """For each row of sent strings its part of ``marked``."""
    marks = np.split(marked, np.cumsum([r["codes"] for r in rows])[:-1])
    return pa.table({"block": pa.array([r["block"] for r in rows], pa.int64()),
                     "owner": pa.array([r["owner"] for r in rows], pa.int32()),
                     "marks": pa.array([np.packbits(m).tobytes() for m in marks], pa.binary()),
                     "codes": pa.array([r["codes"] for r in rows], pa.int32())})


_ANSWERS = "block long, owner int, marks binary, codes int"


def _shared(table: pa.Table) -> pa.Table:
    """One owner: for each block a bitmap of its names that another block has sent."""
    rows, lists = _decoded(table)
    _, place, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    return _bitmaps(rows, count[place] > 1)


def _order(name: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The order by name, second hash and place.  Few names stand for several strings, so
    only those are sorted by the second hash."""
    order = np.argsort(name, kind="stable")
    n, s = name[order], second[order]
    several = n[1:][(n[1:] == n[:-1]) & (s[1:] != s[:-1])]
    if len(several):
        at = np.flatnonzero(np.isin(n, several))
        order[at] = order[at][np.lexsort((s[at], n[at]))]
    return order


_PAIRS = _CODES + ", seconds binary"


def _pairs(row: dict, block: tuple) -> tuple[np.ndarray,
                                             list[tuple[int, np.ndarray, np.ndarray]]]:
    """Of a block (and its ``_firsts``) with the owners' bitmaps: for each first the place of its string in the
    list of all strings that are sent again (-1: in no other block), and that list: for
    each owner names and second hashes, in this order and each pair once."""
    data, starts, first, names = block
    answers = sorted(row["answers"], key=lambda a: a["owner"])
    bits = [np.unpackbits(np.frombuffer(a["marks"], dtype=np.uint8))[:a["codes"]]
            for a in answers]
    distinct, place = np.unique(names, return_inverse=True)
    again = np.concatenate(bits).astype(bool)[place] if bits else np.zeros(0, dtype=bool)
    owner = np.repeat([a["owner"] for a in answers], [a["codes"] for a in answers])[place[again]]
    second = prefix_names(data, LENGTH, _SECOND, 257)[starts[first][again]]
    name = names[again]
    order = _order(name, second)
    new = np.ones(len(order), dtype=bool)
    new[1:] = ((name[order][1:] != name[order][:-1])
               | (second[order][1:] != second[order][:-1]))
    at = np.full(len(names), -1)
    at[np.flatnonzero(again)[order]] = np.cumsum(new) - 1
    kept = order[new]
    cuts = np.flatnonzero(np.diff(owner[kept], prepend=-1))
    return at, [(int(owner[part[0]]), name[part], second[part])
                for part in np.split(kept, cuts[1:]) if len(part)]


def _send_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_PAIRS)
    for batch in batches:
        for row in batch.to_pylist():
            sent = _pairs(row, _firsts(row))[1]
            coded = [golomb_encode(n) for _, n, _ in sent]
            yield record_batch(schema, len(sent), block=row["block"], owner=[o for o, _, _ in sent],
                               codes=[len(n) for _, n, _ in sent],
                               first=[int(n[0]) for _, n, _ in sent],
                               low_bits=[c[0] for c in coded], high=[c[1] for c in coded],
                               low=[c[2] for c in coded], seconds=[x.tobytes() for _, _, x in sent])


def _earlier(table: pa.Table) -> pa.Table:
    """One owner: for each block a bitmap of its strings that an earlier block has sent,
    equal in name and second hash."""
    rows, lists = _decoded(table)
    name = np.concatenate(lists)
    second = np.concatenate([np.frombuffer(r["seconds"], dtype=_U) for r in rows])
    order = _order(name, second)  # the blocks' order within equal strings
    marked = np.zeros(len(order), dtype=bool)
    marked[order[1:]] = ((name[order[1:]] == name[order[:-1]])
                         & (second[order[1:]] == second[order[:-1]]))
    return _bitmaps(rows, marked)


_SPANS = "doc_id long, sha string, starts array<long>, ends array<long>"


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the owners' answers to the removed spans of each segment."""
    schema = arrow_schema(_SPANS)
    for batch in batches:
        for row in batch.to_pylist():
            sizes = np.array(row["sizes"])
            marks = np.concatenate([np.zeros(0, dtype=np.uint8), *(
                np.unpackbits(np.frombuffer(a["marks"], dtype=np.uint8))[:a["codes"]]
                for a in sorted(row["earlier"] or (), key=lambda a: a["owner"]))]).astype(bool)
            data, starts, first = _block_strings(row)
            gone = ~first
            if marks.any():  # a first of the block starts in an earlier one
                at, _ = _pairs(row, _firsts(row))
                gone[np.flatnonzero(first)] = (at >= 0) & marks[at]
            edge = np.zeros(len(data) + 1, dtype=np.int32)
            edge[starts[gone]] += 1  # no place comes twice
            edge[starts[gone] + LENGTH] -= 1
            covered = (np.cumsum(edge[:-1]) > 0).astype(np.int8)
            out = []
            ends = np.cumsum(sizes)
            for lo, hi, at in zip(ends - sizes, ends, row["ats"], strict=True):
                turn = np.diff(covered[lo:hi], prepend=0, append=0)
                out.append(((np.flatnonzero(turn == 1) + at).tolist(),
                            (np.flatnonzero(turn == -1) + at).tolist()))
            some = [i for i, x in enumerate(out) if x[0]]
            yield record_batch(schema, len(some), doc_id=[row["doc_ids"][i] for i in some],
                               sha=[row["shas"][i].decode() for i in some],
                               starts=[out[i][0] for i in some], ends=[out[i][1] for i in some])


_CLEAN = ("doc_id long, n_bytes long, n_removed long, n_spans long, bytes binary, "
          "kept_sha256 string")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_CLEAN)
    for batch in batches:
        sizes, removed, spans, kept = [], [], [], []
        for text, a, b, copy in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4)),
                                    strict=True):
            runs: list[list[int]] = []
            if copy and len(text) >= LENGTH:
                runs = [[0, len(text)]]
            else:
                for x, y in sorted(zip(a or (), b or (), strict=True)):
                    if runs and x <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], y)
                    else:
                        runs.append([x, y])
            edges = [0, *(x for run in runs for x in run), len(text)]
            sizes.append(len(text))
            removed.append(sum(y - x for x, y in runs))
            spans.append(len(runs))
            kept.append(b"".join(text[x:y] for x, y in zip(edges[0::2], edges[1::2],
                                                           strict=True)))
        yield record_batch(schema, batch.num_rows, doc_id=batch.column(0), n_bytes=sizes,
                           n_removed=removed, n_spans=spans, bytes=kept,
                           kept_sha256=[hashlib.sha256(k).hexdigest() for k in kept])


def _by_block(answers: DataFrame, name: str) -> DataFrame:
    return answers.groupBy("block").agg(
        F.collect_list(F.struct("owner", "marks", "codes")).alias(name))


def suffix_dedup(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs), bytes (what remains; it may cut a character) and kept_sha256.

    Every byte goes that a string of LENGTH bytes covers which also starts earlier (in a
    smaller doc_id, or further ahead in the document); strings never cross documents and
    are judged on the input.  Null and empty texts have no bytes.  A null doc_id is the
    smallest; rows with one doc_id and different texts go by the hash of their texts; rows
    that repeat a doc_id and its text are one document, and each gets its result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    owners = owners or shuffle_parts(spark)
    none = -(1 << 63)
    texts = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(none)).alias("doc_id"),
                        F.sha2(text_of(docs), 256).alias("sha"),
                        text_of(docs).cast("binary").alias("text"))
    # whole copies: all but the smallest doc_id of a text
    ids = saved(texts.select("doc_id", "sha"), "text-hashes")
    keep = ids.groupBy("sha").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    copies = saved(ids.join(keep.filter("low < high"), "sha").filter("doc_id > low")
                   .select(F.col("doc_id").alias("copy_id"), F.col("sha").alias("copy_sha"))
                   .distinct(), "copies")
    copies = if_small(copies, F.lit(80), BROADCAST_BYTES)
    is_copy = (F.col("doc_id") == F.col("copy_id")) & (F.col("sha") == F.col("copy_sha"))
    singles = texts.join(copies, is_copy, "left_anti")

    sent = saved(singles.select("text").mapInArrow(_fingerprints(owners), _CODES), "prints")
    repeated = saved(sent.groupBy("owner").applyInArrow(
        _repeated, "codes int, first long, low_bits int, high binary, low binary"), "repeated")
    n_repeated = repeated.agg(F.sum("codes")).first()[0] or 0
    if 8 * n_repeated <= FILTER_BYTES:
        lists = [golomb_decode(r.codes, r.first, r.low_bits, bytes(r.high), bytes(r.low))
                 for r in repeated.filter("codes > 0").collect()]
        known = spark.sparkContext.broadcast(
            np.sort(np.concatenate(lists)).tobytes() if lists else b"")
        around = singles.select("doc_id", "sha", "text")
    else:
        known = None
        prints = singles.select("doc_id", "text").mapInArrow(_doc_prints, _PRINTS)
        hits = (prints.join(repeated.mapInArrow(_names, "name long"), "name", "left_semi")
                .groupBy("doc_id").agg(F.collect_set("name").alias("names")))
        around = singles.join(hits, "doc_id").select("doc_id", "sha", "text", "names")
    segments = saved(around.mapInArrow(_segments(known), _SEGMENTS), "segments")
    total = segments.agg(F.sum("strings")).first()[0] or 0
    parts = max(shuffle_parts(spark), -(-total // (4 * BLOCK)))
    blocks = saved(segments.repartitionByRange(parts, "doc_id", "sha", "at")
                   .sortWithinPartitions("doc_id", "sha", "at")
                   .select("doc_id", "sha", "at", "bytes")
                   .mapInArrow(_sort_blocks, _BLOCKS), "blocks")
    discard(segments)  # the blocks hold the same bytes
    names = blocks.select("block", "sizes", "bytes", "firsts").mapInArrow(
        _block_names(max(owners, -(-total // OWNER_STRINGS))), _CODES)
    shared = names.groupBy("owner").applyInArrow(_shared, _ANSWERS)
    asked = saved(_by_block(shared, "answers"), "shared")
    pairs = (blocks.select("block", "sizes", "bytes", "firsts").join(asked, "block")
             .mapInArrow(_send_pairs, _PAIRS))
    earlier = _by_block(pairs.groupBy("owner").applyInArrow(_earlier, _ANSWERS), "earlier")
    found = (blocks.join(asked, "block").join(earlier, "block", "left").drop("block")
             .mapInArrow(_spans, _SPANS))
    spans = saved(found.groupBy("doc_id", "sha").agg(
        F.flatten(F.collect_list("starts")).alias("starts"),
        F.flatten(F.collect_list("ends")).alias("ends")), "spans")
    spans = if_small(spans, 80 + 16 * F.size("starts"), BROADCAST_BYTES).select(
        F.col("doc_id").alias("span_id"), F.col("sha").alias("span_sha"), "starts", "ends")
    marked = (texts.join(spans, (F.col("doc_id") == F.col("span_id"))
                         & (F.col("sha") == F.col("span_sha")), "left")
              .join(copies, is_copy, "left")
              .select(F.expr(f"nullif(doc_id, {none})").alias("doc_id"), "text", "starts", "ends",
                      F.col("copy_id").isNotNull().alias("copy")))
    return marked.mapInArrow(_cut, _CLEAN)
