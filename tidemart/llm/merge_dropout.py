"""SentencePiece encoding with seeded merge-dropout, and its inverse.

The agenda holds the candidate merges of neighbouring pieces, best score first, then
leftmost.  A candidate taken from it is skipped if a keyed 64-bit hash of the word's occurrence
(seed, document and the word's position in it), its place and its pieces' sizes falls under
the dropout rate.  Each occurrence of a word is drawn anew, however often the word or the
whole text occurs; the hash alone decides, so a run repeated on any cluster gives the same
pieces.

The words of a batch of documents that a worker does not know yet are merged together:
each has its own agenda, and a step takes the top of every one.  Words are independent (no
piece of the vocabulary goes on after another character into a space).  What an agenda does
next depends on the skips so far alone, so a worker remembers a word as a tree: a node is the
candidate on top, its two branches are the agenda with that candidate skipped or merged, a leaf
holds the pieces.  An occurrence walks down by its own hashes; where the tree ends, its agenda is
worked off and the path is added.  The trees' size is bounded, which changes no result: words
beyond it are merged each time.  Characters without a piece are spelled in bytes, and so is the
space mark itself where a text contains it: decoding is lossless for every text.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tidemart.llm.shared import arrow_schema, record_batch, ship_package, text_of

SPACE = "▁"
DROPOUT = 0.1
#: Nodes and leaves of the words that a worker remembers, and the length of such a word.
NODES, LEAVES, MEMORY_CHARS = 400_000, 200_000, 40
_MASK = (1 << 64) - 1


@dataclass(frozen=True)
class Pieces:
    ids: dict[str, int]
    scores: dict[str, float]
    bytes_: tuple[int, ...]  # id of each byte's piece

    @classmethod
    def load(cls, path: str) -> Pieces:
        model = SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size())
                 if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
                         or model.is_unused(i))]
        names = [model.id_to_piece(i) for i in plain]
        if any(re.search(f"[^{SPACE}]{SPACE}", n) for n in names):
            raise ValueError("pieces that go on over a space: words are not independent")
        spelled = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
        if model.unk_id() in spelled:
            raise ValueError("the vocabulary has no byte pieces: decoding would lose text")
        return cls(dict(zip(names, plain, strict=True)),
                   {n: model.get_score(i) for n, i in zip(names, plain, strict=True)}, spelled)


def ranks(scores: dict[str, float]) -> dict[str, int]:
    """Places of the pieces in the agenda's order: the best score first, ties alike."""
    place = {v: i for i, v in enumerate(sorted(set(scores.values()), reverse=True))}
    return {p: place[v] for p, v in scores.items()}


def skip_limit(rate: float) -> int | None:
    """The largest 64-bit hash that skips a merge."""
    return round(rate * (1 << 64)) - 1 if rate else None


_ODD, _M1, _M2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_M1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_M2)
    return x ^ (x >> np.uint64(31))


def mixed_one(x: int) -> int:
    """``mixed`` of one number."""
    x = ((x ^ (x >> 30)) * _M1) & _MASK
    x = ((x ^ (x >> 27)) * _M2) & _MASK
    return x ^ (x >> 31)


def segment(symbols: list[str], rank: dict[str, int], limit: int | None, key: int) -> list[str]:
    """Byte-pair merges of ``symbols`` by agenda; ``key`` decides which ones are skipped."""
    n = len(symbols)
    bits = max(10, n.bit_length())
    mask, top = (1 << bits) - 1, 3 * bits
    piece = list(symbols)
    size = [1] * n  # symbols in the piece that begins here; 0: merged away
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    # an entry is one number: rank, place of the left piece, sizes of both
    agenda = [(r << top) + (a << 2 * bits) + (1 << bits) + 1 for a, r in enumerate(
        [rank.get(x + y) for x, y in zip(symbols, symbols[1:])]) if r is not None]
    heapq.heapify(agenda)
    get, pop, push = rank.get, heapq.heappop, heapq.heappush
    while agenda:
        entry = pop(agenda)
        a, left, right = (entry >> 2 * bits) & mask, (entry >> bits) & mask, entry & mask
        b = a + left
        if size[a] != left or b >= n or size[b] != right:
            continue  # one of its pieces has been merged meanwhile
        if limit is not None and mixed_one(
                (key + ((a << 40) + (left << 20) + right) * _ODD) & _MASK) <= limit:
            continue
        piece[a] = merged = piece[a] + piece[b]
        size[a], size[b] = left + right, 0
        after[a] = c = after[b]
        if c < n:
            before[c] = a
            r = get(merged + piece[c])
            if r is not None:
                push(agenda, (r << top) + (a << 2 * bits) + (size[a] << bits) + size[c])
        c = before[a]
        if c >= 0:
            r = get(piece[c] + merged)
            if r is not None:
                push(agenda, (r << top) + (c << 2 * bits) + (size[c] << bits) + size[a])
    return [p for p, s in zip(piece, size, strict=True) if s]


class Merges:
    """Agendas of many words worked off at once, a step of each word at a time.

    Symbols are numbers: the pieces' ids, then a number for each other character that
    pieces hold, and one (``none``) that never merges, for all the rest.  A word is a
    column; its candidates stand in the row of their left piece, so the smallest number of
    a column, (rank, row), is the top of that word's agenda.  The pieces are those of
    ``segment``, merge for merge.
    """

    #: Longest word in symbols, and words worked off together.
    LENGTH, WORDS = 60, 1 << 12
    _ROW = 6  # bits of a row in a candidate
    _NEVER = np.iinfo(np.int32).max
    _ODD = np.uint64(_ODD)

    def __init__(self, ids: dict[str, int], rank: dict[str, int]):
        self.first = max(ids.values()) + 1  # numbers from here on are no ids
        number = dict(ids)
        for c in sorted({c for n in ids for c in n} - ids.keys()):
            number[c] = len(number) - len(ids) + self.first
        self.none = max(number.values()) + 1
        self.symbol = np.full(0x110000, self.none, dtype=np.int32)
        for n, i in number.items():
            if len(n) == 1:
                self.symbol[ord(n)] = i
        pairs = np.array([(number[n[:k]], number[n[k:]], rank[n], i) for n, i in ids.items()
                          for k in range(1, len(n)) if n[:k] in number and n[k:] in number],
                         dtype=np.int64).reshape(-1, 4)
        # open addressing: a pair lies in the first free slot from its own one on
        bits = max(4, (8 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.rank = np.full(1 << bits, self._NEVER, dtype=np.int32)
        self.made = np.zeros(1 << bits, dtype=np.int32)
        keys = pairs[:, 0] * (self.none + 1) + pairs[:, 1]
        slots, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slots[left]] == -1]
            self.keys[slots[free]] = keys[free]  # of several in one slot the last one stays
            done = left[self.keys[slots[left]] == keys[left]]
            self.rank[slots[done]] = pairs[done, 2] << self._ROW
            self.made[slots[done]] = pairs[done, 3]
            left = np.setdiff1d(left, done, assume_unique=True)
            slots[left] = (slots[left] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * self._ODD) >> self.shift).view(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slots of pairs of symbols; a pair that is no piece gets an empty one."""
        keys = left.astype(np.int64) * (self.none + 1) + right
        slots = self._slots(keys)
        found = self.keys[slots]
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            found = self.keys[slots[open_]]
            open_ = open_[(found != keys[open_]) & (found != -1)]
        return slots

    def segment(self, symbols: np.ndarray, limit: int | None, keys: np.ndarray,
                trace: list | None = None) -> np.ndarray:
        """Pieces of words: ``symbols`` has a word in each column, a row of ``none`` before
        and after it and -1 nowhere; the result has -1 where a symbol was merged away.
        ``trace`` gets the columns, candidates and skips of each step."""
        rows, n = symbols.shape
        out = symbols.copy()
        word = np.arange(n)
        piece, size = symbols.copy(), np.ones((rows, n), dtype=np.int32)
        before = np.repeat(np.arange(-1, rows - 1, dtype=np.int32)[:, None], n, axis=1)
        agenda = np.full((rows, n), self._NEVER, dtype=np.int32)
        first = self.rank[self.find(piece[:-1].ravel(), piece[1:].ravel())].reshape(rows - 1, n)
        row = np.arange(rows - 1, dtype=np.int32)[:, None]
        agenda[:-1] = np.where(first == self._NEVER, first, first + row)
        low = (1 << self._ROW) - 1
        while n:
            top = agenda.min(axis=0)
            at = np.flatnonzero(top != self._NEVER)
            if 4 * len(at) < 3 * n:  # words that are done make room
                ended = np.flatnonzero(top == self._NEVER)
                out[:, word[ended]] = piece[:, ended]
                word, n = word[at], len(at)
                piece, size, before, agenda = (
                    np.ascontiguousarray(x[:, at]) for x in (piece, size, before, agenda))
                top, at = top[at], np.arange(n)
                if not n:
                    break
            flat = [x.reshape(-1) for x in (piece, size, before, agenda)]
            pieces, sizes, befores, agendas = flat
            a = (top[at] & low).astype(np.int64)
            left_at = a * n + at
            left = sizes[left_at]
            right_at = left_at + left.astype(np.int64) * n
            right = sizes[right_at]
            if limit is not None:
                place = ((a - 1) << 40) + (left.astype(np.int64) << 20) + right
                skip = mixed(keys[word[at]] + place.view(np.uint64) * self._ODD) <= np.uint64(limit)
                if trace is not None:
                    trace.append((word[at], place, skip))
                agendas[left_at[skip]] = self._NEVER
                go = np.flatnonzero(~skip)
                at, a, left_at, right_at = at[go], a[go], left_at[go], right_at[go]
                left, right = left[go], right[go]
            merged = self.made[self.find(pieces[left_at], pieces[right_at])]
            pieces[left_at], pieces[right_at] = merged, -1
            sizes[left_at] = left + right
            agendas[right_at] = self._NEVER
            next_at = right_at + right.astype(np.int64) * n
            befores[next_at] = a
            prev = befores[left_at]
            prev_at = prev.astype(np.int64) * n + at
            for x, y, place, r in ((left_at, next_at, left_at, a), (prev_at, left_at, prev_at, prev)):
                rank = self.rank[self.find(pieces[x], pieces[y])]
                agendas[place] = np.where(rank == self._NEVER, rank, rank + r.astype(np.int32))
        return out


#: Codes of an occurrence on its way: a node (0 or more), not known, or -2 - the leaf.
_UNKNOWN = -1


class Paths:
    """Decision trees of words, in flat arrays that tasks of a worker share."""

    def __init__(self, nodes: int, leaves: int):
        self.place = np.zeros(nodes, dtype=np.int64)  # the candidate on top of the agenda
        self.branch = np.full(2 * nodes, _UNKNOWN, dtype=np.int32)  # merged, skipped
        self.root: dict[str, int] = {}
        self.leaves: list[bytes] = []
        self.nodes, self.limits = 0, (nodes, leaves)

    def walk(self, words: list[str], keys: np.ndarray, limit: int | None) -> np.ndarray:
        """The code at which each occurrence ends: a leaf, or not known."""
        get = self.root.get
        codes = np.fromiter([get(w, _UNKNOWN) for w in words], np.int64, len(words))
        at = np.flatnonzero(codes >= 0)
        while len(at):
            node = codes[at]
            skip = mixed(keys[at] + self.place[node].view(np.uint64)
                         * np.uint64(_ODD)) <= np.uint64(limit)
            codes[at] = found = self.branch[2 * node + skip]
            at = at[found >= 0]
        return codes

    def learn(self, word: str, places: list[int], skips: list[bool], ids: bytes) -> None:
        """Add the path of an occurrence, if there is room."""
        if (self.nodes + len(places) > self.limits[0]
                or len(self.leaves) == self.limits[1]):
            return
        slot, code = -1, self.root.get(word, _UNKNOWN)
        for place, skip in zip(places, skips, strict=True):
            if code == _UNKNOWN:
                code, self.nodes = self.nodes, self.nodes + 1
                self.place[code] = place
                if slot < 0:
                    self.root[word] = code
                else:
                    self.branch[slot] = code
            slot = 2 * code + skip
            code = int(self.branch[slot])
        if code == _UNKNOWN:  # else another occurrence of the batch was as this one
            code = -2 - len(self.leaves)
            self.leaves.append(ids)
            if slot < 0:
                self.root[word] = code
            else:
                self.branch[slot] = code


class Codec:
    def __init__(self, pieces: Pieces, rate: float, seed: int, nodes: int = NODES,
                 leaves: int = LEAVES):
        self.pieces, self.rate, self.seed = pieces, rate, seed
        self.ranks = ranks(pieces.scores)
        self.limit = skip_limit(rate)
        self.merges = Merges(pieces.ids, self.ranks)
        self.paths = Paths(nodes, leaves)
        self.texts: dict[int, bytes] = {i: n.replace(SPACE, " ").encode()
                                        for n, i in pieces.ids.items()}
        self.texts |= {i: bytes([b]) for b, i in enumerate(pieces.bytes_)}

    def keys(self, doc: int | None, n: int) -> np.ndarray:
        """The keys of a document's ``n`` words, by position."""
        first = xxhash.xxh3_64_intdigest(str(doc).encode(), seed=self.seed & _MASK)
        return mixed(np.uint64(first) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD))

    def word(self, word: str, key: int) -> bytes:
        """Ids of a word with one space before it, as 32-bit integers; ``key`` decides
        which merges are skipped."""
        lead = len(word) - len(word.lstrip(" "))
        # a space mark in the text itself must not become a space: it has no symbol
        symbols = [SPACE] * (lead + 1) + ["" if c == SPACE else c for c in word[lead:]]
        ids: list[int] = []
        runs = [symbols]
        if "" in symbols:  # nothing merges over such a place
            runs, run = [], []
            for s in symbols:
                if s:
                    run.append(s)
                else:
                    runs += [run, [""]]
                    run = []
            runs.append(run)
        for number, run in enumerate(runs):
            if run == [""]:
                ids += [self.pieces.bytes_[b] for b in SPACE.encode()]
                continue
            for p in segment(run, self.ranks, self.limit, (key + number) & _MASK):
                known = self.pieces.ids.get(p)
                ids += [known] if known is not None else [self.pieces.bytes_[b]
                                                          for b in p.encode()]
        return np.array(ids, dtype="<u4").tobytes()

    def words(self, words: list[str], keys: np.ndarray) -> list[bytes]:
        """``word`` of many: long words and those with a space mark by themselves, the
        rest in columns of similar length.  Their paths are remembered."""
        made = self.merges
        out = [b""] * len(words)
        classes: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if len(w) >= made.LENGTH or SPACE in w:
                out[k] = self.word(w, int(keys[k]))
            else:
                classes.setdefault(len(w) + 3 & ~3, []).append(k)
        for length, members in classes.items():
            for start in range(0, len(members), made.WORDS):
                part = members[start:start + made.WORDS]
                # "\0" fills up a column and is told apart by the word's length
                joined = "".join([(SPACE + words[k].replace(" ", SPACE)).ljust(length + 1, "\0")
                                  for k in part])
                points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4").reshape(
                    len(part), length + 1).T
                symbols = np.full((length + 3, len(part)), made.none, dtype=np.int32)
                symbols[1:-1] = made.symbol[points]
                lengths = np.array([len(words[k]) + 1 for k in part])
                rows = np.arange(length + 1)[:, None]
                filled = rows >= lengths
                symbols[1:-1][filled] = made.none
                trace: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                found = made.segment(symbols, self.limit, keys[part], trace)[1:-1]
                found[filled] = -1
                stays = found.T >= 0
                ids = found.T[stays]
                ends = np.cumsum(stays.sum(axis=1))
                spelled = np.flatnonzero(ids >= made.first)
                if len(spelled):  # characters without a piece
                    ids, ends = self._spell(ids, ends, spelled, points.T[stays])
                data, at = ids.astype("<u4").tobytes(), 0
                for k, end in zip(part, (4 * ends).tolist(), strict=True):
                    out[k] = data[at:end]
                    at = end
                self._learn([words[k] for k in part], [out[k] for k in part], trace)
        return out

    def _learn(self, words: list[str], ids: list[bytes], trace: list) -> None:
        """Remember the paths of words that were merged together."""
        if not (self.paths.nodes < self.paths.limits[0]
                and len(self.paths.leaves) < self.paths.limits[1]):
            return
        column = np.concatenate([t[0] for t in trace]) if trace else np.zeros(0, dtype=np.int64)
        order = np.argsort(column, kind="stable")
        ends = np.cumsum(np.bincount(column, minlength=len(words))).tolist()
        places = np.concatenate([t[1] for t in trace])[order].tolist() if trace else []
        skips = np.concatenate([t[2] for t in trace])[order].tolist() if trace else []
        at = 0
        for word, x, end in zip(words, ids, ends, strict=True):
            if len(word) <= MEMORY_CHARS:
                self.paths.learn(word, places[at:end], skips[at:end], x)
            at = end

    def _spell(self, ids: np.ndarray, ends: np.ndarray, spelled: np.ndarray,
               points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` with byte pieces for the characters (``points``) at ``spelled``."""
        encoded = [chr(p).encode() for p in points[spelled].tolist()]
        counts = np.ones(len(ids), dtype=np.int64)
        counts[spelled] = [len(b) for b in encoded]
        longer = np.repeat(ids, counts)
        places = np.repeat(ids >= self.merges.first, counts)
        longer[places] = np.array(self.pieces.bytes_)[np.frombuffer(b"".join(encoded), np.uint8)]
        return longer, np.concatenate([[0], np.cumsum(counts)])[ends]

    def _split(self, text: str) -> list[str]:
        words = text.split(" ")
        if "" in words:  # runs of spaces belong to the word after them
            joined, lead = [], 0
            for w in words[:-1]:
                if w:
                    joined.append(" " * lead + w)
                    lead = 0
                else:
                    lead += 1
            words = [*joined, " " * lead + words[-1]]
        return words

    def encode(self, texts: list[str], docs: list[int | None]) -> list[bytes]:
        """Ids of each text; the empty text has none."""
        parts = [self._split(t) if t else [] for t in texts]
        words = [w for part in parts for w in part]
        if not words:
            return [b""] * len(texts)
        if self.limit is None:  # no draws: the occurrences of a word are alike
            keys = np.zeros(len(words), dtype=np.uint64)
        else:
            keys = np.concatenate([self.keys(d, len(p)) for d, p in zip(docs, parts, strict=True)])
        codes = self.paths.walk(words, keys, self.limit)
        new = np.flatnonzero(codes == _UNKNOWN)
        leaves = self.paths.leaves
        ids = [b"" if c == _UNKNOWN else leaves[-2 - c] for c in codes.tolist()]
        if self.limit is None:
            names = list(dict.fromkeys(words[k] for k in new.tolist()))
            made = dict(zip(names, self.words(names, keys[:len(names)]), strict=True))
            for k in new.tolist():
                ids[k] = made[words[k]]
        else:
            for k, x in zip(new.tolist(), self.words([words[k] for k in new.tolist()], keys[new]),
                            strict=True):
                ids[k] = x
        ends = np.cumsum([0, *map(len, parts)]).tolist()
        return [b"".join(ids[a:b]) for a, b in zip(ends, ends[1:])]

    def decode(self, ids: bytes) -> str:
        texts = self.texts
        return b"".join([texts[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])[1:].decode()


#: One codec in each worker process, kept from task to task.
_CODECS: dict[tuple, Codec] = {}


def codec(pieces: Pieces, rate: float, seed: int) -> Codec:
    key = (zlib.crc32(repr(sorted(pieces.ids.items())).encode()), rate, seed)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(pieces, rate, seed)
    return _CODECS[key]


_IDS = "doc_id long, n_pieces long, ids_crc32 long, lossless boolean, ids array<int>"


def _encode(pieces, rate: float, seed: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, made = arrow_schema(_IDS), codec(pieces.value, rate, seed)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                ids = made.encode(texts, docs)
                lists = pa.nulls(len(ids), schema.field("ids").type)
                if keep_ids:
                    ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
                yield record_batch(
                    schema, len(ids), doc_id=batch.column(0), ids=lists,
                    n_pieces=[len(x) // 4 for x in ids], ids_crc32=[zlib.crc32(x) for x in ids],
                    lossless=[made.decode(x) == t for x, t in zip(ids, texts, strict=True)])
    return run


def encode_pieces(docs: DataFrame, pieces: Pieces, rate: float = DROPOUT, seed: int = 1,
                  keep_ids: bool = True) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of the ids as little-endian 32-bit integers), lossless
    (the ids decode to the very text) and ids (null unless kept) for each row of ``docs``
    (doc_id, text).  Null and empty texts have no pieces; rate 0 gives the tokenizer's
    own segmentation."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(pieces)
    return (docs.select(F.col("doc_id").cast("long"), text_of(docs).alias("text"))
            .mapInArrow(_encode(held, rate, seed, keep_ids), _IDS))


def _decode(pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, made = arrow_schema("doc_id long, text string"), codec(pieces.value, 0.0, 0)
        for batch in batches:
            texts = [made.decode(np.array(x or (), dtype="<u4").tobytes())
                     for x in batch.column(1).to_pylist()]
            yield record_batch(schema, batch.num_rows, doc_id=batch.column(0), text=texts)
    return run


def decode_pieces(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id and text of rows with doc_id and ids (null: no ids)."""
    ship_package(encoded.sparkSession)
    held = encoded.sparkSession.sparkContext.broadcast(pieces)
    return encoded.select("doc_id", "ids").mapInArrow(_decode(held), "doc_id long, text string")
