"""Each operator against brute force, on small tables with the awkward cases."""

import os
import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from tidemart.llm import (  # noqa: E402
    chat_windows, decontamination, exact_dedup, line_dedup, merge_dropout, near_dedup,
    suffix_dedup, token_counts, token_files, toxicity,
)
from tidemart.llm.shared import roots  # noqa: E402
from tidemart.session import work_path  # noqa: E402

SCHEMA = "doc_id long, text string, sha string, size long, class string, ids array<int>"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def made_docs():
    """Copies, near copies, shared lines and passages, blanks, nulls, odd and long texts."""
    rng = random.Random(3)
    vocab = ["".join(rng.choice("aeioustrnlé") for _ in range(rng.randint(2, 7)))
             for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    line, passage = prose(12), prose(40)
    texts = [prose(rng.randint(1, 120)) for _ in range(60)]
    for k in range(12):  # near copies of one text: a few words changed
        words = texts[50].split() * 2
        for _ in range(k % 4):
            words[rng.randrange(len(words))] = "other"
        texts.append(" ".join(words))
    texts += [texts[0]] * 9 + [texts[1]] * 2
    texts += [f"{prose(8)}\n  {line.upper() if k % 2 else line}\t\n{prose(5)}" for k in range(8)]
    texts += [prose(10) + passage + prose(10) for _ in range(4)]
    texts += [None, "", "", " \n\t ", "a", "two words", "x\n\n\ny", "é😀 ▁ \x00 　z",
              "aaaa" * 700, prose(9000), "a  b   c \n d ", "<|x|> & < &lt; \\"]
    return list(enumerate(texts))


DOCS = made_docs()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, "c", [1]) for i, t in rows], SCHEMA).repartition(5)


def got(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select(columns[0], *columns[1:]).collect()}


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, empty):
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got(exact_dedup.exact_dedup(docs), *cols) == brute.exact(DOCS)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_keeps_one_of_repeated_rows(spark):
    rows = [(1, "same"), (1, "same"), (None, "same"), (2, "x"), (2, "y"), (None, None)]
    found = exact_dedup.exact_dedup(frame(spark, rows))
    kept = [(r.doc_id, r.text_sha256) for r in found.filter("kept").collect()]
    assert sorted(kept, key=str) == sorted(
        [(1, brute.sha("same")), (2, brute.sha("x")), (2, brute.sha("y")),
         (None, brute.sha(""))], key=str)
    left = exact_dedup.drop_copies(frame(spark, rows))
    assert left.columns == SCHEMA_COLUMNS and left.count() == 4


SCHEMA_COLUMNS = [c.split(" ")[0] for c in SCHEMA.split(", ")]


def test_golomb_round_trip():
    import numpy as np
    rng = np.random.default_rng(1)
    for n, top in ((1, 1 << 47), (2, 5), (500, 1 << 48), (1000, 1200), (3, 1 << 61)):
        values = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        low_bits, high, low = exact_dedup.golomb_encode(values)
        back = exact_dedup.golomb_decode(len(values), int(values[0]), low_bits, high, low)
        assert (back == values).all()


def test_line_dedup(docs, empty):
    cols = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got(line_dedup.line_dedup(docs), *cols) == brute.lines(DOCS)
    assert line_dedup.line_dedup(empty).count() == 0


def test_decontamination(spark, docs, empty):
    whole = DOCS[40][1]
    items = [(1, whole), (2, "Two  words!"), (3, None), (None, "a"), (4, DOCS[50][1]), (4, "")]
    bench = spark.createDataFrame([(i, t, "q") for i, t in items],
                                  "item_id long, text string, doc_id string")
    want = brute.contamination(DOCS, [("" if i is None else i, t) for i, t in items])
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got(decontamination.decontaminate(docs, bench), *cols) == want
    # the same rows if the benchmark needs several automata
    assert got(decontamination.decontaminate(docs, bench, chunk_chars=300), *cols) == want
    none = decontamination.decontaminate(docs, bench.limit(0))
    assert none.filter("n_hit > 0").count() == 0
    assert decontamination.decontaminate(empty, bench).count() == 0


def test_offsets_map_to_the_original():
    automaton = decontamination.build_automaton([("q", b"Four SCORE and, seven")])
    text = "Ünd: four -- score AND seven, years"
    _, starts, ends, items = decontamination.scan(text.encode(), automaton)
    (a, b), = decontamination.original_spans(text, starts, ends)
    assert (text[a:b], items) == ("four -- score AND seven", ["q"])


def test_near_dedup(docs, empty):
    cols = ("doc_id", "n_shingles", "component_id", "kept")
    assert got(near_dedup.near_dedup(docs, words=4), *cols) == brute.near(DOCS)
    assert near_dedup.near_dedup(empty).count() == 0


def test_near_dedup_in_blocks(spark, monkeypatch):
    """A cluster dealt into pairs of blocks gives the same components."""
    monkeypatch.setattr(near_dedup, "GROUP_SHINGLES", 600)
    rows = [d for d in DOCS if 50 <= d[0] < 80]
    found = near_dedup.near_dedup(frame(spark, rows), words=4)
    assert got(found, "doc_id", "n_shingles", "component_id", "kept") == brute.near(rows)


def test_near_dedup_links_short_near_copies(spark):
    """Many pairs of 7 to 15 words, the second without the last word of the first."""
    rng = random.Random(11)
    rows = []
    for k in range(1800):
        words = [f"w{rng.randrange(10 ** 9)}" for _ in range(8 if k % 2 else rng.randint(7, 15))]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:-1]))]
    found = near_dedup.near_dedup(frame(spark, rows), words=4)
    assert got(found, "doc_id", "n_shingles", "component_id", "kept") == brute.near(rows)


def places(n, depth, rng):
    """Places of one tree that share the first ``depth`` hashes."""
    width = 4 * near_dedup.DEPTH
    return [b"\0" + b"\7" * (4 * depth) + rng.bytes(width - 4 * depth) for _ in range(n)]


@pytest.mark.parametrize("depth, crowd, n", [(3, near_dedup.CROWD, 11_500), (6, 2000, 4000)])
def test_crowded_region_loses_no_pair(spark, depth, crowd, n):
    """One prefix for thousands of different sketches over several partitions; 500 far-apart
    pairs share a sketch but for a few bits.  A crowd that shares all hashes is compared whole."""
    rng, pairs = np.random.default_rng(depth), 500
    sketches = [rng.bytes(near_dedup.BINS // 8) for _ in range(n)]
    alike = [bytes([s[0] ^ 7]) + s[1:] for s in sketches[:pairs]]
    rows = list(zip(places(n + pairs, depth, rng), range(n + pairs), sketches + alike, strict=True))
    forest = spark.createDataFrame(rows, "place binary, node long, sketch binary")
    links = near_dedup.forest_links(forest, 3, crowd).distinct().collect()
    top = dict(enumerate(roots(n + pairs, ((r.a, r.b) for r in links)).tolist()))
    assert all(top[k] == top[n + k] for k in range(pairs))
    # and no link joins what sketches do not connect
    bits = np.frombuffer(b"".join(sketches + alike), dtype=np.uint64).reshape(-1, 2)
    need = int(np.ceil(near_dedup.SKETCH_SHARE * near_dedup.BINS))
    near = []
    for k, own in enumerate(bits):
        far = np.bitwise_count(bits[k + 1:] ^ own).sum(axis=1)
        near += [(k, k + 1 + int(j)) for j in np.flatnonzero(near_dedup.BINS - far >= need)]
    connected = roots(n + pairs, near)
    assert all(connected[r.a] == connected[r.b] for r in links)


def test_deeper_prefix_decides_in_a_crowd(spark):
    """Beyond the crowd's size those that share a longer prefix still meet."""
    rng = np.random.default_rng(4)
    sketches = [rng.bytes(near_dedup.BINS // 8) for _ in range(3000)]
    where = places(3000, 3, rng)
    rows = list(zip(where + where, range(6000), sketches + sketches, strict=True))
    forest = spark.createDataFrame(rows, "place binary, node long, sketch binary")
    links = near_dedup.forest_links(forest, 4, 1000).collect()
    top = roots(6000, ((r.a, r.b) for r in links))
    assert (top[:3000] == top[3000:]).all()


def test_member_of_a_group_that_is_unlike_its_leader_goes_along():
    """x is like the leader and y is like x, but y is not like the leader: y finds x."""
    first = np.zeros(2, dtype=np.uint64)
    x, y = first.copy(), first.copy()
    x[0], y[0], y[1] = (1 << 30) - 1, (1 << 30) - 1, (1 << 15) - 1
    block = np.stack([first, x])
    along = near_dedup._leaders(block, near_dedup._groups(block))
    assert along.tolist() == [0, 1]
    assert near_dedup._groups(np.stack([first, y])).tolist() == [0, 1]
    assert near_dedup._groups(np.stack([first, x, y])).tolist() == [0, 0, 0]


def test_near_copies_within_boilerplate(spark):
    """A thousand texts with 60 of 100 words in common: only the planted near copies link."""
    rng = random.Random(3)
    frame_words = [f"b{k}" for k in range(60)]
    rows = []
    for k in range(1000):
        own = [f"w{rng.randrange(10 ** 9)}" for _ in range(40)]
        rows.append((k, " ".join(frame_words + own)))
        if k < 60:
            rows.append((5000 + k, " ".join(frame_words + own[:-1] + ["other"])))
    found = near_dedup.near_dedup(frame(spark, rows), words=4)
    assert got(found, "doc_id", "n_shingles", "component_id", "kept") == brute.near(rows)


def test_near_dedup_null_ids_and_repeated_rows(spark):
    text = DOCS[50][1]
    rows = [(None, text), (5, text), (5, text), (7, None)]
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_dedup(
        frame(spark, rows)).collect()), key=str)
    assert found == sorted([(None, None, True), (5, None, False), (5, None, False),
                            (7, 7, True)], key=str)


def test_suffix_dedup(docs, empty):
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(suffix_dedup.suffix_dedup(docs), *cols) == brute.repeats(DOCS)
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_suffix_dedup_over_many_blocks_and_without_filter(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    monkeypatch.setattr(suffix_dedup, "FILTER_BYTES", -1)
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(suffix_dedup.suffix_dedup(docs), *cols) == brute.repeats(DOCS)


def test_suffix_dedup_keeps_strings_whose_names_collide(docs, monkeypatch):
    """Names of a few bits collide all the time; only truly repeated bytes go."""
    made = suffix_dedup._firsts

    def weak(row):
        data, starts, first, names = made(row)
        return data, starts, first, names >> 52 << 52

    monkeypatch.setattr(suffix_dedup, "BLOCK", 2000)
    rows = [r for r in DOCS if len(r[1] or "") < 2000][:70]
    texts = [(i, (t or "").encode()) for i, t in rows]
    blocks = [suffix_dedup._sorted_block(k, [{"doc_id": i, "sha": "s", "at": 0, "bytes": t}])
              .to_pylist()[0] for k, (i, t) in enumerate(texts) if len(t) >= 100]
    monkeypatch.setattr(suffix_dedup, "_firsts", weak)
    import pyarrow as pa

    def asked(step, tables, name):
        table = pa.Table.from_batches(tables)
        for owner in set(table["owner"].to_pylist()):
            mine = table.filter(pa.compute.equal(table["owner"], owner))
            for r in step(mine).to_pylist():
                blocks[r["block"]].setdefault(name, []).append(r)

    for b in blocks:
        b["block"] = blocks.index(b)
    feed = [pa.RecordBatch.from_pylist([b]) for b in blocks]
    asked(suffix_dedup._shared, list(suffix_dedup._block_names(3)(iter(feed))), "answers")
    feed = [pa.RecordBatch.from_pylist([b]) for b in blocks]
    asked(suffix_dedup._earlier, list(suffix_dedup._send_pairs(iter(feed))), "earlier")
    for b in blocks:
        b.setdefault("earlier", None)
    feed = [pa.RecordBatch.from_pylist([b]) for b in blocks]
    found = pa.Table.from_batches(list(suffix_dedup._spans(iter(feed)))).to_pylist()
    gone = {r["doc_id"]: sum(r["ends"]) - sum(r["starts"]) for r in found}
    want = {i: r[1] for i, r in brute.repeats(rows).items()}
    assert {i: gone.get(i, 0) for i in want} == want


def test_suffix_dedup_filter_holds_at_every_size(spark, monkeypatch):
    """Beyond FILTER_BYTES only the surroundings of repeats are sorted, as below it."""
    rng = random.Random(4)
    passage = " ".join(str(rng.random()) for _ in range(20))
    rows = [(k, " ".join(str(rng.random()) for _ in range(300))) for k in range(40)]
    rows += [(100 + k, passage) for k in range(3)] + [(200, "x " + passage), (201, "y" + passage)]
    kept, made = [], suffix_dedup.saved

    def watched(df, label):
        out = made(df, label)
        if label == "segments":
            kept.append(out.agg(F.sum("strings")).first()[0])
        return out

    monkeypatch.setattr(suffix_dedup, "saved", watched)
    results = []
    for limit in (suffix_dedup.FILTER_BYTES, -1):
        monkeypatch.setattr(suffix_dedup, "FILTER_BYTES", limit)
        results.append(got(suffix_dedup.suffix_dedup(frame(spark, rows)), "doc_id", "n_removed",
                           "kept_sha256"))
    assert results[0] == results[1] and kept[0] == kept[1] < 2000


def test_suffix_dedup_owners_grow_with_the_strings(docs, monkeypatch):
    asked, made = [], suffix_dedup._block_names
    monkeypatch.setattr(suffix_dedup, "OWNER_STRINGS", 100)
    monkeypatch.setattr(suffix_dedup, "_block_names", lambda n: asked.append(n) or made(n))
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(suffix_dedup.suffix_dedup(docs, owners=2), *cols) == brute.repeats(DOCS)
    assert asked[0] > 2


def test_suffix_array_is_sorted():
    import numpy as np
    rng = random.Random(5)
    for n, letters in ((1, 2), (2, 2), (3, 1), (50, 2), (400, 3), (90, 200)):
        s = [rng.randint(1, letters) for _ in range(n)]
        order = suffix_dedup.suffix_array(np.array(s)).tolist()
        keys = [s[i:i + suffix_dedup.LENGTH] for i in order]
        assert sorted(order) == list(range(n)) and keys == sorted(keys)


def test_suffix_array_with_long_repeats_and_ties():
    """Suffixes that agree on LENGTH bytes come next to each other, in any order."""
    import numpy as np
    rng = random.Random(8)
    for _ in range(60):
        unit = [rng.randint(1, 3) for _ in range(rng.choice([1, 2, 7, 130, 300]))]
        s = [x for _ in range(rng.randint(1, 12)) for x in
             (*unit, *(rng.randint(1, 3) for _ in range(rng.choice([0, 0, 1, 40]))))]
        order = suffix_dedup.suffix_array(np.array(s)).tolist()
        keys = [s[i:i + suffix_dedup.LENGTH] for i in order]
        assert sorted(order) == list(range(len(s))) and keys == sorted(keys)


def test_strings_are_ordered_by_name_second_hash_and_place():
    import numpy as np
    rng = np.random.default_rng(2)
    for names, seconds in ((1 << 40, 1 << 60), (50, 1 << 60), (50, 2), (1, 1), (3, 40)):
        name = rng.integers(0, names, 500).astype(np.uint64)
        second = rng.integers(0, seconds, 500).astype(np.uint64)
        assert (suffix_dedup._order(name, second) == np.lexsort((second, name))).all()


def test_suffix_dedup_of_null_and_repeated_ids(spark):
    """A null id is the smallest; rows that repeat id and text are one document; one id with
    two texts goes by their hashes."""
    rng = random.Random(6)

    def words(n):
        return " ".join(str(rng.random()) for _ in range(n))
    passage, own = words(15), words(15)
    two = [f"{words(9)} {a}{own}{b} {words(9)}" for a, b in ("AB", "CD")]
    tail = "tail " + passage + " end"
    rows = [(3, tail), (None, "head " + passage), (3, tail), (8, two[0]), (8, two[1]), (9, None), (None, None)]
    found = [(r.doc_id, r.n_bytes, r.n_removed) for r in
             suffix_dedup.suffix_dedup(frame(spark, rows)).collect()]
    inside = len(passage) + 1  # and the space before it
    first = min(two, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    second = two[1] if first == two[0] else two[0]
    assert sorted(found, key=str) == sorted([
        (None, len(rows[1][1]), 0), (None, 0, 0), (9, 0, 0),
        *[(3, len(rows[0][1]), inside)] * 2,
        (8, len(first), 0), (8, len(second), len(own))], key=str)


def test_token_files(spark, docs, empty):
    spec = open(public_tokenizers.path("byte_bpe_50k.json")).read()
    want = brute.tokens(DOCS, Tokenizer.from_str(spec))
    path = work_path(spark, "tokens")
    token_files.write_tokens(docs, path, spec)
    files = spark.read.parquet(path)
    cols = ("doc_id", "start", "n_tokens", "ids_crc32")
    assert got(token_files.token_checksums(files), *cols) == want
    # the metadata is read without the ids
    index = token_files.token_index(files.drop("ids"))
    assert got(index, "doc_id", "start") == {k: v[:1] for k, v in want.items()}
    path = work_path(spark, "tokens")
    token_files.write_tokens(empty, path, spec)
    assert token_files.token_checksums(spark.read.schema(files.schema).parquet(path)).count() == 0


def test_line_filters_hold_packed_bits():
    """A worker's filters take a bit for each bit, and hold what was set."""
    import numpy as np
    bits, rng = 1 << 16, np.random.default_rng(1)
    filter_, plain = np.zeros(bits // 8, dtype=np.uint8), np.zeros(bits, dtype=bool)
    for _ in range(5):
        places = line_dedup._bit_places(rng.integers(0, 1 << 63, 900, dtype=np.uint64), bits)
        assert (line_dedup._held(filter_, places) == plain[places].all(axis=1)).all()
        line_dedup._set(filter_, places)
        plain[places.ravel()] = True
        assert (np.packbits(plain) == filter_).all()


def test_token_counts(docs, empty):
    vocabulary = token_counts.Vocabulary.load(PIECES)
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=PIECES)
    plain = Tokenizer(models.Unigram([(model.id_to_piece(i), model.get_score(i))
                                      for i in range(model.get_piece_size())], 0, True))
    want = {i: (len(plain.encode("▁" + t.replace(" ", "▁")).ids) if t else 0,)
            for i, t in DOCS for t in [t or ""]}
    assert got(token_counts.token_counts(docs, vocabulary), "doc_id", "n_tokens") == want
    assert token_counts.token_counts(empty, vocabulary).count() == 0


def test_token_counts_without_byte_fallback_join_unknown_characters():
    pieces = (("▁", -1.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("▁a", -3.0))
    plain = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0))
    counter = token_counts.Counter(token_counts.Vocabulary(pieces, False, -4.0))
    for text in ("ab", "axxb", "x", "xx yy a", "abab ba"):
        assert counter.count(text)[1] == len(plain.encode("▁" + text.replace(" ", "▁")).ids)


def test_token_counts_of_rounded_scores_follow_the_whole_text():
    """Sums of rounded scores differ by the order they are added in: ties go by whole texts."""
    rng, by_word = random.Random(8), 0
    for _ in range(60):
        pieces = {c: -round(rng.uniform(1, 5), 1) for c in "▁abcd"}
        for _ in range(25):
            piece = "".join(rng.choice("abcd") for _ in range(rng.randint(2, 4)))
            pieces[rng.choice(["", "▁"]) + piece] = -round(rng.uniform(1, 9), 1)
        listed = (("<unk>", 0.0), *pieces.items())
        plain = Tokenizer(models.Unigram(list(listed), 0))
        counter = token_counts.Counter(
            token_counts.Vocabulary(tuple(pieces.items()), False, min(pieces.values())))
        assert not counter.splits
        for _ in range(20):
            text = " ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 9)))
                            for _ in range(rng.randint(1, 12)))
            want = len(plain.encode("▁" + text.replace(" ", "▁")).ids)
            assert counter.count(text)[1] == want
            by_word += sum(counter.best("▁" + w)[1] for w in text.split(" ")) != want
    assert by_word  # counting by words would have been wrong
    registered = token_counts.Counter(token_counts.Vocabulary.load(PIECES))
    assert registered.splits and registered.exact_chars > 9_000_000


def test_merge_dropout(docs, empty):
    pieces = merge_dropout.Pieces.load(PIECES)
    encoded = merge_dropout.encode_pieces(docs, pieces, rate=0.3, seed=5).cache()
    assert encoded.filter("not lossless").count() == 0
    assert got(merge_dropout.decode_pieces(encoded, pieces), "doc_id", "text") == {
        i: (t or "",) for i, t in DOCS}
    again = merge_dropout.encode_pieces(docs.repartition(3), pieces, rate=0.3, seed=5)
    crc = got(encoded, "doc_id", "ids_crc32")
    assert got(again, "doc_id", "ids_crc32") == crc
    other = merge_dropout.encode_pieces(docs, pieces, rate=0.3, seed=6)
    assert got(other, "doc_id", "ids_crc32") != crc
    assert merge_dropout.encode_pieces(empty, pieces).count() == 0


def test_merge_dropout_at_rate_zero_is_the_plain_segmentation():
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=PIECES)
    pieces = merge_dropout.Pieces.load(PIECES)
    codec = merge_dropout.Codec(pieces, 0.0, 1)
    import numpy as np
    for i, t in DOCS:
        if t and len(t) < 900 and "▁" not in t:
            ids = np.frombuffer(codec.encode([t], [i])[0], dtype="<u4").tolist()
            assert ids == model.encode(t)
            assert ids == brute.merges(t, pieces.ids, pieces.scores,
                                       lambda q: [pieces.bytes_[b] for b in q.encode()])


def test_merge_dropout_of_many_words_equals_one_by_one():
    pieces = merge_dropout.Pieces.load(PIECES)
    rng = random.Random(7)
    letters = "abcdeinorst" * 3 + "ABéßж語😀\n\t\0▁0"
    words = sorted({"".join(rng.choices(letters, k=rng.randint(1, 24))) for _ in range(3000)}
                   | {"", "   lead", "▁", "▁▁x", "a" * 59, "b" * 60, "ab" * 500, "\0", "\0\0"})
    for rate in (0.0, 0.1, 0.7, 1.0):
        codec = merge_dropout.Codec(pieces, rate, 3)
        for doc in range(4):
            keys = codec.keys(doc, len(words))
            many = codec.words(words, keys)
            assert many == [codec.word(w, k) for w, k in zip(words, keys.tolist(), strict=True)]
    texts = ["", "a", " ", "  b  ", " ".join(words)]
    codec = merge_dropout.Codec(pieces, 0.3, 3)
    assert [codec.decode(x) for x in codec.encode(texts, [1, 2, 3, 4, 5])] == texts


def test_merge_dropout_equals_brute_force():
    """Ids at several rates against plain merging with draws of its own, each occurrence by
    itself; the worker's trees know much, little or nothing."""
    pieces = merge_dropout.Pieces.load(PIECES)
    rng = random.Random(11)
    common = ["the", "understanding", "of", "internationalization", "naïve", "语言", "x😀y", "\0"]
    texts = [" ".join(rng.choices(common, k=rng.randint(1, 40))) for _ in range(40)]
    texts += [texts[0], texts[0], "", "a", "word " + "long" * 20 + " word"]
    docs = [*range(40), 0, 900, 901, None, -5]
    for rate in (0.1, 0.5, 1.0):
        want = [brute.dropped_merges(t, d, 9, rate, pieces.ids, pieces.scores,
                                     lambda q: [pieces.bytes_[b] for b in q.encode()])
                for t, d in zip(texts, docs, strict=True)]
        for room in ((400_000, 200_000), (60, 200_000), (400_000, 5), (0, 0)):
            codec = merge_dropout.Codec(pieces, rate, 9, *room)
            for _ in range(3):  # the second time most paths are known
                found = codec.encode(texts, docs)
                assert [memoryview(x).cast("I").tolist() for x in found] == want
            assert codec.paths.nodes <= room[0] and len(codec.paths.leaves) <= room[1]


def test_merge_dropout_segments_copies_and_repeated_words_differently():
    """300 copies of one text: each has its own draws, and a word has far more segmentations
    than a fixed number of variants would give."""
    codec = merge_dropout.Codec(merge_dropout.Pieces.load(PIECES), 0.3, 1)
    text = " ".join(["internationalization", "understandable", "everything"] * 20)
    found = codec.encode([text] * 300, list(range(300)))
    assert len(set(found)) == 300
    assert len({codec.word("internationalization", k)
                for k in codec.keys(7, 2000).tolist()}) > 50
    again = merge_dropout.Codec(codec.pieces, 0.3, 1)
    assert again.encode([text] * 2, [7, 299]) == [found[7], found[299]]


def test_merge_dropout_skips_at_the_rate():
    """One candidate each ("a" + "b"): the share of unmerged words over many keys is the rate."""
    keys = [merge_dropout.mixed_one(k) for k in range(20000)]
    limit = merge_dropout.skip_limit(0.1)
    left = sum(len(merge_dropout.segment(["a", "b"], {"ab": 0}, limit, k)) == 2 for k in keys)
    assert 1850 < left < 2150


def test_chat_windows(spark):
    rng = random.Random(2)
    rows = []
    for c in range(12):
        for t in range(rng.randint(1, 30)):
            role = "system" if t == 0 and c % 2 else "assistant" if t % 2 else "user"
            rows.append((c, t, role, rng.choice(["hi & <b>", "</turn>\n<turn user>\nx", "é" * 70,
                                                 "w " * rng.randint(1, 200), "", None])))
    rows += [(50, 1, None, "no role"), (50, None, "user", None), (51, 0, "assistant", "same"),
             (51, 0, "assistant", "same"), (None, 0, "assistant", "no id")]
    df = spark.createDataFrame([(*r, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, ord string")
    windows = chat_windows.chat_windows(df, budget=200, history_tokens=60, history_turns=2)
    want = {}
    for c in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == c),
                       key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        said = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
        learnt = "".join(t or "" for _, r, t in turns if r == "assistant")
        want[c] = (len(turns), brute.sha(said), len(learnt), brute.sha(learnt))
    assert got(chat_windows.digests(windows), "conv_id", "n_turns", "turns_sha256",
               "loss_chars", "loss_sha256") == want
    # only a turn that is too long with the system turn takes its window over the budget, alone
    alone = F.expr("size(filter(repeated, x -> not x)) - int(ords[0] = 1 and not repeated[0] and "
                   "startswith(formatted, '<turn system>')) <= 1")
    assert windows.filter("tokens > 200").filter(~alone).count() == 0
    assert windows.filter("window > 0").filter(F.expr("exists(repeated, x -> x)")).count() > 0
    assert chat_windows.digests(chat_windows.chat_windows(df.limit(0))).count() == 0


def by_hand(tokens, system, budget, history_tokens, history_turns):
    """(repeated ords, own ords) of each window, turn by turn."""
    windows, own, used = [], [], 0
    for k, n in enumerate(tokens):
        if k == 0 and system:
            continue
        room = budget - (tokens[0] if system else 0)
        if own and used + n <= room:
            own.append(k)
            used += n
            continue
        history = []
        for j in reversed(own[-history_turns:]):
            if sum(tokens[i] for i in [j, *history]) > min(history_tokens, room - n):
                break
            history.insert(0, j)
        own, used = [k], n + sum(tokens[i] for i in history)
        windows.append((history, own))
    return windows


def test_chat_windows_spans_are_greedy(spark):
    """Windows hold what the budget allows, by a turn-by-turn account; they are well filled."""
    rng = random.Random(5)
    talks, rows = {}, []
    for c in range(40):
        system = c % 3 == 0
        counts = [rng.choice([0, 5, 30, 60, 90, 300]) for _ in range(rng.randint(1, 60))]
        talks[c] = (counts, system)
        rows += [(c, k, "system" if system and k == 0 else "user", f"{c} {k}", n or None)
                 for k, n in enumerate(counts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int")
    windows = chat_windows.chat_windows(df, 256, 64, 3, tokens=F.col("n")).collect()
    assert {r.conv_id for r in windows} == set(talks)
    filled = []
    for c, (counts, system) in talks.items():
        found = [([o - 1 for o, x in zip(r.ords, r.repeated, strict=True)
                   if x and not (system and o == 1)],
                  [o - 1 for o, x in zip(r.ords, r.repeated, strict=True)
                   if not x and not (system and o == 1)])
                 for r in sorted((r for r in windows if r.conv_id == c), key=lambda r: r.window)]
        want = by_hand(counts, system, 256, 64, 3)
        assert found == (want or [([], [])])
        filled += [r.tokens for r in windows if r.conv_id == c and r.window < len(want) - 1]
    assert sum(filled) / len(filled) > 0.7 * 256


def test_chat_windows_run_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")],
                               "conv_id long, turn long, role string, text string")
    plan = chat_windows.digests(chat_windows.chat_windows(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_toxicity(spark, empty):
    rng = random.Random(8)
    words = [f"w{''.join(rng.choice('abcdef') for _ in range(5))}" for _ in range(300)]
    bad = ["zorgle", "bliften"]
    rows, labels = [], []
    for i in range(400):
        w = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        if i % 4 == 0:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((i, " ".join(w)))
        labels.append((i, 1 if i % 4 == 0 else 0, 1))
    labels += [(3, None, 1), (None, 1, 1), (9999, 1, 1)]
    known = spark.createDataFrame(labels, "doc_id long, toxic int, text int")
    model = toxicity.fit(frame(spark, rows), known.filter(~toxicity.held_out()))
    tests = [(1, "a ZORGLE here"), (2, "z0rgle, and b1iften"), (3, "plain words"), (4, ""),
             (5, None), (6, "zоrgle " * 3), (7, "zor​gle zorgle")]
    found = got(toxicity.score_documents(frame(spark, tests), model), "doc_id", "score")
    assert all((found[i][0] >= 0.5) == (i in (1, 2, 6, 7)) for i in found) and len(found) == 7
    assert toxicity.score_documents(empty, model).count() == 0
    scores = got(toxicity.score_documents(frame(spark, rows), model), "doc_id", "score")
    assert sum((s >= 0.5) == (i % 4 == 0) for i, (s,) in scores.items()) >= 396
    blank = toxicity.fit(frame(spark, rows), known.limit(0))
    assert got(toxicity.score_documents(frame(spark, tests[:1]), blank), "doc_id", "score") == {
        1: (0.5,)}


def test_exception_phrases_are_spared():
    model = toxicity.Model({"trash": 3.0, "clown*": 3.0})
    made = toxicity.build_automaton(model)
    assert not toxicity.hits(toxicity.fold("A trash can, clown fish"), made)
    assert len(toxicity.hits(toxicity.fold("trash! Cl0wns"), made)) == 2


def test_encoder_pieces_at_odd_spaces():
    """New and remembered pieces give the ids of the whole text, whatever the spaces are."""
    from pathlib import Path

    from tidemart.llm import queries, token_files
    made = token_files.Encoder(Path(queries.BYTE_BPE).read_text())
    texts = ["a  b", " ", "", "x \n y", "x y ", "\u3000a \u3000b", "a \u00a0b", "some words stand here"]
    for _ in range(2):
        assert made.encode(texts) == made._encode(texts)
    parts, ids, gap = made._known("some words unseen99".split(" "))
    assert gap == [2] and ids[1] == made.memory["words"]
