"""Brute-force versions of the operators, over lists of (doc_id, text)."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import xxhash


def sha(s):
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def exact(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[t or ""].append(i)
    return {i: (max(g := groups[t or ""]), len(g), i == max(g), sha(t or "")) for i, t in docs}


def lines(docs, min_chars=40, min_docs=5):
    def key(line):
        return low(re.sub(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line))

    held = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            held[key(x)].add(i)
    out = {}
    for i, t in docs:
        every = (t or "").split("\n")
        kept = [x for x in every if not (len(key(x)) >= min_chars and max(held[key(x)]) != i
                                         and len(held[key(x)]) >= min_docs)]
        out[i] = (len(every), len(every) - len(kept), sha("\n".join(kept)))
    return out


def contamination(docs, items, size=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    owners = defaultdict(set)
    for item, text in items:
        w = word.findall(low(text or ""))
        for k in range(max(1, len(w) - size + 1)) if w else ():
            owners[tuple(w[k:k + size])].add(str(item))
    out = {}
    for i, t in docs:
        w, hit, found = word.findall(low(t or "")), set(), set()
        for n in {len(x) for x in owners}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in owners:
                    hit.update(range(k, k + n))
                    found |= owners[x]
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))),
                  bool(hit) and 20 * len(hit) >= len(w))
    return out


def near(docs, words=4, percent=80):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t or ""))
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    up = {i: i for i in sets}

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    held = defaultdict(list)
    for i in sorted(sets):
        for j, n in Counter(j for s in sets[i] for j in held[s]).items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
        for s in sets[i]:
            held[s].append(i)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


def repeats(docs, length=100):
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if b[s:s + length] in seen:
                gone[s:s + length] = [True] * length
            seen.add(b[s:s + length])
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), spans, sha(kept))
    return out


def tokens(docs, tokenizer):
    out, start = {}, 0
    for i, t in sorted(docs, key=lambda d: d[0]):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        out[i] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    return out


def merges(text, ids, scores, spell):
    """Plain byte-pair merging of a whole text: the best score, then the leftmost."""
    p = list("▁" + text.replace(" ", "▁")) if text else []
    while True:
        found = [(-scores[p[k] + p[k + 1]], k) for k in range(len(p) - 1)
                 if p[k] + p[k + 1] in scores]
        if not found:
            return [x for q in p for x in ([ids[q]] if q in ids else spell(q))]
        k = min(found)[1]
        p[k:k + 2] = [p[k] + p[k + 1]]


def mix64(x):
    """The finisher of the splitmix64 generator."""
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2 ** 64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2 ** 64
    return x ^ x >> 31


def dropped_merges(text, doc, seed, rate, ids, scores, spell):
    """Merge-dropout of a text without runs of spaces: for each word, again and again, the best
    and leftmost pair that no draw has skipped; a draw is a keyed hash of document, position
    of the word, and place and sizes of the pair."""
    odd, out = 0x9E3779B97F4A7C15, []
    drawn = xxhash.xxh3_64_intdigest(str(doc).encode(), seed=seed)
    for number, word in enumerate(text.split(" ") if text else []):
        key, p, skipped = mix64((drawn + (number + 1) * odd) % 2 ** 64), list("▁" + word), set()
        while True:
            starts = [sum(map(len, p[:k])) for k in range(len(p))]
            found = [(-scores[x + y], at, k, (at, len(x), len(y)))
                     for k, (at, x, y) in enumerate(zip(starts, p, p[1:]))
                     if x + y in scores and (at, len(x), len(y)) not in skipped]
            if not found:
                break
            _, _, k, (at, left, right) = min(found)
            if mix64((key + (at * 2 ** 40 + left * 2 ** 20 + right) * odd) % 2 ** 64
                     ) < rate * 2 ** 64:
                skipped.add((at, left, right))
            else:
                p[k:k + 2] = [p[k] + p[k + 1]]
        out += [x for q in p for x in ([ids[q]] if q in ids else spell(q))]
    return out


def merkle(rows, fan=16):
    """doc_id -> leaf, subroot, root, proof_sha256, folded_root, verified; ``rows`` are
    (doc_id, source, lang, n_chars, text)."""
    def field(v):
        if v is None:
            return b"-"
        v = (v if isinstance(v, str) else str(v)).encode()
        return str(len(v)).encode() + b":" + v

    def leaf(row):
        return sha(b"".join(map(field, row)))

    def levels(digests):
        out = [digests]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][k:k + fan])) for k in range(0, len(out[-1]), fan)])
        return out

    def siblings(tree, index):
        out = []
        for level in tree[:-1]:
            first = index - index % fan
            out.append((level[first:index], level[index + 1:first + fan]))
            index //= fan
        return out

    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in sources[s]])
    top = levels([trees[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for k, s in enumerate(order):
        for i, row in enumerate(sources[s]):
            path = siblings(trees[s], i) + siblings(top, k)
            claimed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4]:
                claimed = (*row[:4], low(row[4]))
            digest = leaf(claimed)
            for left, right in path:
                digest = sha("".join(left) + digest + "".join(right))
            out.append((row[0], leaf(row), trees[s][-1][0], root,
                        sha("".join("".join(a) + "".join(b) for a, b in path)), digest,
                        digest == root))
    return out


def ranking(docs, items, k=10):
    """(item_id, rank, doc_id, score) of the best documents; ``docs`` and ``items`` are lists
    of (id, text)."""
    import math
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    held = [(i, Counter(term.findall(low(t or "")))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for (i, c), n in zip(held, sizes):
            m = 100 - 90 + (90 * n * n_docs) // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(term.findall(low(text or ""))) if t in c)
            if s > 0:
                scores.append((-s, i is None, i))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(scores[:k], 1)]
    return out
