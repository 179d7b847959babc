"""The operators' results worked out plainly, row by row."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near_duplicates(rows, percent=85):
    """{id: (set size, component, kept)} of (id, text) rows with distinct ids."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    r, s = top(a), top(b)
                    parent[max(r, s)] = min(r, s)
    return {d: (len(sets[d]), top(d), top(d) == d) for d in ids}


def unit_dedup(rows, least=40):
    """{id: (kept text, removed spans)} of (id, text) rows with distinct ids: lines, and sentences of lines of several."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        at, kept, spans = 0, [], []
        for line in (text or "").split("\n") if text else []:
            cuts = [c for c in re.findall(r".*?(?:[.!?][\x20\x09-\x0D]+|$)", line, re.S) if c]
            said = " ".join(words(line))
            gone = bool(said) and said in seen
            seen.add(said)
            left, inner = [], []
            for cut in cuts if len(cuts) > 1 else []:
                unit = " ".join(words(cut))
                if unit and len(unit) >= least:
                    if unit in seen:
                        inner.append((at + sum(map(len, left)) + sum(b - a for a, b in inner), 0))
                        inner[-1] = (inner[-1][0], inner[-1][0] + len(cut))
                        continue
                    seen.add(unit)
                left.append(cut)
            if gone:
                spans.append((at, at + len(line)))
            else:
                spans += inner
                stays = "".join(left) if len(cuts) > 1 else line
                if stays or not inner:
                    kept.append(stays)
            at += len(line) + 1
        out[d] = ("\n".join(kept), spans)
    return out


def suffix_dedup(rows, width=50):
    """(n_bytes, n_removed, n_spans, sha256) in the order of (id, text) rows; a NULL id counts as last."""
    rank = [math.inf if d is None else d for d, _ in rows]
    bodies = [(t or "").encode() for _, t in rows]
    first = {}
    for r, b in zip(rank, bodies):
        for i in range(len(b) - width + 1):
            w = b[i : i + width]
            first[w] = min(first.get(w, math.inf), r)
    out = []
    for r, b in zip(rank, bodies):
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < r:
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def contained(docs, items, percent=80):
    """{(doc, item): (item size, shared)}"""
    held = {d: shingles(t) for d, t in docs}
    out = {}
    for item, text in items:
        s = shingles(text)
        for d, h in held.items():
            if s and len(s & h) * 100 >= percent * len(s):
                out[d, item] = (len(s), len(s & h))
    return out


def fold(key, n):
    return None if key is None else zlib.crc32(str(key).encode()) % n


def kneser_ney(rows):
    """Rows (id, text) -> [(held_out, n_tokens, n_known, N, base, score)], with the textbook formulas on dictionaries."""
    docs = [(d, [*words(t), None]) for d, t in rows]        # None is the end
    taught = [w for d, w in docs if fold(d, 10) not in (0, None)]
    count = Counter(t for w in taught for t in w)
    total, vocabulary = sum(count.values()), len(count)
    pairs = Counter(p for w in taught for p in zip(["<begin>", *w[:-1]], w))

    def cut(values):
        n = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
        raw = [1 - 2 * y * n[1] / n[0] if n[0] else 0.5, 2 - 3 * y * n[2] / n[1] if n[1] else 1.0, 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
        d = [0.0] + [min(max(x, 0.05 * k), 0.95 * k) for k, x in zip((1, 2, 3), raw)]
        return lambda c: d[min(c, 3)]

    before = Counter(b for _, b in pairs)
    after = defaultdict(list)
    for (a, _), c in pairs.items():
        after[a].append(c)
    d2, d1 = cut(list(pairs.values())), cut(list(before.values()))
    kinds = len(pairs)
    rest = sum(map(d1, before.values())) / kinds if kinds else 1.0
    lefts = {a: (sum(c), sum(map(d2, c)) / sum(c)) for a, c in after.items()}
    out = []
    for d, w in docs:
        base = score = 0.0
        for a, b in zip(["<begin>", *w[:-1]], w):
            base += math.log10((count[b] + 0.1) / (total + 0.1 * (vocabulary + 1)))
            p = rest / (vocabulary + 1) + ((before[b] - d1(before[b])) / kinds if before[b] else 0.0)
            if a in lefts:
                n, g = lefts[a]
                c = pairs[a, b]
                p = (c - d2(c)) / n + g * p if c else g * p
            score += math.log10(p)
        out.append((fold(d, 10) == 0, len(w), sum(count[b] > 0 for b in w), total, base, score))
    return out


def license_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    places, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += at
        if at:
            labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def _signed(h):
    return h - (1 << 64) if h >= 1 << 63 else h


def _chained(numbers):
    """The 64-bit hash of a row of longs, each with the hash so far as its seed."""
    h = 42
    for n in numbers:
        h = xxhash.xxh64(struct.pack("<q", n), seed=h).intdigest()
    return _signed(h)


def sketch(text, full=64, fraction=8):
    """(whole, sorted hashes) of a text's five-word shingles; words are split and lowered as the sketch does it."""
    said = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    hashed = [_signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in said]
    runs = [hashed[i : i + 5] for i in range(len(hashed) - 4)] if len(hashed) >= 5 else [hashed] if hashed else []
    hashes = {_chained(r) for r in runs}
    whole = len(hashes) <= full
    return whole, sorted(hashes if whole else (h for h in hashes if h < -(1 << 63) + (1 << 64) // fraction))


def sketch_text(s):
    return ("=" if s[0] else "<") + "".join(f"{h & (1 << 64) - 1:016x}" for h in s[1])


def sketch_likeness(s, t, fraction=8):
    a, b = (set(x[1]) if s[0] and t[0] else {h for h in x[1] if h < -(1 << 63) + (1 << 64) // fraction} for x in (s, t))
    return len(a & b) / len(a | b) if a | b else float(s == t)
