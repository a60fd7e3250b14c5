"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


class Joined:
    def __init__(self, n):
        self.up = list(range(n))

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def least_ids(ids, joined):
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            r = joined.root(k)
            least[r] = min(least.get(r, i), i)
    return [least.get(joined.root(k)) for k in range(len(ids))]


def shingle_sets(texts, width=5):
    found = []
    for text in texts:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = words(lower)
        whole = {tuple(w)} if w else set()
        found.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or whole)
    return found


def near_duplicates(ids, texts, width=5):
    """n_shingles and component of each row."""
    sets = shingle_sets(texts, width)
    joined = Joined(len(ids))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and ids[i] is not None and ids[j] is not None:
                shared = len(a & b)
                if 100 * shared >= 75 * (len(a) + len(b) - shared):
                    joined.join(i, j)
    return list(zip(map(len, sets), least_ids(ids, joined), strict=True))


def repeats(texts, length):
    """n_bytes, n_removed, n_spans and the digest of what is left, of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    named = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    named += [None] if None in sizes else []
    weight = {s: weights[k % len(weights)] for k, s in enumerate(named)}
    held, free = {}, set(named)
    while free:
        level = (sum(sizes.values()) - sum(held.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > most * sizes[s]]
        if not over:
            return held | {s: weight[s] * level for s in free}
        for s in over:
            held[s] = most * sizes[s]
            free.discard(s)
    return held


def near_vectors(ids, vectors, threshold=0.9):
    able = [
        i
        for i, v in enumerate(vectors)
        if ids[i] is not None
        and v
        and all(x is not None and math.isfinite(x) for x in v)
        and any(v)
    ]
    joined, links = Joined(len(ids)), [0] * len(ids)
    for a in able:
        for b in able:
            if a < b and len(vectors[a]) == len(vectors[b]):
                x, y = ([c / max(map(abs, v)) for c in v] for v in (vectors[a], vectors[b]))
                dot = sum(p * q for p, q in zip(x, y, strict=True))
                if dot / math.sqrt(sum(p * p for p in x) * sum(q * q for q in y)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    joined.join(a, b)
    return list(zip(links, least_ids(ids, joined), strict=True))


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)
