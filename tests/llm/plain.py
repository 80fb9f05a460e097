"""Plain single-machine versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

BLANKS = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    """[(id, text)] -> {id: (keep, size, kept, digest)} for distinct ids."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[BLANKS.sub(" ", t or "")].append(i)
    return {i: (min(g), len(g), i == min(g), sha(t)) for t, g in groups.items() for i in g}


class Union(dict):
    def __missing__(self, x):
        self[x] = x
        return x

    def find(self, x):
        while self[x] != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self[b] = a


def near(rows, size=5, percent=75):
    """[(id, text)] -> {id: (set size, component, kept)}."""
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    groups, ids = Union(), sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                groups.join(a, b)
    return {i: (len(sets[i]), groups.find(i), groups.find(i) == i) for i in ids}


def hit(text, items, size=10):
    """Words, hit flags and items of one text against [(item, text)]."""
    w, flags, found = BENCH_WORD.findall(lower(text or "")), None, set()
    flags = [False] * len(w)
    for item, t in items:
        v = BENCH_WORD.findall(lower(t or ""))
        k = min(size, len(v))
        windows = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i:i + k]) in windows:
                flags[i:i + k] = [True] * k
                found.add(str(item))
    return w, flags, sorted(found)


def repeats(rows, size=50):
    """[(id, text)] -> {id: (words, removed, kept text)} for distinct ids."""
    words = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k:k + size]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < i:
                gone.update(range(k, k + size))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]
