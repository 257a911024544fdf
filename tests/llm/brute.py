"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def near_classes(rows, least=0.8):
    """Class of every id, by comparing all pairs; ids are unique."""
    shingles = {}
    for i, text in rows:
        w = words(text)
        shingles[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    sets = Sets(shingles)
    texts = dict(rows)
    for i in shingles:
        for j in shingles:
            if i < j:
                a, b = shingles[i], shingles[j]
                same = (texts[i] or "") == (texts[j] or "")
                if same or (a and b and len(a & b) >= least * len(a | b)):
                    sets.join(i, j)
    return {i: sets.root(i) for i in shingles}


def without_repeats(texts, length=200):
    """Removal marks of every text's bytes."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[s : s + length] for d in data for s in range(len(d) - length + 1))
    marks = []
    for d in data:
        mark = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if seen[d[s : s + length]] > 1:
                mark[s : s + length] = b"\1" * length
        marks.append(bytes(mark))
    return data, marks


def contamination(docs, items, window=13):
    """(words, hit words, item ids) of every text."""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[s : s + window])].add(item)
    sizes = {len(g) for g in windows}
    found = []
    for text in docs:
        w, hit, ids = words(text), set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if (g := tuple(w[s : s + k])) in windows:
                    hit |= set(range(s, s + k))
                    ids |= {str(i) for i in windows[g] if i is not None}
        found.append((len(w), len(hit), ids))
    return found
