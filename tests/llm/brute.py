"""Plain-Python versions of the operators for small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def repeats(rows, length=50):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, sha)}; strings of documents with smaller ids are removed."""
    first = {}
    for doc_id, text in rows:
        if doc_id is not None:
            b = (text or "").encode()
            for i in range(len(b) - length + 1):
                s = b[i : i + length]
                first[s] = min(first.get(s, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = [False] * len(b)
        if doc_id is not None:
            for i in range(len(b) - length + 1):
                if first[b[i : i + length]] < doc_id:
                    gone[i : i + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, words=4):
    w = WORD.findall((text or "").encode().translate(LOWER))
    if not w:
        return frozenset()
    if len(w) < words:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1))


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def similar(rows, words=4, percent=85):
    sets = [(i, shingles(t, words)) for i, t in rows]
    union = Union()
    for x, (a, s) in enumerate(sets):
        for b, t in sets[x + 1 :]:
            if s and t and a is not None and b is not None:
                inter = len(s & t)
                if 100 * inter >= percent * (len(s) + len(t) - inter):
                    union.join(a, b)
    return [(i, len(s), None if i is None else union.find(i)) for i, s in sets]
