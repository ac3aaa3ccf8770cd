"""Benchmark decontamination: shared q-grams counted in diagonal bands by the q-gram lemma, verified by banded alignment.

Texts and benchmark items are compared as UTF-8 bytes with A-Z lowered and white space runs as one blank. An item is
cut in segments of SEGMENT bytes that overlap by half (a shorter item is one segment); a document leaks an item if a
region of it lies within the edit budget of one of the item's segments. Any 3 / 2 SEGMENT - 1 bytes of an item hold a
whole segment, so an excerpt of that length leaks wherever it starts.

A region within k edits of m bytes keeps at least m + 1 - GRAM * (k + 1) of their q-grams of GRAM bytes, on at most
k + 1 neighbouring diagonals. Counting all places of such short q-grams would touch most of a text, so a test that
loses nothing comes first: of the two halves of a segment one lies within k // 2 edits, and one of its k // 2 + 1
pieces of Q bytes is unchanged. Each place of a piece opens a band of 2 k + 1 diagonals around its own; bands of
neighbouring places overlap. In the band the q-grams that text and half share are counted, then those that text and
segment share (13 of 33 at 36 bytes and 5 edits); a band that reaches both bounds is aligned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowstats.llm.common import LOWER, WORD_SEPARATORS, ragged, slices

#: The budget of half a segment must be at least half of the segment's, rounded down.
SEGMENT, Q, EDIT_SHARE = 36, 6, 0.14
#: Bytes of the q-grams that are counted.
GRAM = 4
#: `without_leaks` drops a row at so many bytes of one item.
LEAST_MATCHED = 50
#: Items are broadcast in blocks of at most this many bytes; every block is searched in all documents.
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 2 << 20
HITS_AT_ONCE = 4_000_000
_FILTER_BITS = 21
#: Bytes between texts, which match nothing: more than any budget, so that no alignment crosses them.
_GAP = 8
_LOW_BYTES = np.uint64((1 << 8 * Q) - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_ALIGNED_AT_ONCE = 1 << 15
_SPACE = np.zeros(256, bool)
_SPACE[list(WORD_SEPARATORS)] = True
_FOLD = LOWER.copy()
_FOLD[_SPACE] = 32
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_LETTER = _ALNUM.copy()
_LETTER[128:255] = True  # 255 stands between texts


def normalize(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowered bytes with one blank for each run of white space, and the new offsets."""
    if not len(data):
        return data, offsets
    space = _SPACE[data]
    follows = np.r_[False, space[:-1]]
    follows[offsets[:-1][offsets[:-1] < len(data)]] = False
    keep = ~(space & follows)
    return _FOLD[data[keep]], np.r_[0, np.cumsum(keep)][offsets]


def _budget(length: int) -> int:
    """Edits allowed in `length` bytes: the share of the length, lowered to what leaves a piece of Q bytes unchanged."""
    return max(0, min(int(length * EDIT_SHARE), length // Q - 1))


def _grams(data: np.ndarray) -> np.ndarray:
    """The Q bytes from each place as a number; `data` has 8 - Q bytes more than places."""
    return np.ndarray(len(data) - 7, "<u8", data, strides=(1,)) & _LOW_BYTES


def _counted(data: np.ndarray) -> np.ndarray:
    """16 bits of a hash of the GRAM bytes from each place; equal q-grams stay equal, so counts are never too small."""
    grams = np.ndarray(len(data) - GRAM + 1, "<u4", data, strides=(1,))
    return ((grams * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def _between_words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether no word goes on across each place: letters on both sides, one of them in ASCII, are one word."""
    a, b = data[at - 1], data[at]
    return ~(_LETTER[a] & _LETTER[b] & (_ALNUM[a] | _ALNUM[b]))


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * _SPREAD) >> np.uint64(64 - _FILTER_BITS)


class _Strings:
    """Distinct byte strings, numbered; those of one length lie in one matrix."""

    def __init__(self):
        self.number: dict[bytes, int] = {}

    def add(self, text: bytes) -> int:
        return self.number.setdefault(text, len(self.number))

    def close(self) -> None:
        self.length = np.array([len(x) for x in self.number], np.int64)
        self.place = np.zeros(len(self.length), np.int64)
        self.by_length = {}
        texts = list(self.number)
        for m in np.unique(self.length).tolist():
            same = np.flatnonzero(self.length == m)
            self.place[same] = np.arange(len(same))
            self.by_length[m] = np.frombuffer(b"".join(texts[i] for i in same), np.uint8).reshape(len(same), m)
        del self.number
        self.grams = {m: _counted(np.ascontiguousarray(x).ravel()) for m, x in self.by_length.items() if m >= GRAM}
        self.grams = {
            m: np.lib.stride_tricks.as_strided(g, (len(self.by_length[m]), m - GRAM + 1), (2 * m, 2)).copy()
            for m, g in self.grams.items()
        }

    def enough_shared(self, text_grams: np.ndarray, which: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Whether each string shares the lemma's number of q-grams with the text in the band around `start`."""
        enough = np.empty(len(which), bool)
        for m in np.unique(self.length[which]).tolist():
            k, n = _budget(m), m - GRAM + 1
            windows = np.lib.stride_tricks.sliding_window_view(text_grams, n + 2 * k)
            same = np.flatnonzero(self.length[which] == m)
            for lo in range(0, len(same), _ALIGNED_AT_ONCE):
                part = same[lo : lo + _ALIGNED_AT_ONCE]
                text = np.ascontiguousarray(windows[start[part] - k].T)
                pattern = np.ascontiguousarray(self.grams[m][self.place[which[part]]].T)
                shared = text[:n] == pattern
                for diagonal in range(1, 2 * k + 1):
                    shared |= text[diagonal : diagonal + n] == pattern
                enough[part] = shared.view(np.uint8).sum(0, dtype=np.uint8) >= m + 1 - GRAM * (k + 1)
        return enough

    def align(self, padded: np.ndarray, which: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits of each string on the diagonals within its budget from `start`, and that alignment's end."""
        edits, end = np.empty(len(which), np.int64), np.empty(len(which), np.int64)
        for m in np.unique(self.length[which]).tolist():
            k = _budget(m)
            width = 2 * k + 1
            windows = np.lib.stride_tricks.sliding_window_view(padded, m + 2 * k)
            same = np.flatnonzero(self.length[which] == m)
            for lo in range(0, len(same), _ALIGNED_AT_ONCE):
                part = same[lo : lo + _ALIGNED_AT_ONCE]
                text = np.ascontiguousarray(windows[start[part] - k].T)
                pattern = np.ascontiguousarray(self.by_length[m][self.place[which[part]]].T)
                d = np.zeros((width, len(part)), np.uint8)
                for i in range(m):
                    e = d + (text[i : i + width] != pattern[i])
                    np.minimum(e[:-1], d[1:] + np.uint8(1), out=e[:-1])
                    for j in range(1, width):
                        np.minimum(e[j], e[j - 1] + np.uint8(1), out=e[j])
                    d = e
                best = d.argmin(0)
                edits[part] = d[best, np.arange(len(part))]
                end[part] = start[part] - k + m + best
        return edits, end


def _expand(at: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into `at`, place) of all places first[x] to first[x + 1] of each x in `at`."""
    n = first[at + 1] - first[at]
    hit = np.repeat(np.arange(len(at)), n)
    return hit, np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n) + first[at][hit]


def _lists(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): the places of key x in `keys` are order[first[x]:first[x + 1]]."""
    return np.argsort(keys, kind="stable"), np.r_[0, np.cumsum(np.bincount(keys, minlength=n))]


class Index:
    """The distinct segments of the items of a block, the parts that are counted first, and the parts' pieces."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item, pattern_of, halves, bodies, starts_at, ends_at = [], [], [], [], [], []
        apart = bytes([254]) * SEGMENT  # no byte of UTF-8, nor the one between texts
        size = len(apart)
        self.patterns, self.parts = _Strings(), _Strings()
        for item_id, text in items:
            body = np.frombuffer((text or "").encode("utf-8"), np.uint8)
            body, _ = normalize(body, np.array([0, len(body)]))
            body = body.tobytes().strip(b" ")
            if not body:
                continue
            bodies.append(body)
            starts = [0] if len(body) <= SEGMENT else [*range(0, len(body) - SEGMENT, SEGMENT // 2), len(body) - SEGMENT]
            for s in starts:
                self.item.append(item_id)
                pattern_of.append(self.patterns.add(body[s : s + SEGMENT]))
                starts_at.append(size + s)
                ends_at.append(size + min(s + SEGMENT, len(body)))
            size += len(body) + len(apart)
        self.bodies = np.frombuffer(b"".join([apart, *(x + apart for x in bodies)]), np.uint8)
        self.starts_at, self.ends_at = np.array(starts_at, np.int64), np.array(ends_at, np.int64)
        self.tiny = {}  # patterns under Q bytes: length -> (grams, numbers)
        for number, text in enumerate(self.patterns.number):
            if len(text) < Q:
                self.tiny.setdefault(len(text), []).append((int.from_bytes(text, "little"), number))
                continue
            cuts = (0, SEGMENT // 2) if len(text) == SEGMENT else (0,)
            for c, e in zip(cuts, (*cuts[1:], len(text)), strict=True):
                halves.append((self.parts.add(text[c:e]), number, c))
        pieces = [
            (int.from_bytes(x[o : o + Q], "little"), u, o)
            for u, x in enumerate(self.parts.number)
            for o in range(0, Q * (_budget(len(x)) + 1), Q)
        ]
        self.segments, self.first_segment = _lists(np.array(pattern_of, np.int64), len(self.patterns.number))
        half = np.array(halves, np.int64).reshape(-1, 3)
        order, self.first_half = _lists(half[:, 0], len(self.parts.number))
        self.half_pattern, self.half_at = half[order, 1], half[order, 2]
        for m, pairs in self.tiny.items():
            pairs.sort()
            self.tiny[m] = tuple(np.array(x, t) for x, t in zip(zip(*pairs, strict=True), (np.uint64, np.int64), strict=True))
        self.patterns.close()
        self.parts.close()
        self.pattern_budget = np.array([_budget(m) for m in self.patterns.length.tolist()], np.int64)
        grams = np.array([p[0] for p in pieces], np.uint64)
        order = np.argsort(grams, kind="stable")
        self.grams, first = np.unique(grams[order], return_index=True)
        self.first = np.r_[first, len(order)]
        piece = np.array([p[1:] for p in pieces], np.int64).reshape(-1, 2)[order]
        self.piece_part, self.piece_at = piece[:, 0], piece[:, 1]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[_slot(self.grams)] = True

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, segment, edits, end) of the segments found in normalized texts, each with its best region."""
        return self.regions(data, offsets)[:4]

    def regions(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, segment, edits, end, from, to): as `find`, and the bytes of `bodies` that are matched.

        They are the segment's own; an unchanged one takes in the equal bytes around its region, SEGMENT / 2 at most
        on either side, behind which the neighbouring segment is found itself.
        """
        none = tuple(np.zeros(0, np.int64) for _ in range(6))
        if not len(self.item) or not len(data):
            return none
        n_rows, margin = len(offsets) - 1, 2 * SEGMENT
        begins = offsets[:-1] + margin + _GAP * np.arange(n_rows)
        padded = np.full(len(data) + _GAP * n_rows + 2 * margin, 255, np.uint8)  # no byte of UTF-8
        padded[np.arange(len(data)) + np.repeat(begins - offsets[:-1], np.diff(offsets))] = data
        best = self._tiny(padded, begins)
        grams = _grams(padded)
        pos = np.flatnonzero(self.filter[_slot(grams)]) if len(self.grams) else np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.grams, grams[pos]), len(self.grams) - 1)
        ok = self.grams[at] == grams[pos]
        pos, at = pos[ok], at[ok]
        if len(pos):
            counted = _counted(padded)
            # Frequent pieces have many places in the items: their hits are counted some millions at a time.
            upto = np.cumsum(self.first[at + 1] - self.first[at])
            cuts = np.unique(np.r_[0, np.searchsorted(upto, np.arange(HITS_AT_ONCE, upto[-1], HITS_AT_ONCE)) + 1, len(pos)])
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                best = _least(np.concatenate([best, self._verified(padded, counted, begins, pos[lo:hi], at[lo:hi])], axis=1))
        row, pattern, edits, end = best
        hit, place = _expand(pattern, self.first_segment)
        row, edits, end, segment = row[hit], edits[hit], end[hit], self.segments[place]
        lo, hi = self.starts_at[segment].copy(), self.ends_at[segment].copy()
        same = np.flatnonzero(edits == 0)
        step = np.arange(SEGMENT // 2)
        for part in np.array_split(same, len(same) // _ALIGNED_AT_ONCE + 1):
            start = end[part] - (hi[part] - lo[part])
            before = self.bodies[lo[part, None] - 1 - step] == padded[start[:, None] - 1 - step]
            after = self.bodies[hi[part, None] + step] == padded[end[part, None] + step]
            lo[part] -= np.logical_and.accumulate(before, axis=1).sum(1)
            hi[part] += np.logical_and.accumulate(after, axis=1).sum(1)
        return row, segment, edits, np.minimum(end - begins[row], np.diff(offsets)[row]), lo, hi

    def _verified(self, padded, counted, begins, pos, at) -> np.ndarray:
        """(row, pattern, edits, end) columns of what the places `pos` of the pieces `at` lead to."""
        hit, place = _expand(at, self.first)
        part, start = self.piece_part[place], pos[hit] - self.piece_at[place]
        ok = self.parts.enough_shared(counted, part, start)
        # A part opened by several pieces on one diagonal goes on once.
        key = np.unique(start[ok] * len(self.parts.length) + part[ok])
        start, part = key // len(self.parts.length), key % len(self.parts.length)
        hit, place = _expand(part, self.first_half)
        pattern, start = self.half_pattern[place], start[hit] - self.half_at[place]
        ok = self.patterns.enough_shared(counted, pattern, start)
        pattern, start = pattern[ok], start[ok]
        edits, end = self.patterns.align(padded, pattern, start)
        length = self.patterns.length[pattern]
        ok = edits <= self.pattern_budget[pattern]
        ok &= (length >= 2 * Q) | (_between_words(padded, start) & _between_words(padded, start + length))
        row = np.searchsorted(begins, end[ok] - 1, side="right") - 1
        return np.stack([row, pattern[ok], edits[ok], end[ok]])

    def _tiny(self, padded: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """(row, pattern, 0, end) columns of the patterns under Q bytes that stand as whole words."""
        found = np.zeros((4, 0), np.int64)
        whole = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
        for m, (grams, numbers) in self.tiny.items():
            here = whole & np.uint64((1 << 8 * m) - 1)
            at = np.minimum(np.searchsorted(grams, here), len(grams) - 1)
            pos = np.flatnonzero(grams[at] == here)
            pos = pos[_between_words(padded, pos) & _between_words(padded, pos + m)]
            row = np.searchsorted(begins, pos, side="right") - 1
            found = _least(np.concatenate([found, np.stack([row, numbers[at[pos]], np.zeros_like(pos), pos + m])], axis=1))
        return found


def _least(found: np.ndarray) -> np.ndarray:
    """Of (row, pattern, edits, end) columns, for each row and pattern that of fewest edits, then the first."""
    if not found.shape[1]:
        return found
    found = found[:, np.lexsort(found[::-1])]
    return found[:, np.r_[True, (found[:2, 1:] != found[:2, :-1]).any(0)]]


def _blocks(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes over the items in order, each of a bounded number of bytes."""
    held, size = [], 0
    for r in benchmark.select("item_id", "text").where(F.col("text").isNotNull()).orderBy("item_id", "text").toLocalIterator():
        held.append((r.item_id, r.text))
        size += len(r.text.encode("utf-8"))
        if size >= BLOCK_BYTES:
            yield Index(held)
            held, size = [], 0
    if held:
        yield Index(held)


def _search(batch: pa.RecordBatch, column: int, index: Index):
    """(rows of the slice, row, item, edits, matched segments, matched bytes, end) over slices of a batch."""
    data, offsets = ragged(batch.column(column))
    items = np.array(index.item, np.int64)
    for lo, hi in slices(offsets, SLICE_BYTES):
        body, offs = normalize(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        row, seg, edits, end, at, upto = index.regions(body, offs)
        item = items[seg]
        order = np.lexsort((end, edits, item, row))
        row, item, edits, end = row[order], item[order], edits[order], end[order]
        head = np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1])][: len(row)]
        group, n = np.cumsum(head) - 1, int(head.sum())
        # Bytes of the union of what is matched: ranges by start, each counts what lies beyond all before it.
        wide = group * (len(index.bodies) + 1)
        by_start = np.argsort(wide + at[order], kind="stable")
        a, b = (wide + at[order])[by_start], (wide + upto[order])[by_start]
        reach = np.maximum.accumulate(b)
        gain = np.maximum(0, b - np.maximum(a, np.r_[np.int64(-1), reach[:-1]][: len(a)]))
        covered = np.bincount(group[by_start], gain, minlength=n).astype(np.int64)
        yield batch.slice(lo, hi - lo), row[head], item[head], edits[head], np.bincount(group, minlength=n), covered, end[head]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits, matched_segments, matched_bytes, end_byte) for every document row and item that it leaks.

    `edits` is the fewest over the item's segments, `end_byte` where that alignment ends in the normalized text,
    `matched_bytes` how many bytes of the item its matched segments cover; an unchanged segment also counts the equal
    bytes around its first place. Items under 12 bytes leak only unchanged and as whole words, however short they are.
    Null and empty texts and items leak nothing; texts of any length are searched whole, in slices; equal items with
    other ids are each reported; repeated document rows are each searched; other columns are not read, whatever their
    names; empty tables give an empty result. One narrow pass over the documents for each block of items.
    """
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "item_id", "edits", "matched_segments", "matched_bytes", "end_byte"]
    schema = f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in names[1:])
    out = spark.createDataFrame([], schema)
    first = True
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in batches:
                for rows, row, *columns in _search(batch, 1, shared.value):
                    if len(row):
                        ids = rows.column(0).take(pa.array(row))
                        yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], names=names)

        found = docs.select("doc_id", "text").mapInArrow(run, schema)
        out, first = (found if first else out.union(found)), False
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST_MATCHED) -> DataFrame:
    """The rows of `docs`, all columns kept, that leak less than `least` bytes (`matched_bytes`) of every item.

    With 50 bytes, 53 unchanged bytes of an item from any place are enough, or 71 with at most 5 edits in each segment
    (two segments cover 54). A document that only shares a phrase of some 40 bytes with an item stays, and one that
    holds all of an item under `least` bytes. See `leaks`, whose rules for nulls, long texts and repeated rows hold.
    """
    at = docs.columns.index("text")
    for block in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in batches:
                for rows, row, _, _, _, covered, _ in _search(batch, at, shared.value):
                    clean = np.ones(rows.num_rows, bool)
                    clean[row[covered >= least]] = False
                    yield rows.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
