"""Words of ragged byte arrays, written one after the other, and checksums of runs of them."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

from flowstats.llm.common import LOWER

#: Bytes of the words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of a lower-cased text: digits, letters, all beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
SPACE, ROW_END = 0x20, 0x0A


@dataclass
class Words:
    """The lower-cased words of several rows in one buffer, a space after each, a line feed after a row's last.

    `starts`, `ends` are places in `buffer`, `raw_ends` in the source; row i has the words from `rows[i]` to `rows[i + 1]`.
    """

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    raw_ends: np.ndarray
    rows: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray, table: np.ndarray = ALNUM) -> Words:
        inside = table[data] if len(data) else np.zeros(0, bool)
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True  # no word crosses a row
        follows = np.r_[False, inside]
        before = np.flatnonzero(inside & (~follows[:-1] | edge[:-1]))
        after = np.flatnonzero(inside & (~np.r_[inside[1:], False] | edge[1:])) + 1
        lengths = after - before
        starts = np.zeros(len(before), np.int64)
        np.cumsum(lengths[:-1] + 1, out=starts[1:])
        rows = np.searchsorted(before, offsets)
        buffer = np.full(int(lengths.sum()) + len(before), SPACE, np.uint8)
        at = np.flatnonzero(inside)
        buffer[at + np.repeat(starts - before, lengths)] = LOWER[data[at]]
        last = rows[1:][np.diff(rows) > 0] - 1
        buffer[starts[last] + lengths[last]] = ROW_END
        return cls(buffer, starts, starts + lengths, after, rows)

    def runs(self, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, row) of all runs of so many consecutive words of one row."""
        row = np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))
        n = max(0, len(row) - words + 1)
        whole = row[:n] == row[words - 1 :][:n]
        first = np.flatnonzero(whole)
        return self.starts[first], self.ends[first + words - 1], row[first]


# Fixed value: the reversed polynomial of the checksum that `zlib.crc32` computes.
_POLYNOMIAL = np.uint32(0xEDB88320)


def _table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & np.uint32(1), (value >> np.uint32(1)) ^ _POLYNOMIAL, value >> np.uint32(1))
    return value


_CRC = _table()
#: Longer ranges are rare and go one by one.
LONG_RANGE = 64


def crc32_of(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of every byte range: one step per byte position, for all ranges that reach it at once."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint32)
    for i in np.flatnonzero(lengths > LONG_RANGE):
        out[i] = zlib.crc32(buffer[starts[i] : ends[i]].tobytes())
    short = np.flatnonzero(lengths <= LONG_RANGE)
    order = short[np.argsort(-lengths[short], kind="stable")]
    at, crc = starts[order], np.full(len(order), 0xFFFFFFFF, np.uint32)
    reach = np.searchsorted(-lengths[order], -np.arange(LONG_RANGE + 1), side="right")  # ranges of at least j bytes
    for j in range(LONG_RANGE):
        m = int(reach[j + 1])
        if m == 0:
            break
        crc[:m] = _CRC[(crc[:m] ^ buffer[at[:m] + j]) & np.uint32(255)] ^ (crc[:m] >> np.uint32(8))
    out[order] = ~crc
    return out
