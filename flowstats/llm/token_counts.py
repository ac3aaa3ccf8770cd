"""Token counts of byte-level BPE by rank-synchronous merging of ragged symbol arrays.

Texts are cut into pre-tokens, a slice of many texts at a time. Pre-tokens that the task has not met yet are held
together as one ragged array of symbols with the rank of every adjacent pair; in every step each sequence finds its
lowest rank and all of its occurrences are merged in all sequences at once, and only the pairs beside a merge are looked
up again. The surviving symbols are the tokens. No text is ever truncated.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Fixed value: the split pattern of the byte-level pre-tokenizer, with white space as the Unicode property.
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_NO_RANK = np.iinfo(np.int32).max
#: Pre-token counts a task remembers before it starts anew; bounds memory, never changes a count.
CACHE_ENTRIES = 400_000
#: Characters after which a slice of texts ends: their new pre-tokens are merged together. Never changes a count.
SLICE_CHARS = 1_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


class MergeTable:
    """Merge ranks of a byte-level BPE vocabulary file as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.first = np.array([vocab[c] for c in byte_symbols()], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], np.arange(len(keys), dtype=np.int32)[order], made
        self.byte_ranks = self.rank(np.repeat(self.first, 256), np.tile(self.first, 256))  # of all pairs of bytes
        self.specials = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NO_RANK)

    def count(self, pretokens: list[bytes]) -> np.ndarray:
        """Number of tokens of each pre-token."""
        lengths = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        counts = lengths.copy()
        data = np.frombuffer(b"".join(pretokens), np.uint8)
        symbols, ranks = self.first[data], np.full(len(data), _NO_RANK, np.int32)
        # The rank of a symbol with the next one; the last symbol of a sequence has none.
        ranks[:-1] = self.byte_ranks[data[:-1].astype(np.int64) * 256 + data[1:]]
        owner = np.flatnonzero(lengths)
        sizes = lengths[owner]
        ranks[np.cumsum(sizes) - 1] = _NO_RANK
        while len(symbols):
            lowest = np.minimum.reduceat(ranks, np.cumsum(sizes) - sizes)
            live = lowest != _NO_RANK  # sequences without a mergeable pair are finished
            stay = np.repeat(live, sizes)
            symbols, ranks = symbols[stay], ranks[stay]
            owner, sizes, lowest = owner[live], sizes[live], lowest[live]
            at = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            # Of overlapping hits (a a a) every second one counts, from the left.
            run = np.flatnonzero(np.r_[True, np.diff(at) != 1]) if len(at) else at
            since = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[since % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            last = np.cumsum(sizes) - 1
            sequence = np.searchsorted(last, at)
            leads, ends = at == (last - sizes + 1)[sequence], at + 1 == last[sequence]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, ranks = symbols[stay], ranks[stay]
            merged = np.bincount(sequence, minlength=len(sizes))
            counts[owner] -= merged
            sizes -= merged
            at -= np.arange(len(at))  # places without the symbols that were merged into the one before
            ranks[at[ends]] = _NO_RANK
            beside = np.r_[at[~leads] - 1, at[~ends]]
            ranks[beside] = self.rank(symbols[beside], symbols[beside + 1])
        return counts


def _slices(texts: list[str]):
    """Consecutive runs of the texts with about `SLICE_CHARS` characters; a longer text is one of its own or ends one."""
    part, chars = [], 0
    for text in texts:
        part.append(text)
        chars += len(text)
        if chars >= SLICE_CHARS:
            yield part
            part, chars = [], 0
    if part:
        yield part


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    A null or empty text has 0 bytes and 0 tokens; a null id stays null; repeated rows are each returned; an empty
    table gives an empty result. Strings of the file's added tokens inside a text count as one token. Other columns,
    whatever their names, are not read. One narrow pass: no shuffle.
    """
    table = docs.sparkSession.sparkContext.broadcast(MergeTable(tokenizer_path))

    def run(batches):
        merges = table.value
        split = regex.compile(PRETOKEN).findall
        special = regex.compile("|".join(map(regex.escape, merges.specials))) if merges.specials else None
        known: dict[str, int] = {}
        for batch in batches:
            n_bytes, n_tokens = [], []
            for texts in _slices([text or "" for text in batch.column(1).to_pylist()]):
                parts, n_special = [], []
                for text in texts:
                    n_bytes.append(len(text.encode("utf-8")))
                    if special is not None and special.search(text):
                        n_special.append(len(special.findall(text)))
                        parts.append([p for piece in special.split(text) for p in split(piece)])
                    else:
                        n_special.append(0)
                        parts.append(split(text))
                met = set().union(*parts)
                new = list(met - known.keys())
                if new:
                    if len(known) > CACHE_ENTRIES:
                        known.clear()
                        new = list(met)
                    known.update(zip(new, merges.count([p.encode("utf-8") for p in new]).tolist(), strict=True))
                n_tokens += [n + sum(map(known.__getitem__, p)) for n, p in zip(n_special, parts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array([n > limit for n in n_tokens], pa.bool_()),
                ],
                names=[id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    id_type = dict(docs.dtypes)[id_column]
    schema = f"`{id_column}` {id_type}, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select(id_column, text_column).mapInArrow(run, schema)
