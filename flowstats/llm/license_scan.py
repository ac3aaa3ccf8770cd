"""Licence notices and identifier tags by Aho-Corasick, licence expressions by a shunting-yard parser.

One automaton holds the words of the tags and of all notice phrases. It runs over the texts' words written one after
the other, several texts at once, so a phrase is found whatever stands between its words. Behind a tag and a colon
the raw text is read as a licence expression: operands go to a value stack, `and`, `or`, `with` and parentheses to an
operator stack, and every reduction yields the licences and how far they restrict reuse. One narrow pass, no shuffle.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowstats.llm.common import ragged, slices
from flowstats.llm.ragged_words import Words

# Phrases of the base search with their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notices that the method labels.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
# Words of a tag; a colon and an expression must follow.
TAGS = ("spdx license identifier", "spdx license expression", "license")
# How far the licence of a name's family restricts reuse, the longest matching prefix counting.
RESTRICTION = {
    "public-domain": 0.05, "cc0": 0.05, "unlicense": 0.05, "0bsd": 0.05, "wtfpl": 0.05,
    "mit": 0.1, "isc": 0.1, "bsd": 0.1, "zlib": 0.1, "apache": 0.15, "cc-by": 0.2,
    "mpl": 0.4, "epl": 0.4, "cddl": 0.4, "lgpl": 0.5, "cc-by-sa": 0.6, "gfdl": 0.6, "gpl": 0.8, "agpl": 0.9,
    "cc-by-nd": 0.9, "cc-by-nc": 0.9, "all-rights-reserved": 1.0,
}
#: Of a licence whose family is not known.
UNKNOWN_RESTRICTION = 0.95
#: An exception (`with`) takes off this share of the restriction.
EXCEPTION_RELIEF = 0.5
#: Bytes of text that a task searches at once; a longer text stands alone.
SLICE_BYTES = 4 << 20

PLACE = "struct<word: bigint, words: int, label: string, kind: string>"
EXPRESSION = "struct<word: bigint, expression: string, complete: boolean, labels: array<string>, restriction: double>"

_TOKEN = re.compile(rb"[ \t]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_COLON = re.compile(rb"[ \t]*:")
_BINDING = {"or": 1, "and": 2, "with": 3}


def restriction(label: str) -> float:
    """0 (none) to 1 (no reuse) of a licence by the longest family name that starts its own."""
    families = [f for f in RESTRICTION if label == f or label.startswith((f + "-", f + " "))]
    return RESTRICTION[max(families, key=len)] if families else UNKNOWN_RESTRICTION


def _is_licence(name: str) -> bool:
    """A known family, a reference to a licence text, or a name with a version, as identifiers have."""
    return restriction(name) != UNKNOWN_RESTRICTION or "licenseref-" in name or re.fullmatch(r"[a-z][a-z0-9.]*(-[a-z0-9.]+)*-\d[a-z0-9.-]*", name) is not None


def parse_expression(raw: bytes, at: int = 0, end: int | None = None) -> tuple[str, bool, tuple[str, ...], float] | None:
    """(expression, complete, labels, restriction) of the longest licence expression that starts at `at`; None without any.

    `and` joins the restrictions to the greater, `or` lets the user choose the lesser, `with` grants an exception;
    `with` binds more than `and`, `and` more than `or`; all from the left. An operator without an operand after it is
    not part of the expression. Open parentheses at its end are closed, and `complete` is false.
    """
    end = len(raw) if end is None else end
    values: list[tuple[frozenset[str], float]] = []
    operators: list[str] = []
    waiting: list[str] = []  # operators and opening parentheses since the last operand
    text: list[str] = []
    depth = 0

    def reduce() -> None:
        op = operators.pop()
        (right, r), (left, x) = values.pop(), values.pop()
        if op == "with":
            made = frozenset(f"{a} with {b}" for a in left for b in right)
            values.append((made, x * (1 - EXCEPTION_RELIEF)))
        else:
            values.append((left | right, max(x, r) if op == "and" else min(x, r)))

    wants_operand = True
    while (token := _TOKEN.match(raw, at, end)) is not None:
        word = token.group(1).decode("ascii").lower()
        if wants_operand:
            if word == "(":
                waiting.append(word)
            elif word != ")" and word not in _BINDING and (_is_licence(word.rstrip("+")) or waiting[-1:] == ["with"]):
                for op in waiting:
                    # An operator to the left that binds at least as much is due first.
                    while op != "(" and operators and operators[-1] != "(" and _BINDING[operators[-1]] >= _BINDING[op]:
                        reduce()
                    operators.append(op)
                    depth += op == "("
                text += [*waiting, word]
                waiting = []
                values.append((frozenset([word]), restriction(word.rstrip("+"))))
                wants_operand = False
            else:
                break
        elif word == ")":
            if depth == 0:
                break
            while operators[-1] != "(":
                reduce()
            operators.pop()
            depth -= 1
            text.append(word)
        elif word in _BINDING:
            waiting.append(word)
            wants_operand = True
        else:
            break
        at = token.end()
    if not values:
        return None
    while operators:
        if operators[-1] == "(":
            operators.pop()
        else:
            reduce()
    shown = " ".join(text).replace("( ", "(").replace(" )", ")")
    return shown, depth == 0, tuple(sorted(values[0][0])), values[0][1]


class _Search:
    """The automaton over all phrases and tags, and the search of one slice of texts."""

    def __init__(self, base: dict[str, str], notices: dict[str, str], tags: tuple[str, ...]):
        self.label, self.kind, self.words, self.length = [], [], [], []
        by_phrase: dict[str, list[int]] = {}
        for kind, phrases in (("base", base), ("notice", notices), ("tag", dict.fromkeys(tags, ""))):
            for phrase, label in phrases.items():
                by_phrase.setdefault(phrase, []).append(len(self.label))
                self.label.append(label)
                self.kind.append(kind)
                self.words.append(len(phrase.split(" ")))
                self.length.append(len(phrase.encode("utf-8")))
        self.automaton = ahocorasick.Automaton()
        for phrase, ids in by_phrase.items():
            self.automaton.add_word(phrase.encode("utf-8").decode("latin-1"), tuple(ids))
        if by_phrase:
            self.automaton.make_automaton()
        self.lengths = np.array(self.length, np.int64)
        self.n_words = np.array(self.words, np.int64)
        self.is_tag = np.array([k == "tag" for k in self.kind], bool)

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, phrase id) of every place where a phrase's words stand, in order."""
        if not len(self.lengths) or not len(words.starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends, ids = [], []
        for end, found in self.automaton.iter(words.buffer.tobytes().decode("latin-1")):
            for i in found:
                ends.append(end + 1)
                ids.append(i)
        ends, ids = np.array(ends, np.int64), np.array(ids, np.int64)
        starts = ends - self.lengths[ids]
        first = np.minimum(np.searchsorted(words.starts, starts), len(words.starts) - 1)
        last = np.minimum(np.searchsorted(words.ends, ends), len(words.ends) - 1)
        whole = (words.starts[first] == starts) & (words.ends[last] == ends)
        first, ids = first[whole], ids[whole]
        order = np.lexsort((ids, first))
        return first[order], ids[order]


def find_licenses(
    docs: DataFrame,
    base: dict[str, str] = BASE_PHRASES,
    notices: dict[str, str] = NOTICES,
    tags: tuple[str, ...] = TAGS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_words, places, expressions, restriction) of every row of `docs`.

    `places` are all places of `base` and `notices` phrases (lower-case words joined by single spaces), overlapping
    ones included, in order: the first word counted from 0, how many words, the label and the kind. `expressions` are
    the licence expressions behind the tags. `restriction` is the greatest of all labels and expressions found, as
    they hold together; 0 without any.

    A null or empty text has no words and no places; a null id stays null; repeated rows are each returned; an empty
    table gives an empty result; other columns, whatever their names, are not read. Texts are searched whole: a very
    long one stands alone in memory, with some 20 bytes a word beside it.
    """
    id_type = dict(docs.dtypes)[id_column]
    place_type = pa.struct([("word", pa.int64()), ("words", pa.int32()), ("label", pa.string()), ("kind", pa.string())])

    def run(batches):
        search = _Search(base, notices, tags)
        grades = np.array([restriction(x) for x in search.label] or [0.0])
        for batch in batches:
            data, offsets = ragged(batch.column(1))
            for a, b in slices(offsets, SLICE_BYTES):
                part = data[offsets[a] : offsets[b]]
                words = Words.of(part, offsets[a : b + 1] - offsets[a])
                first, ids = search.hits(words)
                row = np.searchsorted(words.rows, first, side="right") - 1
                worst = np.zeros(b - a)
                expressions: list[list[dict]] = [[] for _ in range(b - a)]
                tagged = search.is_tag[ids] if len(ids) else np.zeros(0, bool)
                raw = part.tobytes() if tagged.any() else b""
                seen = set()
                for w, i, r in zip(first[tagged].tolist(), ids[tagged].tolist(), row[tagged].tolist(), strict=True):
                    last = w + search.words[i] - 1
                    if last in seen:
                        continue  # a shorter tag that ends with the same word
                    seen.add(last)
                    row_end = int(offsets[a + r + 1] - offsets[a])
                    colon = _COLON.match(raw, int(words.raw_ends[last]), row_end)
                    found = colon and parse_expression(raw, colon.end(), row_end)
                    if found:
                        at = w - int(words.rows[r])
                        expressions[r].append(dict(zip(("word", "expression", "complete", "labels", "restriction"), (at, *found), strict=True)))
                        worst[r] = max(worst[r], found[3])
                first, ids, row = first[~tagged], ids[~tagged], row[~tagged]
                np.maximum.at(worst, row, grades[ids])
                places = pa.StructArray.from_arrays(
                    [
                        pa.array(first - words.rows[row], pa.int64()),
                        pa.array(search.n_words[ids].astype(np.int32), pa.int32()),
                        pa.array(search.label, pa.string()).take(pa.array(ids)),
                        pa.array(search.kind, pa.string()).take(pa.array(ids)),
                    ],
                    fields=list(place_type),
                )
                bounds = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(np.diff(words.rows), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds), places),
                        pa.array(
                            expressions,
                            pa.list_(
                                pa.struct(
                                    [
                                        ("word", pa.int64()), ("expression", pa.string()), ("complete", pa.bool_()),
                                        ("labels", pa.list_(pa.string())), ("restriction", pa.float64()),
                                    ]
                                )
                            ),
                        ),
                        pa.array(worst, pa.float64()),
                    ],
                    names=[id_column, "n_words", "places", "expressions", "restriction"],
                )

    schema = f"`{id_column}` {id_type}, n_words long, places array<{PLACE}>, expressions array<{EXPRESSION}>, restriction double"
    return docs.select(id_column, text_column).mapInArrow(run, schema)


def license_digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row of counts and joined labels per row of `find_licenses`: labels are distinct, sorted by their bytes, '' without any."""
    base = F.filter("places", lambda p: p["kind"] == "base")
    starts = F.transform(base, lambda p: p["word"])
    every = F.concat(F.transform("places", lambda p: p["label"]), F.flatten(F.transform("expressions", lambda e: e["labels"])))

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        id_column,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(F.transform(base, lambda p: p["label"])).alias("base_labels"),
        joined(every).alias("labels"),
        F.col("restriction").alias("score"),
    )
