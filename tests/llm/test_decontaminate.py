"""The benchmark search against a full edit-distance scan."""

from __future__ import annotations

import random
import re

import numpy as np

from flowstats.llm import decontaminate
from flowstats.llm.common import read_table
from flowstats.llm.decontaminate import EDIT_SHARE, LEAST_MATCHED, SEGMENT, Q, leaks, without_leaks

from .brute import LOWER


def norm(text):
    return re.sub(rb"[\x20\x09-\x0d]+", b" ", (text or "").encode().translate(LOWER))


def starts(body):
    if not body:
        return []
    return [0] if len(body) <= SEGMENT else [*range(0, len(body) - SEGMENT, SEGMENT // 2), len(body) - SEGMENT]


def whole_words(pattern, body):
    """The first place of the pattern where no word goes on across its ends, or -1."""
    letter = lambda c: c >= 128 or chr(c).isalnum()
    same = lambda a, b: letter(a) and letter(b) and (a < 128 or b < 128)
    at = body.find(pattern)
    while at >= 0:
        end = at + len(pattern)
        if not (at and same(body[at - 1], body[at])) and not (end < len(body) and same(body[end - 1], body[end])):
            return at
        at = body.find(pattern, at + 1)
    return -1


def distance(pattern, text):
    """Fewest edits of the pattern against any region of the text."""
    d = np.zeros(len(text) + 1, int)
    t = np.frombuffer(text, np.uint8)
    for i, c in enumerate(pattern, 1):
        e = np.empty_like(d)
        e[0] = i
        e[1:] = np.minimum(d[:-1] + (t != c), d[1:] + 1)
        d = np.minimum.accumulate(e - np.arange(len(e))) + np.arange(len(e))
    return int(d.min())


def brute(docs, items):
    """(doc_id, item_id, edits, matched segments, matched bytes), by a full scan of every segment over every text."""
    out = []
    for doc_id, text in docs:
        body = norm(text)
        for item_id, item in items:
            near, covered, whole = [], set(), norm(item).strip(b" ")
            for a in starts(whole):
                s = whole[a : a + SEGMENT]
                k = max(0, min(int(len(s) * EDIT_SHARE), len(s) // Q - 1))
                place = whole_words(s, body) if len(s) < 2 * Q else body.find(s)
                d = 0 if place >= 0 else 99 if len(s) < 2 * Q else distance(s, body)
                if d <= k:
                    near.append(d)
                    covered.update(range(a, a + len(s)))
                if place >= 0:
                    for step in (-1, 1):
                        i, j = (a, place) if step < 0 else (a + len(s) - 1, place + len(s) - 1)
                        while 0 <= (i := i + step) < len(whole) and 0 <= (j := j + step) < len(body) and whole[i] == body[j]:
                            if abs(i - a) > SEGMENT // 2 and step < 0 or i - a - len(s) >= SEGMENT // 2:
                                break
                            covered.add(i)
            if near:
                out.append((doc_id, item_id, min(near), len(near), len(covered)))
    return sorted(out, key=str)


def case():
    rnd = random.Random(6)
    syllables = ["th", "er", "on", "an ", "re", "é", "ing ", ". ", "\n", "st"]
    make = lambda n: "".join(rnd.choice(syllables) for _ in range(n))
    items = [(i, make(rnd.choice([4, 10, 45, 80, 150]))) for i in range(12)] + [(50, None), (51, ""), (52, "short"), (53, None)]
    items.append((54, items[3][1]))
    docs = []
    for i in range(60):
        text = make(rnd.randint(0, 80))
        if rnd.random() < 0.7:
            piece = rnd.choice(items[:12])[1]
            if rnd.random() < 0.4:
                a = rnd.randint(0, max(0, len(piece) - 120))
                piece = piece[a : a + 120]
            piece = list(piece)
            for _ in range(rnd.choice([0, 0, 1, 3, 8, 12])):
                at = rnd.randrange(len(piece))
                piece[at] = rnd.choice(["", "q", "zz", piece[at].upper(), piece[at] + "  "])
            text += "".join(piece) + make(rnd.randint(0, 30))
        docs.append((i, text))
    return [*docs, (60, None), (61, ""), (None, docs[5][1]), (7, docs[7][1])], items


def test_planted_passages(spark, monkeypatch):
    docs, items = case()
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    want = brute(docs, items)
    assert len(want) > 20
    got = lambda: sorted((tuple(r)[:5] for r in leaks(d, b).collect()), key=str)
    assert got() == want
    kept = without_leaks(d, b)
    assert kept.columns == d.columns
    dirty = {r[0] for r in want if r[4] >= LEAST_MATCHED}
    assert len(dirty) < len({r[0] for r in want})
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted(((*r, "x") for r in docs if r[0] not in dirty), key=str)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)  # several blocks of items
    monkeypatch.setattr(decontaminate, "HITS_AT_ONCE", 50)
    assert got() == want


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "some text that is long")], "item_id long, text string")
    assert leaks(d, b.where("item_id < 0")).collect() == []
    assert leaks(d.where("doc_id < 0"), b).collect() == []
    assert without_leaks(d, b.where("item_id < 0")).count() == 1


def test_whole_items_in_the_small_table(spark):
    docs, items = (read_table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in leaks(docs, items).collect()}
    whole = {(d.doc_id, b.item_id) for b in items.collect() for d in docs.collect() if norm(b.text).strip(b" ") in norm(d.text)}
    assert whole <= got
    texts = [(d.doc_id, d.text) for d in docs.collect() if len(d.text) < 1500][:40]
    want = brute(texts, [(b.item_id, b.text) for b in items.collect()][:8])
    ids = {d for d, _ in texts}
    assert [r for r in sorted((tuple(r)[:5] for r in leaks(docs, items).collect()), key=str) if r[0] in ids and r[1] in {b.item_id for b in items.collect()[:8]}] == want


def test_items_and_documents_of_one_character():
    index = decontaminate.Index([(1, "a" * 3000), (2, "b" * 95)])
    data = np.frombuffer(b"a" * 20_000 + b"c" * 500 + b"b" * 95, np.uint8)
    rows, segments_found, edits, _ = index.find(data, np.array([0, 10_000, 20_500, 20_595]))
    found = {(int(r), index.item[s]) for r, s in zip(rows, segments_found, strict=True)}
    assert found == {(0, 1), (1, 1), (2, 2)} and edits.min() == 0


def test_short_items_leak_as_whole_words_only(spark):
    docs = [(1, "two answers here"), (2, "The ANSWER, then"), (3, "no"), (4, "caf\u00e9 nothing"), (5, "答案在这里"), (6, "x" * 40 + " is")]
    items = [(1, "answer"), (2, "no"), (3, "案"), (4, "caf"), (5, "is"), (6, " "), (7, "here")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r)[:5] for r in leaks(d, b).collect()]
    assert sorted(got) == [(1, 7, 0, 1, 4), (2, 1, 0, 1, 6), (3, 2, 0, 1, 2), (5, 3, 0, 1, 3), (6, 5, 0, 1, 2)]
    assert sorted(got, key=str) == brute(docs, items)
    assert without_leaks(d, b).count() == len(docs)  # none holds LEAST_MATCHED bytes of an item
    assert sorted(r.doc_id for r in without_leaks(d, b, least=6).collect()) == [1, 3, 4, 5, 6]


def test_a_stock_phrase_drops_no_document():
    """Prose that shares a phrase with an item stays; 53 unchanged bytes of it from any place, or 71 changed ones, go."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    phrase = "in this paper we show that the"
    items = [(i, f"{prose(6)} {phrase} {prose(20)}") for i in range(20)]
    index = decontaminate.Index(items)

    def covered(text):
        raw = norm(text)
        row, seg, edits, _, lo, hi = index.regions(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        got = {}
        for s, a, b in zip(seg.tolist(), lo.tolist(), hi.tolist(), strict=True):
            got.setdefault(index.item[s], set()).update(range(a, b))
        return max(map(len, got.values()), default=0)

    for _, item in items:
        assert covered(f"{prose(40)} {phrase} {prose(40)}") < LEAST_MATCHED
        at = rnd.randint(0, len(item) - 71)
        assert covered(f"{prose(40)}. {item[at : at + 53]} .{prose(40)}") >= LEAST_MATCHED
        changed = list(item[at : at + 71])
        for place in (10, 30, 45, 60):
            changed[place] = "Q"
        assert covered(f"{prose(40)}. {''.join(changed)} .{prose(40)}") >= LEAST_MATCHED


def test_bands_reach_the_lemma_before_they_are_aligned(monkeypatch):
    """The bound is the lemma's: with it raised by one, a segment with edits spread evenly is lost; as it is, none is."""
    rnd = random.Random(5)
    items = [(i, "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(SEGMENT))) for i in range(50)]
    docs = []
    for i, text in items:
        changed = list(text)
        for place in (8, 14, 20, 26, 32):  # the first piece of six stays
            changed[place] = "0"
        docs.append((i, "".join(changed)))
    assert found(items, docs) == {(i, i) for i, _ in items}
    seen = []
    inner = decontaminate._Strings.enough_shared

    def watched(self, text_grams, which, start):
        ok = inner(self, text_grams, which, start)
        seen.append((int(self.length[which].max(initial=0)), len(ok), int(ok.sum())))
        return ok

    monkeypatch.setattr(decontaminate._Strings, "enough_shared", watched)
    found([(i, t + t[::-1]) for i, t in items], [(0, " ".join(t[:8] for _, t in items))])
    assert seen[0][1] >= 50 and seen[0][2] == 0  # pieces alone reach no bound


def planted(seed, change):
    """(items, documents): each document holds an excerpt of one item, cut anywhere and changed, and leaks that item."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rnd.choice([16, 20, 25, 60]))) for i in range(60)]
    docs = [(i, f"{prose(30)} {change(rnd, text)} {prose(30)}") for i, text in items]
    return items, docs


def found(items, docs):
    index = decontaminate.Index(items)
    raw = [norm(t) for _, t in docs]
    rows, segs, _, _ = index.find(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(x) for x in raw])])
    return {(docs[r][0], index.item[s]) for r, s in zip(rows.tolist(), segs.tolist(), strict=True)}


def test_excerpts_at_any_offset():
    """60 bytes of an item, copied from any place, leak it; what leaks nothing is not found."""

    def cut(rnd, text):
        a = rnd.randint(0, len(text) - 60)
        return text[a : a + 60]

    for seed in range(5):
        items, docs = planted(seed, cut)
        assert found(items, docs) == {(i, i) for i, _ in items}


def test_excerpts_with_replaced_words():
    """120 bytes from any place with one word replaced, and items without 12 bytes at each end."""

    def replaced(rnd, text):
        a = rnd.randint(0, max(0, len(text) - 120))
        words = text[a : a + 120].split(" ")
        words[rnd.randrange(len(words))] = "zzzzzzzz"
        return " ".join(words)

    for change in (replaced, lambda rnd, text: text[12:-12]):
        items, docs = planted(7, change)
        # The claim is about the excerpt: five edits at most in some 53 bytes of the item, by the full scan.
        want = set()
        for (i, item), (d, text) in zip(items, docs, strict=True):
            windows = [norm(item)[a : a + 53] for a in range(max(1, len(item) - 52))]
            if min(distance(w, norm(text)) for w in windows) <= 5:
                want.add((d, i))
        assert len(want) >= 55 and want <= found(items, docs)


def test_everything_the_wider_segments_found():
    """Regions within 8 % edits of 100 bytes of an item, edits close together or spread, are still found."""
    rnd = random.Random(3)
    items, _ = planted(9, lambda rnd, text: text)
    items += [(100 + n, items[n][1][:n].strip()) for n in range(37, 60)] + [(200 + n, items[0][1][:n].ljust(n, "y")) for n in (63, 70, 75, 79, 99)]
    docs, want = [], set()
    for i, text in items:
        for spread in (2, 10, 400):
            a = rnd.randint(0, max(0, len(text) - 100))
            piece = list(text[a : a + 100]) if len(text) > 100 else list(text)
            middle = len(piece) // 2
            for _ in range(max(0, min(int(len(piece) * 0.08), len(piece) // 10 - 1))):
                at = min(len(piece) - 1, max(0, middle + rnd.randint(-spread, spread)))
                piece[at] = rnd.choice(["", "Q", "q" + piece[at]])
            want.add((len(docs), i))
            docs.append((len(docs), "".join(piece)))
    assert want <= found(items, docs)
