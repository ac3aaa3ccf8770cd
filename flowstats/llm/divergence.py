"""How the sources of a language differ in their terms: exact counts by perfect hashes in two passes.

The first pass counts in how many documents of its language each term occurs and keeps the frequent ones exactly. Spark
tasks build a minimal perfect hash for every shard of kept terms, with the terms stored beside it, and the shards are
broadcast. The second pass looks the words up, verifies them against the stored terms, and increments dense slots, an
array per (language, source). Terms beyond the broadcast bound, the rarest, are counted by a shuffle instead. Blocks of
terms, with all sources of a language, then give the divergences and the terms in which a source stands out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowstats.llm.common import LOWER, cut
from flowstats.llm.perfect_hash import PerfectHash

# Documents of a language that a kept term needs, the scale of the shares, ranks of terms reported.
MIN_DOCS = 3
SCALE_STEPS = 3  # of three decimal digits each
TERM_RANKS = 200
#: Kept terms in the broadcast hashes (about 30 bytes each), and in one shard.
BROADCAST_TERMS = 4_000_000
SHARD_TERMS = 1 << 16
#: Bounds of a task's memory; reaching one only sends what is counted so far.
HELD_TERMS = 500_000
DENSE_SLOTS = 8_000_000
CACHED_WORDS = 1_000_000
#: Terms x sources in a block of counts, and the least terms in a block.
BLOCK_CELLS = 2_000_000
BLOCK_TERMS = 256

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_LOWER = LOWER.tobytes()
#: Longer texts are read term by term instead of as one list.
LONG_TEXT = 4 << 20


def terms_of(text: bytes) -> list[bytes] | Iterator[bytes]:
    """The terms `[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`, A-Z lower-cased."""
    lower = text.translate(_LOWER)
    return _TERM.findall(lower) if len(lower) < LONG_TEXT else (m.group() for m in _TERM.finditer(lower))


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _plain(docs: DataFrame, text_column: str, lang_column: str, source_column: str) -> DataFrame:
    return docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_column, "lang"), (source_column, "source"), (text_column, "text"))]
    )


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, docs) of the terms in at least `min_docs` rows of their language; tasks add up before the shuffle."""

    def run(batches):
        held: Counter = Counter()

        def sent():
            keys = list(held)
            names = pa.array([k[0] for k in keys], pa.string())
            out = pa.RecordBatch.from_arrays(
                [names, _strings([k[1] for k in keys]), pa.array(list(held.values()), pa.int64())], names=["lang", "term", "docs"]
            )
            held.clear()
            return out

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang in set(langs):
                here: Counter = Counter()
                for i, name in enumerate(langs):
                    if name == lang:
                        here.update(set(terms_of(batch.column(1)[i].as_buffer().to_pybytes())))
                for term, n in here.items():
                    held[lang, term] += n
                if len(held) > HELD_TERMS:
                    yield sent()
        yield sent()

    parts = docs.select("lang", "text").mapInArrow(run, "lang string, term string, docs long")
    return parts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)


#: Spark's `xxhash64` of one string is the public 64-bit hash with this seed, so tasks find a term's shard themselves.
SPARK_SEED = 42


def _hashes(terms: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t, SPARK_SEED) for t in terms], np.uint64)


class Shard:
    """The terms of one shard of a language by number, found through a perfect hash and verified."""

    def __init__(self, levels: list[bytes], terms: list[bytes]):
        self.hash = PerfectHash([np.frombuffer(x, np.uint8) for x in levels])
        self.terms = terms

    def find(self, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The words' numbers; -1 for a word whose stored term is another one."""
        at = self.hash.number(hashes)
        terms = self.terms
        return np.array([i if i >= 0 and terms[i] == w else -1 for i, w in zip(at.tolist(), words, strict=True)], np.int64)


def _shard(table: pa.Table) -> pa.Table:
    """The perfect hash of one shard's terms and the terms in its order."""
    terms = [t.encode("utf-8") for t in table.column("term").to_pylist()]
    hashes = _hashes(terms)
    first = np.unique(hashes, return_index=True)[1]
    # Of terms with one 64-bit hash, one has the slot; the others stand in a list behind the slots, found by name.
    later = np.setdiff1d(np.arange(len(terms)), first)
    perfect = PerfectHash.build(hashes[first])
    placed: list[bytes] = [b""] * len(first)
    for i, at in zip(first.tolist(), perfect.number(hashes[first]).tolist(), strict=True):
        placed[at] = terms[i]
    return pa.table(
        {
            "lang": table.column("lang").slice(0, 1),
            "shard": table.column("shard").slice(0, 1),
            "levels": pa.array([[x.tobytes() for x in perfect.levels]], pa.list_(pa.binary())),
            "terms": pa.array([placed], pa.list_(pa.binary())),
            "doubles": pa.array([[terms[i] for i in later]], pa.list_(pa.binary())),
        }
    )


def build_shards(kept: DataFrame, shards: int) -> DataFrame:
    """A perfect hash and its terms per (lang, shard) of `kept` (lang, term)."""
    placed = kept.select("lang", "term", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"))
    schema = "lang string, shard int, levels array<binary>, terms array<binary>, doubles array<binary>"
    return placed.groupBy("lang", "shard").applyInArrow(_shard, schema)


class Lookup:
    """Slots of words by language over all broadcast shards, a shard's slots behind those of the shards before."""

    def __init__(self, rows: list[dict], n_shards: int):
        self.n_shards = n_shards
        self.shards: dict[str, dict[int, tuple[int, Shard]]] = {}
        self.terms: dict[str, list[bytes]] = {}
        self.doubles: dict[str, dict[bytes, int]] = {}
        for r in rows:
            terms = self.terms.setdefault(r["lang"], [])
            self.shards.setdefault(r["lang"], {})[r["shard"]] = (len(terms), Shard(r["levels"], r["terms"]))
            terms += r["terms"]
            for term in r["doubles"]:
                self.doubles.setdefault(r["lang"], {})[term] = len(terms)
                terms.append(term)

    def slots(self, lang: str, words: list[bytes]) -> np.ndarray:
        """Slot of every word, -1 where its shard does not store it."""
        out = np.full(len(words), -1, np.int64)
        if lang not in self.shards or not words:
            return out
        hashes = _hashes(words)
        shard_of = hashes.view(np.int64) % self.n_shards
        order = np.argsort(shard_of, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(shard_of[order])) + 1):
            base, shard = self.shards[lang].get(int(shard_of[at[0]]), (0, None))
            if shard is not None:
                found = shard.find([words[i] for i in at.tolist()], hashes[at])
                out[at[found >= 0]] = base + found[found >= 0]
        for i, word in enumerate(words) if lang in self.doubles else ():
            if out[i] < 0:
                out[i] = self.doubles[lang].get(word, -1)
        return out


class _Known(dict):
    """Numbers of the words of a language that a task has met, and their slots, looked up once each."""

    def __init__(self):
        super().__init__()
        self.names: list[bytes] = []
        self.found = np.zeros(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self.names)
        self.names.append(word)
        return at

    def ids(self, text: bytes) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, terms_of(text)), np.int64)

    def slots(self, lookup: Lookup, lang: str) -> np.ndarray:
        if len(self.found) < len(self.names):
            self.found = np.r_[self.found, lookup.slots(lang, self.names[len(self.found) :])]
        return self.found


def frequent_lookup(kept: DataFrame, broadcast_terms: int) -> tuple[Lookup, DataFrame | None]:
    """(hashes of the most frequent terms, as many as the bound allows; the other kept terms, None without any)."""
    level = F.floor(F.log2(F.col("docs").cast("double"))).cast("int")
    total, least, all_in = 0, 64, True
    for r in kept.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # 64 rows at most
        if total + r["count"] > broadcast_terms:
            all_in = False
            break
        total, least = total + r["count"], r.level
    shards = max(1, -(-total // SHARD_TERMS))
    found = Lookup(build_shards(kept.where(level >= least), shards).toArrow().to_pylist(), shards)
    return found, None if all_in else kept.where(level < least)


def recount(docs: DataFrame, lookup, rest: DataFrame | None) -> DataFrame:
    """(lang, source, slot, term, n): occurrences of the kept terms in each group's rows, none of them 0.

    `lookup` is the broadcast `Lookup`; its terms are counted by slot (term null), those of `rest` by term (slot -1).
    """
    has_rest = rest is not None

    def run(batches):
        found = lookup.value
        dense: dict[tuple[str, str], np.ndarray] = {}
        others: Counter = Counter()
        known: dict[str, _Known] = {}
        used = 0

        def sent():
            for (lang, source), counts in dense.items():
                at = np.flatnonzero(counts)
                yield rows(lang, source, pa.array(at), pa.nulls(len(at), pa.string()), pa.array(counts[at]))
            dense.clear()

        def sent_others():
            by_group: dict[tuple[str, str], list] = {}
            for (lang, source, term), n in others.items():
                by_group.setdefault((lang, source), []).append((term, n))
            for (lang, source), pairs in by_group.items():
                none = pa.array(np.full(len(pairs), -1, np.int64))
                yield rows(lang, source, none, _strings([t for t, _ in pairs]), pa.array([n for _, n in pairs], pa.int64()))
            others.clear()

        def rows(lang, source, slots, terms, counts):
            group = [pa.repeat(x, len(slots)) for x in (lang, source)]
            return pa.RecordBatch.from_arrays([*group, slots, terms, counts], names=["lang", "source", "slot", "term", "n"])

        for batch in batches:
            groups: dict[tuple[str, str], list[int]] = {}
            for i, pair in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                groups.setdefault(pair, []).append(i)
            for (lang, source), members in groups.items():
                words = known.setdefault(lang, _Known())
                ids = np.concatenate([words.ids(batch.column(2)[i].as_buffer().to_pybytes()) for i in members])
                slots = words.slots(found, lang)[ids]
                width = len(found.terms.get(lang, ()))
                if (lang, source) not in dense and width:
                    if used + width > DENSE_SLOTS:
                        yield from sent()
                        used = 0
                    dense[lang, source] = np.zeros(width, np.int64)
                    used += width
                if width:
                    dense[lang, source] += np.bincount(slots[slots >= 0], minlength=width)
                if has_rest:
                    left, times = np.unique(ids[slots < 0], return_counts=True)
                    for i, n in zip(left.tolist(), times.tolist(), strict=True):
                        others[lang, source, words.names[i]] += n
                    if len(others) > HELD_TERMS:
                        yield from sent_others()
                if len(words) > CACHED_WORDS:
                    del known[lang]
        yield from sent()
        yield from sent_others()

    parts = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, slot long, term string, n long")
    # A task has added up its rows: they go to their key's partition as they are and are added up there.
    by_slot = parts.where("slot >= 0").select("lang", "source", "slot", "n").repartition("lang", "source", "slot")
    counts = by_slot.groupBy("lang", "source", "slot").agg(F.sum("n").alias("n"))
    counts = counts.select("lang", "source", "slot", F.lit(None).cast("string").alias("term"), "n")
    if has_rest:
        by_term = parts.where("slot < 0").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
        by_term = by_term.join(rest.select("lang", "term"), ["lang", "term"], "left_semi")
        counts = counts.union(by_term.select("lang", "source", F.lit(-1).cast("long").alias("slot"), "term", "n"))
    return counts


def _share(count: np.ndarray, total) -> np.ndarray:
    """1 + floor(10**9 count / total) for count <= total < 2**53, without leaving 64 bits."""
    left, out = count.copy(), np.zeros_like(count)
    for _ in range(SCALE_STEPS):
        left = left * 1000
        out = out * 1000 + left // total
        left = left % total
    return out + 1


def _block(counts: pa.Table, groups: pa.Table, terms_of_lang: dict[str, list[bytes]]) -> pa.Table:
    """Parts of the divergences, and the terms that may reach the reported ranks, of one block of a language's terms."""
    if not groups.num_rows:
        return _RESULT.empty_table()
    info = {x: groups.column(x).to_numpy() for x in ("size", "lang_size", "vocabulary")}
    sources = groups.column("source").to_pylist()
    lang = groups.column("lang")[0].as_py()
    slots, by_slot = counts.column("slot").to_numpy(), terms_of_lang.get(lang, [])
    named = [t.encode("utf-8") if at < 0 else by_slot[at] for at, t in zip(slots.tolist(), counts.column("term").to_pylist(), strict=True)]
    terms, column = np.unique(np.array([*named, b""], object)[:-1], return_inverse=True)
    index = {s: i for i, s in enumerate(sources)}
    seen = np.zeros((len(sources), len(terms)), np.int64)
    seen[[index[s] for s in counts.column("source").to_pylist()], column] = counts.column("n").to_numpy()
    v = int(info["vocabulary"][0])
    p = np.stack([_share(seen[i] + 1, int(info["size"][i]) + v) for i in range(len(sources))]) if v else seen
    q = _share(seen.sum(axis=0) + 1, int(info["lang_size"][0]) + v) if v else seen[0]
    out: dict[str, list] = {x: [] for x in ("part", "source", "item", "value")}

    def add(part, source, items, values):
        out["part"] += [part] * len(items)
        out["source"] += [source] * len(items)
        out["item"] += items
        out["value"] += values

    for i, source in enumerate(sources):
        apart = ((p[i] - p) ** 2 // p).sum(axis=1) if v else np.zeros(len(sources), np.int64)
        add("pair", source, sources[:i] + sources[i + 1 :], np.delete(apart, i).tolist())
        more = np.flatnonzero((seen[i] > 0) & (p[i] > q))
        value = (p[i][more] - q[more]) ** 2 // q[more]
        best = np.lexsort((more, -value))[:TERM_RANKS]
        add("term", source, [terms[j].decode("utf-8") for j in more[best].tolist()], value[best].tolist())
    return pa.table({"lang": [lang] * len(out["part"]), **out}, schema=_RESULT)


_RESULT = pa.schema([("lang", pa.string()), ("part", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def audit_sources(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    broadcast_terms: int = BROADCAST_TERMS,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): for every (lang, source) of `docs`, its divergence from each other
    source of the language (part `pair`), and the terms more frequent than in the language (part `term`, to rank 200).

    All counts and shares are exact integers. Null texts, languages and sources count as ''; empty texts have no terms
    but make their group occur; repeated rows count repeatedly; a language whose terms are all rare has divergences of
    0 and no terms; ties rank by the item's UTF-8 bytes; an empty table gives an empty result; other columns are not
    read. Very long texts are read term by term. A group or language with a third of all rows is counted by all tasks
    that hold its rows, and its terms are spread over blocks.
    """
    plain = _plain(docs, text_column, lang_column, source_column)
    kept = cut(kept_terms(plain, min_docs))
    found, rest = frequent_lookup(kept, broadcast_terms)
    lookup = docs.sparkSession.sparkContext.broadcast(found)
    counts = cut(recount(plain, lookup, rest))
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = plain.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").fillna(0, ["size"])
    langs = groups.groupBy("lang").agg(F.sum("size").alias("lang_size"), F.count(F.lit(1)).alias("sources"))
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
    langs = cut(langs.join(vocabulary, "lang", "left").fillna(0, ["vocabulary"]))
    # All blocks are one number of terms wide: the root of the vocabulary, within a bound of terms x sources.
    most = langs.agg(F.max("vocabulary"), F.max("sources")).first()
    width = max(1, min(max(BLOCK_TERMS, math.isqrt(most[0] or 0)), BLOCK_CELLS // (most[1] or 1)))
    # Blocks by slot come first, 0 to `of_slots`; behind them those by hash, for terms that have no slot.
    of_slots = -(-max(map(len, found.terms.values()), default=0) // width)
    of_rest = 0 if rest is None else -(-(most[0] or 0) // width)
    by_hash = F.lit(of_slots) + F.pmod(F.xxhash64("term"), F.lit(max(1, of_rest)))
    block = F.when(F.col("slot") >= 0, F.floor(F.col("slot") / width)).otherwise(by_hash).cast("int").alias("block")
    left = counts.select("lang", "source", "slot", "term", "n", block)
    # Every block of a language knows all its groups; a language without kept terms has one empty block.
    slots_of_lang = F.least(F.lit(of_slots), F.ceil(F.col("vocabulary") / width))
    blocks = F.concat(
        F.sequence(F.lit(0), F.greatest(slots_of_lang, F.lit(1)).cast("int") - 1),
        F.sequence(F.lit(of_slots), F.lit(of_slots + of_rest - 1)) if of_rest else F.array().cast("array<int>"),
    )
    right = groups.join(langs, "lang").withColumn("block", F.explode(F.array_distinct(blocks.cast("array<int>"))))
    schema = "lang string, part string, source string, item string, value long"
    found = left.groupBy("lang", "block").cogroup(
        right.select("lang", "block", "source", "size", "lang_size", "vocabulary").groupBy("lang", "block")
    ).applyInArrow(lambda x, y: _block(x, y, lookup.value.terms), schema)
    found = cut(found)
    pairs = found.where(F.col("part") == "pair").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    terms = found.where(F.col("part") == "term").select("lang", "source", "part", "item", "value")
    ranked = pairs.withColumn("rank", F.row_number().over(by_value)).union(
        terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= TERM_RANKS)
    )
    return ranked.select("lang", "source", "part", "item", "value", "rank")


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
o AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= {MIN_DOCS}),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(any_value(x.size), 0) AS size FROM (SELECT DISTINCT lang, source FROM d)
    LEFT JOIN (SELECT lang, source, sum(n) AS size FROM c GROUP BY ALL) AS x USING (lang, source) GROUP BY ALL),
v AS (SELECT lang, coalesce(any_value(x.v), 0) AS v, sum(size) AS size FROM g
    LEFT JOIN (SELECT lang, count(*) AS v FROM k GROUP BY ALL) AS x USING (lang) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1)::HUGEINT // (g.size + v.v)::HUGEINT AS p
    FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (SELECT k.lang, k.term, 1 + 1000000000::HUGEINT * (sum(c.n) + 1)::HUGEINT // (any_value(v.size) + any_value(v.v))::HUGEINT AS q
    FROM k JOIN c USING (lang, term) JOIN v USING (lang) GROUP BY ALL),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
    FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
    FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {TERM_RANKS}
"""
