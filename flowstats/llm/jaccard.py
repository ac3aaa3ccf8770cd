"""Similarity join on word shingles by Jaccard, with a token-group matrix.

Documents with equal shingle sets are collapsed. Sets that can reach the threshold are brought together by their
rarest shingles: with all shingles in one order, the first shingle that two linked sets share lies among the first
n - ceil(threshold * n) + 1 of both, so no link is lost; in the order of how many documents hold a shingle, those of
passages that many documents share come last and bring nothing together. Within what is brought together, sets are
partitioned in groups of similar ones and each group's token union is one row of a token-group matrix. A query's
overlap with the union bounds its overlap with every member, so only the groups that reach the threshold are opened
and their members compared exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowstats.llm.common import RangeHash, connected_components, cut, hold, mix, pack, ragged, slices, text_volume, unpack, word_spans

WORDS, PERCENT = 4, 85
SLICE_BYTES = 2 << 20
#: Text bytes per chunk of documents, shingles in one range, and shingles whose sets are compared in one block.
CHUNK_BYTES, RANGE_ENTRIES, BLOCK_SHINGLES = 4 << 20, 4_000_000, 400_000
#: Sets per row of the token-group matrix.
GROUP_SETS = 12


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, set offsets): the sorted distinct shingles of each text; with fewer words, all of them as one."""
    starts, ends, by_row = word_spans(data, offsets)
    w = RangeHash(data, lower=True)(starts, ends)
    n_words = np.diff(by_row)
    n = len(n_words)
    grams = np.zeros(max(0, len(w) - words + 1), np.uint64)
    for i in range(words):
        grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + w[i : i + len(grams)])
    sets = []
    for r in range(n):
        a, k = by_row[r], n_words[r]
        if k >= words:
            g = np.sort(grams[a : a + k - words + 1])
            sets.append(g[np.r_[True, g[1:] != g[:-1]]])
        elif k:
            h = np.array([k], np.uint64)
            for i in range(a, a + k):
                h = mix(h * np.uint64(0xD6E8FEB86659FD93) + w[i : i + 1])
            sets.append(h)
        else:
            sets.append(np.zeros(0, np.uint64))
    sizes = np.array([len(s) for s in sets], np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.r_[0, np.cumsum(sizes)]


def _per_set(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of each set's values; 0 for an empty set."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _ranges_of(tokens: np.ndarray, ranges: int) -> np.ndarray:
    """A shingle's range and 32 more bits of its hash: equal shingles stay equal, and few others meet."""
    place = ((tokens >> np.uint64(40)) * np.uint64(ranges)) >> np.uint64(24)
    return (place << np.uint64(32)) | ((tokens >> np.uint64(8)) & np.uint64(0xFFFFFFFF))


class Chunk:
    """The distinct sets of some documents, and the shingles that occur in them."""

    def __init__(self, table: pa.Table, words: int, ranges: int):
        ids = table.column("doc_id").to_numpy()
        data, offsets = ragged(table.column("text"))
        parts = [shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words) for a, b in slices(offsets, SLICE_BYTES)]
        h = np.concatenate([p[0] for p in parts])
        at = np.r_[0, np.cumsum(np.concatenate([np.diff(p[1]) for p in parts]))]
        # Copies count once: the smallest id of each distinct set.
        f1, f2 = _per_set(mix(h), at), _per_set(mix(h ^ np.uint64(0x5555555555555555)), at)
        order = np.lexsort((ids, f2, f1))
        first = np.r_[True, (f1[order][1:] != f1[order][:-1]) | (f2[order][1:] != f2[order][:-1])]
        rows = np.sort(order[first])
        rows = rows[np.diff(at)[rows] > 0]
        self.ids = ids[rows]
        self.sizes = np.diff(at)[rows]
        self.offsets = np.r_[0, np.cumsum(self.sizes)]
        self.tokens = np.concatenate([h[at[r] : at[r + 1]] for r in rows] or [h[:0]])
        self.names, self.of, self.holders = np.unique(_ranges_of(self.tokens, ranges), return_inverse=True, return_counts=True)

    def rows(self, number: int) -> pa.Table:
        """A row for each range of shingles: the shingles in order, and how many of these sets hold each."""
        bucket = (self.names >> np.uint64(32)).astype(np.int64)
        head = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
        tail = np.r_[head[1:], len(bucket)][: len(head)]
        names, held = self.names.astype(np.uint32), np.minimum(self.holders, 255).astype(np.uint8)
        return pa.table(
            {
                "bucket": pa.array(bucket[head], pa.int64()),
                "chunk": pa.array(np.full(len(head), number), pa.int32()),
                "a": pa.array([pack(names[x:y], in_order=True) for x, y in zip(head, tail, strict=True)], pa.binary()),
                "b": pa.array([pack(held[x:y]) for x, y in zip(head, tail, strict=True)], pa.binary()),
            }
        )

    def prefixes(self, rarity: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(shingles, set) of every set's first shingles from rare to frequent, without those nothing else holds."""
        out_token, out_set = [], []
        rare = rarity[self.of]
        for i, (a, b) in enumerate(zip(self.offsets[:-1], self.offsets[1:], strict=True)):
            n = b - a
            length = n - -(-percent * n // 100) + 1
            c = rare[a:b]
            if np.count_nonzero(c == 0) >= length:
                continue  # its first shingles occur nowhere else
            first = np.lexsort((self.tokens[a:b], c))[:length]
            first = first[c[first] > 0]
            out_token.append(self.tokens[a:b][first])
            out_set.append(np.full(len(first), i))
        if not out_token:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(out_token), np.concatenate(out_set)


def _rarity(table: pa.Table) -> pa.Table:
    """For the shingles of one range, a byte that grows with how many documents hold each; 0 if only one does."""
    names = [unpack(x, "u4", in_order=True) for x in table.column("a").to_pylist()]
    held = np.concatenate([unpack(x, "u1") for x in table.column("b").to_pylist()]).astype(np.int64)
    sizes = [len(x) for x in names]
    flat = np.concatenate(names)
    order = np.argsort(flat)
    head = np.flatnonzero(np.r_[True, flat[order][1:] != flat[order][:-1]])
    total = np.add.reduceat(held[order], head)
    grade = np.minimum(np.ceil(np.log2(total) * 8), 255).astype(np.uint8)
    grades = np.empty(len(flat), np.uint8)
    grades[order] = np.repeat(grade, np.diff(np.r_[head, len(flat)]))
    ends = np.cumsum(sizes)
    return pa.table(
        {
            "bucket": table.column("bucket").cast(pa.int64()),
            "chunk": table.column("chunk").cast(pa.int32()),
            "a": pa.array([pack(grades[e - n : e]) for e, n in zip(ends, sizes, strict=True)], pa.binary()),
        }
    )


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def link_sets(hashes: np.ndarray, offsets: np.ndarray, percent: int, query: np.ndarray | None = None,
              joined: np.ndarray | None = None, side: np.ndarray | None = None) -> np.ndarray:
    """The component of each set under all links among them, as the first set's index.

    With `query` and `side` (0 or 1), only links of a queried set with one of the other side are looked for;
    `joined` are labels of sets already known to be connected. Links inside a component are not needed and not compared.
    """
    sizes = np.diff(offsets)
    n = len(sizes)
    union = _Union(n)
    if joined is not None:
        first: dict[int, int] = {}
        for i, c in enumerate(joined.tolist()):
            union.join(first.setdefault(c, i), i)
    vocabulary, token = np.unique(hashes, return_inverse=True)
    # Groups of similar sets: by their smallest token, then by size.
    smallest = np.array([token[a] if b > a else -1 for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
    kind = np.zeros(n, np.int64) if query is None else 2 * side.astype(np.int64) + query
    order = np.lexsort((sizes, smallest, kind))
    order = order[sizes[order] > 0]
    kinds = np.searchsorted(kind[order], np.arange(5))
    groups = [order[i : min(i + GROUP_SETS, b)] for a, b in zip(kinds[:-1], kinds[1:], strict=True) for i in range(a, b, GROUP_SETS)]
    # Of two sides: queries of the first ask all of the second, queries of the second the rest of the first.
    upto = np.r_[0, np.cumsum(-(-np.diff(kinds) // GROUP_SETS))]
    asked = {0: (0, len(groups))} if query is None else {1: (upto[2], upto[4]), 3: (0, upto[1])}
    unions = [np.unique(np.concatenate([token[offsets[s] : offsets[s + 1]] for s in g])) for g in groups]
    flat = np.concatenate(unions) if unions else np.zeros(0, np.int64)
    union_starts = np.r_[0, np.cumsum([len(u) for u in unions])[:-1]].astype(np.int64) if unions else None
    members = [np.concatenate([token[offsets[s] : offsets[s + 1]] for s in g]) for g in groups]
    member_starts = [np.r_[0, np.cumsum(sizes[g])[:-1]] for g in groups]
    marked = np.zeros(len(vocabulary), np.uint8)
    place = np.empty(n, np.int64)
    for i, g in enumerate(groups):
        place[g] = i
    for q in order.tolist():
        from_group, to_group = asked.get(int(kind[q]), (0, 0))
        if from_group == to_group:
            continue
        own = token[offsets[q] : offsets[q + 1]]
        marked[own] = 1
        base = union_starts[from_group]
        end = union_starts[to_group] if to_group < len(groups) else len(flat)
        bound = np.add.reduceat(marked[flat[base:end]], union_starts[from_group:to_group] - base, dtype=np.int64)
        least = -(-percent * int(sizes[q]) // 100)
        for g in (from_group + np.flatnonzero(bound >= least)).tolist():
            if query is None and g < place[q]:
                continue  # compared when that group's sets were queries
            root = union.find(q)
            if all(union.find(int(s)) == root for s in groups[g]):
                continue
            inter = np.add.reduceat(marked[members[g]], member_starts[g], dtype=np.int64)
            linked = 100 * inter >= percent * (sizes[q] + sizes[groups[g]] - inter)
            for s in groups[g][linked].tolist():
                union.join(q, s)
        marked[own] = 0
    return np.array([union.find(i) for i in range(n)], np.int64)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, f1, f2) of every row; f1 and f2 identify the set."""

    def run(batches):
        for batch in batches:
            data, offsets = ragged(batch.column(1))
            for lo, hi in slices(offsets, SLICE_BYTES):
                h, at = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], words)
                f1, f2 = _per_set(mix(h), at), _per_set(mix(h ^ np.uint64(0x5555555555555555)), at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(at)), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64))],
                    names=["doc_id", "n_shingles", "f1", "f2"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long")


def _candidates(docs: DataFrame, words: int, percent: int, chunks: int, ranges: int) -> DataFrame:
    """Edges (a, b) that connect all documents whose sets share one of both first shingles and fit in size.

    The text is shuffled once, in chunks; a chunk sends each distinct shingle once and gets back how frequent it is.
    """
    spread = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int")
    by_chunk = docs.withColumn("__chunk", spread).groupBy("__chunk")

    def tokens(table: pa.Table) -> pa.Table:
        return Chunk(table, words, ranges).rows(table.column("__chunk")[0].as_py())

    def first(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _entries([], [], [], 1)
        chunk = Chunk(table, words, ranges)
        graded = sorted(zip(answers.column("bucket").to_pylist(), answers.column("a").to_pylist(), strict=True))
        rarity = np.concatenate([unpack(x, "u1") for _, x in graded] or [np.zeros(0, np.uint8)])
        token, of = chunk.prefixes(rarity, percent)
        return _entries(token, chunk.ids[of], chunk.sizes[of], ranges)

    rows = by_chunk.applyInArrow(tokens, "bucket long, chunk int, a binary, b binary")
    grades = rows.groupBy("bucket").applyInArrow(_rarity, "bucket long, chunk int, a binary")
    entries = by_chunk.cogroup(grades.groupBy("chunk")).applyInArrow(first, "bucket long, token binary, doc binary, n binary")
    return entries.groupBy("bucket").applyInArrow(lambda t: _meet(t, percent), "a long, b long")


def _entries(token, doc, size, ranges: int) -> pa.Table:
    token, doc, size = np.asarray(token, np.uint64), np.asarray(doc, np.int64), np.asarray(size, np.uint32)
    order = np.argsort(token, kind="stable")
    token, doc, size = token[order], doc[order], size[order]
    bucket = (((token >> np.uint64(40)) * np.uint64(ranges)) >> np.uint64(24)).astype(np.int64)
    head = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(token) else np.zeros(0, np.int64)
    tail = np.r_[head[1:], len(token)][: len(head)]
    packed = [[pack(x[a:b]) for a, b in zip(head, tail, strict=True)] for x in (token, doc, size)]
    return pa.table(
        {"bucket": pa.array(bucket[head], pa.int64()), **{k: pa.array(v, pa.binary()) for k, v in zip(("token", "doc", "n"), packed, strict=True)}}
    )


def _meet(table: pa.Table, percent: int) -> pa.Table:
    """Edges between neighbours of a shingle's documents in order of size, as long as their sizes allow a link.

    Where two neighbours' sizes do not, no smaller one fits any larger one either, so the chain breaks exactly there.
    """
    token, doc, n = (
        np.concatenate([unpack(x, t) for x in table.column(c).to_pylist()]) for c, t in (("token", "u8"), ("doc", "i8"), ("n", "u4"))
    )
    order = np.lexsort((doc, n, token))
    token, doc, n = token[order], doc[order], n[order].astype(np.int64)
    near = np.flatnonzero((token[1:] == token[:-1]) & (doc[1:] != doc[:-1]) & (100 * n[:-1] >= percent * n[1:]))
    a, b = np.minimum(doc[near], doc[near + 1]), np.maximum(doc[near], doc[near + 1])
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    return pa.table({"a": pa.array(a[new], pa.int64()), "b": pa.array(b[new], pa.int64())})


def similar_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs` (doc_id, text).

    A set holds the distinct shingles of `words` lower-cased words; a text with fewer words is one shingle; a null or
    empty text or one without words has an empty set and links with nothing. Sets link when
    100 * intersection >= percent * union. The component id is the smallest doc_id reachable by links. A null id
    links with nothing and has a null component; rows with the same id are one node; other columns are not read; an
    empty table gives an empty result.
    """
    _, n_bytes = text_volume(docs)
    chunks = max(1, -(-n_bytes // CHUNK_BYTES))
    sets = cut(_sets(docs, words))
    total = sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    linkable = sets.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = cut(linkable.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n")))
    ranges = max(1, -(-total // RANGE_ENTRIES))
    known = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    near = connected_components(_candidates(known, words, percent, chunks, ranges))
    members = classes.join(near, F.col("rep") == F.col("node")).select(F.col("root").alias("g"), "rep", "n")
    groups = members.groupBy("g").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("volume")).where("sets > 1")
    groups = groups.withColumn("blocks", F.ceil(F.col("volume") / BLOCK_SHINGLES).cast("int"))
    packs = groups.where("blocks = 1").agg(F.coalesce(F.sum("volume"), F.lit(0))).first()[0] // BLOCK_SHINGLES + 1
    members = cut(
        _in_blocks(members.join(groups.drop("sets", "volume"), "g"))
        .withColumn("pack", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("g"), F.lit(packs))).otherwise(-1))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    # Links inside blocks, and inside packs of small groups.
    here = hold(members.join(texts, "rep"))  # the texts of sets in groups only; all that is compared later
    dealt = here.withColumn("key", F.when(F.col("pack") >= 0, F.lit(-1).cast("long")).otherwise(F.col("g")))
    links = cut(dealt.groupBy("pack", "key", "block").applyInArrow(_compare(words, percent), "a long, b long"))
    links = _across_blocks(members, here.where("blocks > 1").select("rep", "text"), links, words, percent)
    here.unpersist()
    copies = linkable.join(classes.drop("n"), ["f1", "f2"]).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    roots = connected_components(links)
    # Copies hang on their representative's root; ids that occur with several sets are nodes of the graph as well.
    several = linkable.join(classes.drop("n"), ["f1", "f2"]).groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x <> y")
    if several.limit(1).count():
        roots = connected_components(links.union(copies))
    whole = sets.join(classes.drop("n"), ["f1", "f2"], "left").withColumn(
        "rep", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("rep")).otherwise(F.col("doc_id"))
    )
    whole = whole.join(roots, F.col("rep") == F.col("node"), "left")
    return whole.select("doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id"))


def _in_blocks(members: DataFrame) -> DataFrame:
    """`members` (g, rep, n, blocks) with the block of each: a group's sets in order of size, BLOCK_SHINGLES at a time.

    Sets of one size are dealt over the blocks that their size fills, so only sizes are ordered, not sets.
    """
    by_size = members.where("blocks > 1").groupBy("g", "n").agg(F.sum("n").alias("v"))
    upto = Window.partitionBy("g").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_size = by_size.withColumn("before", F.sum("v").over(upto) - F.col("v"))
    share = F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) / F.lit(1 << 20)
    block = F.floor((F.col("before") + share * F.col("v")) / BLOCK_SHINGLES).cast("int")
    return members.join(by_size, ["g", "n"], "left").withColumn("block", F.coalesce(block, F.lit(0))).drop("before", "v")


def _tiles(rows: DataFrame, percent: int) -> DataFrame:
    """(g, low, high, side, rep, comp, query): what pairs of blocks of `rows` (g, rep, n, block, comp, query) compare.

    Pairs without a query, and those whose sizes allow no link, are left out, and so are the sets of a block that
    fit no set of the other in size or have no query to meet there.
    """
    blocks = cut(
        rows.groupBy("g", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("query").alias("asks"))
    )
    other = blocks.select("g", F.col("block").alias("other"), "least", "most", "asks")
    pairs = blocks.select("g", "block", F.col("least").alias("a"), F.col("most").alias("b"), F.col("asks").alias("own")).join(other, "g")
    fit = (100 * F.col("b") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("a"))
    pairs = pairs.where((F.col("block") != F.col("other")) & (F.col("own") | F.col("asks")) & fit).drop("a", "b", "own")
    sent = rows.join(pairs, ["g", "block"]).where(
        (F.col("query") | F.col("asks"))
        & (100 * F.col("n") >= percent * F.col("least"))
        & (100 * F.col("most") >= percent * F.col("n"))
    )
    return sent.select(
        "g", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "rep", "comp", "query",
    )


def _compare(words: int, percent: int, cross: bool = False):
    """Links (document, smallest document connected to it) of the sets of one block or pack."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("rep").to_numpy()
        data, offsets = ragged(table.column("text"))
        parts = [shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words) for a, b in slices(offsets, SLICE_BYTES)]
        h = np.concatenate([p[0] for p in parts])
        at = np.r_[0, np.cumsum(np.concatenate([np.diff(p[1]) for p in parts]))]
        root = np.arange(len(ids))
        if cross:
            root = link_sets(h, at, percent, *(table.column(c).to_numpy() for c in ("query", "comp", "side")))
        else:
            group = table.column("g").to_numpy()
            order = np.argsort(group, kind="stable")
            edges = np.flatnonzero(np.r_[True, group[order][1:] != group[order][:-1], True])
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                rows = order[lo:hi]
                hs = np.concatenate([h[at[r] : at[r + 1]] for r in rows])
                offs = np.r_[0, np.cumsum(at[rows + 1] - at[rows])]
                root[rows] = rows[link_sets(hs, offs, percent)]
        other = np.flatnonzero(ids != ids[root])
        return pa.table({"a": pa.array(ids[other]), "b": pa.array(ids[root[other]])})

    return run


def _across_blocks(members: DataFrame, texts: DataFrame, links: DataFrame, words: int, percent: int) -> DataFrame:
    """Adds the links between blocks of the groups that were dealt in several.

    First one set of each component meets the others of its group, in blocks again, as long as that joins anything.
    Then what is still apart is compared exactly: every set outside its group's largest component is a query, and
    each pair of blocks with a query is a task of its own, so no link between two components can be missed and no
    task holds more than two blocks.
    """
    large = members.where("blocks > 1").select("g", "rep", "n", "blocks", "block")
    if not large.limit(1).count():
        return links
    large = cut(large)
    while True:
        comp = cut(
            large.join(connected_components(links), F.col("rep") == F.col("node"), "left").select(
                "g", "rep", "n", "blocks", "block", F.coalesce("root", "rep").alias("comp")
            )
        )
        centres = comp.where("rep = comp").select("g", "rep", "n")
        sizes = centres.groupBy("g").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("volume")).where("sets > 1")
        sizes = sizes.withColumn("blocks", F.ceil(F.col("volume") / BLOCK_SHINGLES).cast("int"))
        dealt = centres.join(sizes, "g").withColumn("block", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")))
        found = cut(
            dealt.join(texts, "rep").groupBy("g", "block").applyInArrow(_compare(words, percent), "a long, b long")
        )
        if not found.limit(1).count():
            break
        links = cut(links.union(found))
    weight = comp.groupBy("g", "comp").agg(F.count(F.lit(1)).alias("sets"))
    main = weight.groupBy("g").agg(F.max(F.struct("sets", "comp")).alias("m"), F.count(F.lit(1)).alias("parts"))
    open_groups = main.where("parts > 1").select("g", F.col("m.comp").alias("main"))
    rows = cut(comp.join(open_groups, "g").withColumn("query", F.col("comp") != F.col("main")))
    compare = _compare(words, percent, cross=True)
    found = _tiles(rows, percent).join(texts, "rep").groupBy("g", "low", "high").applyInArrow(compare, "a long, b long")
    return cut(links.union(found))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns kept, without those whose text is linked to a kept one.

    Rows are told apart by id and text, not by id alone: of the rows whose texts are linked, directly or over others,
    that with the smallest id stays (of several texts with that id, one, always the same), and of equal rows one. A
    row goes only because of its own text, whatever other rows have its id. Rows with a null id, and texts without
    words, stay. Columns of any name are kept as they are, but for names that start with `__near_`.

    A row's node is a hash of its id and text. Should two different rows have one node, both stay.
    """
    named = docs.where(F.col("doc_id").isNotNull()).withColumns(
        {"__near_node": F.xxhash64("doc_id", "text"), "__near_check": F.xxhash64(F.lit("check"), "text", "doc_id")}
    )
    nodes = named.groupBy("__near_node").agg(
        F.min("doc_id").alias("id"),
        ((F.min("doc_id") != F.max("doc_id")) | (F.min("__near_check") != F.max("__near_check"))).alias("clash"),
    )
    found = similar_components(named.select(F.col("__near_node").alias("doc_id"), "text"), words, percent)
    found = found.select(F.col("doc_id").alias("__near_node"), "component_id").distinct().join(nodes, "__near_node")
    found = cut(found)
    first = found.groupBy("component_id").agg(F.min(F.struct("id", "__near_node")).alias("first"))
    kept = first.select("first.__near_node").union(found.where("clash").select("__near_node")).distinct()
    one = Window.partitionBy("__near_node", "__near_check").orderBy("__near_check")
    chosen = named.join(kept, "__near_node", "left_semi").withColumn("__near_nth", F.row_number().over(one))
    return chosen.where("__near_nth = 1").select(*docs.columns).union(docs.where(F.col("doc_id").isNull()))


#: All pairs that share a shingle, and the smallest id reachable by links; for small tables.
ORACLE_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {WORDS} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + {WORDS} - 1], ' ') for i in range(1, len(ws) - {WORDS} + 2)]) END AS sh FROM w),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS i
    FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * i >= {PERCENT} * (na + nb - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id),
m AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT s.doc_id, len(sh) AS n_shingles, component_id FROM s JOIN m ON s.doc_id = m.doc_id
"""
