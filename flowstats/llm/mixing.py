"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order. A document's virtual finish time is the number of words
of its source up to and including it, divided by the source's target; a second pass over a source continues its clock.
The mix is the globally ordered list of (virtual finish time, source, document), cut at the total budget.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowstats.llm.common import cut

# Weights in turn over the sources in code point order, and the share of all words.
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_REPEATS = 2


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in the text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Filling level: a source gets weight x level words, at most MAX_REPEATS x its size, and the level is such that
    the targets add up to the share of all words. Sorted by the level at which each source is full, the level
    follows from running sums, so there is no loop. One row per source only.
    """
    full = Window.orderBy("cap_level", "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = (
        sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * MAX_REPEATS)
        .withColumn("cap_level", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * SHARE_PERCENT / F.lit(100.0))
        # If exactly the sources before this one are full, the level of the rest is:
        .withColumn("capped_before", F.coalesce(F.sum("cap").over(full), F.lit(0)))
        .withColumn(
            "weight_left",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full), F.lit(0)),
        )
        .withColumn("level", (F.col("budget") - F.col("capped_before")) / F.col("weight_left"))
    )
    # The level is the one of the first source that it does not fill.
    level = F.min(F.when(F.col("level") < F.col("cap_level"), F.struct("cap_level", "rank", "level"))).over(everything)
    return ranked.withColumn("found", level["level"]).select(
        "source",
        "rank",
        "source_size",
        F.when(F.col("source_size") == 0, F.lit(0.0))
        .otherwise(F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * F.col("found"), F.col("cap"))))
        .alias("target"),
    )


def mix_sources(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of `docs` (doc_id, text, source).

    `taken` is the number of words of the row that the mix takes, repeats counted: 0, size or 2 x size. Null texts
    have size 0 and are never taken; null sources are one source of their own, last; repeated rows queue one after
    the other; an empty table gives an empty result. Other columns are ignored. The order within a source is that
    of a hash of the id, so reruns agree.

    Running sums are taken in two levels, so that a source with a third of the rows is spread over many tasks:
    ranges of the hash (`slice`) are summed first, their offsets come from a window over those few sums, and the
    window over rows covers one slice of one source. The cut at the budget is found the same way over ranges of
    virtual time; it is one (virtual finish time, source rank), against which every row is compared.
    """
    words = cut(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h"),
        )
    )
    # As many slices as rows in one, up to a constant: neither the windows over slices nor those over rows grow fast.
    slices = max(1, math.isqrt(words.count()) // 2)
    targets = source_targets(words.groupBy("source").agg(F.sum("size").alias("source_size")))
    slice_of = F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * F.lit(slices) / F.lit(2**32))
    queue = words.withColumn("slice", slice_of)

    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        queue.groupBy("source", "slice")
        .agg(F.sum("size").alias("slice_words"))
        .withColumn("start", F.coalesce(F.sum("slice_words").over(before), F.lit(0)))
        .join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .select(F.col("source").alias("of"), F.col("slice").alias("part"), "start", "rank", "source_size", "target")
    )
    up_to = Window.partitionBy("source", "slice").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = cut(
        queue.withColumn("words", F.sum("size").over(up_to))
        .join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("part")))
        .select(
            "doc_id", "source", "size", "source_size", "target", "rank",
            *[
                F.when(
                    (F.col("size") > 0) & (F.col("target") > 0),
                    (F.col("start") + F.col("words") + F.col("source_size") * p) / F.col("target"),
                ).alias(f"finish{p}")
                for p in range(MAX_REPEATS)
            ],
        )
    )
    last = _last_taken(placed, slices)
    if last is None:
        taken = F.lit(0).cast("long")
    else:
        taken = sum(
            F.when(
                (F.col(f"finish{p}") < last[0]) | ((F.col(f"finish{p}") == last[0]) & (F.col("rank") <= last[1])),
                F.col("size"),
            ).otherwise(F.lit(0))
            for p in range(MAX_REPEATS)
        )
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def _last_taken(placed: DataFrame, slices: int) -> tuple[float, int] | None:
    """(virtual finish time, source rank) of the last entry before the global order exceeds the budget."""
    entries = placed.select(
        "size", "rank", F.explode(F.array(*[F.col(f"finish{p}") for p in range(MAX_REPEATS)])).alias("finish")
    ).where(F.col("finish").isNotNull())
    entries = entries.withColumn("range", F.floor(F.col("finish") * slices))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    sums = entries.groupBy("range").agg(F.sum("size").alias("range_words")).withColumn("upto", F.sum("range_words").over(upto))
    budget = placed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] * SHARE_PERCENT / 100.0
    # The first range that exceeds the budget holds the cut; everything fits only in an empty mix.
    at = sums.where(F.col("upto") > F.lit(budget)).orderBy("range").select("range", F.col("upto") - F.col("range_words")).first()
    if at is None:
        return None
    inside = Window.orderBy("finish", "rank").rowsBetween(Window.unboundedPreceding, 0)
    row = (
        entries.where(F.col("range") == F.lit(at[0]))
        .withColumn("total", F.sum("size").over(inside) + F.lit(at[1]))
        .where(F.col("total") <= F.lit(budget))
        .orderBy(F.desc("finish"), F.desc("rank"))
        .select("finish", "rank")
        .first()
    )
    if row is None:  # the cut lies before the range's first entry
        row = (
            entries.where(F.col("range") < F.lit(at[0]))
            .orderBy(F.desc("finish"), F.desc("rank"))
            .select("finish", "rank")
            .first()
        )
    return None if row is None else (row[0], row[1])


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns kept, of which the mix takes anything, with size, source_size, target, taken.

    Equal rows (id, source and text) share what the mix takes of them evenly. Columns of `docs` with the added names
    are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "taken")
    tagged = docs.withColumn("__size", word_count(F.col("text")))
    taken = (
        mix_sources(docs)
        .where("taken > 0")
        .groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__words"))
        .agg(F.sum("taken").alias("__taken"), F.max("source_size").alias("source_size"), F.max("target").alias("target"))
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("__id"))
        & F.col("source").eqNullSafe(F.col("__source"))
        & (F.col("__size") == F.col("__words"))
    )
    copies = F.count(F.lit(1)).over(Window.partitionBy("__id", "__source", "__words"))
    joined = tagged.join(taken, same).withColumn("taken", (F.col("__taken") / copies).cast("long"))
    return joined.select(*docs.columns, F.col("__size").alias("size"), "source_size", "target", "taken")


ORACLE_SQL = rf"""
WITH w AS (SELECT doc_id, source,
    CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM w GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS rank FROM s),
k AS (SELECT *, [{", ".join(map(str, WEIGHTS))}][CAST((rank - 1) % {len(WEIGHTS)} + 1 AS INTEGER)] AS weight,
    source_size * {MAX_REPEATS} AS cap FROM r),
c AS (SELECT *, CAST(cap AS DOUBLE) / weight AS cap_level FROM k),
l AS (SELECT *, (sum(source_size) OVER () * {SHARE_PERCENT} / CAST(100 AS DOUBLE)
      - coalesce(sum(cap) OVER (ORDER BY cap_level, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER
        (ORDER BY cap_level, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level FROM c),
f AS (SELECT arg_min(level, cap_level) AS found FROM l WHERE level < cap_level),
t AS (SELECT source, rank, source_size, CASE WHEN source_size = 0 THEN CAST(0 AS DOUBLE)
    ELSE least(CAST(cap AS DOUBLE), coalesce(weight * found, cap)) END AS target FROM l, f),
q AS (SELECT w.*, t.rank, t.source_size, t.target,
    sum(size) OVER (PARTITION BY w.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS words
    FROM w JOIN t ON w.source IS NOT DISTINCT FROM t.source),
e AS (SELECT doc_id, size, rank, CAST(words + source_size * p AS DOUBLE) / target AS finish
    FROM q, range({MAX_REPEATS}) AS passes(p) WHERE size > 0 AND target > 0),
o AS (SELECT *, sum(size) OVER (ORDER BY finish, rank ROWS UNBOUNDED PRECEDING) AS total FROM e),
m AS (SELECT doc_id, sum(size) AS taken FROM o
    WHERE total <= (SELECT sum(size) FROM w) * {SHARE_PERCENT} / CAST(100 AS DOUBLE) GROUP BY doc_id)
SELECT q.doc_id, q.source, q.size, CAST(q.source_size AS BIGINT) AS source_size, q.target,
    CAST(coalesce(m.taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN m ON q.doc_id = m.doc_id
"""
