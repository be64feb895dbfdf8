r"""Operator 10: mixing sources to target weights by weighted fair queueing.

Built-ins only.  A document's size is its number of words.  The budget
(``share`` of all words) is dealt to the sources by weight; a source gets at
most ``max_repeats`` times its own size, and what it cannot use is dealt again
by weight to the others until none is above (:func:`source_targets`).

Each source is a queue: its documents in a seeded shuffle, read ``max_repeats``
times over.  A copy's virtual finish time is the source's words up to its end,
divided by the source's target weight; the fluid schedule has served exactly
the budget at virtual time 1.  Copies are range-sorted by finish time over all
sources and the sorted mix is truncated at the budget; the copy in service at
the cut counts with the words served until then.  The mix as documents
(:func:`mixed_documents`) takes that copy whole: no text is cut or rewritten.

Running sums never need a whole source in one task: shuffle keys fall into
4,096 ranges per source, range totals give each range its base, and only one
range is summed row by row.  The global sum uses 4,096 ranges of virtual time
in the same way.

Defined results: null text has size 0; documents of size 0 are never taken; a
null source is a source of its own, last in order; with no words at all every
target is 0; repeated rows queue separately; null ids are allowed; an empty
table gives an empty result; other columns of the input do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def queued(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """*docs* with its queue columns (all named with two underscores)."""
    return (docs.withColumn("__size", word_count(F.col("text")))
            .withColumn("__none", F.col("source").isNull())
            .withColumn("__src", F.coalesce(F.col("source"), F.lit("")))
            .withColumn("__h", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(
                F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
            .withColumn("__range", F.conv(F.substring("__h", 1, 3), 16, 10).cast("int")))


def source_targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: __none, __src, source_size, target.

    Sources in code-point order (null last) weigh ``weights``, repeating.  The
    reshare has a closed form: in order of cap / weight a source is capped iff
    its cap / weight is below the level left by those before it; all others
    get (level x weight).  The table has one row per source name.
    """
    sizes = rows.groupBy("__none", "__src").agg(F.sum("__size").alias("source_size"))
    order = Window.orderBy("__none", "__src")
    cyc = F.array(*[F.lit(float(w)) for w in weights])
    weighed = (sizes.withColumn("__k", F.row_number().over(order))
               .withColumn("__w", cyc[((F.col("__k") - 1) % len(weights)).cast("int")])
               .withColumn("__cap", F.col("source_size") * float(max_repeats))
               .withColumn("__r", F.col("__cap") / F.col("__w")))
    every = Window.orderBy("__r", "__k").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("__r", "__k").rowsBetween(Window.unboundedPreceding, -1)
    level = (weighed
             .withColumn("__budget", F.sum("source_size").over(every) * share)
             .withColumn("__level",
                         (F.col("__budget") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
                         / (F.sum("__w").over(every)
                            - F.coalesce(F.sum("__w").over(before), F.lit(0.0))))
             .withColumn("__open", F.col("__r") >= F.col("__level")))
    final = F.max(F.when(F.col("__open"), F.col("__level"))).over(every)
    return (level.withColumn("target", F.when(F.col("__open"), final * F.col("__w"))
                             .otherwise(F.col("__cap")))
            .select("__none", "__src", "source_size", "target"))


def scheduled(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
              max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """*docs* plus __size, source_size, target, __start (words of its source
    queued before it) and __row (its place in its range of the queue)."""
    rows = queued(docs, seed)
    targets = source_targets(rows, weights, share, max_repeats)
    ranges = rows.groupBy("__none", "__src", "__range").agg(F.sum("__size").alias("__sum"))
    before = (Window.partitionBy("__none", "__src").orderBy("__range")
              .rowsBetween(Window.unboundedPreceding, -1))
    base = (ranges.withColumn("__base", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
            .drop("__sum").join(targets, ["__none", "__src"]))
    inside = (Window.partitionBy("__none", "__src", "__range")
              .orderBy("__h", F.col("doc_id").asc_nulls_last(), "__size"))
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.join(base, ["__none", "__src", "__range"])
            .withColumn("__row", F.row_number().over(inside))
            .withColumn("__start", F.col("__base") + F.sum("__size").over(running)
                        - F.col("__size")))


def queued_copies(rows: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per copy in the queue: __copy and __begin (words queued before it)."""
    return (rows.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
            .withColumn("__begin", F.col("__start") + F.col("__copy") * F.col("source_size")))


def copies(rows: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per copy in service before virtual time 1: __copy, __words
    (served by then) and __finish (virtual finish time, 1 for the copy cut)."""
    out = queued_copies(rows, max_repeats).withColumn(
        "__words", F.least(F.col("__size"), F.floor(F.col("target")) - F.col("__begin")))
    return (out.filter("__words > 0")
            .withColumn("__finish", F.least(F.lit(1.0), (F.col("__begin") + F.col("__size"))
                                            / F.col("target"))))


def truncated_mix(segments: DataFrame, budget: DataFrame) -> DataFrame:
    """Range-sort *segments* by __finish and truncate at the budget (a one-row
    frame): adds mix_offset (words of the mix before the segment) and cuts
    __words at the budget."""
    slots = segments.withColumn("__slot", F.floor(F.col("__finish") * 4096).cast("int"))
    sums = slots.groupBy("__slot").agg(F.sum("__words").alias("__sum"))
    before = Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    base = (sums.withColumn("__slot_base", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
            .drop("__sum"))
    order = (Window.partitionBy("__slot")
             .orderBy("__finish", "__none", "__src", "__copy", "__range", "__row")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = budget.scalar()
    return (slots.join(base, "__slot")
            .withColumn("mix_offset", F.col("__slot_base") + F.sum("__words").over(order)
                        - F.col("__words"))
            .withColumn("__words", F.greatest(F.lit(0), F.least(
                F.col("__words"), F.floor(total) - F.col("mix_offset"))).cast("long")))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    rows = materialise(
        scheduled(docs.select("doc_id", "source", "text"), weights, share, max_repeats, seed)
        .drop("text", "__base"), "mix")
    budget = rows.agg(F.coalesce(F.sum("__size"), F.lit(0)) * share)
    segments = truncated_mix(copies(rows, max_repeats), budget)
    key = ["__none", "__src", "__range", "__row"]
    taken = segments.groupBy(*key).agg(F.sum("__words").alias("taken"),
                                       F.min("mix_offset").alias("mix_offset"))
    return (rows.join(taken, key, "left")
            .select("doc_id", "source", F.col("__size").alias("size"), "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "mix_offset"))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                    max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix as documents: one row per copy taken, all input columns.  A copy
    is taken whole if it enters service before virtual time 1, so a source
    exceeds its target by less than its last document."""
    rows = queued_copies(scheduled(docs, weights, share, max_repeats, seed), max_repeats)
    return (rows.filter((F.col("__size") > 0) & (F.col("__begin") < F.col("target")))
            .select(*docs.columns))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, source IS NULL AS none, coalesce(source, '') AS src,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
s AS (SELECT none, src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY none, src),
w AS (SELECT *, row_number() OVER (ORDER BY none, src) AS k FROM s),
c AS (SELECT *, CAST([3, 1, 2][((k - 1) % 3) + 1] AS DOUBLE) AS w,
             2.0::DOUBLE * source_size AS cap FROM w),
r AS (SELECT *, cap / w AS r FROM c),
l AS (
  SELECT *, ((sum(source_size) OVER ()) * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY r, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY r, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev
  FROM r),
t AS (
  SELECT none, src, source_size,
         CASE WHEN r >= lev THEN w * max(CASE WHEN r >= lev THEN lev END) OVER () ELSE cap END AS target
  FROM l),
q AS (
  SELECT d.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY d.none, d.src ORDER BY h, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
  FROM d JOIN t ON d.none = t.none AND d.src = t.src),
g AS (
  SELECT *, greatest(0, least(size, floor(target) - start))
          + greatest(0, least(size, floor(target) - start - source_size)) AS taken
  FROM q),
o AS (
  SELECT q.none, q.src, q.h, q.doc_id, q.size, e,
         least(q.size, floor(target) - start - e * source_size) AS words,
         least(1.0, (start + e * source_size + q.size) / target) AS fin, start
  FROM q CROSS JOIN (SELECT unnest([0, 1]) AS e) WHERE least(q.size, floor(target) - start - e * source_size) > 0),
m AS (
  SELECT none, src, start, size, doc_id, e,
         sum(words) OVER (ORDER BY fin, none, src, e, h, doc_id, size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - words AS mix_offset
  FROM o)
SELECT g.doc_id, g.source, g.size, g.source_size, g.target, CAST(g.taken AS BIGINT) AS taken,
       CAST(m.mix_offset AS BIGINT) AS mix_offset
FROM g LEFT JOIN m ON m.none = g.none AND m.src = g.src AND m.start = g.start AND m.size = g.size
     AND m.doc_id IS NOT DISTINCT FROM g.doc_id AND m.e = 0
"""
