"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight schedule over training time 0..1.  Its target says how many words the whole mix takes from
it; the integral of the schedule says how these words are spread over time.  A document stands at some place of its
source's stream of words, and the inverse of the cumulative demand turns that place into a training position.  Sorting
by range on the position yields the training order.

The stream order within a source is a hash of the row (id, size and text), so reruns agree and the order is the same
however many tasks share the work.  Rows are range-partitioned by source, hash and row number of the written table,
so neither a source with a third of all rows nor a row that repeats without end lands in one task; running sums over
the partitions give each its start, and rows are only summed up inside one partition.  Sources are ranked the same
way, and the common level of their targets is found by aggregates, so there may be as many sources as web domains.
Only keys and sizes are shuffled, never texts.

Defined results: a null text has size 0; null sources are one source, the last; rows that repeat are separate
documents, and which of the same ones is taken is open, as they are alike; a source whose documents are all empty has
target 0; an empty table gives an empty result; input columns other than those named are not carried.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.text import blanks_to_spaces, single_spaces, word_count
from siltstone.operators.groups import with_position
from siltstone.storage import materialize

#: Weights by the rank of the source, the share of all words to take, and the most passes.
WEIGHTS, SHARE, MOST_PASSES = (5, 2, 1), 1.5, 2.0
#: Rows (id, source, size, hash) to one task; it shapes the work, not the result.
TASK_ROWS = 200_000
#: Weight of a source at the start and the end of training, linear between, repeating by rank.
SCHEDULES = ((1.0, 1.0), (2.0, 0.5), (0.5, 2.0))


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, source, size, a 60-bit hash that orders the rows of a source, and a number that tells equal rows apart."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    picked = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), blanks_to_spaces(text).alias("_flat"), F.md5(text).alias("_m"))
    flat = picked.select("doc_id", "source", "_m", single_spaces(F.col("_flat")).alias("_flat"))
    sized = flat.select("doc_id", "source", "_m", word_count(F.col("_flat")).alias("size"))
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"), F.col("_m")))
    return sized.select("doc_id", "source", "size", F.conv(F.substring(key, 1, 15), 16, 10).cast("long").alias("_h"), F.monotonically_increasing_id().alias("_row"))


def targets(by_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> DataFrame:
    """Adds ``rank`` and ``target`` to a table of one row per source with ``source_size``.

    A source is capped at ``most`` times its size; what is cut off is shared out again by weight.  The limit of that is
    a common level L with target = min(cap, weight * L).  The total of the targets is a concave function of L, so
    Newton's method climbs to the level in a few steps, each one aggregate over the sources.
    """
    ranked = with_position(by_source, F.col("source").isNull(), F.col("source"), out="_i")
    rank = (F.col("_i") + 1).alias("rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    capped = materialize(ranked.select("source", "source_size", rank, weight.alias("_w"), (F.col("source_size") * F.lit(float(most))).alias("_cap")), "sources")
    words, weighs = capped.agg(F.sum("source_size"), F.sum("_w")).first()
    full, level = 0, (words or 0) * share / weighs if weighs else math.inf
    while level < math.inf:
        filled = F.col("_cap") <= F.col("_w") * F.lit(level)
        n, held, open_ = capped.agg(F.count_if(filled), F.coalesce(F.sum(F.when(filled, F.col("_cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~filled, F.col("_w"))), F.lit(0.0))).first()
        if n == full:
            break
        full, level = n, (words * share - held) / open_ if open_ else math.inf
    return capped.select("source", "source_size", "rank", F.least("_cap", F.col("_w") * F.lit(level)).alias("target"))


def invert_schedule(share: Column, begin: Column, end: Column) -> Column:
    """The time at which ``share`` (0..1) of the integral of a linear weight from ``begin`` to ``end`` is reached.

    The cumulative demand is D(t) = (begin * t + (end - begin) * t * t / 2) / ((begin + end) / 2).
    """
    mean, slope = (begin + end) / 2, end - begin
    root = (F.sqrt(begin * begin + 2 * slope * mean * share) - begin) / slope
    return F.when(slope == 0, share).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), root)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES, schedules: tuple[tuple[float, float], ...] = SCHEDULES, parts: int | None = None) -> DataFrame:
    """One row per document: ``size``, ``source_size``, ``target``, ``taken`` (words, repeats counted) and ``positions``.

    ``positions`` holds the training position of each pass; it is empty for documents that the mix leaves out, which
    come last.  A document is taken for the n-th time when n - 1 full passes over its source and the words before its
    middle in the stream fit the target, so every source ends within about one document of its target.  A fractional
    ``most`` allows its last pass to part of a source.  ``parts`` is the number of tasks, by rows unless given.
    """
    spark = docs.sparkSession
    sized = materialize(sizes(docs, id_col, text_col, source_col), "mixing")
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sized.count() // TASK_ROWS))
    order = [F.col("source").isNull(), F.col("source"), F.col("_h"), F.col("_row")]
    dealt = materialize(sized.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "mixing-dealt")
    by_part = materialize(dealt.groupBy("source", "_part").agg(F.sum("size").alias("_words")), "mixing-parts")
    by_source = targets(by_part.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, share, most)
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select("source", "_part", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_start"))
    plan = starts.alias("a").join(by_source.alias("s"), F.col("a.source").eqNullSafe(F.col("s.source"))).select("a.*", "source_size", "target", "rank")
    inside = Window.partitionBy("_part", "source").orderBy("_h", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("_end", F.sum("size").over(inside))
    joined = placed.alias("p").join(plan.alias("q"), (F.col("p._part") == F.col("q._part")) & F.col("p.source").eqNullSafe(F.col("q.source")))
    joined = joined.select("p.doc_id", "p.source", "p.size", "p._h", "p._row", "q.source_size", "q.target", "q.rank", (F.col("q._start") + F.col("p._end") - F.col("p.size") / 2).alias("_middle"))
    passes = F.filter(F.sequence(F.lit(0), F.lit(math.ceil(most) - 1)), lambda n: (F.col("size") > 0) & (n * F.col("source_size") + F.col("_middle") <= F.col("target")))
    kind = ((F.col("rank") - 1) % len(schedules) + 1).cast("int")
    begin, end = (F.element_at(F.array(*[F.lit(float(s[i])) for s in schedules]), kind) for i in (0, 1))
    positions = F.transform("_passes", lambda n: invert_schedule((n * F.col("source_size") + F.col("_middle")) / F.col("target"), begin, end))
    out = joined.withColumn("_passes", passes).withColumn("positions", positions)
    mixed = out.select("doc_id", "source", "size", "source_size", "target", (F.size("_passes") * F.col("size")).cast("long").alias("taken"), "positions", F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0)).alias("_at"), "_h", "_row")
    return mixed.repartitionByRange("_at", "_h", "_row").sortWithinPartitions("_at", "_h", "_row").drop("_at", "_h", "_row")
