"""Mixing sources to target weights by systematic sampling.

A document's expected copies are its source's target over its source's size. Within a source,
documents are ranked by size, the expected copies are summed along the rank, one random offset
is added, and a document is emitted once for each whole number that its step crosses. Ranks
are global but computed piecewise: the narrow table is range-partitioned, each piece ranks its own
rows, and counts of earlier pieces are added; no source lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.llm.common import let, words
from sparkloom.storage import materialize

WEIGHTS = (3, 1, 2)
#: Words to take over words there are, and the most that a source is repeated.
BUDGET = 1.5
MOST = 2
SEED = 42


def unit(key: Column) -> Column:
    """A reproducible number in [0, 1): the first 13 hex digits of the key's SHA-256."""
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 13), 16, 10).cast("bigint").cast("double") / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one narrow row per source.

    Sources by code point, null last, take the weights in turn. Filling by weight until a source
    reaches most times its size, and resharing the excess, ends at one water level: sources are
    ordered by the level at which they are full, and the level is the first that leaves the rest
    unfilled.
    """
    ordered = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows = ordered.withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    by_full = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    upto = by_full.rowsBetween(Window.unboundedPreceding, -1)
    after = by_full.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("full", F.coalesce(F.sum("cap").over(upto), F.lit(0))).withColumn("open", F.sum("weight").over(after))
    total = F.sum("source_size").over(Window.partitionBy())
    rows = rows.withColumn("level", (F.lit(budget) * total - F.col("full")) / F.col("open"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    first = F.first(fits, ignorenulls=True).over(by_full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = F.coalesce(first, F.lit(float("inf")))
    target = F.when(level * F.col("weight") < F.col("cap"), level * F.col("weight")).otherwise(F.col("cap").cast("double"))
    return rows.select("source", "source_size", target.alias("target"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, **options) -> DataFrame:
    """Per row of docs: id, size, source_size, target and n_copies (whole, at most 2).

    Size counts words; a null text has 0 and is taken like any other document of size 0. A null
    source is a source of its own. Repeated rows are separate documents.
    """
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), let(words(F.col(text_col)), F.size).cast("bigint").alias("size"))
    rows = materialize(rows.withColumn("key", unit(key)), "mix-sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = materialize(targets(sums, **options), "mix-targets")
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("key"), F.col("id")]
    pieces = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = materialize(rows.repartitionByRange(pieces, *order).withColumn("piece", F.spark_partition_id()), "mix-order")
    own = F.row_number().over(Window.partitionBy("piece", "source").orderBy(*order[1:]))
    counts = dealt.groupBy("piece", "source").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select(F.col("piece").alias("b_piece"), F.col("source").alias("b_source"), F.coalesce(before, F.lit(0)).alias("before"))
    ranked = dealt.withColumn("own", own).join(before, (F.col("piece") == F.col("b_piece")) & F.col("source").eqNullSafe(F.col("b_source")))
    ranked = ranked.withColumn("rank", F.col("before") + F.col("own"))
    goals = goals.select(F.col("source").alias("g_source"), "source_size", "target")
    joined = ranked.join(goals, F.col("source").eqNullSafe(F.col("g_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = unit(F.concat_ws(":", F.lit(seed), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null"))))
    step = F.floor(F.col("rank") * rate + start) - F.floor((F.col("rank") - 1) * rate + start)
    return joined.select(F.col("id").alias(id_col), "size", "source_size", "target", F.least(step, F.lit(MOST)).cast("bigint").alias("n_copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with all its columns and a number (copy, from 1).

    Rows that share an id take the most copies that one of them gets.
    """
    n = copies(docs, id_col, text_col, source_col, **options).where("n_copies > 0")
    n = n.groupBy(F.col(id_col).alias("m_id")).agg(F.max("n_copies").alias("m_copies"))
    name = next(x for k in range(99) if (x := f"copy{k or ''}") not in docs.columns)
    taken = docs.join(n, docs[id_col].eqNullSafe(n["m_id"]))
    return taken.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), n["m_copies"].cast("int"))).alias(name))
