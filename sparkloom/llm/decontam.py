"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A test item is short and a document long, so their Jaccard similarity says nothing; what counts is
how much of the item lies inside the document. Items are partitioned by their number of shingles.
Within a partition each item's sketch is its k smallest shingle hashes, and a document is a
candidate if it holds one of them. k exceeds the number of shingles that may be missing at
the threshold, so no contained item is lost; only shingles below the largest sketched hash leave a
document. Candidates are then verified on the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.llm.common import let
from sparkloom.storage import broadcast_if_small, materialize

SHINGLE = 5
THRESHOLD = 0.8
#: Sketch rows, item shingles or candidate ids that may be broadcast; beyond, joins shuffle.
BROADCAST_ROWS = 1_000_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def windows(w: Column, sizes: list[int], of: Callable[[list[Column]], Column]) -> Column:
    """of(words of a window) for each window of each size; w is evaluated once."""

    def of_size(x: Column, n: int) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(x) - n), lambda i: of([F.get(x, i + k) for k in range(n)]))
        return F.when(F.size(x) >= n, each)

    def all_of(x: Column) -> Column:
        return F.flatten(F.filter(F.array(*[of_size(x, n) for n in sizes]), lambda a: a.isNotNull()))

    return let(w, all_of)


def hashes(w: Column, sizes: list[int]) -> Column:
    return windows(w, sizes, lambda x: F.xxhash64(*x))


def shingles(w: Column, sizes: list[int]) -> Column:
    return windows(w, sizes, lambda x: F.concat_ws(" ", *x))


def sketch(items: DataFrame, threshold: float) -> DataFrame:
    """(item_id, h, part): the bottom-k hashes of each item, k fixed by its size partition."""
    own = items.select("item_id", F.explode("hashes").alias("h")).distinct()
    by_item = Window.partitionBy("item_id")
    sized = own.withColumn("n", F.count(F.lit(1)).over(by_item)).withColumn("rank", F.row_number().over(by_item.orderBy("h")))
    part = F.floor(F.log2(F.col("n"))).cast("int")
    most = F.pow(F.lit(2.0), F.col("part") + 1) - 1  # the largest size of the partition
    missing = F.floor((1 - threshold) * most + 1e-9)
    return sized.withColumn("part", part).where(F.col("rank") <= missing + 1).select("item_id", "h", "part")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """(id, item_id, n_shingles, n_found, containment) for every document that holds at least threshold of an item's distinct shingles.

    An item with fewer words than a shingle counts as one shingle of its own length; an item
    without words is never found. Rows that share an id (or have none) are one document.
    Null texts hold nothing. Only the named columns are read, so other names can't clash.
    """
    w = tokens(F.col("t"))
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("t")).select("item_id", w.alias("w")).where(F.size("w") > 0)
    short = F.least(F.size("w"), F.lit(size))
    items = materialize(items.select("item_id", "w", short.alias("k")), "items")
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect()) or [size]
    # An item's own shingles all have one size: the shingle's, or the item's length where that is less.
    per_size = [items.where(F.col("k") == k).select("item_id", hashes(F.col("w"), [k]).alias("hashes"), shingles(F.col("w"), [k]).alias("shingles")) for k in sizes]
    items = per_size[0]
    for x in per_size[1:]:
        items = items.union(x)
    items = materialize(items, "item-shingles")
    marks = materialize(sketch(items, threshold), "item-sketches")
    top = marks.agg(F.coalesce(F.max("h"), F.lit(-(1 << 63)))).first()[0]
    docs = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t"))
    probes = docs.select("d", F.explode(F.filter(hashes(w, sizes), lambda h: h <= F.lit(top))).alias("h"))
    pairs = materialize(probes.join(broadcast_if_small(marks.select("item_id", "h"), BROADCAST_ROWS), "h").select("d", "item_id").distinct(), "candidates")
    ids = broadcast_if_small(materialize(pairs.select(F.col("d").alias("c")).distinct(), "candidate-ids"), BROADCAST_ROWS)
    held = docs.join(ids, F.col("d").eqNullSafe(F.col("c")), "left_semi").select("d", F.explode(F.array_distinct(shingles(w, sizes))).alias("s"))
    exact = items.select("item_id", F.explode(F.array_distinct("shingles")).alias("s"))
    exact = materialize(exact.withColumn("n_shingles", F.count(F.lit(1)).over(Window.partitionBy("item_id"))), "exact-shingles")
    found = held.join(broadcast_if_small(exact, BROADCAST_ROWS), "s").select("d", "item_id", "n_shingles", "s").distinct()
    found = found.groupBy("d", "item_id", "n_shingles").agg(F.count(F.lit(1)).alias("n_found")).where(F.col("n_found") >= F.lit(threshold) * F.col("n_shingles") - 1e-9)
    sure = found.join(pairs.select(F.col("d").alias("p"), F.col("item_id").alias("p_item")), F.col("d").eqNullSafe(F.col("p")) & (F.col("item_id") == F.col("p_item")), "left_semi")
    return sure.select(F.col("d").alias(id_col), F.col("item_id"), "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs in which no item is found, with all their columns."""
    gone = contaminated(docs, items, id_col, text_col, **options).select(F.col(id_col).alias("gone_id")).distinct()
    gone = broadcast_if_small(materialize(gone, "contaminated"), BROADCAST_ROWS)
    return docs.join(gone, docs[id_col].eqNullSafe(gone["gone_id"]), "left_anti")
