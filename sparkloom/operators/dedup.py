"""First-wins deduplication over two keys, and collection with caps."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.operators.running import running
from sparkloom.storage import materialize


#: Undecided rows of narrow keys that one task scans in order.
SCAN_ROWS = 200_000


def first_of(df: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """The first row of each key."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    return ranked.where("_rank = 1").drop("_rank")


def dedup_two_keys(df: DataFrame, exact: str = "fingerprint", near: str = "near_fingerprint", order: str = "seq") -> DataFrame:
    """Rows that a scan in order keeps, when a row goes if a kept one has its exact or its near key.

    order must be unique. A null near key is the exact one; rows without either are copies of each other. Where
    the exact key fixes the near key one sum answers. In general the kept rows are found in rounds over the narrow
    keys: an undecided row that is first in both its groups stays and takes its group-mates with it. Each round is
    a table in the shared folder. What is undecided and fits SCAN_ROWS is scanned in one task, which ends long chains.
    """
    key = lambda *c: F.coalesce(*[F.col(x).cast("string") for x in c], F.lit("None"))
    keys = materialize(df.select(F.col(order).alias("o"), key(exact).alias("a"), key(near, exact).alias("b")), "dedup-keys")
    loose = keys.groupBy("a").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).where("lo != hi")
    if loose.isEmpty():
        kept = keys.groupBy("b").agg(F.min("o").alias("o")).select("o")
        return df.join(kept, df[order] == kept.o, "left_semi")
    left, kept = keys, keys.select("o").limit(0)
    while left.limit(SCAN_ROWS + 1).count() > SCAN_ROWS:
        firsts = left.withColumn("fa", F.min("o").over(Window.partitionBy("a"))).withColumn("fb", F.min("o").over(Window.partitionBy("b")))
        won = materialize(firsts.where("o = fa and o = fb").select("o", "a", "b"), "dedup-won")
        kept = kept.union(won.select("o"))
        left = left.join(won.select("a"), "a", "left_anti").join(won.select("b"), "b", "left_anti").select("o", "a", "b")
        left = materialize(left, "dedup-left")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a_seen, b_seen = set(), set()
        for pdf in batches:
            stays = []
            for a, b in zip(pdf["a"], pdf["b"], strict=True):
                stays.append(a not in a_seen and b not in b_seen)
                if stays[-1]:
                    a_seen.add(a)
                    b_seen.add(b)
            yield pdf.loc[stays, ["o"]]

    kind = df.schema[order].dataType.simpleString()
    kept = kept.union(left.repartition(1).sortWithinPartitions("o").mapInPandas(scan, f"o {kind}"))
    return df.join(kept, df[order] == kept.o, "left_semi")


def group_cap(df: DataFrame, group: str, most: int, order) -> DataFrame:
    """At most most rows of each group, first in order; 0 leaves all."""
    if most <= 0:
        return df
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(order)))
    return ranked.where(F.col("_rank") <= most).drop("_rank")


def collect_in_order(df: DataFrame, targets: dict[str, int], most_per_group: int = 0, source: str = "source", row: str = "row") -> DataFrame:
    """Decisions of a collection: (seq, outcome), where state is shared by all sources.

    df: seq (unique), source, row (numbers the raw rows of a source), fp, near, grp, tokens. A source
    stops before the raw row that finds its target reached. Rows after are `not_read`; others
    are duplicate, near_duplicate, group_limit or accepted. Caps, duplicates and stops depend on all
    that came before, so the fold is sequential by nature: it runs on the narrow keys only, in
    one task, and its state is the sets of accepted keys.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        exact, close, groups, taken, reading = set(), set(), {}, {}, {}
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                if reading.get(r.source) != r.row and taken.get(r.source, 0) >= targets.get(r.source, 1 << 62):
                    out.append("not_read")
                    continue
                reading[r.source] = r.row
                if r.fp in exact:
                    out.append("duplicate")
                elif r.near in close:
                    out.append("near_duplicate")
                elif most_per_group and groups.get(r.grp, 0) >= most_per_group:
                    out.append("group_limit")
                else:
                    exact.add(r.fp)
                    close.add(r.near)
                    groups[r.grp] = groups.get(r.grp, 0) + 1
                    taken[r.source] = taken.get(r.source, 0) + r.tokens
                    out.append("accepted")
            yield pd.DataFrame({"seq": pdf["seq"], "outcome": out})

    narrow = df.select("seq", F.col(source).alias("source"), F.col(row).alias("row"), "fp", "near", "grp", "tokens")
    return narrow.repartition(1).sortWithinPartitions("seq").mapInPandas(fold, "seq long, outcome string")


def source_stop(df: DataFrame, target, tokens: str = "tokens", source: str = "source", order: str = "seq") -> DataFrame:
    """Rows of each source until their tokens reach the target (a column or number): the row that reaches it is the last."""
    return running(df, tokens, order, source).where(F.col("_before") < target).drop("_before")
