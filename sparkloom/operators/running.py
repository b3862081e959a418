"""Running sums that no single task has to make: sums of pieces, or of prefixes of a hash, decide where a row stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.storage import broadcast_if_small, materialize

#: Hex digits of a hash whose sums are compared with a budget first, and pieces' sums that may be broadcast.
DIGITS = 4
BROADCAST_SUMS = 200_000


def running(df: DataFrame, value: str, order: str, by: str) -> DataFrame:
    """df with _before: the sum of value over the earlier rows (in order) of the same by.

    Rows are dealt by ranges of by and order, so a by of any size is cut into pieces; each piece sums its own
    rows and adds the sums of the pieces before it. order must be unique within by.
    """
    dealt = materialize(df.repartitionByRange(by, order).withColumn("_piece", F.spark_partition_id()), "running")
    sums = dealt.groupBy(F.col(by).alias("_by"), F.col("_piece").alias("_p")).agg(F.sum(value).alias("_sum"))
    # A by and a piece have one row here: as many rows in all as there are pieces and bys.
    sums = sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(Window.partitionBy("_by").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    sums = broadcast_if_small(materialize(sums, "running-sums"), BROADCAST_SUMS)
    own = F.sum(value).over(Window.partitionBy(by, "_piece").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    summed = dealt.withColumn("_own", F.coalesce(own, F.lit(0)))
    joined = summed.join(sums, summed[by].eqNullSafe(sums["_by"]) & (summed["_piece"] == sums["_p"]))
    return joined.select(*df.columns, (F.col("_own") + F.col("_offset")).alias("_before"))


def within_reach(df: DataFrame, hashed: Column, value: str, budget: int | Column, *by: str) -> DataFrame:
    """Rows that a take in the order of a hash (hex) can reach before the budget, and some more: those of the same prefix.

    Only sums of prefixes are sorted; of the rows, what lies behind the budget is dropped where it lies.
    """
    prefix = F.substring(hashed, 1, DIGITS)
    sums = df.groupBy(*by, prefix.alias("_prefix")).agg(F.sum(value).alias("_sum"))
    order = Window.partitionBy(*[F.col(b) for b in by] or [F.lit(0)]).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    reached = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(order), F.lit(0))).where(F.col("_before") < budget)
    last = reached.groupBy(*[F.col(b).alias(f"_{b}") for b in by]).agg(F.max("_prefix").alias("_last"))
    last = broadcast_if_small(materialize(last, "reached"), BROADCAST_SUMS)
    same = F.lit(True)
    for b in by:
        same = same & df[b].eqNullSafe(F.col(f"_{b}"))
    return df.join(last, same & (prefix <= F.col("_last"))).select(*df.columns)
