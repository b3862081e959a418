"""Leakage-free split: whole groups go to one side, by the hash of their name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.functions.hashing import hash_int, stable_hash
from sparkloom.operators.running import within_reach
from sparkloom.storage import materialize


def in_validation(group: Column, fraction: float, seed: int = 42) -> Column:
    """Whether a group's hash bucket (of 10 000) is below the fraction."""
    if not 0 <= fraction < 1:
        raise ValueError("the validation fraction lies in [0, 1)")
    return hash_int(stable_hash(F.lit(seed), group)) % 10_000 < int(fraction * 10_000)


def split_by_group(df: DataFrame, fraction: float, seed: int = 42, at_least: int = 0, group: str = "group_id") -> DataFrame:
    """df with a column split (train or validation).

    Validation gets whole groups until it has the minimum (at most all but one row, one where a
    fraction is asked for), in hash order; train never becomes empty. Works on the table of groups.
    """
    if at_least < 0:
        raise ValueError("the minimum is not negative")
    sizes = df.groupBy(F.col(group).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes.withColumn("val", in_validation(F.col("g"), fraction, seed)).withColumn("h", stable_hash(F.lit(seed), F.lit("validation-minimum"), F.col("g"))), "split-groups")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("val"), F.col("n"))), F.lit(0)).alias("v"), F.count(F.when(~F.col("val"), 1)).alias("t")).first()
    goal = max(min(at_least, total["n"] - 1), 1 if fraction > 0 and total["n"] > 1 else 0)
    chosen = sizes.where("val").select("g")
    need = goal - total["v"]
    if need > 0 and total["t"] > 1:
        order = Window.orderBy("h", "g").rowsBetween(Window.unboundedPreceding, -1)
        moved = within_reach(sizes.where("not val"), F.col("h"), "n", need).withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).withColumn("k", F.row_number().over(Window.orderBy("h", "g")))
        chosen = chosen.union(moved.where((F.col("before") < need) & (F.col("k") < total["t"])).select("g"))
    elif total["t"] == 0 and total["n"]:
        back = sizes.orderBy("h", "g").limit(1).select("g")
        chosen = chosen.join(back, "g", "left_anti")
    side = chosen.distinct().withColumn("v", F.lit(True))
    joined = df.join(side, df[group].eqNullSafe(side.g), "left")
    return joined.select(*df.columns, F.when(F.col("v"), "validation").otherwise("train").alias("split"))


def split_report(split: DataFrame, tokens: str = "num_tokens", group: str = "group_id") -> DataFrame:
    """One row: examples and tokens of either side, and groups on both (0 if nothing leaks)."""
    sides = split.groupBy(group).agg(F.countDistinct("split").alias("sides"))
    both = sides.agg(F.coalesce(F.sum((F.col("sides") > 1).cast("bigint")), F.lit(0)).alias("group_overlap"))
    on = lambda s, v: F.coalesce(F.sum(F.when(F.col("split") == s, v)), F.lit(0)).cast("bigint")
    one = F.lit(1)
    got = split.agg(on("train", one).alias("train_examples"), on("train", F.col(tokens)).alias("train_tokens"), on("validation", one).alias("validation_examples"), on("validation", F.col(tokens)).alias("validation_tokens"))
    return got.join(F.broadcast(both), F.lit(True))
