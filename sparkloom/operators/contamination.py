"""Candidates against evaluation tasks: by id, by template, by the normalised prompt's hash, by n-gram similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.storage import broadcast_if_small, materialize

THRESHOLD, NGRAM = 0.70, 5
#: N-grams of the evaluation side that may be broadcast; beyond, the join shuffles.
BROADCAST_GRAMS = 1_000_000


def prompts(df: DataFrame, id_col: str, text_col: str, exact: bool = False) -> DataFrame:
    """(id, words, norm) of each prompt."""
    words = df.select(F.col(id_col).alias("id"), T.prompt_words(F.col(text_col), exact).alias("words"))
    return words.withColumn("norm", F.array_join("words", " "))


def gram_rows(left: DataFrame, n: int) -> DataFrame:
    """(left_id, left_key, g) for each position of each prompt, repeats included; left_key tells texts of one id apart.

    The generator keeps rows without a word, so that no filter on the words is inferred (it would be pushed below
    them and tokenize every text again), and n-grams are hashed from the words where they lie, in compiled code.
    """
    at, size = F.col("i"), F.size("words")
    a = left.select(F.col("id").alias("left_id"), F.xxhash64("words").alias("left_key"), "words")
    rows = a.select("left_id", "left_key", "words", F.posexplode_outer("words").alias("i", "w")).where((at <= size - n) | ((at == 0) & (size < n)))
    return rows.select("left_id", "left_key", T.gram_hash(F.col("words"), at, n).alias("g"))


def similar(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD, measure: str = "jaccard", empty: bool = True, n: int = NGRAM) -> DataFrame:
    """(left_id, right_id, shared, score) of all pairs from the threshold on; both: outputs of prompts().

    An inverted index on hashed n-grams forms only pairs that share one; the right side's grams are broadcast
    where they are few, so that the left side's are dropped where they lie. measure: jaccard, or containment
    of the right in the left. Jaccard needs the left side's set sizes too: they are counted only for prompts that hold
    the threshold's share of a right one, since no other pair can reach it. Two prompts without any n-gram are alike
    (score 1), unless empty is false. Rows that share an id are compared one by one, equal rows of the left once.
    """
    keyed = right.select(F.monotonically_increasing_id().alias("right_key"), F.col("id").alias("right_id"), F.col("norm").alias("right_norm"), T.prompt_gram_hashes(F.col("words"), n).alias("grams"))
    b = materialize(keyed.withColumn("right_n", F.size("grams")), "right-grams")
    index = broadcast_if_small(b.select("right_key", "right_id", "right_n", F.explode("grams").alias("g")), BROADCAST_GRAMS)
    shared = gram_rows(left, n).join(index, "g").groupBy("left_id", "left_key", "right_key", "right_id", "right_n").agg(F.count_distinct("g").alias("shared"))
    found = shared.withColumn("score", F.col("shared") / F.col("right_n")).where(F.col("score") >= threshold)
    if measure == "jaccard":
        found = materialize(found, "shared-grams")
        held = broadcast_if_small(found.select(F.col("left_id").alias("id")).distinct(), BROADCAST_GRAMS)
        # Written, as the join would infer a filter on the sizes, below the semi-join and so over all texts.
        sizes = materialize(left.join(held, "id", "left_semi").select(F.col("id").alias("left_id"), F.xxhash64("words").alias("left_key"), F.size(T.prompt_gram_hashes(F.col("words"), n)).alias("left_n")).distinct(), "left-sizes")
        score = F.col("shared") / (F.col("left_n") + F.col("right_n") - F.col("shared"))
        found = found.join(sizes, ["left_id", "left_key"]).withColumn("score", score).where(F.col("score") >= threshold)
    found = found.select("left_id", "right_id", "shared", "score")
    if not empty or b.where("right_n = 0").isEmpty():
        return found
    # Prompts without an n-gram have no word, so they are all the same text.
    blank = left.where(F.size("words") == 0).select(F.col("id").alias("left_id"), "norm").join(b.where("right_n = 0").select("right_id", "right_norm"), F.col("norm") == F.col("right_norm"))
    return found.union(blank.select("left_id", "right_id", F.lit(0).cast("bigint"), F.lit(1.0)))


def report(candidates: DataFrame, tasks: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, reason) of each contaminated candidate, the first reason in the order id, template, prompt_hash, similarity.

    Both sides: id, template_id, prompt.
    """
    by_id = candidates.join(tasks.select("id").distinct(), "id", "left_semi").select("id", F.lit(1).alias("k"))
    names = tasks.where("template_id is not null").select("template_id").distinct()
    by_name = candidates.join(names, "template_id", "left_semi").select("id", F.lit(2).alias("k"))
    a, b = prompts(candidates, "id", "prompt"), prompts(tasks, "id", "prompt")
    by_hash = a.withColumn("h", F.sha2("norm", 256)).join(b.select(F.sha2("norm", 256).alias("h")).distinct(), "h", "left_semi").select("id", F.lit(3).alias("k"))
    # Prompts without an n-gram are found by their hash already.
    near = similar(a, b, threshold, empty=False).select(F.col("left_id").alias("id"), F.lit(4).alias("k")).distinct()
    names = F.create_map(*[F.lit(x) for p in enumerate(("id", "template", "prompt_hash", "similarity"), 1) for x in p])
    return by_id.union(by_name).union(by_hash).union(near).groupBy("id").agg(F.min("k").alias("k")).select("id", F.element_at(names, F.col("k")).alias("reason"))


def require_clean(candidates: DataFrame, tasks: DataFrame, threshold: float = THRESHOLD) -> None:
    """Raises with the first contaminated candidate, if there is one."""
    first = report(candidates, tasks, threshold).orderBy("id").limit(1).collect()
    if first:
        raise ValueError(f"contaminated candidate {first[0]['id']}: {first[0]['reason']}")
