"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Both multinomials are counted over every document; scoring and thresholding are row-local
DataFrame expressions, so the filter neither shuffles texts nor leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import let, words
from sparkloom.storage import materialize

#: Buckets that unigrams and bigrams hash into.
BUCKETS = 1 << 15
#: Pseudo-count of each bucket, spread like the raw corpus.
SMOOTHING = 1.0
SCALE = 10_000
#: Mean log-likelihood ratio per n-gram below which a document goes.
THRESHOLD = -0.08
#: Trusted ids that may be broadcast (about 60 bytes each as a hash table); beyond, trusted texts are joined and counted apart.
BROADCAST_IDS = 500_000
SYMBOLS = "[#*$%&|<>]"


def chained(a: Column, b: Column, n: Column, skip: int) -> Column:
    """Hashes of a[i] with b[i + skip] for the first n places (none if n is below 1)."""
    n = F.greatest(n, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(skip + 1), n), lambda x, y: F.xxhash64(x, y))


def grams(w: Column, body: Callable[[Column, Column], Column]) -> Column:
    """body(hashes of the words, hashes of the word pairs), both arrays computed once."""
    return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(chained(h, h, F.size(h) - 1, 1), lambda p: body(h, p)))


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """The log ratio of every bucket in SCALE-ths, as whole numbers, so that sums don't depend on order.

    docs: the whole raw corpus. trusted: ids (column id_col) of the documents of the target.
    The bucket table has a fixed number of rows, whatever the corpus. Without trusted
    documents every ratio is 0.
    """
    ids = materialize(trusted.select(F.col(id_col).alias("t_id")).where("t_id is not null").distinct(), "trusted")
    rows = docs.select(F.col(id_col).alias("d_id"), F.col(text_col).alias("t"))
    gram = F.explode(grams(words(F.col("t")), lambda h, p: F.concat(h, p))).alias("gram")
    bucket = F.col("gram").bitwiseAND(F.lit(buckets - 1)).cast("int").alias("bucket")
    n = F.count(F.lit(1))
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        rows = rows.join(F.broadcast(ids), rows.d_id == ids.t_id, "left").select(F.col("t_id").isNotNull().cast("int").alias("is_target"), gram)
        counts = rows.groupBy(bucket).agg(n.alias("raw"), F.sum("is_target").alias("target"))
    else:  # only the target's own texts are dealt out; the raw corpus is counted where it lies
        raw = rows.select(gram).groupBy(bucket).agg(n.alias("raw"))
        target = rows.join(ids, rows.d_id == ids.t_id).select(gram).groupBy(bucket).agg(n.alias("target"))
        counts = raw.join(target, "bucket", "left").select("bucket", "raw", F.coalesce("target", F.lit(0)).alias("target"))
    counts = materialize(counts, "ngram-counts")
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw_all"), F.coalesce(F.sum("target"), F.lit(0)).alias("target_all")).first()
    raw_all, target_all = total["raw_all"], total["target_all"]
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in counts.toLocalIterator():
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    p_raw = (raw + 1.0) / (raw_all + buckets)
    p_target = (target + SMOOTHING * buckets * p_raw) / (target_all + SMOOTHING * buckets)
    return np.round(SCALE * np.log(p_target / p_raw)).astype(np.int32) if target_all else np.zeros(buckets, np.int32)


def mean_ratio(h: Column, p: Column, model: Column, buckets: int) -> Column:
    """Length-normalised ratio over the hashes of words and word pairs; 0 without words."""
    total = lambda of, start: F.aggregate(of, start, lambda acc, x: acc + F.get(model, x.bitwiseAND(F.lit(buckets - 1)).cast("int")))
    return F.when(F.size(h) > 0, total(p, total(h, F.lit(0).cast("bigint"))) / (F.size(h) + F.size(p)) / SCALE).otherwise(0.0)


def repeat_words(h: Column, p: Column) -> Column:
    """Words inside five-word windows that a text has twice or more, the first included.

    h, p: hashes of the words and of the word pairs. Only a text with a repeated window is sorted.
    """
    n, size = F.size(h), 5
    windows = let(chained(p, p, n - 3, 2), lambda q: chained(q, p, n - 4, 3))

    def covered(at: Column) -> Column:
        spans = F.transform(at, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(at, k + 1) - x, F.lit(size))))
        return F.aggregate(spans, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    def repeated(s: Column) -> Column:
        same = lambda e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda e, i: same(e, i - 1) | same(e, i + 1)), lambda e: e["at"]))

    def counted(r: Column) -> Column:
        tagged = F.sort_array(F.transform(r, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(r)) == F.size(r), F.lit(0).cast("bigint")).otherwise(let(let(tagged, repeated), covered))

    return let(windows, counted)


def measures(text: Column, model: Column, buckets: int = BUCKETS) -> Column:
    """A struct with the base counts and the mean ratio of one text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of = lambda w: grams(w, lambda h, p: F.struct(F.size(h).cast("bigint").alias("n_words"), repeat_words(h, p).alias("n_repeat_words"), mean_ratio(h, p, model, buckets).alias("mean_llr"), F.length(F.array_join(w, "")).cast("bigint").alias("word_chars")))
    return F.struct(
        let(words(text), of).alias("own"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x)))).cast("bigint").alias("n_dup_lines"),
    )


def judge(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """One row per row of docs: id, base counts, base_failed, mean_llr and kept.

    A null text has no words; an empty or short one fails the base rule; repeated rows are
    judged alike; other columns of docs are ignored, so their names can't clash.
    """
    rows = docs.select(F.col(id_col).alias(id_col), measures(F.col(text_col), F.lit(model), buckets).alias("m"))
    own = F.col("m.own")
    n, repeats = own["n_words"], own["n_repeat_words"]
    failed = (n < 10) | (100 * repeats > 20 * n)
    return rows.select(
        id_col, n.alias("n_words"), own["word_chars"].alias("word_chars"), "m.n_symbols", "m.n_dup_lines", repeats.alias("n_repeat_words"),
        failed.alias("base_failed"), (~failed & (own["mean_llr"] >= threshold)).alias("kept"), own["mean_llr"].alias("mean_llr"),
    )


def keep(docs: DataFrame, model: np.ndarray, text_col: str = "text", threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """The rows of docs that pass, with all their columns; row-local, no shuffle."""

    def passes(h: Column, p: Column) -> Column:
        n = F.size(h)
        return F.when(n < 10, False).otherwise((100 * repeat_words(h, p) <= 20 * n) & (mean_ratio(h, p, F.lit(model), buckets) >= threshold))

    return docs.where(grams(words(F.col(text_col)), passes))
