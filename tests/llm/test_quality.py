"""Base counts against plain Python; the ratio's direction; edges."""

import re
from collections import Counter

from pyspark.sql import functions as F

from sparkloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def measured(docs, trusted):
    return {r["doc_id"]: r for r in quality.judge(docs, quality.fit(docs, trusted)).collect()}


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_documents_equal_plain_counts(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = measured(docs, spark.read.parquet(f"{data}/labels.parquet").where("quality = 1"))
    for r in docs.collect():
        assert tuple(got[r["doc_id"]][c] for c in COLUMNS) == plain(r["text"])
        assert not (got[r["doc_id"]]["kept"] and got[r["doc_id"]]["base_failed"])


def test_ratio_rejects_what_the_target_lacks(docs_of):
    good = ["the cat sat on the mat and looked at the other cat %d" % i for i in range(40)]
    bad = ["zz## qq%% ww$$ xx&& yy** vv|| uu<< tt>> ss## rr%% pp$$ %d" % i for i in range(10)]
    docs = docs_of(good + bad)
    model = quality.fit(docs, docs.where("doc_id < 30"), buckets=256)  # few buckets: smoothing weighs one word a bucket
    got = {r["doc_id"]: r for r in quality.judge(docs, model, buckets=256).collect()}
    assert all(got[i]["kept"] for i in range(40)) and not any(got[i]["kept"] for i in range(40, 50))


def test_edges(docs_of):
    rows = [None, "", " \t\n ", "a b c d e " * 3, "é\x0bü\x0cß one two three four five six seven eight", "x " * 9, "w" * 100_000, (3, "again"), (3, "again"), (None, "no id")]
    docs = docs_of(rows).withColumn("gram", F.lit(1)).withColumn("m", F.lit(2))
    got = quality.judge(docs, quality.fit(docs, docs.limit(0))).collect()
    assert len(got) == len(rows) and all(r["mean_llr"] == 0 for r in got)
    by_text = Counter(tuple(r[c] for c in COLUMNS) for r in got)
    assert by_text == Counter(plain(t if not isinstance(t, tuple) else t[1]) for t in rows)
    empty = docs_of([]).limit(0)
    assert quality.judge(empty, quality.fit(empty, empty)).count() == 0


def test_keep_agrees_with_judge(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{data}/labels.parquet").where("quality = 1"))
    kept = {r["doc_id"] for r in quality.keep(docs, model).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in quality.judge(docs, model).where("kept").collect()}


def test_many_trusted_ids_give_the_same_model(spark, data, monkeypatch):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    trusted = labels.where("quality = 1").select("doc_id")
    want = quality.fit(docs, trusted)
    monkeypatch.setattr(quality, "BROADCAST_IDS", 3)
    assert want.any() and (quality.fit(docs, trusted) == want).all()
