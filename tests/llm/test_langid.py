"""Held-out accuracy, calibration and edges."""

import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sparkloom.llm import langid


def test_held_out_accuracy_and_split(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = langid.predict(docs, langid.fit(docs)).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_labels_are_not_used(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    wrong = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    a, b = langid.fit(docs), langid.fit(wrong)
    assert a.langs == b.langs and (a.weights == b.weights).all() and a.temperature == b.temperature


def test_edges(docs_of):
    docs = docs_of([None, "", "123 !?", "é", (7, "hello"), (7, "hello"), (None, "x y"), (8, "word " * 60_000)]).withColumn("t", F.lit(1))
    got = sorted(((r["doc_id"], r["lang_pred"]) for r in langid.predict(docs, langid.fit(docs)).collect()), key=str)
    assert got == sorted([(0, "und"), (1, "und"), (2, "und"), (3, "en"), (7, "en"), (7, "en"), (None, "en"), (8, "en")], key=str)
    empty = docs_of([]).limit(0)
    assert langid.predict(empty, langid.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in langid.predict(docs, langid.fit(empty)).collect()} == {"und"}


def test_bounded_sample(docs_of):
    docs = docs_of([f"text number {i} of many" for i in range(2000)])
    m = langid.fit(docs, max_rows=50)
    assert m.langs == ["en"]


def slots(text):
    """Slot counts of all 1- to 3-grams of code points, one by one."""
    c, out = [ord(x) for x in f" {text.lower()} "], Counter()
    for n in langid.ORDERS:
        for i in range(len(c) - n + 1):
            h = 0
            for x in c[i : i + n]:
                h = ((h ^ x) * 0x9E3779B1) & 0xFFFFFFFF
            out[((h ^ h >> 15) * 0x85EBCA77 & 0xFFFFFFFF) >> 18] += 1
    return out


def plain_scores(text, m):
    x = {k: math.sqrt(n) * m.idf[k] for k, n in slots(text).items()}
    size = math.sqrt(sum(v * v for v in x.values()))
    z = [(sum(v / size * m.weights[k, j] for k, v in x.items()) + m.bias[j]) / m.temperature for j in range(len(m.langs))]
    e = [math.exp(v - max(z)) for v in z]
    return {lang: v / sum(e) for lang, v in zip(m.langs, e)}


def plain_ftrl(rows, n_langs):
    """FTRL-proximal, one weight at a time."""
    z, n, rng = {}, {}, np.random.default_rng(7)

    def weight(k):
        if abs(z.get(k, 0.0)) <= langid.L1:
            return 0.0
        return -(z[k] - math.copysign(langid.L1, z[k])) / ((langid.BETA + math.sqrt(n[k])) / langid.ALPHA + langid.L2)

    for _ in range(langid.EPOCHS):
        for r in rng.permutation(len(rows)):
            x, y = rows[r]
            own = [(k, v) for k, v in x.items()] + [(langid.SLOTS, 1.0)]
            w = {(k, j): weight((k, j)) for k, _ in own for j in range(n_langs)}
            s = [sum(v * w[k, j] for k, v in own) for j in range(n_langs)]
            e = [math.exp(v - max(s)) for v in s]
            for j in range(n_langs):
                for k, v in own:
                    g, old = v * (e[j] / sum(e) - (j == y)), n.get((k, j), 0.0)
                    z[k, j] = z.get((k, j), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / langid.ALPHA * w[k, j]
                    n[k, j] = old + g * g
    return weight, z


def test_scores_equal_a_plain_sum_over_ngrams(docs_of, spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    m = langid.fit(docs)
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(40).collect() if r["text"] and any(map(str.isalpha, r["text"])) and len(r["text"]) < 4000]
    texts += ["é", "Ein kurzer Satz.", "a " * 3000, "the \U0001f600 end"]
    for r in langid.predict(docs_of(texts), m).collect():
        want = plain_scores(texts[r["doc_id"]], m)
        assert r["lang_pred"] == max(want, key=want.get) and abs(r["score"] - want[r["lang_pred"]]) < 1e-9


def test_training_equals_plain_updates():
    rng = random.Random(4)
    rows = [({rng.randrange(40): rng.random() for _ in range(6)}, rng.randrange(3)) for _ in range(30)]
    w, bias = langid.ftrl([(np.array(list(x)), np.array(list(x.values())), y) for x, y in rows], 3)
    weight, z = plain_ftrl(rows, 3)
    for (k, j) in z:
        assert abs((bias[j] if k == langid.SLOTS else w[k, j]) - weight((k, j))) < 1e-9


def test_counts_cover_all_training_rows_and_rare_languages_are_learned(docs_of):
    rows = [(i, f"the quick number {i} went home", "en") for i in range(3000)] + [(5000 + i, f"der schnelle wagen {i} zieht weiter", "de") for i in range(12)]
    docs = docs_of([(i, t) for i, t, _ in rows]).withColumn("lang", F.when(F.col("doc_id") >= 5000, "de").otherwise("en"))
    m = langid.fit(docs, max_rows=200)
    used = [t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5]
    df = Counter(k for t in used for k in slots(t))
    assert m.langs == ["de", "en"] and all(abs(m.idf[k] - math.log((1 + len(used)) / (1 + n)) - 1) < 1e-9 for k, n in df.items())
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, m).collect()}
    assert sum(got[i] == x for i, _, x in rows) >= 0.99 * len(rows) and sum(got[5000 + i] == "de" for i in range(12)) >= 11


def test_quota_fills_small_languages_first():
    assert langid.quota([10, 10], 100) >= 10 and langid.quota([1, 1000, 1000], 101) == 50.0 and langid.quota([7], 3) == 3.0
