"""Containment search against a plain comparison of every item with every document."""

import re

from pyspark.sql import functions as F

from sparkloom.llm import decontam as D


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(w, n):
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def plain(docs, items, threshold=0.8, size=5):
    held = {}
    for i, t in docs:
        held.setdefault(i, []).append(tokens(t))
    out = set()
    for item, text in items:
        w = tokens(text)
        if not w:
            continue
        n = min(size, len(w))
        own = shingles(w, n)
        for i, texts in held.items():
            found = len(own & set().union(*(shingles(x, n) for x in texts)))
            if found >= threshold * len(own) - 1e-9:
                out.add((i, item, len(own), found))
    return out


def found(docs, items, **options):
    return {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in D.contaminated(docs, items, **options).collect()}


def test_documents_equal_plain_comparison(spark, data):
    docs, items = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert found(docs, items) == want and want


def test_partial_items_at_the_threshold(spark, docs_of):
    words = [f"w{i}" for i in range(24)]  # 20 shingles
    cases = [" ".join(words), " ".join(words[:20]), " ".join(words[:19]), "x " + " ".join(words[:12]) + " y " + " ".join(words[12:]), " ".join(words[::-1])]
    docs = docs_of([f"before {c} after" for c in cases])
    items = spark.createDataFrame([(1, " ".join(words)), (2, "W0, w1"), (3, ""), (4, None), (5, "w23 w22 w21")], "item_id long, text string")
    rows = [(i, f"before {c} after") for i, c in enumerate(cases)]
    for t in (0.5, 0.8, 1.0):
        assert found(docs, items, threshold=t) == plain(rows, [tuple(r) for r in items.collect()], t)


def test_edges(spark, docs_of):
    items = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    rows = [None, "", "One  two, three four five six seven!", (2, "One  two, three four five six seven!"), (None, "x one two three four five six seven"), (8, "z " * 50_000 + "one two three four five six seven")]
    docs = docs_of(rows).withColumn("item_id", F.lit(9)).withColumn("h", F.lit(1)).withColumn("s", F.lit("x"))
    assert found(docs, items) == {(2, 1, 3, 3), (None, 1, 3, 3), (8, 1, 3, 3)}
    assert found(docs_of([]).limit(0), items) == set() and found(docs, items.limit(0)) == set()
    assert sorted(r["doc_id"] for r in D.clean(docs, items).collect()) == [0, 1]
