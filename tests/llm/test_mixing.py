"""Targets, bounds and the systematic sample against plain Python and SQL."""

import hashlib
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from sparkloom.llm import mixing as M


def unit(key):
    return int(hashlib.sha256(key.encode()).hexdigest()[:13], 16) / 2**52


def targets(sizes):
    """By the wording: share by weight, stop at twice the size, reshare the excess until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    full, left, out = set(), 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        w = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / w for s in open_} if open_ else {}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return out | share
        for s in over:
            full.add(s)
            out[s] = 2.0 * sizes[s]
            left -= 2 * sizes[s]


def plain(rows):
    size = lambda t: len((t or "").replace("\x0b", " ").replace("\x0c", " ").split())
    by = defaultdict(list)
    for i, t, s in rows:
        by[s].append((size(t), unit(f"42:{'null' if i is None else i}"), i))
    goal = targets({s: sum(x[0] for x in v) for s, v in by.items()})
    out = []
    for s, own in by.items():
        n = sum(x[0] for x in own)
        rate, start = (goal[s] / n if n else 0.0), unit(f"42:{'null' if s is None else 's' + s}")
        for k, (z, _, i) in enumerate(sorted(own, key=lambda x: (x[0], x[1])), 1):
            copies = min(2, int(k * rate + start) - int((k - 1) * rate + start))
            out.append((i, z, n, round(goal[s], 6), copies))
    return sorted(out, key=str)


def sampled(df):
    return sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["n_copies"]) for r in M.copies(df).collect()), key=str)


def test_documents_equal_plain_sample_and_meet_targets(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet")
    got = sampled(df)
    assert got == plain([(r["doc_id"], r["text"], r["source"]) for r in df.collect()])
    source = {r["doc_id"]: r["source"] for r in df.select("doc_id", "source").collect()}
    taken, goal, largest = defaultdict(int), {}, defaultdict(int)
    for i, z, _, t, c in got:
        taken[source[i]] += c * z
        goal[source[i]], largest[source[i]] = t, max(largest[source[i]], z)
        assert c <= 2
    assert all(abs(taken[s] - goal[s]) <= largest[s] for s in goal)


def test_reruns_and_partitions_agree(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet")
    first = sampled(df)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert sampled(df.repartition(7)) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_edges(docs_of):
    rows = [(0, None, "a"), (1, "", "a"), (2, "one two", None), (3, "x " * 30_000, "é"), (4, "a b c", "b"), (4, "a b c", "b"), (None, "q r", ""), (5, None, "empty")]
    df = docs_of([]).sparkSession.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(1)).withColumn("rank", F.lit(2))
    assert sampled(df) == plain(rows)
    assert M.copies(docs_of([]).limit(0)).count() == 0


def test_mix_repeats_rows(docs_of):
    df = docs_of([(i, "w " * (i + 1)) for i in range(40)]).withColumn("copy", F.lit("mine"))
    n = {r["doc_id"]: r["n_copies"] for r in M.copies(df).collect()}
    got = defaultdict(list)
    for r in M.mix(df).collect():
        assert r["copy"] == "mine"
        got[r["doc_id"]].append(r["copy1"])
    assert {i: sorted(c) for i, c in got.items()} == {i: list(range(1, c + 1)) for i, c in n.items() if c}


def test_sql_agrees(spark, data):
    from sparkloom.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{data}/documents.parquet'")
    con.execute(ORACLES["op10_source_mixing"])
    names = [d[0] for d in con.description]
    want = sorted(tuple(r) for r in con.fetchall())
    got = sorted(tuple(r[n] for n in names) for r in QUERIES["op10_source_mixing"](spark, data).collect())
    assert got == want
