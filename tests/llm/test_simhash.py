"""Fingerprints and components against the definition."""

import math
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sparkloom.llm import simhash as S


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    own = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, radius=2):
    label = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = label[i], label[j]
                label = [min(x, y) if v in (x, y) else v for v in label]
    return label


def test_documents_equal_definition(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").collect()
    prints = [fingerprint(r["text"]) for r in rows]
    want = {r["doc_id"]: (f"{p:016x}", rows[c]["doc_id"]) for r, p, c in zip(rows, prints, components(prints))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in S.near_groups(spark.read.parquet(f"{data}/documents.parquet")).collect()}
    assert got == want


def test_links_find_every_component(spark, monkeypatch):
    rng = random.Random(5)
    for finer, piece in (((10**9, 10**9), 16), ((10, 10**9), 4096), ((10, 20), 3)):
        monkeypatch.setattr(S, "FINER", finer)
        monkeypatch.setattr(S, "PIECE", piece)
        seeds = [rng.getrandbits(64) for _ in range(15)]
        prints = list(seeds)
        for s in seeds:
            for _ in range(rng.randrange(12)):
                s ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
                prints.append(s)
        prints = sorted(set(prints))
        df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
        found = {r["node"]: r["root"] for r in S.components(S.links(df)).collect()}
        groups = {}
        for p, c in zip(prints, components(prints)):
            groups.setdefault(c, set()).add(p)
        mine = {}
        for p in prints:
            s = int(np.uint64(p).view(np.int64))
            mine.setdefault(found.get(s, s), set()).add(p)
        assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))


def test_edges(docs_of):
    rows = [None, "", "  ", "One", "one", "a b", "A  B\n", (7, "x y z w"), (7, "x y z w"), (None, "x y z w"), (50, "q " * 50_000)]
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in S.near_groups(docs_of(rows).withColumn("fp", F.lit(1))).collect()), key=str)
    ids = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
    prints = [fingerprint(t) for _, t in ids]
    labels = components(prints)
    low = {c: min((i for (i, _), k in zip(ids, labels) if k == c and i is not None), default=None) for c in labels}
    assert got == sorted(((i, f"{p:016x}", low[c]) for (i, _), p, c in zip(ids, prints, labels)), key=str)
    assert S.near_groups(docs_of([]).limit(0)).count() == 0


def test_keep_one_of_each_group(docs_of):
    text = " ".join(f"word{i}" for i in range(300))
    kept = S.keep_one(docs_of([(5, text), (2, text), (9, text.upper()), (4, "something else entirely here"), (None, "without an id at all")])).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == sorted([2, 4, None], key=str)


def wide(text, words=8, size=5):
    """(number of distinct shingles, fingerprint as one number), bit by bit."""
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    own = {" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    h, m, out = {xxhash.xxh64_intdigest(s.encode(), seed=42) for s in own}, (1 << 64) - 1, 0
    for k in range(words):
        v = [(x + 0x9E3779B97F4A7C15 * (k + 1)) & m for x in h]
        v = [((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & m for x in v]
        v = [((x ^ x >> 27) * 0x94D049BB133111EB) & m for x in v]
        v = [x ^ x >> 31 for x in v]
        out |= sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in v) > len(v)) << 64 * k
    return len(h), out


def shingle_set(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def edited(rng, text, share):
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def exact_components(texts, similarity=0.8):
    sets = [shingle_set(t) if t and t.strip() else set() for t in texts]
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= similarity * len(a | b):
                x, y = label[i], label[j]
                label = [min(x, y) if v in (x, y) else v for v in label]
    return label


def test_exact_groups_equal_the_jaccard_of_all_pairs(docs_of, monkeypatch):
    rng, texts = random.Random(11), []
    word = lambda: f"w{rng.randrange(10**6)}"
    for n in (8, 8, 8, 8, 16, 19, 24, 44, 104):  # 4 of 5 shingles, 12 of 15, and others at 0.8
        base = [word() for _ in range(n)]
        texts += [" ".join(base), " ".join([*base, *(word() for _ in range((n - 4) // 4))])]
    family = [word() for _ in range(400)]  # one template: pairs at about 0.7
    for k in range(24):
        own = list(family)
        for at in range(12, 400, 57):
            own[at + k % 3] = word()
        texts.append(" ".join(own))
    for k in range(12):
        base = " ".join(word() for _ in range(rng.choice((12, 60, 240))))
        texts += [base, base.upper()] + [edited(rng, base, rng.choice((0.01, 0.02, 0.03, 0.05))) for _ in range(k % 5)]
    texts += ["", None, " \n", "one two", "one two three", (None, texts[0]), (500, texts[2]), (500, texts[2])]
    rng.shuffle(texts)
    ids = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    label = exact_components([t for _, t in ids])
    low = {c: min((i for (i, _), k in zip(ids, label) if k == c and i is not None), default=None) for c in label}
    for piece, sets in ((4096, 4096), (7, 3)):
        monkeypatch.setattr(S, "PIECE", piece)
        monkeypatch.setattr(S, "PIECE_SETS", sets)
        got = sorted(((r["doc_id"], r["component_id"]) for r in S.exact_groups(docs_of(texts)).collect()), key=str)
        assert got == sorted(((i, low[c]) for (i, _), c in zip(ids, label)), key=str)


def test_proposals_reach_similar_sets_of_every_size():
    def half(k):
        return np.array([math.comb(k, x) for x in range(k + 1)]) / 2.0**k

    def above(k, least):
        return np.append(half(k)[::-1].cumsum()[::-1], 0)[np.clip(np.floor(least).astype(int) + 1, 0, k + 1)]

    limit = math.acos(1.6 / 1.8) / math.pi
    for c in range(4, 70):
        for a in range(c // 4 + 1):
            for b in range(a, c // 4 + 1 - a):
                x, u, v = np.arange(c + 1), *(above(k, (c + k) / 2 - np.arange(c + 1)) for k in (a, b))
                p = float((half(c) * (u * (1 - v) + v * (1 - u))).sum())
                assert p <= limit * (1 + 1 / (c + a))
    for words in (2, 8):
        radii = S.proposal_radii(0.8, words)
        assert (np.diff(radii) <= 0).all() and 64 * words * limit + 5.9 * math.sqrt(64 * words * limit * (1 - limit)) < radii[-1] < 25 * words
