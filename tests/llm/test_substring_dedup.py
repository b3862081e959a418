"""Removed stretches against a plain first-occurrence scan."""

import re

from pyspark.sql import functions as F

from sparkloom.llm import substring_dedup as S

PASSAGE = " ".join(f"Sentence {c} has some eight words in it." for c in "abcdefgh")  # 64 words


def plain(rows, min_words=S.MIN_WORDS):
    """rows in rank order: a scan that remembers where each unit came first and compares word by word from there."""
    low = lambda t: [x.lower() for x in re.findall(r"[^\x20\x09-\x0D]+", t)]
    first, cut, out = {}, {}, {}
    for i, t in rows:
        cut[i] = own = [(a, b, low(t[a:b])) for a, b in S.units(t or "") if low(t[a:b])]
        came = []
        for k, (_, _, w) in enumerate(own):
            came.append(first.get(tuple(w)))
            first.setdefault(tuple(w), (i, k))
        spans, k = [], 0
        while k < len(own):
            s = k
            while k < len(own) and came[k]:
                k += 1
            if k == s:
                k += 1
                continue
            longest = max(range(s, k), key=lambda x: (len(own[x][2]), -x))
            where, shift = came[longest][0], came[longest][1] - longest
            n, start, end = sum(len(u[2]) for u in own[s:k]), own[s][0], own[k - 1][1]
            there = cut[where]
            if s and s - 1 + shift >= 0:
                w, v = own[s - 1][2], there[s - 1 + shift][2]
                c = next((c for c in range(min(len(w), len(v))) if w[-1 - c] != v[-1 - c]), min(len(w), len(v)))
                if c:
                    n, start = n + c, [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", t[: own[s - 1][1]])][-c]
            if k < len(own) and k + shift < len(there):
                w, v = own[k][2], there[k + shift][2]
                c = next((c for c in range(min(len(w), len(v))) if w[c] != v[c]), min(len(w), len(v)))
                if c:
                    n, end = n + c, [m.end() for m in re.finditer(r"[^\x20\x09-\x0D]+", t[own[k][0] :])][c - 1] + own[k][0]
            if n >= min_words and spans and start <= spans[-1][1]:
                spans[-1] = spans[-1][0], max(end, spans[-1][1])
            elif n >= min_words:
                spans.append((start, end))
        out[i] = len(own), spans
    return out


def result(df, **options):
    return {r["doc_id"]: (r["n_units"], r["removed"], r["text"]) for r in S.dedup_substrings(df, **options).collect()}


def test_units_cover_the_text():
    for t in ("", "a", "a.b c. d!\n\n e?? f", "...\n.", "x" * 1000, "no end \t.  ", "3.14 is pi. So", "." * 5000 + " a"):
        own = list(S.units(t))
        assert "".join(t[a:b] for a, b in own) == t and all(a < b for a, b in own)


def test_documents_equal_plain_scan(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.orderBy("doc_id").collect()]
    want, got = plain(rows), result(df)
    for i, t in rows:
        n, spans = want[i]
        assert got[i][0] == n and got[i][1] == ",".join(f"{a}:{b}" for a, b in spans)
        for a, b in reversed(spans):
            t = t[:a] + t[b:]
        assert got[i][2] == t


def test_passage_goes_from_all_but_the_first(docs_of):
    got = result(docs_of([f"These own words begin {i}. {PASSAGE} {i} And so it ends." for i in range(4)]))
    assert PASSAGE in got[0][2] and got[0][1] == ""
    for i in (1, 2, 3):
        assert got[i][2] == f"These own words begin {i}. {i} And so it ends."
        start, end = map(int, got[i][1].split(":"))
        assert f"These own words begin {i}. {PASSAGE} {i} And"[start:end].strip() == PASSAGE


def test_passages_that_begin_and_end_inside_sentences(docs_of):
    w = [f"p{k}" for k in range(60)]
    passage = " ".join(w[:20]) + ". " + " ".join(w[20:32]) + ". " + " ".join(w[32:])
    texts = [f"Here document begins {c} {passage} {c} goes on to its end. Bye {c}." for c in "abcd"]
    got = result(docs_of([(k, t.upper() if k == 2 else t) for k, t in enumerate(texts)]))
    assert got[0][1] == ""
    for k in (1, 2, 3):
        start, end = map(int, got[k][1].split(":"))
        assert texts[k][start:end] == passage
    short = " ".join(w[:20]) + ". " + " ".join(w[20:32]) + ". " + " ".join(w[32:49])
    got = result(docs_of([f"Here begins {c} {short} {c} goes." for c in "abcd"]))
    assert all(v[1] == "" for v in got.values())


def test_joins_beyond_the_broadcast_bounds_give_the_same(spark, data, monkeypatch):
    df = spark.read.parquet(f"{data}/documents.parquet")
    want = result(df)
    monkeypatch.setattr(S, "BROADCAST_TEXTS", 0)
    monkeypatch.setattr(S, "BROADCAST_EDGES", 0)
    assert result(df) == want


def test_a_long_neighbour_of_a_hot_line_is_not_copied(docs_of):
    hot = ". ".join(" ".join(f"h{k}x{j}" for j in range(9)) for k in range(8)) + "."
    rows = [(0, hot + " " + "w " * 60_000)] + [(k, f"{hot} then {k} ends") for k in range(1, 40)]
    got = result(docs_of(rows))
    assert got[0][1] == "" and all(got[k][2] == f"then {k} ends" for k in range(1, 40))


def test_short_repeats_stay(docs_of):
    got = result(docs_of(["All rights reserved. One.", "All rights reserved. Two."]))
    assert all(v[1] == "" for v in got.values())


def test_edges(docs_of):
    rows = [(None, PASSAGE), (3, PASSAGE), (3, PASSAGE), (4, None), (5, ""), (6, PASSAGE.upper()), (7, f"{PASSAGE}\n{PASSAGE}"), (8, "w " * 60_000)]
    out = S.dedup_substrings(docs_of(rows).withColumn("mark", F.lit(1)).withColumn("at", F.lit(2))).collect()
    got = sorted(((r["doc_id"], r["text"]) for r in out), key=str)
    assert got == sorted([(None, ""), (3, PASSAGE), (3, PASSAGE), (4, None), (5, ""), (6, ""), (7, ""), (8, "w " * 60_000)], key=str)
    assert S.dedup_substrings(docs_of([]).limit(0)).count() == 0
