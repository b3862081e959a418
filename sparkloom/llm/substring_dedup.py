"""Substring dedup by hashing units: lines, and the sentences within them.

Every unit is normalised and hashed to 128 bits; digests are grouped globally and the earliest
occurrence (smallest id, then position) stays. Units that occur earlier are anchors: a run of them is
compared, word by word to either side, with the text around its earliest occurrence, since a repeated
passage may begin and end inside a sentence. A run that so has MIN_WORDS words is removed, and its
offsets in the original text are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.llm.common import LOWER
from sparkloom.storage import broadcast_if_small, materialize

#: Words that a repeated stretch has at least; shorter coincidences stay.
MIN_WORDS = 50
#: Texts whose units are asked for, or asked for units, that may be broadcast; beyond, the joins shuffle.
BROADCAST_TEXTS, BROADCAST_EDGES = 50_000, 100_000
#: A unit ends at a line end or after a sentence's last mark and the blanks behind it.
UNIT = re.compile(r"[^\n.!?]*(?:[.!?]+(?![\s])[^\n.!?]*)*(?:[.!?]+[^\S\n]*|\n|\Z)\n*")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def units(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the units of a text; together they cover it. Those without a word aren't numbered."""
    at = 0
    while at < len(text):
        end = UNIT.match(text, at).end()
        yield at, end
        at = end


def words(unit: str) -> list[bytes]:
    """The words of a unit, A-Z lower-cased."""
    return unit.encode("utf-8", "surrogatepass").translate(LOWER).split()


def numbered(text: str) -> Iterator[tuple[int, int, list[bytes]]]:
    """(start, end, words) of the units that have words."""
    for start, end in units(text):
        if own := words(text[start:end]):
            yield start, end, own


def digest(own: list[bytes]) -> tuple[int, int]:
    """128 bits of a unit's words, joined by single blanks."""
    joined = b" ".join(own)
    return xxhash.xxh64_intdigest(joined, seed=42), xxhash.xxh64_intdigest(joined, seed=977)


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per unit: digest, place, and the words of it, of the unit before and of the one after."""
    for b in batches:
        for k in range(0, b.num_rows, 256):
            part = b.slice(k, 256)
            h, place, sizes = [], [], []
            for i, mark, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                own = [w for _, _, w in numbered(text or "")]
                n = [0, *map(len, own), 0]
                h += map(digest, own)
                place += [(i, mark, at) for at in range(len(own))]
                sizes += zip(n[1:-1], n[:-2], n[2:], strict=True)
            h1, h2 = np.array(h, np.uint64).reshape(-1, 2).T
            columns = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (h1, h2)]
            columns += [pa.array([x[k] for x in place], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32()))]
            columns += [pa.array([x[k] for x in sizes], pa.int32()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "id", "mark", "at", "n", "n_before", "n_after"])


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, t): mark is the text's hash, so that rows that share id and text are one document."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("t"))


def runs(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(id, mark, s, e, n, n_before, n_after, f_id, f_mark, shift): runs of units s to e that occur earlier and may reach min_words.

    n counts the run's words, n_before and n_after those of its neighbours. Its longest unit's earliest
    occurrence is in the text (f_id, f_mark), where units have numbers that are larger by shift.
    """
    found = materialize(texts(docs, id_col, text_col).mapInArrow(hashed, "h1 long, h2 long, id long, mark long, at int, n int, n_before int, n_after int"), "units")
    # Null ids rank last; texts that share an id rank by their hash.
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "mark", "at")
    often = found.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n_units")).where("n_units > 1").select("h1", "h2", "first")
    # As a table of its own it is dealt anew for the join, so that a hot digest's rows can be split.
    often = materialize(often, "first-units")
    later = found.join(often, ["h1", "h2"]).where(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("mark") == F.col("first.mark")) & (F.col("at") == F.col("first.at"))))
    # One deal by text serves the distinct rows, the numbering and the runs.
    later = later.drop("h1", "h2").repartition("id", "mark").dropDuplicates(["id", "mark", "at"])
    island = F.col("at") - F.row_number().over(Window.partitionBy("id", "mark").orderBy("at"))
    ends = (F.min("at").alias("s"), F.max("at").alias("e"), F.sum("n").alias("n"))
    sides = (F.min_by("n_before", "at").alias("n_before"), F.max_by("n_after", "at").alias("n_after"))
    anchor = F.max_by(F.struct("first.id", "first.mark", (F.col("first.at") - F.col("at")).alias("shift")), F.struct("n", -F.col("at"))).alias("anchor")
    found = later.withColumn("island", island).groupBy("id", "mark", "island").agg(*ends, *sides, anchor)
    found = found.where(F.col("n") + F.col("n_before") + F.col("n_after") >= min_words)
    return found.select("id", "mark", "s", "e", "n", "n_before", "n_after", F.col("anchor.id").alias("f_id"), F.col("anchor.mark").alias("f_mark"), "anchor.shift")


def edges(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, hits): for each text its runs with the words that stand beside their earliest occurrence, no more of them than their own neighbours have."""
    side = lambda name, at, room: F.struct(F.lit(name).alias("side"), (at + F.col("shift")).alias("at"), room.alias("room"))
    sides = F.array(side("before", F.col("s") - 1, F.col("n_before")), side("after", F.col("e") + 1, F.col("n_after")))
    asked = found.select("id", "mark", "s", "e", "n", "f_id", "f_mark", F.explode(sides).alias("x")).select("*", "x.*").drop("x")
    asked = materialize(asked, "unit-edges")
    wanted = asked.where("at >= 0 and room > 0").groupBy("f_id", "f_mark").agg(F.collect_set("at").alias("ats"))
    wanted = broadcast_if_small(materialize(wanted.toDF("w_id", "w_mark", "ats"), "edge-texts"), BROADCAST_TEXTS)
    rows = texts(docs, id_col, text_col).join(wanted, (F.col("mark") == F.col("w_mark")) & F.col("id").eqNullSafe(F.col("w_id"))).select("id", "mark", "t", "ats")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for i, mark, text, ats in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = [w for _, _, w in numbered(text or "")]
                for at in ats:
                    if at < len(own):
                        for column, v in zip(out, (i, mark, at, [w.decode("utf-8", "surrogatepass") for w in own[at]]), strict=True):
                            column.append(v)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["u_id", "u_mark", "u_at", "words"])

    beside = rows.mapInArrow(read, "u_id long, u_mark long, u_at int, words array<string>").dropDuplicates(["u_id", "u_mark", "u_at"])
    beside = broadcast_if_small(materialize(beside, "edge-units"), BROADCAST_EDGES)
    joined = asked.join(beside, (F.col("f_mark") == F.col("u_mark")) & (F.col("at") == F.col("u_at")) & F.col("f_id").eqNullSafe(F.col("u_id")), "left")
    room = F.least(F.col("room"), F.coalesce(F.size("words"), F.lit(0)))
    near = F.when(room <= 0, F.lit(None)).when(F.col("side") == "before", F.slice("words", -room, room)).otherwise(F.slice("words", F.lit(1), room))
    return joined.groupBy("id", "mark").agg(F.collect_list(F.struct("s", "e", "n", "side", near.alias("words"))).alias("hits"))


def shared(own: list[bytes], other: list[str]) -> int:
    """How many words two lists have in common from their beginnings on."""
    k = 0
    while k < min(len(own), len(other)) and own[k] == other[k].encode("utf-8", "surrogatepass"):
        k += 1
    return k


def removed(text: str, hits: list[dict], min_words: int) -> tuple[int, list[tuple[int, int]]]:
    """Number of units, and the merged spans of stretches that occur earlier. hits: s, e, n, side and words of runs."""
    own = list(numbered(text))
    ends: dict[tuple[int, int], list[int]] = {}
    for x in hits:
        s, e, beside = x["s"], x["e"], x["words"] or []
        span = ends.setdefault((s, e), [own[s][0], own[e][1], x["n"]])
        if x["side"] == "before" and s > 0 and (k := shared(own[s - 1][2][::-1], beside[::-1])):
            at = own[s - 1]
            span[0], span[2] = [at[0] + m.start() for m in WORD.finditer(text[at[0] : at[1]])][-k], span[2] + k
        if x["side"] == "after" and e + 1 < len(own) and (k := shared(own[e + 1][2], beside)):
            at = own[e + 1]
            span[1], span[2] = [at[0] + m.end() for m in WORD.finditer(text[at[0] : at[1]])][k - 1], span[2] + k
    spans: list[tuple[int, int]] = []
    for start, end, n in sorted(ends.values()):
        if n >= min_words and spans and start <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(end, spans[-1][1])
        elif n >= min_words:
            spans.append((start, end))
    return len(own), spans


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of docs: id, n_units, n_removed (code points), removed (start:end, comma-joined, in the original text) and the text that stays.

    A null text has no units and stays null. Rows with the same id and text are one document and
    lose the same stretches; null ids rank last. Only the two named columns are read.
    """
    found = materialize(runs(docs, id_col, text_col, min_words), "unit-runs")
    marks = edges(docs, found, id_col, text_col).select(F.col("id").alias("r_id"), F.col("mark").alias("r_mark"), "hits")
    joined = texts(docs, id_col, text_col).join(marks, (F.col("mark") == F.col("r_mark")) & F.col("id").eqNullSafe(F.col("r_id")), "left").select("id", "t", "hits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                out: list[list] = [[], [], [], []]
                for text, hits in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    n, spans = removed(text or "", hits or [], min_words)
                    kept, done = [], 0
                    for a, e in spans:
                        kept.append(text[done:a])
                        done = e
                    kept = text if not spans else "".join([*kept, text[done:]])
                    for column, v in zip(out, (n, sum(e - a for a, e in spans), ",".join(f"{a}:{e}" for a, e in spans), kept), strict=True):
                        column.append(v)
                types = (pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(out, types, strict=True))], [id_col, "n_units", "n_removed", "removed", "text"])

    return joined.mapInArrow(cut, f"`{id_col}` long, n_units long, n_removed long, removed string, text string")
