"""Line dedup over a sharded minimal perfect hash.

Long lines are hashed to 128 bits, counted over all documents, and those that enough documents
hold are indexed: each shard is a minimal perfect hash (displacement table) into a fingerprint
array, a count array and an array with the largest id that holds the line. Documents then
probe the arrays where they lie; no line is joined and no text is shuffled. An index that is too
large to broadcast is probed shard by shard instead: digests of lines go to their shard's arrays,
and line numbers come back. Either way the corpus is read twice, whatever the index holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkloom.llm.common import LOWER, SPACE
from sparkloom.storage import broadcast_if_small, materialize

MIN_CHARS = 40
MIN_DOCS = 5
#: Keys of one shard, and bytes of index that may be broadcast; beyond, lines go to the shards.
SHARD_KEYS = 1 << 16
BROADCAST_BYTES = 64 << 20
#: Lines that probe one copy of a shard at most; a shard with a hot line is copied. Documents with dropped lines that may be broadcast.
PROBES = 1 << 20
BROADCAST_DOCS = 100_000
LOWEST = -(1 << 63)
INDEX = "shard int, n int, disp binary, fp binary, cnt binary, top binary, rest binary"


def line_key(line: str, min_chars: int) -> bytes | None:
    """The key of a line in UTF-8, if it is long enough: stripped of ASCII white space, A-Z lower-cased."""
    line = line.strip(SPACE)
    return line.encode("utf-8", "surrogatepass").translate(LOWER) if len(line) >= min_chars else None


def long_lines(text: str | None, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(number, key) of the lines that are long enough."""
    for j, line in enumerate((text or "").split("\n")):
        if (key := line_key(line, min_chars)) is not None:
            yield j, key


def digest(key: bytes) -> tuple[int, int]:
    return xxhash.xxh64_intdigest(key, seed=42), xxhash.xxh64_intdigest(key, seed=977)


def mixed(h: np.ndarray, d: np.ndarray | int) -> np.ndarray:
    """64 well-mixed bits of hash h under displacement d."""
    with np.errstate(over="ignore"):
        x = h ^ (np.asarray(d, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build_shard(h: np.ndarray) -> np.ndarray:
    """Displacements of a minimal perfect hash over distinct 64-bit hashes: d >= 0 displaces, d < 0 names slot -d-1."""
    n = len(h)
    buckets = max(1, (n + 3) // 4)
    disp, used = np.zeros(buckets, dtype=np.int64), np.zeros(n, dtype=bool)
    if not n:
        return disp
    of = (mixed(h, 0) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    starts = np.searchsorted(of[order], np.arange(buckets + 1))
    sizes = np.diff(starts)
    for b in np.argsort(-sizes, kind="stable"):
        if sizes[b] < 2:
            break
        own, d = h[order[starts[b] : starts[b + 1]]], 1
        while True:
            at = (mixed(own[None, :], np.arange(d, d + 64)[:, None]) % np.uint64(n)).astype(np.int64)
            ranked = np.sort(at, axis=1)
            good = ~used[at].any(axis=1) & (np.diff(ranked, axis=1) > 0).all(axis=1)
            if good.any():
                k = int(good.argmax())
                disp[b], used[at[k]] = d + k, True
                break
            d += 64
    alone = np.flatnonzero(sizes == 1)
    disp[alone] = -np.flatnonzero(~used)[: len(alone)] - 1
    return disp


def slots(disp: np.ndarray, n: int, h: np.ndarray) -> np.ndarray:
    d = disp[(mixed(h, 0) % np.uint64(len(disp))).astype(np.int64)]
    return np.where(d < 0, -d - 1, (mixed(h, np.maximum(d, 0)) % np.uint64(max(n, 1))).astype(np.int64))


def build_index(pdf: pd.DataFrame) -> pd.DataFrame:
    h1 = pdf["h1"].to_numpy(np.int64).view(np.uint64)
    _, first = np.unique(h1, return_index=True)
    later = np.setdiff1d(np.arange(len(h1)), first)  # distinct lines with equal h1: listed apart
    own = pdf.iloc[first]
    h = h1[first]
    disp = build_shard(h)
    at = slots(disp, len(h), h)
    arrays = [np.zeros(len(h), dtype=t) for t in (np.int64, np.uint32, np.int64)]
    arrays[0][at], arrays[1][at], arrays[2][at] = own["h2"], np.minimum(own["n_docs"], 2**32 - 1), own["top"]
    rest = pdf.iloc[later][["h1", "h2", "n_docs", "top"]].to_numpy(np.int64)
    return pd.DataFrame([[int(pdf["shard"].iloc[0]), len(h), disp.astype(np.int32).tobytes(), *(a.tobytes() for a in arrays), rest.tobytes()]], columns=["shard", "n", "disp", "fp", "cnt", "top", "rest"])


class Probe:
    """Shards of one pass, unpacked once per Python worker."""

    def __init__(self, shards: list[tuple], n_shards: int) -> None:
        self.n_shards, self.shards = n_shards, {}
        for shard, n, disp, fp, cnt, top, rest in shards:
            extra = {(a, b): (c, t) for a, b, c, t in np.frombuffer(rest, np.int64).reshape(-1, 4).tolist()}
            self.shards[shard] = np.frombuffer(disp, np.int32).astype(np.int64), n, np.frombuffer(fp, np.int64), np.frombuffer(cnt, np.uint32), np.frombuffer(top, np.int64), extra

    def find(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and largest holder of each line; count 0 where the index doesn't have it."""
        count, top = np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64)
        of = (h1.view(np.uint64) % np.uint64(self.n_shards)).astype(np.int64)
        for shard in np.unique(of):
            if shard not in self.shards:
                continue
            disp, n, fp, cnt, tops, extra = self.shards[shard]
            rows = np.flatnonzero(of == shard)
            at = slots(disp, n, h1[rows].view(np.uint64))
            hit = fp[at] == h2[rows]
            count[rows[hit]], top[rows[hit]] = cnt[at[hit]], tops[at[hit]]
            for r in rows[~hit] if extra else ():
                count[r], top[r] = extra.get((int(h1[r]), int(h2[r])), (0, 0))
        return count, top


def signed(pairs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    a = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return np.ascontiguousarray(a[:, 0]), np.ascontiguousarray(a[:, 1])


def line_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> tuple[DataFrame, int]:
    """The shards (one row each) over every line hash that at least min_docs documents hold, and their number.

    Rows that share an id are one document, as are all rows without one.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ids = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {key for _, key in long_lines(text, min_chars)}
                found += map(digest, own)
                ids += [LOWEST if i is None else i] * len(own)
            h1, h2 = signed(found)
            yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(ids, pa.int64())], ["h1", "h2", "id"])

    lines = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).mapInArrow(hashed, "h1 long, h2 long, id long")
    # Distinct first, dealt by line and id: a line that a third of all documents hold is summed before it meets one task.
    often = lines.distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("top")).where(F.col("n_docs") >= min_docs)
    often = materialize(often, "line-counts")
    n_shards = max(1, -(-often.count() // SHARD_KEYS))

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = (b.column(0).to_numpy().view(np.uint64) % np.uint64(n_shards)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(of), *b.columns], ["shard", "h1", "h2", "n_docs", "top"])

    dealt = often.mapInArrow(shard, "shard int, h1 long, h2 long, n_docs long, top long")
    return materialize(dealt.groupBy("shard").applyInPandas(build_index, INDEX), "line-shards"), n_shards


def index_bytes(index: DataFrame) -> int:
    size = F.length("disp") + F.length("fp") + F.length("cnt") + F.length("top") + F.length("rest")
    return index.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def probe_all(docs: DataFrame, index: DataFrame, n_shards: int, id_col: str, text_col: str, min_chars: int, min_docs: int, finish: Callable, schema: StructType | str) -> DataFrame:
    """docs through the arrays, then through finish(batch, dropped line numbers of each row)."""
    if index_bytes(index) > BROADCAST_BYTES:
        marks = marks_by_shard(docs, index, n_shards, id_col, text_col, min_chars, min_docs)
        drops, m_id, m_mark = ("_".join(["dropped", x, *(c for c in docs.columns if c.startswith("dropped"))]) for x in ("lines", "id", "mark"))
        marks = broadcast_if_small(materialize(marks.toDF(m_id, m_mark, drops), "line-marks"), BROADCAST_DOCS)
        same = (F.xxhash64(docs[text_col]) == marks[m_mark]) & docs[id_col].cast("long").eqNullSafe(marks[m_id])
        joined = docs.join(marks, same, "left").select(*(docs[c] for c in docs.columns), marks[drops])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield finish(b.select(b.schema.names[:-1]), [d or [] for d in b.column(b.num_columns - 1).to_pylist()])

        return joined.mapInArrow(cut, schema)
    shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in index.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = Probe(shared.value, n_shards)
        for batch in batches:
            ids, texts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (id_col, text_col))
            found, where, drops = [], [], [[] for _ in ids]
            for r, text in enumerate(texts):
                for j, key in long_lines(text, min_chars):
                    found.append(digest(key))
                    where.append((r, j))
            if found:
                count, top = probe.find(*signed(found))
                for k in np.flatnonzero(count >= min_docs):
                    r, j = where[k]
                    if top[k] != (LOWEST if ids[r] is None else ids[r]):
                        drops[r].append(j)
            yield finish(batch, drops)

    return docs.mapInArrow(run, schema)


def marks_by_shard(docs: DataFrame, index: DataFrame, n_shards: int, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """(id, mark, drops): the numbers of the lines that a text loses; mark is the text's hash. Only digests are shuffled.

    A shard's arrays and the digests that fall to it meet in one task, the arrays first, so a task holds one shard
    at a time; a shard that more than PROBES lines fall to is copied and its lines are dealt out over the copies.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                b = batch.slice(k, 256)
                found, ids, marks, at = [], [], [], []
                for i, mark, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    for j, key in long_lines(text, min_chars):
                        found.append(digest(key))
                        ids.append(i)
                        marks.append(mark)
                        at.append(j)
                h1, h2 = signed(found)
                of = (h1.view(np.uint64) % np.uint64(n_shards)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(h1), pa.array(h2), pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(at, pa.int32())], ["shard", "h1", "h2", "id", "mark", "line"])

    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.xxhash64(text_col).alias("m"), F.col(text_col).alias("t"))
    lines = materialize(rows.mapInArrow(hashed, "shard int, h1 long, h2 long, id long, mark long, line int"), "line-probes")
    copies = lines.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / PROBES).cast("int").alias("copies"))
    copies = broadcast_if_small(materialize(copies, "shard-copies"), BROADCAST_DOCS)
    arrays = index.columns[1:]
    none = lambda names, kind: [F.lit(None).cast(k).alias(n) for n, k in zip(names, kind, strict=True)]
    probes = lines.join(copies, "shard").select("shard", F.pmod(F.xxhash64("id", "mark", "line"), F.col("copies")).cast("int").alias("copy"), F.lit(1).alias("kind"), *none(arrays, ["int"] + ["binary"] * 5), "h1", "h2", "id", "mark", "line")
    shards = index.join(copies, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"), *arrays, *none(("h1", "h2", "id", "mark", "line"), ["long"] * 4 + ["int"]))
    dealt = shards.union(probes).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind")

    def probe_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = Probe([], n_shards)
        for batch in batches:
            begin = 0
            for at in [*np.flatnonzero(batch.column(2).to_numpy() == 0).tolist(), batch.num_rows]:
                part = batch.slice(begin, at - begin)
                if part.num_rows:
                    count, top = probe.find(part.column(9).to_numpy(), part.column(10).to_numpy())
                    gone = (count >= min_docs) & (top != part.column(11).fill_null(LOWEST).to_numpy())
                    yield pa.RecordBatch.from_arrays([c.filter(pa.array(gone)) for c in part.columns[11:]], ["id", "mark", "line"])
                if at < batch.num_rows:
                    shard = [c[at].as_py() for c in batch.columns]
                    probe = Probe([(shard[0], *shard[3:9])], n_shards)
                begin = at + 1

    gone = dealt.mapInArrow(probe_rows, "id long, mark long, line int")
    return gone.groupBy("id", "mark").agg(F.sort_array(F.collect_set("line")).alias("drops"))


def kept_text(text: str | None, dropped: list[int]) -> str:
    gone = set(dropped)
    return "\n".join(x for j, x in enumerate((text or "").split("\n")) if j not in gone)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with repeated lines removed from text_col, all other columns as they were.

    A null text is one empty line and stays null. Rows that share an id count as one document, as do all
    rows without one; all rows with the largest id keep the line. A null id ranks below all others.
    """

    def rewrite(b: pa.RecordBatch, drops: list) -> pa.RecordBatch:
        at = b.schema.get_field_index(text_col)
        texts = [kept_text(t, d) if d else t for t, d in zip(b.column(at).to_pylist(), drops, strict=True)]
        return pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(texts, b.column(at).type), *b.columns[at + 1 :]], b.schema.names)

    index, n_shards = line_index(docs, id_col, text_col, min_chars, min_docs)
    return probe_all(docs, index, n_shards, id_col, text_col, min_chars, min_docs, rewrite, docs.schema)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per row of docs: id, n_lines, n_dropped and the SHA-256 of the text that stays; rules as in dedup_lines."""
    docs = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias(text_col))

    def report(b: pa.RecordBatch, drops: list) -> pa.RecordBatch:
        texts = b.column(1).to_pylist()
        lines = [(t or "").count("\n") + 1 for t in texts]
        shas = [hashlib.sha256(kept_text(t, d).encode("utf-8", "surrogatepass")).hexdigest() for t, d in zip(texts, drops, strict=True)]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(lines, pa.int64()), pa.array([len(d) for d in drops], pa.int64()), pa.array(shas, pa.string())], [id_col, "n_lines", "n_dropped", "kept_sha256"])

    index, n_shards = line_index(docs, id_col, text_col, min_chars, min_docs)
    return probe_all(docs, index, n_shards, id_col, text_col, min_chars, min_docs, report, f"`{id_col}` long, n_lines long, n_dropped long, kept_sha256 string")
