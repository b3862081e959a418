"""SimHash near-dedup by tiled exact comparison.

Equal fingerprints are collapsed first. A tile holds fingerprints that agree in the population
counts of their 16-bit blocks. The block counts of two fingerprints differ, summed, by at
most their Hamming distance, so tile pairs whose counts differ by more than the radius are never
formed; the others are compared bit by bit with numpy. From each tile pair only a spanning forest
of its links goes on, which keeps every component and stays linear in the tile's size.

near_groups() links at 2 of 64 bits, which finds copies but few edited ones. exact_groups() and
keep_one() link at a Jaccard similarity of five-word shingles: 512 bits propose, with a radius that
similar sets don't exceed, over tiles of like-sized sets (sets whose sizes differ by more than a
quarter can't be similar), and the shingle sets of all that a proposed component holds decide.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import LOWER
from sparkloom.storage import broadcast_if_small, discard, materialize

RADIUS = 2
SHINGLE = 3
#: Fingerprints of one tile piece; two pieces are compared in blocks of 256 rows.
PIECE = 4096
#: Distinct fingerprints beyond which tiles are cut finer (blocks of 8 and of 4 bits).
FINER = (20_000_000, 5_000_000_000)
#: For groups of similar texts: five words, a Jaccard similarity, and 64-bit words of a fingerprint.
WIDE_SHINGLE = 5
SIMILARITY = 0.8
WORDS = 8
WIDE = tuple(f"w{k}" for k in range(WORDS))
LARGEST_PIECE = 250_000
#: Narrow rows (ids of near copies, members of proposed components) that may be broadcast; beyond, texts are shuffled.
BROADCAST_IDS = 500_000
#: Chance that one similar pair lies outside the radius of a proposal.
MISS = 1e-9
#: Shingles and sets of one piece of a proposed component, whose sets are compared in pairs of pieces.
PIECE_SHINGLES, PIECE_SETS = 2_000_000, 4096


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half the XXH64 hashes of the text's word shingles."""
    own = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not own:
        return 0
    joined = b" ".join(own)
    if len(own) <= size:
        return xxhash.xxh64_intdigest(joined, seed=42)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.concatenate(([0], ends[: len(own) - size] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, fp) of every row of docs; fp is the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(t, size) for t in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.int64())], ["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).mapInArrow(run, "id long, fp long")


def neighbours(blocks: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of block counts within the radius, one of each +/- pair."""
    near = [()]
    for _ in range(blocks):
        near = [(*d, x) for d in near for x in range(-radius, radius + 1) if sum(map(abs, d)) + abs(x) <= radius]
    return [d for d in near if d >= tuple(-x for x in d)]


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member number of each of n nodes' components under links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def forest(x: np.ndarray, y: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the graph in which members of x and y within the radius are joined."""
    nodes = x if same else np.concatenate((x, y))
    label = np.arange(len(nodes))
    for k in range(0, len(x), 256):
        near = np.bitwise_count(x[k : k + 256, None] ^ y[None, :]) <= radius
        a, b = np.nonzero(near)
        if len(a):
            a, b = label[a + k], label[b if same else b + len(x)]
            if (a != b).any():
                label = roots(len(nodes), a, b)[label]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) pairs of distinct fingerprints (column fp) that join exactly what lies within the radius."""
    n = classes.count()
    blocks = 4 * 2 ** sum(n > x for x in FINER)
    width = 64 // blocks
    block = lambda k: F.bit_count(F.shiftrightunsigned("fp", k * width).bitwiseAND(F.lit((1 << width) - 1)))
    # A tile's number has its block counts as digits. The base exceeds any two tiles' distance in a
    # digit after a step, so number plus step is a tile's number only if every digit agrees.
    base = 1 << (width + radius).bit_length()
    tile = sum((block(k).cast("long") * F.lit(base**k) for k in range(1, blocks)), block(0).cast("long"))
    tiled = classes.select("fp", tile.alias("tile"))
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces"))
    dealt = tiled.join(sizes, "tile").withColumn("piece", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
    tiles = materialize(dealt.groupBy("tile", "piece").agg(F.collect_list("fp").alias("fps")), "simhash-tiles")
    steps = [sum(x * base**k for k, x in enumerate(d)) for d in neighbours(blocks, radius)]
    # Pairs of keys first: arrays are copied only for tiles that have a neighbour.
    keys = tiles.select("tile", "piece")
    left = keys.select(F.col("tile").alias("tile_a"), F.col("piece").alias("piece_a"), F.explode(F.transform(F.array(*map(F.lit, steps)), lambda s: F.col("tile") + s)).alias("tile"))
    pairs = left.join(keys, "tile").where((F.col("tile") != F.col("tile_a")) | (F.col("piece") >= F.col("piece_a")))
    pairs = pairs.join(tiles.select(F.col("tile").alias("tile_a"), F.col("piece").alias("piece_a"), F.col("fps").alias("x")), ["tile_a", "piece_a"])
    pairs = pairs.join(tiles.withColumnRenamed("fps", "y"), ["tile", "piece"])
    pairs = pairs.select("x", "y", ((F.col("tile") == F.col("tile_a")) & (F.col("piece") == F.col("piece_a"))).alias("same"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            x, y, same = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            xs, ys = x.flatten().to_numpy().view(np.uint64), y.flatten().to_numpy().view(np.uint64)
            xo, yo = x.offsets.to_numpy() - x.offsets[0].as_py(), y.offsets.to_numpy() - y.offsets[0].as_py()
            for r, one in enumerate(same):
                found = forest(xs[xo[r] : xo[r + 1]], ys[yo[r] : yo[r + 1]], one, radius)
                if len(found[0]):
                    a.append(found[0])
                    b.append(found[1])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], ["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): every linked node with the smallest node of its component.

    Large-star and small-star steps in turn until nothing changes; each round is a table, so a lost
    executor costs one round.
    """
    star = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "star")
    if star.isEmpty():
        return star.select(F.col("u").alias("node"), F.col("v").alias("root"))
    seen = None
    for _ in range(rounds):
        both = star.union(star.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u")
        small = small.select("u", F.col("low").alias("v")).union(small.where("v != low").select("v", "low")).distinct()
        old, star = star, materialize(small, "star")
        discard(old)
        now = star.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return star.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id that is reachable over links of at most radius bits. Texts
    without words (null, empty) have fingerprint zero and link like any other. Rows without id get
    their component's smallest id, or null where no member has one. Repeated rows stay repeated.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, size), "fingerprints")
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("low")), "fingerprint-classes")
    linked = components(materialize(links(classes.select("fp"), radius), "simhash-links"))
    rooted = classes.join(linked, classes.fp == linked.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = materialize(rooted.join(lowest, "root").select(F.col("fp").alias("c_fp"), "component_id"), "component-ids")
    out = prints.join(named, prints.fp == named.c_fp, "left")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def spread(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th of several independent 64-bit hashes that are derived from one."""
    with np.errstate(over="ignore"):
        x = h + np.uint64(0x9E3779B97F4A7C15) * np.uint64(k + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, size: int = WIDE_SHINGLE) -> np.ndarray:
    """The sorted distinct XXH64 hashes of the text's word shingles; a shorter text is one shingle."""
    own = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not own:
        return np.zeros(0, np.uint64)
    joined = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    n = max(1, len(own) - size + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends[-n:].tolist(), strict=True)), np.uint64, n))


def wide_fingerprint(h: np.ndarray) -> np.ndarray:
    """A fingerprint of WORDS times 64 bits over the hashes of a text's shingles (without any: zeros)."""
    ones = np.zeros((WORDS, 64), np.int64)
    for at in range(0, len(h), 1 << 14):
        part = h[at : at + (1 << 14)]
        for k in range(WORDS):
            ones[k] += np.unpackbits(spread(part, k).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(h), axis=1, bitorder="little").view(np.uint64).ravel()


def reach(bits: int, p: float, miss: float = MISS) -> int:
    """The number of bits that, where each differs with probability p, more differ with a chance of at most miss."""
    tail = 0.0
    for k in range(bits, 0, -1):
        tail += math.comb(bits, k) * p**k * (1 - p) ** (bits - k)
        if tail > miss:
            return k
    return 0


@functools.cache
def proposal_radii(similarity: float, words: int) -> np.ndarray:
    """Bits of so many words in which similar sets may differ, by the smaller set's size (the last for all larger ones).

    A bit differs with the probability acos(2s / (1 + s)) / pi in large sets; in small ones, where ties
    of the majority count, with up to 1 + 1 / size times that (exact sums; the tests repeat them).
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return np.array([reach(64 * words, p * (1 + 1 / max(n, 1))) for n in range(65)])


def wide_forest(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, same: bool, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions, those of y behind those of x) of a spanning forest of the pairs that may be similar.

    x, y: wide fingerprints, nx, ny: their shingle counts. The first two words rule out nearly all unlike pairs;
    those that already are in one tree aren't looked at again.
    """
    n = nx if same else np.concatenate((nx, ny))
    wide = x if same else np.concatenate((x, y))
    label, shift = np.arange(len(n)), 0 if same else len(x)
    first, second = (np.ascontiguousarray(wide[:, k]) for k in (0, 1))
    radii = proposal_radii(similarity, WORDS)
    most = proposal_radii(similarity, 2)[min(n.min(), 64)]
    for i in range(0, len(x), 256):
        for j in range(i + shift if same else shift, len(n), 8192):
            rows = slice(i, min(i + 256, len(x)))
            bits = np.bitwise_count(first[rows, None] ^ first[None, j : j + 8192])
            bits += np.bitwise_count(second[rows, None] ^ second[None, j : j + 8192])
            a, b = np.nonzero(bits <= most)
            a, b = a + i, b + j
            for k in range(0, len(a), 1 << 15):
                c, d = a[k : k + (1 << 15)], b[k : k + (1 << 15)]
                open_ = label[c] != label[d]
                c, d = c[open_], d[open_]
                small = np.minimum(n[c], n[d])
                near = (small >= similarity * np.maximum(n[c], n[d])) & (np.bitwise_count(wide[c] ^ wide[d]).sum(axis=1, dtype=np.int32) <= radii[np.minimum(small, 64)])
                if near.any():
                    label = roots(len(n), label[c[near]], label[d[near]])[label]
    moved = np.flatnonzero(label != np.arange(len(n)))
    return moved, label[moved]


def wide_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WIDE_SHINGLE) -> DataFrame:
    """(id, text_hash, n, mark, bucket, w0 to w7) of every row of docs; mark is the shingle set's hash; shingle counts in one or neighbouring buckets differ by up to a quarter and more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, mark, found = [], [], []
            for t in b.column(2).to_pylist():
                h = shingle_hashes(t, size)
                n.append(len(h))
                mark.append(xxhash.xxh64_intdigest(h.tobytes(), 42))
                found.append(wide_fingerprint(h))
            n, mark = np.array(n, np.int64), np.array(mark, np.uint64).view(np.int64)
            wide = np.array(found, np.uint64).reshape(-1, WORDS).view(np.int64)
            bucket = np.floor(np.log(np.maximum(n, 1)) / math.log(1.25 + 1e-9)).astype(np.int32)
            columns = [b.column(0), b.column(1), pa.array(n), pa.array(mark), pa.array(bucket), *(pa.array(np.ascontiguousarray(wide[:, k])) for k in range(WORDS))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text_hash", "n", "mark", "bucket", *WIDE])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, "id long, text_hash long, n long, mark long, bucket int, " + ", ".join(f"{w} long" for w in WIDE))


def wide_links(classes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b) pairs of nodes that join exactly those within the radius of a proposal; classes: node, n, bucket, w0 to w7 of distinct fingerprints.

    A tile holds fingerprints of one bucket of shingle counts. Tile pairs are skipped whose population counts
    differ by more than the radius, and those of buckets that aren't neighbours: at 0.8 or more, similar sets lie in
    one bucket or two neighbouring ones. Large tiles are cut into pieces, so that no task compares more than two at once.
    """
    if similarity < 0.8:
        raise ValueError("buckets of shingle counts are made for similarities of 0.8 and more")
    sizes = classes.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.select("bucket", F.least(F.ceil(F.col("size") / PIECE), F.greatest(F.lit(16), F.ceil(F.col("size") / LARGEST_PIECE))).cast("int").alias("pieces"))
    # At most 196 rows: a bucket's number is a logarithm of a 64-bit count. The join leaves rows where they lie,
    # so that tiles are dealt out by piece too and not by bucket alone.
    dealt = classes.join(F.broadcast(sizes), "bucket").withColumn("piece", F.pmod(F.xxhash64(*WIDE), F.col("pieces")).cast("int"))
    population = sum((F.bit_count(w) for w in WIDE[1:]), F.bit_count(WIDE[0]))
    ends = (F.min(population).alias("low"), F.max(population).alias("high"))
    tiles = materialize(dealt.groupBy("bucket", "piece").agg(F.collect_list(F.struct("node", "n", *WIDE)).alias("own"), *ends), "wide-tiles")
    keys = tiles.select("bucket", "piece", "low", "high")
    tiles = tiles.select("bucket", "piece", "own")
    other = keys.toDF("o_bucket", "o_piece", "o_low", "o_high")
    radius = int(proposal_radii(similarity, WORDS).max())
    near = (F.col("o_low") - F.col("high") <= radius) & (F.col("low") - F.col("o_high") <= radius)
    pairs = keys.withColumn("o_bucket", F.explode(F.array(F.col("bucket"), F.col("bucket") + 1))).join(other, "o_bucket")
    pairs = pairs.where(near & ((F.col("o_bucket") != F.col("bucket")) | (F.col("o_piece") >= F.col("piece")))).select("bucket", "piece", "o_bucket", "o_piece")
    pairs = pairs.join(tiles.withColumnRenamed("own", "x"), ["bucket", "piece"])
    right = tiles.select(F.col("bucket").alias("o_bucket"), F.col("piece").alias("o_piece"), F.col("own").alias("y"))
    pairs = pairs.join(right, ["o_bucket", "o_piece"]).select("x", "y", ((F.col("o_bucket") == F.col("bucket")) & (F.col("o_piece") == F.col("piece"))).alias("same"))

    def unpacked(column: pa.ListArray, r: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, n, *wide = (c.to_numpy() for c in column.slice(r, 1).flatten().flatten())
        return node, n, np.stack(wide, axis=1).view(np.uint64)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, same in enumerate(batch.column(2).to_pylist()):
                node, n, wide = unpacked(batch.column(0), r)
                o_node, o_n, o_wide = (node, n, wide) if same else unpacked(batch.column(1), r)
                a, b = wide_forest(wide, o_wide, n, o_n, same, similarity)
                nodes = node if same else np.concatenate((node, o_node))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[a]), pa.array(nodes[b])], ["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def component_ids(prints: DataFrame, classes: DataFrame, linked: DataFrame, keys: list[str]) -> DataFrame:
    """(id, component_id) of every row of prints; keys name its class, linked the roots of the classes' nodes."""
    rooted = classes.join(linked.withColumnRenamed("node", "l_node"), F.col("node") == F.col("l_node"), "left").select(*keys, "low", F.coalesce("root", "node").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = materialize(rooted.join(lowest, "root").select(*keys, "component_id"), "wide-components")
    return prints.join(named, keys, "left").select("id", "component_id")


def set_forest(flat: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    """For each set the smallest number of its tree, in a spanning forest of the similar pairs of a set of left and one of right.

    flat: the elements of all sets one after the other, none empty; at: where each starts, and the end. Common
    elements are counted exactly; pairs that already are in one tree aren't counted.
    """
    n, label = np.diff(at), np.arange(len(at) - 1)
    found, flat = np.unique(flat, return_inverse=True)
    own = np.zeros(len(found), bool)
    for i in left:
        j = right[(label[right] != label[i]) & (np.minimum(n[right], n[i]) >= similarity * np.maximum(n[right], n[i]) - 1e-9)]
        if not len(j):
            continue
        own[flat[at[i] : at[i + 1]]] = True
        begin = np.cumsum(n[j]) - n[j]
        common = np.add.reduceat(own[flat[np.arange(n[j].sum()) + np.repeat(at[j] - begin, n[j])]], begin, dtype=np.int64)
        own[flat[at[i] : at[i + 1]]] = False
        j = j[common >= similarity * (n[j] + n[i] - common) - 1e-9]
        if len(j):
            trees = np.unique(label[np.append(j, i)])
            label[np.isin(label, trees)] = trees[0]
    return label


def verified_links(docs: DataFrame, members: DataFrame, similarity: float, size: int) -> DataFrame:
    """(a, b) pairs of nodes that join exactly the similar sets of each proposed component.

    docs: id, text_hash and text t; members: node, root, n, and id and text_hash of one row that holds the set.
    A large component is cut into pieces and every pair of pieces compared, so that no task holds more than two.
    """
    pieces = F.greatest(F.ceil(F.sum("n") / PIECE_SHINGLES), F.ceil(F.count(F.lit(1)) / PIECE_SETS)).cast("int")
    # Only components of several pieces: fewer rows than the corpus has pieces' worth of shingles or sets.
    large = members.groupBy("root").agg(pieces.alias("pieces")).where("pieces > 1")
    dealt = members.join(F.broadcast(large), "root", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64("text_hash"), F.col("pieces")).cast("int")).withColumnsRenamed({"id": "m_id", "text_hash": "m_hash"})
    dealt = broadcast_if_small(materialize(dealt, "wide-pieces"), BROADCAST_IDS)
    rows = docs.join(dealt, (F.col("text_hash") == F.col("m_hash")) & F.col("id").eqNullSafe(F.col("m_id"))).select("root", "pieces", "piece", "node", "t")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                b = batch.slice(k, 256)
                sets = [shingle_hashes(t, size).tobytes() for t in b.column(4).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(sets, pa.binary())], ["root", "pieces", "piece", "node", "own"])

    sets = rows.mapInArrow(hashed, "root long, pieces int, piece int, node long, own binary")
    sets = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    sets = sets.select("root", F.least("piece", "other").alias("lo"), F.greatest("piece", "other").alias("hi"), "piece", "node", "own")

    def compare(group: pa.Table) -> pa.Table:
        lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
        piece, node = group["piece"].to_numpy(), group["node"].to_numpy()
        own = [np.frombuffer(s, np.uint64) for s in group["own"].to_pylist()]
        at = np.cumsum([0, *map(len, own)])
        label = set_forest(np.concatenate(own), at, np.flatnonzero(piece == lo), np.flatnonzero(piece == hi), similarity)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": pa.array(node[moved], pa.int64()), "b": pa.array(node[label[moved]], pa.int64())})

    return sets.groupBy("root", "lo", "hi").applyInArrow(compare, "a long, b long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, size: int = WIDE_SHINGLE) -> DataFrame:
    """One row per row of docs: id and component_id, the smallest id that is reachable over links of similar texts.

    Two texts link if their sets of size-word shingles have the similarity (Jaccard) or more, counted on the
    sets. Only sets of one component of the proposals are counted; a similar pair is outside with a chance of
    about MISS. Texts without words link to each other. Rows that share an id are one document. Rows without id
    get their text's or component's smallest id, or null where there is none.
    """
    prints = materialize(wide_prints(docs, id_col, text_col, size), "wide-prints")
    node = F.coalesce(F.min("id"), F.xxhash64("n", "mark"))
    one = F.min(F.struct("id", "text_hash"))
    classes = prints.groupBy("n", "bucket", "mark").agg(F.min("id").alias("low"), node.alias("node"), one.alias("one"), *(F.min(w).alias(w) for w in WIDE))
    classes = materialize(classes, "wide-classes")
    proposed = components(materialize(wide_links(classes.select("node", "n", "bucket", *WIDE), similarity), "wide-edges"))
    proposed = proposed.union(proposed.select(F.col("root").alias("node"), "root").distinct())  # roots aren't among the nodes
    members = classes.join(proposed.withColumnRenamed("node", "p_node"), F.col("node") == F.col("p_node")).select("node", "root", "n", "one.id", "one.text_hash")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("t"))
    linked = components(materialize(verified_links(rows, materialize(members, "wide-members"), similarity, size), "wide-verified"))
    return component_ids(prints, classes, linked, ["n", "mark"]).withColumnRenamed("id", id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, size: int = WIDE_SHINGLE) -> DataFrame:
    """The rows of docs that have the smallest id of their group of similar texts (rows without id only where no member has one)."""
    groups = exact_groups(docs, id_col, text_col, similarity, size)
    gone = groups.where(F.col("component_id").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("gone_id")).distinct()
    gone = broadcast_if_small(materialize(gone, "near-copies"), BROADCAST_IDS)
    return docs.join(gone, docs[id_col].cast("long").eqNullSafe(gone["gone_id"]), "left_anti")
