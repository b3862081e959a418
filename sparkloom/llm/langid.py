"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Languages and document frequencies are counted over all training rows. Training is
follow-the-regularised-leader (proximal) with an elastic-net penalty on a bounded, reproducible sample,
drawn for each language, so that rare ones are learned too; biases are moved back to the languages'
own shares. A temperature fitted on rows left out of training calibrates the probabilities. Scoring
is vectorised over a text's code points and keeps no state.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import in_fifth

SLOTS = 1 << 14
ORDERS = (1, 2, 3)
#: Labelled rows that training may use, spread over a language's rows by a hash of the id; and languages there may be.
MAX_ROWS, MAX_LANGS = 4000, 2000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 1e-4, 1e-4
NO_LANG = "und"


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # slots x languages
    bias: np.ndarray
    temperature: float


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of a lower-cased text with a blank at either end."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out, h = np.zeros(SLOTS, np.int64), np.zeros(len(c), np.uint32)
    with np.errstate(over="ignore"):
        for n in range(1, max(ORDERS) + 1):
            if len(c) < n:
                break
            h = (h[: len(c) - n + 1] ^ c[n - 1 :]) * np.uint32(0x9E3779B1)
            if n in ORDERS:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77)
                out += np.bincount(mixed >> np.uint32(32 - 14), minlength=SLOTS)
    return out


def tfidf(n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.sqrt(n) * idf
    return x / max(float(np.sqrt(x @ x)), 1e-9)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_langs: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after EPOCHS passes over (slots, values, language) rows in a fixed order."""
    z, n = np.zeros((SLOTS + 1, n_langs)), np.zeros((SLOTS + 1, n_langs))

    def weights(k: np.ndarray | slice) -> np.ndarray:
        w = -(z[k] - np.sign(z[k]) * L1) / ((BETA + np.sqrt(n[k])) / ALPHA + L2)
        return np.where(np.abs(z[k]) <= L1, 0.0, w)

    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for r in rng.permutation(len(rows)):
            k, x, y = rows[r]
            k, x = np.append(k, SLOTS), np.append(x, 1.0)
            w = weights(k)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            z[k] += g - (np.sqrt(n[k] + g * g) - np.sqrt(n[k])) / ALPHA * w
            n[k] += g * g
    w = weights(slice(None))
    return w[:SLOTS], w[SLOTS]


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log-loss, from a fixed grid."""
    grid = np.geomspace(0.05, 5, 60)
    loss = [-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def quota(sizes: list[int], most: int) -> float:
    """Rows of each language that together are at most most, where smaller languages give all they have."""
    left, level = float(most), float(most)
    for k, n in enumerate(sorted(sizes)):
        level = left / (len(sizes) - k)
        if n > level:
            break
        left -= n
    return level


def document_frequencies(own: DataFrame) -> np.ndarray:
    """In how many texts (column t) of the table each slot occurs: summed in each task, then by slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(SLOTS, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                held += counts(t) > 0
        k = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(held[k])], ["slot", "n"])

    df = np.zeros(SLOTS)
    for r in own.select("t").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        df[r["slot"]] = r["n"]
    return df


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS) -> Model:
    """Learns from rows with a language outside the held-out fifth; weights from about max_rows of them at most.

    Raises where the language column names more than MAX_LANGS: that is no language column.
    """
    own = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~in_fifth(F.col(id_col)))
    own = own.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))
    sizes = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"{lang_col} names more than {MAX_LANGS} languages")
    langs, total = sorted(sizes), sum(sizes.values())
    if not langs:
        return Model([], np.ones(SLOTS), np.zeros((SLOTS, 0)), np.zeros(0), 1.0)
    level = quota(list(sizes.values()), max_rows)
    shares = docs.sparkSession.createDataFrame([(x, int(min(1.0, level / n) * (1 << 30))) for x, n in sizes.items()], "s_lang string, share long")
    place = F.pmod(F.xxhash64(F.lit(11), F.col("id")), F.lit(1 << 30))
    chosen = own.join(F.broadcast(shares), F.col("lang") == F.col("s_lang")).where(place < F.col("share")).select("id", "lang", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots, values = [], []
            for t in b.column(2).to_pylist():
                c = counts(t)
                k = np.flatnonzero(c)
                slots.append(k.astype(np.uint16).tobytes())
                values.append(c[k].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(slots, pa.binary()), pa.array(values, pa.binary())], ["id", "lang", "slots", "n"])

    rows = sorted(chosen.mapInArrow(run, "id long, lang string, slots binary, n binary").collect(), key=lambda r: (r["id"], r["lang"], r["slots"], r["n"]))
    idf = np.log((1 + total) / (1 + document_frequencies(own))) + 1
    vectors = []
    for r in rows:
        k, x = np.frombuffer(r["slots"], np.uint16).astype(np.int64), np.sqrt(np.frombuffer(r["n"], np.uint32))
        x = x * idf[k]
        vectors.append((k, x / max(float(np.sqrt(x @ x)), 1e-9), langs.index(r["lang"])))
    aside = vectors[::5] if len(vectors) >= 50 else []
    learn = [v for i, v in enumerate(vectors) if i % 5 or not aside]
    w, bias = ftrl(learn, len(langs))
    z, y = np.array([x @ w[k] + bias for k, x, _ in aside]), np.array([y for _, _, y in aside], int)
    warmth = temperature(z, y) if aside else 1.0
    # The sample holds languages in other shares than the rows do: calibrated, then as likely a priori as in the rows.
    held = np.bincount([y for _, _, y in learn], minlength=len(langs))
    prior = np.array([sizes[x] / total for x in langs]) / (np.maximum(held, 1) / max(held.sum(), 1))
    return Model(langs, idf, w, bias + warmth * np.log(prior), warmth)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, held_out, lang_pred and score (the calibrated probability).

    A text that is null or has no letter is `und` with score 0, as is every text where nothing
    was learned. Whole texts are read, whatever their length; repeated rows repeat.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            names, scores = [], []
            for t in b.column(2).to_pylist():
                if t is None or not m.langs or not any(map(str.isalpha, t)):
                    names.append(NO_LANG)
                    scores.append(0.0)
                    continue
                p = softmax((tfidf(counts(t), m.idf) @ m.weights + m.bias) / m.temperature)
                k = int(p.argmax())
                names.append(m.langs[k])
                scores.append(float(min(1.0, p[k])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], [id_col, "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), in_fifth(F.col(id_col)).alias("held_out"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"`{id_col}` long, held_out boolean, lang_pred string, score double")
