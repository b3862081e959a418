"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexicon transducer turns words into tags: insult, threat, target, negation, reported speech. Its
insult arcs are learned: words and word beginnings that labelled documents show to be toxic. Three
more transducers rewrite an insult's tag by what stands before it in its clause (a negation whose
scope lasts, a target, reported speech), and one completes threats by their target. They are
composed and run once over each clause; weights of the final tags are fitted to the labels around
fixed priors. A document without a tagged word never reaches the grammar.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import in_fifth
from sparkloom.storage import broadcast_if_small, materialize

#: Labelled rows that learning may use, spread over the rows by a hash of the id, and insult arcs kept.
MAX_ROWS = 20_000
MAX_TERMS = 2000
#: An arc's support in toxic documents, its share of toxic ones, and its smoothed log-odds.
SUPPORT, PRECISION, LOG_ODDS = 3, 0.9, 3.0
PREFIXES = (4, 5, 6)
#: Words that the scope of a negation or a target lasts, and that a threat waits for its target.
SCOPE = 4
#: Added to the state of a waiting threat that is negated or reported.
NEGATED, REPORTED = 100, 200

INSULTS = "idiot idiots moron morons imbecile stupid pathetic worthless scum trash loser losers clown disgusting dumb filth vermin bastard idioten dummkopf abschaum versager widerlich idiota imbécil estúpido basura escoria asqueroso idiote imbécile crétin ordure minable répugnant"
THREATS = "kill murder hurt destroy shoot stab strangle töten umbringen verletzen erschießen matar destruir herir tuer détruire frapper"
TARGETS = "you your yours they them their he she him her du dich dir ihr euch sie tu te vous toi ils elles ustedes vosotros ellos ellas"
NEGATIONS = "not never no neither nor isn aren don doesn nicht kein keine niemals nie pas jamais aucun ningún ninguna nunca jamás"
REPORTS = "said says called claims claimed wrote quoted according allegedly sagte sagt nannte behauptet dit appelé affirme prétend dijo dice llamó afirma"
SEEDS = {"THR": THREATS, "TGT": TARGETS, "NEG": NEGATIONS, "REP": REPORTS}
SEED_STRENGTH = 0.8

#: Final tags: an insult is plain or directed, and stated, negated or reported; a threat likewise.
TAGS = ("INS", "INS@", "INS~", "INS@~", 'INS"', 'INS@"', "THREAT", "THREAT~", 'THREAT"')
PRIOR = np.array([-3.0, 6.0, 7.0, 1.5, 2.0, 1.5, 2.0, 6.0, 1.0, 1.5])  # bias first
PRIOR_SD = 2.0
MOST = 4.0
#: Steps that fitting may take, and the gradient for each row at which it has settled.
STEPS, SETTLED = 200, 1e-7

CLAUSE = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"[^\W\d_]+")

Machine = Callable[[int, str], tuple[int, str]]


def scoped(opens: str, mark: str, scope: int, on: str) -> Machine:
    """A transducer that marks tags beginning with on while the scope of an opening tag lasts (0: to the clause's end)."""

    def step(state: int, tag: str) -> tuple[int, str]:
        if tag == opens:
            return scope or -1, tag
        out = tag + mark if state and tag.startswith(on) else tag
        return (state - 1 if state > 0 else state), out

    return step


def threat(state: int, tag: str) -> tuple[int, str]:
    """A transducer that turns a target within SCOPE words behind a threat into THREAT, with the threat's own marks."""
    if tag.startswith("THR"):
        return SCOPE + NEGATED * ("~" in tag) + REPORTED * ("~" not in tag and '"' in tag), "o"
    words, mark = state % NEGATED, state // NEGATED * NEGATED
    if words and tag == "TGT":
        return 0, "THREAT" + {0: "", NEGATED: "~", REPORTED: '"'}[mark]
    return (state - 1 if words else 0), tag


#: The composed grammar behind the lexicon: target, then negation, then reported speech, then threats.
GRAMMAR: tuple[Machine, ...] = (
    scoped("TGT", "@", SCOPE, "INS"),
    scoped("NEG", "~", SCOPE, "INS"),
    scoped("NEG", "~", SCOPE, "THR"),
    scoped("REP", '"', 0, "INS"),
    scoped("REP", '"', 0, "THR"),
    threat,
)


@dataclass
class Lexicon:
    words: dict[str, tuple[str, float]]
    prefixes: dict[str, float]

    def tag(self, word: str) -> tuple[str, float]:
        found = self.words.get(word)
        if found:
            return found
        for k in PREFIXES:
            if len(word) > k and word[:k] in self.prefixes:
                return "INS", self.prefixes[word[:k]]
        return "o", 0.0

    def triggers(self, own: set[str]) -> bool:
        """Whether an insult or a threat is among the words."""
        if any(self.words[w][0] in ("INS", "THR") for w in own & self.words.keys()):
            return True
        return bool(self.prefixes) and any(w[:4] in self.heads and self.tag(w)[0] == "INS" for w in own)

    def __post_init__(self) -> None:
        self.heads = {p[:4] for p in self.prefixes}


def features(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """The summed strengths of each final tag over the text's clauses, at most MOST each."""
    out = np.zeros(len(TAGS))
    text = (text or "").lower()
    if not lexicon.triggers(set(WORD.findall(text))):
        return out
    for clause in CLAUSE.split(text):
        states = [0] * len(GRAMMAR)
        for word in WORD.findall(clause):
            tag, strength = lexicon.tag(word)
            for k, step in enumerate(GRAMMAR):
                states[k], tag = step(states[k], tag)
            if tag[:3] == "INS" or tag[:6] == "THREAT":
                negated = tag.replace('"', "") if "~" in tag else tag
                out[TAGS.index(negated)] += strength or SEED_STRENGTH
    return np.minimum(out, MOST)


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, text: str | None) -> float:
        z = self.weights[0] + float(features(text, self.lexicon) @ self.weights[1:])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_weights(x: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> np.ndarray:
    """Most likely weights under the priors (the bias first); those of tags are at least 0. n: how often each row counts.

    Newton steps over the weights that no bound holds, halved until the objective falls; where such a step
    finds no fall, one along the scaled gradient. The objective is convex, so the weights settle; if they don't, it raises.
    """
    n = np.ones(len(y)) if n is None else n
    x = np.hstack([np.ones((len(x), 1)), x])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(n @ (np.logaddexp(0.0, z) - y * z) + ((w - PRIOR) ** 2).sum() / (2 * PRIOR_SD**2))

    def bounded(w: np.ndarray) -> np.ndarray:
        return np.append(w[:1], np.maximum(w[1:], 0.0))

    w = PRIOR.copy()
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        g = x.T @ (n * (p - y)) + (w - PRIOR) / PRIOR_SD**2
        free = np.append(True, (w[1:] > 0) | (g[1:] < 0))
        if np.abs(g[free]).max() <= SETTLED * (1 + n.sum()):
            return w
        h = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w)) / PRIOR_SD**2
        newton, scaled = np.zeros(len(w)), np.where(free, g / np.diag(h), 0.0)
        newton[free] = np.linalg.solve(h[np.ix_(free, free)], g[free])
        tries = [bounded(w - step / 2**k) for step in (newton, scaled) for k in range(40)]
        now = loss(w)
        w = next((v for v in tries if (fall := g @ (w - v)) > 0 and loss(v) <= now - 1e-4 * fall), None)
        if w is None:
            break
    raise RuntimeError("the weights of the toxicity grammar did not settle")


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int, seed: int = 5) -> DataFrame:
    """(id, t, y, kin): at most about max_rows labelled texts outside the held-out fifth; kin is a hash of all words in order, which only copies share."""
    own = labels.where(F.col(label_col).isNotNull() & ~in_fifth(F.col(id_col)))
    own = own.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("y")).distinct()
    n = own.count()
    place = F.pmod(F.xxhash64(F.lit(seed), F.col("l_id")), F.lit(1 << 30))
    own = own.where(place < int(min(1.0, max_rows / max(n, 1)) * (1 << 30)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t is not null")
    rows = rows.join(broadcast_if_small(own, 2 * max_rows), F.col("id") == F.col("l_id")).select("id", "t", "y")
    own_words = F.trim(F.regexp_replace(F.lower(F.col("t")), r"[^\p{L}]+", " "))
    return materialize(rows.withColumn("kin", F.xxhash64(own_words)), "toxic-sample")


def seeded() -> Lexicon:
    """The lexicon of the seeds alone."""
    words: dict[str, tuple[str, float]] = {w: ("INS", SEED_STRENGTH) for w in INSULTS.split()}
    return Lexicon(words | {w: (tag, 0.0) for tag, own in SEEDS.items() for w in own.split()}, {})


def learn_terms(rows: DataFrame) -> Lexicon:
    """Seeds, and the insult arcs that the sample shows; one text of each group of copies counts."""
    one = rows.groupBy("kin", "y").agg(F.min("id").alias("one_id"))
    rows = rows.join(one.withColumnRenamed("kin", "o_kin").withColumnRenamed("y", "o_y"), (F.col("kin") == F.col("o_kin")) & (F.col("y") == F.col("o_y")) & (F.col("id") == F.col("one_id")), "left_semi")
    total = rows.agg(F.coalesce(F.sum("y"), F.lit(0)), F.count(F.lit(1))).first()
    n_bad, n_good = total[0], total[1] - total[0]
    words = seeded().words
    own = F.filter(F.array_distinct(F.split(F.lower(F.col("t")), r"[^\p{L}]+")), lambda w: F.length(w) >= 3)
    each = rows.select("y", F.explode(own).alias("term")).groupBy("term").agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good"))
    each = materialize(each, "toxic-words")
    heads = each.select("bad", "good", "term", F.explode(F.array(*[F.when(F.length("term") > k, F.substring("term", 1, k)) for k in PREFIXES])).alias("head")).where("head is not null")
    heads = heads.groupBy("head").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.sum((F.col("bad") > 0).cast("int")).alias("kinds"))
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1.0)) - F.log((F.col("good") + 0.5) / (n_good + 1.0))

    def best(df: DataFrame, name: str, support: int) -> list:
        sure = df.where((F.col("bad") >= support) & (F.col("bad") >= PRECISION * (F.col("bad") + F.col("good")))).withColumn("odds", odds).where(F.col("odds") >= LOG_ODDS)
        return sure.orderBy(F.col("odds").desc(), name).limit(MAX_TERMS).collect()

    support = max(SUPPORT, round(0.003 * n_bad))
    strength = lambda r: float(min(1.0, r["odds"] / 6))
    for r in best(each, "term", support):
        words.setdefault(r["term"], ("INS", strength(r)))
    heads = best(heads.where("kinds >= 3"), "head", max(5, 2 * support))
    prefixes: dict[str, float] = {}
    for r in sorted(heads, key=lambda r: (len(r["head"]), r["head"])):
        if not any(r["head"][:k] in prefixes for k in PREFIXES):
            prefixes[r["head"]] = strength(r)
    return Lexicon(words, prefixes)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", max_rows: int = MAX_ROWS, seed: int = 5,
) -> Model:
    """Learns arcs and weights from labelled rows outside the held-out fifth, about max_rows of them at most, by seed.

    Where labels name one class alone, or none, nothing tells them apart: seeds and priors stand.
    """
    rows = sample(docs, labels, id_col, text_col, label_col, max_rows, seed)
    if rows.select("y").distinct().count() < 2:
        return Model(seeded(), PRIOR.copy())
    lexicon = learn_terms(rows)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t, shared.value).astype(np.float64).tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), b.column(1)], ["x", "y"])

    found = rows.select("t", "y").mapInArrow(run, "x binary, y int").groupBy("x", "y").count().collect()
    found.sort(key=lambda r: (r["x"], r["y"]))
    x = np.array([np.frombuffer(r["x"]) for r in found])
    return Model(lexicon, fit_weights(x, np.array([r["y"] for r in found], float), np.array([r["count"] for r in found], float)))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, held_out, score and predicted (1 from 0.5 on).

    Null and empty texts get the score of a text without tags. Whole texts are read; repeated rows
    repeat; only the two named columns are read, so other names can't clash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [shared.value.score(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], [id_col, "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), in_fifth(F.col(id_col)).alias("held_out"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"`{id_col}` long, held_out boolean, score double, predicted int")
