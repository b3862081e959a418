"""A generator of small coding contracts and evaluation tasks from a catalogue of families.

Each family has a task sentence, a right solution and its tests; archetypes ask for writing, repairing or
explaining the function. Rows are a function of their number, so any partitioning makes the same.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.functions import text as T
from sparkloom.functions.hashing import hash_int, stable_hash
from sparkloom.operators import messages, raw

ARCHETYPES = ("write", "repair", "explain")
LANGUAGES = ("en",) * 7 + ("es",) * 3
EVALUATION_NAMES = ("dev", "hidden_a", "hidden_b", "hidden_c")
MOST_ROUNDS = 100_000


@dataclass(frozen=True)
class Family:
    name: str
    task: str
    body: str
    wrong: str
    tests: tuple[str, ...]


def family(name: str, task: str, body: str, wrong: str, *tests: str) -> Family:
    return Family(name, task, body, wrong, tests)


FAMILIES = (
    family("clamp", "limits a number to a closed range", "(x, lo, hi):\n    return max(lo, min(hi, x))", "(x, lo, hi):\n    return min(lo, max(hi, x))", "{f}(5, 0, 3) == 3", "{f}(-1, 0, 3) == 0"),
    family("run_lengths", "turns a text into pairs of letter and run length", "(s):\n    out = []\n    for c in s:\n        if out and out[-1][0] == c:\n            out[-1] = (c, out[-1][1] + 1)\n        else:\n            out.append((c, 1))\n    return out", "(s):\n    return [(c, s.count(c)) for c in s]", "{f}('aab') == [('a', 2), ('b', 1)]", "{f}('') == []"),
    family("window_sums", "sums every window of k neighbours", "(a, k):\n    return [sum(a[i:i + k]) for i in range(len(a) - k + 1)]", "(a, k):\n    return [sum(a[i:i + k]) for i in range(len(a))]", "{f}([1, 2, 3], 2) == [3, 5]", "{f}([1], 2) == []"),
    family("stable_unique", "drops later repeats and keeps the order", "(a):\n    seen = set()\n    return [x for x in a if not (x in seen or seen.add(x))]", "(a):\n    return sorted(set(a))", "{f}([3, 1, 3]) == [3, 1]", "{f}([]) == []"),
    family("invert_map", "lists the keys of each value", "(d):\n    out = {}\n    for k, v in d.items():\n        out.setdefault(v, []).append(k)\n    return out", "(d):\n    return {v: [k] for k, v in d.items()}", "{f}({'a': 1, 'b': 1}) == {1: ['a', 'b']}"),
    family("digit_root", "adds the digits until one is left", "(n):\n    while n > 9:\n        n = sum(map(int, str(n)))\n    return n", "(n):\n    return sum(map(int, str(n)))", "{f}(99) == 9", "{f}(0) == 0"),
    family("merge_sorted", "merges two sorted lists", "(a, b):\n    out, i, j = [], 0, 0\n    while i < len(a) and j < len(b):\n        if a[i] <= b[j]:\n            out.append(a[i])\n            i += 1\n        else:\n            out.append(b[j])\n            j += 1\n    return out + a[i:] + b[j:]", "(a, b):\n    return a + b", "{f}([1, 4], [2, 3]) == [1, 2, 3, 4]"),
    family("balanced", "tells whether round and square brackets match", "(s):\n    open_, pair = [], {')': '(', ']': '['}\n    for c in s:\n        if c in '([':\n            open_.append(c)\n        elif c in pair and (not open_ or open_.pop() != pair[c]):\n            return False\n    return not open_", "(s):\n    return s.count('(') == s.count(')') and s.count('[') == s.count(']')", "{f}('([])')", "not {f}('([)]')"),
    family("chunks", "cuts a list into pieces of n", "(a, n):\n    return [a[i:i + n] for i in range(0, len(a), n)]", "(a, n):\n    return [a[i:i + n] for i in range(0, len(a) - n, n)]", "{f}([1, 2, 3], 2) == [[1, 2], [3]]"),
    family("transpose", "swaps rows and columns", "(m):\n    return [list(r) for r in zip(*m)]", "(m):\n    return [r[::-1] for r in m]", "{f}([[1, 2], [3, 4]]) == [[1, 3], [2, 4]]"),
    family("common_prefix", "finds the longest beginning that all texts share", "(words):\n    if not words:\n        return ''\n    lo, hi = min(words), max(words)\n    k = 0\n    while k < min(len(lo), len(hi)) and lo[k] == hi[k]:\n        k += 1\n    return lo[:k]", "(words):\n    return min(words) if words else ''", "{f}(['inner', 'inset']) == 'in'", "{f}([]) == ''"),
)


def catalogue(spark: SparkSession) -> DataFrame:
    """(k, family, task, body, wrong, tests): the families as a small dimension table."""
    return spark.createDataFrame([(k, f.name, f.task, f.body, f.wrong, list(f.tests)) for k, f in enumerate(FAMILIES)], "k int, family string, task string, body string, wrong string, tests array<string>")


def named(tests, name):
    return F.array_join(F.transform(tests, lambda t: F.concat(F.lit("assert "), F.replace(t, F.lit("{f}"), name))), "\n")


def contracts(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """n contracts (seq, id, family, archetype, language, name, prompt, code, tests), round-robin over families, then archetypes."""
    rows = spark.range(n).select(F.col("id").alias("seq")).withColumn("k", (F.col("seq") % len(FAMILIES)).cast("int"))
    rows = rows.join(F.broadcast(catalogue(spark)), "k")
    pick = lambda values, index: F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))
    archetype = pick(ARCHETYPES, F.floor(F.col("seq") / len(FAMILIES)) % len(ARCHETYPES))
    language = pick(LANGUAGES, hash_int(stable_hash(F.lit(seed), F.lit("language"), F.col("seq"))) % len(LANGUAGES))
    name = F.concat("family", F.format_string("_%04d", F.col("seq")))
    rows = rows.withColumn("archetype", archetype).withColumn("language", language).withColumn("name", name)
    ask = F.when(F.col("archetype") == "write", F.concat(F.lit("Write a function "), name, F.lit(" that "), "task", F.lit(".")))
    ask = ask.when(F.col("archetype") == "repair", F.concat(F.lit("This function should be one that "), "task", F.lit(" but is wrong. Repair it.\n```python\ndef "), name, "wrong", F.lit("\n```")))
    ask = ask.otherwise(F.concat(F.lit("Show and explain a function "), name, F.lit(" that "), "task", F.lit(".")))
    return rows.select("seq", stable_hash(F.lit(seed), F.lit("contract"), F.col("seq")).alias("id"), "family", "archetype", "language", "name", ask.alias("prompt"), F.concat(F.lit("def "), name, "body").alias("code"), named(F.col("tests"), name).alias("tests"))


def contracts_for(spark: SparkSession, tokens: int, count, seed: int = 42) -> DataFrame:
    """Contracts in order until their tokens (count: an expression over the columns) reach the target."""
    n = min(MOST_ROUNDS, max(1, tokens))
    ranked = contracts(spark, n, seed).withColumn("num_tokens", count)
    before = F.coalesce(F.sum("num_tokens").over(Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = ranked.withColumn("_before", before).where(F.col("_before") < tokens).drop("_before")
    got = kept.agg(F.coalesce(F.sum("num_tokens"), F.lit(0))).first()[0]
    if got < tokens:
        raise ValueError(f"{n} contracts hold {got} of {tokens} tokens")
    return kept


def evaluation_tasks(spark: SparkSession) -> DataFrame:
    """(id, family, template_id, split, prompt, name, public_tests, hidden_tests): of each family one task to develop on, three hidden."""
    rows = catalogue(spark).select("*", F.posexplode(F.array(*map(F.lit, EVALUATION_NAMES))).alias("i", "label"))
    name = F.concat_ws("_", F.lit("solve"), "family", "label")
    return rows.select(F.concat_ws("/", F.lit("eval"), "family", "label").alias("id"), "family", F.concat_ws("/", F.lit("template"), "family", "label").alias("template_id"), F.when(F.col("i") == 0, "dev").otherwise("hidden").alias("split"), F.concat(F.lit("Please implement "), name, F.lit(": it "), "task", F.lit(".")).alias("prompt"), name.alias("name"), named(F.slice("tests", 1, 1), name).alias("public_tests"), named(F.col("tests"), name).alias("hidden_tests"))


def task_messages(task: Column) -> Column:
    """The messages that a task (a variant) is asked with: its own, or its system text and prompt; null where it has neither."""
    own = raw.fields(task)
    at = lambda k: F.try_element_at(own, F.lit(k))
    given = F.transform(raw.items(at("messages")), lambda m: raw.message(raw.fields(m)))
    said = lambda k: F.when(raw.is_kind(at(k), "STRING"), F.when(T.strip(raw.shown(at(k))) != "", raw.shown(at(k))))
    system, prompt = said("system"), said("prompt")
    flat = F.filter(F.array(F.when(system.isNotNull(), messages.message("system", system)), messages.message("user", prompt)), lambda m: m.isNotNull())
    return F.when(F.size(given) > 0, given).when(prompt.isNotNull(), flat)


# How answers are generated.
DIRECT_TOKENS, THINKING_TOKENS, TOP_K = 512, 2048, 20
SAMPLING = {"thinking": {"temperature": 0.6, "top_p": 0.95}, "direct": {"temperature": 0.7, "top_p": 0.8}}


def generation_policy(decoding: str, mode: str | None = None, max_new_tokens: int | None = None) -> tuple[str, dict[str, Any]]:
    """The mode and the settings of a generation; deterministic decoding admits the direct mode and its length alone."""
    fixed = decoding == "deterministic"
    mode = mode or ("direct" if fixed else "thinking")
    length = (DIRECT_TOKENS if fixed else THINKING_TOKENS) if max_new_tokens is None else max_new_tokens
    if length <= 0 or fixed and (mode, length) != ("direct", DIRECT_TOKENS):
        raise ValueError(f"{decoding} decoding admits no {mode} mode with {length} tokens")
    how = {"do_sample": False, "num_beams": 1, "use_cache": True} if fixed else {"do_sample": True, "top_k": TOP_K, **SAMPLING[mode]}
    return mode, how | {"max_new_tokens": length}
