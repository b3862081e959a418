"""Preparation of a stage: candidates in, train and validation out, gates in between; nothing is written that fails a gate."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.functions.hashing import hash_unit, stable_hash
from sparkloom.operators import messages, mixing, quality, split
from sparkloom.plans import config as C
from sparkloom.sources import jsonl
from sparkloom.storage import delete, materialize


class GateError(RuntimeError):
    """A gate that a prepared stage fails."""


@dataclass
class Prepared:
    train: DataFrame
    validation: DataFrame
    report: dict[str, Any]
    failed: list[str] = field(default_factory=list)


def build_candidates(rows: DataFrame, settings: dict[str, Any], seed: int = 42, counter: messages.Counter = messages.Counter()) -> DataFrame:
    """Rows (source, category, license, source_id, group_key, messages, verified and optional evidence) as candidates with reject_reason.

    Read where they are there, as raw.from_raw() and raw.mark_holdout() make them: source_key (else source),
    empty_response, holdout, patch and patch_needed. One row per accepted segment and one per rejected row.
    Everything is row-local: no shuffle.
    """
    limits = quality.Limits(max_tool_messages=settings["max_tool_messages"], max_run=settings["max_repeated_message_run"], max_assistant_chars=settings["max_assistant_chars"], min_tokens=settings["min_tokens"], max_tokens=settings["max_seq_length"])
    m, there = F.col("m"), set(rows.columns)
    source = F.col("source_key" if "source_key" in there else "source")
    rows = rows.withColumn("m", messages.with_system(F.col("messages")))
    secret = quality.has_secret(m)
    rows = rows.withColumn("secret", secret).withColumn("m", messages.sanitize(m, settings["max_tool_output_chars"]))
    given = {k: F.col(k) for k in ("holdout", "patch", "patch_needed") if k in there}
    reason = quality.reject_reason(m, limits, verified=F.col("verified") if settings.get("successful_only") else None, **given)
    reason = F.when(F.col("secret"), "secret").otherwise(reason)
    if "empty_response" in there:
        reason = F.when(F.col("empty_response"), "empty_response").otherwise(reason)
    rows = rows.withColumn("reject_reason", reason).withColumn("counted", counter.each(m))
    rows = rows.withColumn("cut", F.when(F.col("reject_reason").isNull(), messages.segments(m, settings["max_seq_length"], F.col("counted"))))
    rows = rows.withColumn("reject_reason", F.when(F.col("reject_reason").isNull() & (F.size("cut") == 0), "too_long").otherwise(F.col("reject_reason")))
    key = lambda i: stable_hash(source, F.col("source_id"), i)
    share = settings.get("direct_fraction", {})
    fractions = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in share.items() for x in p]), F.col("category")), F.lit(0.0)) if share else F.lit(0.0)
    rows = rows.withColumn("cut", F.transform("cut", lambda s, i: F.when(hash_unit(key(i)) < fractions, direct_or_same(s)).otherwise(s)))
    rows = rows.withColumn("counted", counter.lists(F.col("cut")))
    chars = lambda s: F.aggregate(quality.contents(s, "assistant"), F.lit(0), lambda a, c: a + F.length(c))
    fits = lambda s, n: (n >= limits.min_tokens) & (n <= limits.max_tokens) & quality.replies_reason(s, limits).isNull() & (chars(s) <= limits.max_assistant_chars)
    numbered = F.transform("cut", lambda s, i: F.struct(i.alias("segment"), s.alias("messages")))
    each = F.zip_with(numbered, F.col("counted"), lambda s, n: F.struct(s["segment"].alias("segment"), s["messages"].alias("messages"), n.alias("n"), fits(s["messages"], n).alias("ok")))
    rows = rows.withColumn("cut", F.filter(each, lambda s: s["ok"]))
    rows = rows.withColumn("reject_reason", F.when(F.col("reject_reason").isNull() & (F.size("cut") == 0), "length_filter").otherwise(F.col("reject_reason")))
    each = rows.drop("messages", "m", "secret", "counted").withColumn("s", F.explode_outer("cut")).drop("cut")
    each = each.withColumn("messages", F.col("s.messages")).withColumn("segment", F.col("s.segment")).withColumn("num_tokens", F.col("s.n")).drop("s")
    made = F.col("messages").isNotNull()
    each = each.withColumn("fingerprint", F.when(made, T.fingerprint(F.col("messages")))).withColumn("near_fingerprint", F.when(made, T.near_fingerprint(F.col("messages"))))
    each = each.withColumn("id", stable_hash(source, F.col("source_id"), F.col("segment"), F.col("fingerprint")))
    each = each.withColumn("group_id", F.concat_ws(":", source, F.coalesce("group_key", "source_id")))
    return each.withColumn("reasoning_band", F.when(made, T.reasoning_band(F.col("messages"), counter.text)))


def direct_or_same(s: Column) -> Column:
    """Messages without thinking, if an assistant message is left."""
    plain = messages.strip_thinking(s)
    return F.when(F.exists(plain, lambda m: m["role"] == "assistant"), plain).otherwise(s)


def gates(report: dict[str, Any], settings: dict[str, Any]) -> list[str]:
    """Names of the gates that a report fails."""
    checks = {
        "train_not_empty": report["split"]["train_examples"] > 0,
        "no_leak": report["split"]["group_overlap"] == 0,
        "category_deviation": report["mix"]["max_category_deviation"] <= settings["max_category_deviation"],
        "reasoning_deviation": report["mix"]["max_reasoning_deviation"] <= settings["max_reasoning_deviation"],
        "token_budget": report["mix"]["budget_fraction"] >= settings["min_token_budget_fraction"],
    }
    return [name for name, ok in checks.items() if not ok]


def prepare(candidates: DataFrame, config: dict[str, Any], stage: str) -> Prepared:
    """Mix and split of a stage over accepted candidates (with a unique seq), with the report of its gates."""
    own, settings, seed = config["stages"][stage], C.data_of(config, stage), config.get("seed", 42)
    chosen, plan = mixing.mix_by_tokens(candidates, own["token_budget"], own["category_weights"], settings["reasoning_distribution"], seed, settings["max_examples_per_group"])
    chosen = materialize(chosen, "mixed")
    sides = materialize(split.split_by_group(chosen, settings["validation_fraction"], seed, settings["min_validation_examples"]), "split")
    records = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731  a few aggregate rows each
    by_category, by_band = (records(mixing.deviation(chosen, by, w)) for by, w in (("category", own["category_weights"]), ("reasoning_band", settings["reasoning_distribution"])))
    most = lambda rows: max((r["deviation"] if r["deviation"] is not None else 1.0 for r in rows), default=1.0)
    mix = records(mixing.scalars(chosen, own["token_budget"], plan.feasible))[0]
    mix |= {"category": by_category, "reasoning": by_band, "max_category_deviation": most(by_category), "max_reasoning_deviation": most(by_band)}
    mix["matrix"] = records(mixing.matrix(chosen, list(own["category_weights"]), list(settings["reasoning_distribution"])))
    report = {"stage": stage, "effective_data_config": settings, "mix": mix, "split": records(split.split_report(sides))[0]}
    rows = jsonl.training_rows
    return Prepared(rows(sides.where("split = 'train'")), rows(sides.where("split = 'validation'")), report, gates(report, settings))


def write(prepared: Prepared, folder: str) -> None:
    """The report, then both sides as JSON lines. If a gate failed, what an earlier run left there goes, and it raises: only the report stays."""
    spark = prepared.train.sparkSession
    jsonl.write_text(spark, f"{folder}/dataset_report.json", jsonl.readable(prepared.report | {"failed_gates": prepared.failed}))
    for side in ("train", "validation"):
        delete(spark, f"{folder}/{side}")
    if prepared.failed:
        raise GateError(", ".join(prepared.failed))
    jsonl.write_jsonl(prepared.train, f"{folder}/train")
    jsonl.write_jsonl(prepared.validation, f"{folder}/validation")


#: What a corpus must reach before training starts: tokens, deviation from its quotas, and optimizer steps.
CORPUS_TOKENS, CORPUS_DEVIATION, CORPUS_STEPS = 304_000, 0.05, (15, 25)


def corpus_gate(report: dict[str, Any], length: int = 2048, accumulation: int = 8) -> int:
    """The optimizer steps of a prepared corpus; raises with the first thing that it doesn't reach."""
    mix, tokens = report["mix"], report["split"]["train_tokens"]
    steps = math.ceil(math.ceil(tokens / length) / accumulation)
    if mix["selected_tokens"] < CORPUS_TOKENS:
        raise GateError(f"{mix['selected_tokens']} tokens, expected {CORPUS_TOKENS}")
    if mix["max_category_deviation"] > CORPUS_DEVIATION:
        raise GateError(f"deviates from its quotas by {mix['max_category_deviation']}")
    if not CORPUS_STEPS[0] <= steps <= CORPUS_STEPS[1]:
        raise GateError(f"{steps} steps, expected {CORPUS_STEPS[0]} to {CORPUS_STEPS[1]}")
    return steps


def first_rows(df: DataFrame, most: int | None, order: str) -> DataFrame:
    """The first rows of a training table in order; null takes all."""
    return df if most is None else df.orderBy(order).limit(most)
