"""Corrective candidates from outside: published coding rows that are run again, and rows of an earlier corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.functions.fixed import LICENSES
from sparkloom.functions.hashing import stable_hash
from sparkloom.operators import contamination, messages, mixing
from sparkloom.operators.running import running
from sparkloom.operators.sandbox import RUNNER, SandboxLimits, literal_list, run_tests

CRITERIA = ("requirement_conformance", "logical_correctness", "edge_case_consideration")
JUDGEMENT = ", ".join(f"{c} struct<score:double,justification:string>" for c in CRITERIA)
REQUEST = "\n\nExplain briefly, and give one Python code block that ends with asserts."


def published_reason() -> Column:
    """The first reason against a published row (after parsing), or null; codes are stable, so they can be counted."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    judged = F.lit(True)
    for c in CRITERIA:
        judged = judged & F.coalesce(F.col("judgement")[c]["score"] == 5, F.lit(False))
    return (
        F.when(no(F.col("average_test_score") == 1.0), "score")
        .when(no(F.forall("statuses", lambda s: F.lower(s) == "pass")), "published_tests")
        .when(no(F.forall("tests", lambda t: T.strip(t) != "")), "tests")
        .when(no(F.size("statuses") == F.size("tests")), "test_count")
        .when(~judged, "judgement")
        .when(F.col("code").isNull(), "code_block")
        .when(F.coalesce(F.col("explanation"), F.lit("")) == "", "explanation")
        .when(F.coalesce(T.strip(F.col("input")), F.lit("")) == "", "input")
    )


def candidate_columns(rows: DataFrame, source: str, revision: str, license_: str, category: str, level: str) -> DataFrame:
    """rows (source_id, messages, evidence columns, ...) with the columns that candidates of one source share."""
    rows = rows.withColumn("fingerprint", T.json_fingerprint(F.col("messages"))).withColumn("num_tokens", T.n_tokens(F.col("messages")))
    first_user = F.get(F.filter("messages", lambda m: m["role"] == "user"), F.lit(0))["content"]
    lit = {"source": source, "source_revision": revision, "license": license_, "category": category, "verification_level": level, "reasoning_band": "direct"}
    for name, value in lit.items():
        rows = rows.withColumn(name, F.lit(value)) if value is not None else rows
    rows = rows.withColumn("source_sha256", F.sha2("source", 256)).withColumn("revision_sha256", F.sha2("source_revision", 256))
    return rows.withColumn("near_fingerprint", F.sha2(T.normalized_prompt(first_user), 256)).withColumn("id", stable_hash(F.col("source"), F.col("source_id"), F.col("fingerprint")))


def published(rows: DataFrame, tasks: DataFrame, target: int, source: str, revision: str, license_: str = "cc-by-4.0", most_tokens: int = 2048, limits: SandboxLimits = SandboxLimits()) -> DataFrame:
    """Every row (seq, id, input, output, unit_tests, tests_execution_status, average_test_score, llm_judgement) as a candidate with reject_reason.

    Rows that pass on paper are run again; those that pass that, fit and resemble no task (id,
    template_id, prompt) are accepted in order of seq until the target is reached: not_needed after.
    """
    parsed = rows.withColumn("statuses", literal_list("tests_execution_status")).withColumn("tests", literal_list("unit_tests")).withColumn("judgement", F.from_json("llm_judgement", JUDGEMENT))
    parsed = parsed.withColumn("code", T.only_block(F.col("output"))).withColumn("explanation", T.short_explanation(T.strip(F.col("judgement.logical_correctness.justification"))))
    parsed = parsed.withColumn("reject_reason", published_reason()).withColumn("test", F.array_join(F.transform("tests", lambda t: T.strip(t)), "\n"))
    paper = parsed.where("reject_reason is null")
    ran = run_tests(paper.select("seq", "code", "test"), limits).select("seq", F.col("status"))
    parsed = parsed.join(ran, "seq", "left").withColumn("reject_reason", F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason")).when(F.col("status") != "passed", F.concat(F.lit("rerun_"), "status")))
    prompt = F.concat(T.strip(F.col("input")), F.lit(REQUEST))
    answer = F.concat("explanation", F.lit("\n\n```python\n"), T.strip(F.col("code")), F.lit("\n\n"), "test", F.lit("\n```"))
    parsed = parsed.withColumn("messages", F.array(messages.message("user", prompt), messages.message("assistant", answer))).withColumn("source_id", F.coalesce("id", F.sha2(prompt, 256))).withColumn("prompt", prompt)
    made = candidate_columns(parsed.drop("id"), source, revision, license_, "corrective_published", "local_public_tests")
    near = contamination.report(made.where("reject_reason is null").select(F.col("source_id").alias("id"), F.lit(None).cast("string").alias("template_id"), "prompt"), tasks).select(F.col("id").alias("c_id"), F.concat(F.lit("contaminated_"), "reason").alias("found"))
    made = made.join(near, F.col("source_id") == F.col("c_id"), "left").withColumn("reject_reason", F.coalesce("reject_reason", F.when(F.col("num_tokens") > most_tokens, "too_long"), "found")).drop("c_id", "found")
    made = made.withColumn("_own", F.when(F.col("reject_reason").isNull(), F.col("num_tokens")).otherwise(0)).withColumn("_all", F.lit(0))
    made = running(made, "_own", "seq", "_all").withColumn("reject_reason", F.when(F.col("_before") >= target, "not_needed").otherwise(F.col("reject_reason")))
    return made.select("seq", "id", F.concat_ws(":", "source", "source_id").alias("group_id"), "source", "source_id", "source_revision", "source_sha256", "revision_sha256", "license", "category", "reasoning_band", "verification_level", F.col("reject_reason").isNull().alias("verified"), F.lit(RUNNER).alias("runner_version"), F.sha2("code", 256).alias("code_sha256"), F.sha2("test", 256).alias("tests_sha256"), "num_tokens", "fingerprint", "near_fingerprint", "messages", "reject_reason")


def replay(rows: DataFrame, licenses: dict[str, str], revision: str, most_tokens: int = 2048) -> DataFrame:
    """Rows (id, source, license, group_id, messages) of an earlier corpus as candidates with reject_reason.

    Thinking goes, closed or not; a source without an admitted license, or a row without user or
    assistant, is rejected.
    """
    known = F.try_element_at(F.create_map(*[F.lit(x) for p in licenses.items() for x in p]), F.trim("source")) if licenses else F.lit(None).cast("string")
    rows = rows.withColumn("license", F.lower(F.trim(F.coalesce(F.nullif("license", F.lit("")), known)))).withColumn("messages", messages.strip_thinking(F.col("messages"), unclosed=True))
    has = lambda role: F.exists("messages", lambda m: m["role"] == role)
    reason = F.when(F.coalesce(F.trim("source"), F.lit("")) == "", "source").when(~F.coalesce(F.col("license").isin(*LICENSES), F.lit(False)), "license").when(~has("assistant"), "missing_assistant").when(~has("user"), "missing_user")
    made = candidate_columns(rows.withColumnRenamed("id", "source_id"), None, revision, None, "corrective_replay", "replay_champion")
    made = made.withColumn("reject_reason", reason).withColumn("reject_reason", F.coalesce("reject_reason", F.when(F.col("num_tokens") > most_tokens, "too_long")))
    return made.withColumn("group_id", F.coalesce("group_id", F.concat(F.lit("replay:"), "source_id"))).withColumn("data_sha256", F.col("fingerprint")).withColumn("verified", F.col("reject_reason").isNull())


def sample_until(rows: DataFrame, target: int, seed: int = 42) -> DataFrame:
    """Rows in hash order until the target is reached; raises if they don't reach it."""
    order = stable_hash(F.lit(seed), F.lit("replay"), F.col("id"))
    kept = mixing.take_until(rows, target, order)
    got = kept.agg(F.coalesce(F.sum("num_tokens"), F.lit(0))).first()[0]
    if got < target:
        raise ValueError(f"rows hold {got} of {target} tokens")
    return kept
