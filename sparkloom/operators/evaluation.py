"""From predictions to metrics, rankings and the promotion decision."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType
from pyspark.sql.window import Window

from sparkloom.functions import text as T
from sparkloom.operators import raw
from sparkloom.operators.sandbox import SandboxLimits, run_tests
from sparkloom.storage import materialize

#: Checkpoints that one evaluation compares.
MAX_CHECKPOINTS = 1000
METRICS = ("functional_pass", "contract_pass", "format_valid", "timeout", "truncated", "test_fraction", "repetition", "generated_tokens", "ended_with_eos")
#: Points that ratings need in total and per criterion, and the sizes of the two sets.
MIN_TOTAL, MIN_CORRECT, MIN_FOLLOW, MIN_EXPLAIN = 84, 37, 29, 17
HIDDEN_TASKS, REGRESSION_TASKS, MIN_GAIN, MAX_FAMILY_LOSS = 33, 13, 3, 1


def require_unique(df: DataFrame, *keys: str) -> None:
    """Raises with one key that occurs twice."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate key {dict(zip(keys, twice[0][:-1], strict=True))}")


def match(predictions: DataFrame, tasks: DataFrame, key: str = "id") -> DataFrame:
    """Predictions with their task's columns; raises on a prediction without a task."""
    lost = predictions.join(tasks.select(key), key, "left_anti").limit(1).collect()
    if lost:
        raise ValueError(f"unknown task {lost[0][key]}")
    return predictions.join(tasks, key)


def missing(evaluated: DataFrame, tasks: DataFrame, key: str = "id") -> DataFrame:
    """(checkpoint, key) without an evaluation: every checkpoint owes every task. Raises beyond MAX_CHECKPOINTS checkpoints."""
    names = evaluated.select("checkpoint").distinct().limit(MAX_CHECKPOINTS + 1).collect()
    if len(names) > MAX_CHECKPOINTS:
        raise ValueError(f"more than {MAX_CHECKPOINTS} checkpoints")
    every = F.array(*[F.lit(r["checkpoint"]) for r in names]).cast(ArrayType(evaluated.schema["checkpoint"].dataType))
    owed = tasks.select(key).distinct().select(F.explode(every).alias("checkpoint"), key)
    return owed.join(evaluated.select("checkpoint", key), ["checkpoint", key], "left_anti")


def test_list(task: Column, *keys: str) -> Column:
    """The tests of a task (a variant): of the first key that it or, where it has none, its `evaluation` has.

    One text is a list of one; of objects their code or test counts; blank ones are left out.
    """
    own = raw.fields(task)
    inner = raw.fields(F.try_element_at(own, F.lit("evaluation")))
    there = lambda fields: F.coalesce(*[F.try_element_at(fields, F.lit(k)) for k in keys])
    found = there(own)
    found = F.when(found.isNull() | raw.is_kind(found, "VOID"), there(inner)).otherwise(found)
    listed = F.when(raw.is_kind(found, "STRING"), F.array(found)).otherwise(raw.items(found))

    def code(v: Column) -> Column:
        part = raw.first(raw.fields(v), ("code", "test"))
        return F.when(raw.is_kind(v, "STRING"), raw.shown(v)).when(raw.is_kind(part, "STRING"), raw.shown(part))

    tests = F.filter(F.transform(listed, lambda v: T.strip(code(v))), lambda t: t.isNotNull() & (t != ""))
    return F.coalesce(tests, F.array().cast("array<string>"))


def parse_losses(given: list[str]) -> dict[str, float]:
    """Losses of checkpoints from arguments like name=0.5; the last = parts them, and a loss is a number from 0 on."""
    out = {}
    for argument in given:
        name, sign, value = argument.rpartition("=")
        loss = float(value) if sign and name else math.nan
        if not 0 <= loss < math.inf:
            raise ValueError(f"{argument!r} is no CHECKPOINT=LOSS")
        out[name] = loss
    return out


def evaluate(predictions: DataFrame, tasks: DataFrame, limits: SandboxLimits = SandboxLimits(), partitions: int = 0) -> DataFrame:
    """One row of metrics per prediction (checkpoint, id, response, truncated, finish_reason, generated_tokens, max_new_tokens, ended_with_eos).

    tasks: id, family, hidden_tests and contract_tests (arrays; without contract tests the hidden ones
    count). A reply without a valid block runs nothing. Equal pairs of code and test run once.
    """
    require_unique(tasks, "id")
    require_unique(predictions, "checkpoint", "id")
    if not tasks.where("coalesce(size(hidden_tests), 0) <= 0").isEmpty():
        raise ValueError("a task has no hidden tests")
    if not predictions.where("response is null").isEmpty():
        raise ValueError("a prediction has no response")
    own = match(predictions, tasks.select("id", "family", "hidden_tests", "contract_tests"))
    contract = F.when(F.coalesce(F.size("contract_tests"), F.lit(0)) > 0, F.col("contract_tests")).otherwise(F.col("hidden_tests"))
    own = own.withColumn("block", T.explained_block(F.col("response"))).withColumn("contract_tests", contract)
    own = materialize(own, "predictions")
    each = own.where("block.valid").select("checkpoint", "id", F.col("block.code").alias("code"), F.explode(F.concat(F.transform("hidden_tests", lambda t: F.struct(F.lit("hidden").alias("set"), t.alias("test"))), F.transform("contract_tests", lambda t: F.struct(F.lit("contract").alias("set"), t.alias("test"))))).alias("x"))
    ran = run_tests(each.select("checkpoint", "id", "code", "x.set", "x.test"), limits, partitions)
    of = lambda name: F.coalesce(F.sum(((F.col("set") == name) & (F.col("status") == "passed")).cast("bigint")), F.lit(0))
    sums = ran.groupBy("checkpoint", "id").agg(of("hidden").alias("hidden_passed"), of("contract").alias("contract_passed"), F.max(F.col("status") == "timeout").alias("timed_out"), F.max(F.col("status") == "rejected").alias("rejected"))
    rows = own.join(sums, ["checkpoint", "id"], "left")
    no = F.lit(False)
    timeout, rejected = F.coalesce("timed_out", no), F.coalesce("rejected", no)
    valid = F.col("block.valid") & ~rejected
    cut = T.is_truncated(F.col("truncated"), F.col("finish_reason"), F.col("generated_tokens"), F.col("max_new_tokens"), F.col("ended_with_eos"))
    hidden, contract = F.coalesce("hidden_passed", F.lit(0)), F.coalesce("contract_passed", F.lit(0))
    return rows.select(
        "checkpoint", "id", F.coalesce("family", F.lit("uncategorized")).alias("family"),
        (valid & (hidden == F.size("hidden_tests")) & ~timeout & ~cut).alias("functional_pass"),
        (hidden / F.size("hidden_tests")).alias("test_fraction"), (contract / F.size("contract_tests")).alias("contract_pass"),
        valid.alias("format_valid"), F.when(rejected, "sandbox_rejected").otherwise(F.col("block.reason")).alias("format_reason"),
        timeout.alias("timeout"), cut.alias("truncated"), T.repetition_fraction(F.col("response")).alias("repetition"), "generated_tokens", F.coalesce("ended_with_eos", no).alias("ended_with_eos"),
        F.sha2("response", 256).alias("response_sha256"), F.sha2(F.col("block.code"), 256).alias("code_sha256"),
    )


def aggregate(evaluated: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Means of the metrics per checkpoint (family null) and per checkpoint and family, in one pass."""
    own = evaluated.select("checkpoint", "family", *metrics)
    cubed = own.groupingSets([("checkpoint",), ("checkpoint", "family")], "checkpoint", "family")
    return cubed.agg(F.count(F.lit(1)).alias("tasks"), *[F.avg(F.col(m).cast("double")).alias(m) for m in metrics])


def weighted_score(weights: dict[str, float], penalties: dict[str, float]) -> Column:
    """Weighted sum less penalties; null where a metric is missing."""
    out = F.lit(0.0)
    for name, w in weights.items():
        out = out + F.col(name) * F.lit(w)
    for name, w in penalties.items():
        out = out - F.col(name) * F.lit(w)
    return out


def rank_by_score(reports: DataFrame, weights: dict[str, float], penalties: dict[str, float]) -> DataFrame:
    """Reports with score and place, best first, ties by checkpoint; raises where a metric is missing."""
    scored = reports.withColumn("score", weighted_score(weights, penalties))
    bad = scored.where("score is null").limit(1).collect()
    if bad:
        raise ValueError(f"checkpoint {bad[0]['checkpoint']} lacks a metric")
    return scored.withColumn("place", F.row_number().over(Window.orderBy(F.col("score").desc(), "checkpoint")))


def rank_models(models: DataFrame, losses: DataFrame | None = None) -> DataFrame:
    """Models with place: most passes, contracts and valid formats, fewest timeouts and cuts, lowest loss (none last), name."""
    rows = models if losses is None else models.join(losses, "checkpoint", "left")
    rows = rows if "eval_loss" in rows.columns else rows.withColumn("eval_loss", F.lit(None).cast("double"))
    order = [F.col("functional_pass").desc(), F.col("contract_pass").desc(), F.col("format_valid").desc(), (F.col("timeout") + F.col("truncated")).asc(), F.col("eval_loss").asc_nulls_last(), F.col("checkpoint").asc()]
    return rows.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def rating_totals(ratings: DataFrame, mapping: DataFrame) -> DataFrame:
    """Totals per identity. ratings: id, scores map<label, struct<correctness, instruction, explanation>>; mapping: id, labels map<label, identity>."""
    require_unique(ratings, "id")
    require_unique(mapping, "id")
    each = ratings.select("id", F.explode("scores").alias("label", "s")).select("id", "label", "s.*")
    wrong = each.where("not (correctness between 0 and 5 and instruction between 0 and 5 and explanation between 0 and 5) or correctness is null or instruction is null or explanation is null").limit(1).collect()
    if wrong:
        raise ValueError(f"rating of {wrong[0]['id']} is not a whole number from 0 to 5")
    who = mapping.select("id", F.explode("labels").alias("label", "identity"))
    lost = each.join(who, ["id", "label"], "left_anti").limit(1).collect()
    if lost:
        raise ValueError(f"no identity for {lost[0]['id']} {lost[0]['label']}")
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("correctness", "instruction", "explanation")]
    total = F.sum(F.col("correctness") + F.col("instruction") + F.col("explanation")).cast("bigint").alias("total")
    return each.join(who, ["id", "label"]).groupBy("identity").agg(F.count(F.lit(1)).alias("tasks"), *sums, total)


def promotion(models: DataFrame, ratings: DataFrame, candidate: str, champion: str, base: str, rated_candidate: str | None = None, rated_base: str | None = None) -> DataFrame:
    """One row of boolean checks and their conjunction.

    models: checkpoint, family (null: overall), tasks, passes, contract_pass, format_valid. ratings: the
    output of rating_totals. An identity that is missing raises: that is no failed check.
    """
    names = {r["checkpoint"] for r in models.where(F.col("checkpoint").isin(candidate, champion)).select("checkpoint").distinct().collect()}
    rated_candidate, rated_base = rated_candidate or candidate, rated_base or base
    rated = {r["identity"] for r in ratings.where(F.col("identity").isin(rated_candidate, rated_base)).select("identity").collect()}
    lacking = ({candidate, champion} - names) | ({rated_candidate, rated_base} - rated)
    if lacking:
        raise ValueError(f"no results for {sorted(lacking)}")
    cols = ("tasks", "passes", "contract_pass", "format_valid")
    overall = lambda who, p: models.where((F.col("checkpoint") == who) & F.col("family").isNull()).select(*[F.col(c).alias(p + c) for c in cols])
    family = lambda who, p: models.where((F.col("checkpoint") == who) & F.col("family").isNotNull()).select("family", F.col("passes").alias(p))
    drops = family(candidate, "c").join(family(champion, "h"), "family", "full_outer").select((F.coalesce("c", F.lit(0)) - F.coalesce("h", F.lit(0))).alias("delta"))
    worst = drops.agg(F.coalesce(F.min("delta"), F.lit(0)).alias("worst_family"))
    rate = lambda who, p: ratings.where(F.col("identity") == who).select(*[F.col(c).alias(p + c) for c in ("tasks", "correctness", "instruction", "explanation", "total")])
    row = overall(candidate, "c_")
    for other in (overall(champion, "h_"), worst, rate(rated_candidate, "rc_"), rate(rated_base, "rb_")):
        row = row.join(F.broadcast(other), F.lit(True))
    checks = {
        "all_hidden_tasks": (F.col("c_tasks") == HIDDEN_TASKS) & (F.col("h_tasks") == HIDDEN_TASKS),
        "more_passes": F.col("c_passes") - F.col("h_passes") >= MIN_GAIN,
        "contract_not_worse": F.col("c_contract_pass") >= F.col("h_contract_pass"),
        "format_not_worse": F.col("c_format_valid") >= F.col("h_format_valid"),
        "no_family_lost": F.col("worst_family") >= -MAX_FAMILY_LOSS,
        "all_regression_tasks": (F.col("rc_tasks") == REGRESSION_TASKS) & (F.col("rb_tasks") == REGRESSION_TASKS),
        "total": F.col("rc_total") >= MIN_TOTAL,
        "correctness": F.col("rc_correctness") >= MIN_CORRECT,
        "instruction": F.col("rc_instruction") >= MIN_FOLLOW,
        "explanation": F.col("rc_explanation") >= MIN_EXPLAIN,
        "beats_base": F.col("rc_total") > F.col("rb_total"),
    }
    checked = row.select(*[c.alias(n) for n, c in checks.items()])
    every = F.lit(True)
    for n in checks:
        every = every & F.col(n)
    return checked.withColumn("promote", every)


def blind(results: DataFrame, seed: int = 42, item: str = "id", variant: str = "variant") -> DataFrame:
    """results with a label (A, B, ...) per item, in hash order: the same for any partitioning."""
    h = F.sha2(F.concat_ws("\x1f", F.lit(str(seed)), F.col(item).cast("string"), F.col(variant).cast("string")), 256)
    k = F.row_number().over(Window.partitionBy(item).orderBy(h, variant))
    return results.withColumn("label", F.char(k.cast("bigint") + 64))


def rating_template(blinded: DataFrame, item: str = "id") -> DataFrame:
    """One row per item with an empty rating for each label."""
    empty = F.struct(*[F.lit(None).cast("int").alias(c) for c in ("correctness", "instruction", "explanation")])
    return blinded.groupBy(item).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", empty.alias("s"))))).alias("scores"))


def rubric(blinded: DataFrame, item: str = "id", title: str = "title", prompt: str = "prompt", answer: str = "answer") -> DataFrame:
    """(item, markdown): the sheet on which each item is rated, its answers under their labels and a table to fill in."""
    parts = F.array_sort(F.collect_list(F.struct("label", F.col(answer).alias("answer"))))
    own = blinded.groupBy(item).agg(F.min(title).alias("title"), F.min(prompt).alias("prompt"), parts.alias("parts"))
    answers = F.array_join(F.transform("parts", lambda p: F.concat(F.lit("### Answer "), p["label"], F.lit("\n\n"), p["answer"], F.lit("\n\n"))), "")
    lines = F.array_join(F.transform("parts", lambda p: F.concat(F.lit("| "), p["label"], F.lit(" |  |  |  |\n"))), "")
    head = F.lit("| Answer | Correctness (0-5) | Instructions (0-5) | Explanation (0-5) |\n|---|---:|---:|---:|\n")
    sheet = F.concat(F.lit("## "), "title", F.lit(" (`"), F.col(item).cast("string"), F.lit("`)\n\n### Prompt\n\n"), "prompt", F.lit("\n\n"), answers, head, lines)
    return own.select(item, sheet.alias("markdown"))


def packed_steps(tokens: Column, length: int, batch: int, accumulation: int, epochs: float) -> Column:
    """Optimizer steps over packed sequences."""
    sequences = F.ceil(tokens / length)
    return F.ceil(sequences * epochs / (batch * accumulation)).cast("bigint")


def step_preflight(train: DataFrame, reported: int, length: int, batch: int, accumulation: int, epochs: float, least: int, most: int) -> dict[str, int]:
    """Recounts the tokens of a train table against the report and checks the number of steps."""
    row = train.agg(F.coalesce(F.sum("num_tokens"), F.lit(0)).alias("t")).select("t", packed_steps(F.col("t"), length, batch, accumulation, epochs).alias("s")).first()
    if row["t"] != reported:
        raise ValueError(f"the table holds {row['t']} tokens, the report says {reported}")
    if not least <= row["s"] <= most:
        raise ValueError(f"{row['s']} optimizer steps, expected {least} to {most}")
    return {"tokens": row["t"], "steps": row["s"]}
