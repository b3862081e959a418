"""Published and replayed rows, verification, and evaluation from end to end."""

import json

from pyspark.sql import functions as F

from sparkloom.operators import evaluation, external, messages, quality

CODE = "Words.\n```python\ndef f(x):\n    return x + 1\n```"
GOOD = {"average_test_score": 1.0, "tests_execution_status": "['pass', 'Pass']", "unit_tests": "['assert f(1) == 2', 'assert f(0) == 1']", "llm_judgement": json.dumps({c: {"score": 5, "justification": "it adds ```x``` one"} for c in external.CRITERIA}), "input": "Add one to a number.", "output": CODE}


def published(spark, *changes, target=10_000):
    rows = [(k, f"r{k}", *(GOOD | c).values()) for k, c in enumerate(changes)]
    df = spark.createDataFrame(rows, "seq long, id string, average_test_score double, tests_execution_status string, unit_tests string, llm_judgement string, input string, output string")
    tasks = spark.createDataFrame([("e", "t", "Count all the words of a text and give the total as a number")], "id string, template_id string, prompt string")
    return {r["seq"]: r for r in external.published(df, tasks, target, "lab/rows", "v1").collect()}


def test_published_rows_are_filtered_and_run_again(spark):
    low = json.dumps({c: {"score": 4, "justification": "x"} for c in external.CRITERIA})
    got = published(spark, {}, {"average_test_score": 0.9}, {"tests_execution_status": "['pass', 'fail']"}, {"unit_tests": "['assert f(1) == 2']"}, {"llm_judgement": low}, {"output": "no block"}, {"input": " "}, {"unit_tests": "['assert f(1) == 3', 'assert f(0) == 1']"}, {"unit_tests": "not a list"}, {"output": "```python\nimport os\n```"})
    assert [got[k]["reject_reason"] for k in range(10)] == [None, "score", "published_tests", "test_count", "judgement", "code_block", "input", "rerun_failed", "tests", "rerun_rejected"]
    assert got[0]["verified"] and got[0]["messages"][1]["content"].startswith("it adds one") and got[0]["num_tokens"] > 0


def test_published_rows_stop_at_the_target(spark):
    got = published(spark, {}, {"input": "Another question."}, {"input": "A third one."}, target=1)
    assert [got[k]["reject_reason"] for k in range(3)] == [None, "not_needed", "not_needed"]


def test_replay(spark):
    say = lambda *t: [dict(role=r, content=c) for r, c in t]
    rows = [("a", "s", "MIT", None, say(("user", "q"), ("assistant", "<think>x</think>yes"))), ("b", "s", None, "g", say(("user", "q"), ("assistant", "<think>x"))), ("c", "known", None, None, say(("user", "q"), ("assistant", "a"))), ("d", "s", "proprietary", None, say(("user", "q"), ("assistant", "a"))), ("e", "s", "mit", None, say(("assistant", "a")))]
    df = spark.createDataFrame(rows, f"id string, source string, license string, group_id string, messages {messages.MESSAGES}")
    got = {r["source_id"]: r for r in external.replay(df, {"known": "cc-by-4.0"}, "v").collect()}
    assert {k: r["reject_reason"] for k, r in got.items()} == {"a": None, "b": "license", "c": None, "d": "license", "e": "missing_user"}
    assert got["a"]["messages"][1]["content"] == "yes" and got["a"]["group_id"] == "replay:a"


def test_row_success_and_verification(spark):
    df = spark.createDataFrame([(None, None, None), (False, 1.0, "yes"), (None, 2.0, None), (None, 0.0, " Passed "), (True, 0.0, "no")], "f boolean, n double, w string")
    got = [r["s"] for r in df.select(quality.row_success([("flag", F.col("f")), ("number", F.col("n")), ("word", F.col("w"))]).alias("s")).collect()]
    assert got == [False, False, True, True, True]
    first = df.select(quality.row_success([("number", F.col("n")), ("flag", F.col("f"))]).alias("s")).collect()
    assert first[1]["s"] is True
    rows = spark.createDataFrame([(("passed", "x"), "lab", False), (("passed", None), "lab", False), (None, None, True), (("failed", "y"), None, True)], "e struct<status:string,sha256:string>, l string, s boolean")
    out = [r["v"] for r in rows.select(quality.verification(F.col("e"), F.col("l"), F.col("s"), F.lit("fall")).alias("v")).collect()]
    assert [v["verified"] for v in out] == [True, False, True, True]
    assert out[2]["level"] == "source_reported_success" and out[2]["evidence"]["sha256"] == "fall" and out[3]["evidence"]["sha256"] == "y"


def test_evaluate_end_to_end(spark):
    tasks = spark.createDataFrame([("t1", "fam", ["assert f(1) == 2", "assert f(2) == 3"], ["assert f(0) == 1"]), ("t2", None, ["assert f(1) == 3"], [])], "id string, family string, hidden_tests array<string>, contract_tests array<string>")
    rows = [("a", "t1", CODE, None, "stop", 5, 50, True), ("a", "t2", CODE, None, "stop", 5, 50, True), ("b", "t1", CODE, None, "length", 50, 50, False), ("b", "t2", "no code", None, None, 5, 50, True), ("c", "t1", "x\n```python\nimport os\n```", None, None, 5, 50, True)]
    preds = spark.createDataFrame(rows, "checkpoint string, id string, response string, truncated boolean, finish_reason string, generated_tokens long, max_new_tokens long, ended_with_eos boolean")
    got = {(r["checkpoint"], r["id"]): r for r in evaluation.evaluate(preds, tasks).collect()}
    assert got["a", "t1"]["functional_pass"] and got["a", "t1"]["test_fraction"] == 1 and got["a", "t1"]["contract_pass"] == 1
    assert not got["a", "t2"]["functional_pass"] and got["a", "t2"]["contract_pass"] == 0 and got["a", "t2"]["family"] == "uncategorized"
    assert got["b", "t1"]["truncated"] and not got["b", "t1"]["functional_pass"]
    assert got["b", "t2"]["format_reason"] == "fence_count" and got["c", "t1"]["format_reason"] == "sandbox_rejected" and not got["c", "t1"]["format_valid"]
    assert [tuple(r) for r in evaluation.missing(evaluation.evaluate(preds, tasks), tasks).collect()] == [("c", "t2")]
