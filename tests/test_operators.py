"""Operators on small inputs, against plain Python where the order of rows decides."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import hashing as H
from sparkloom.functions import text as T
from sparkloom.plans import config, prepare
from sparkloom.operators import contamination, dedup, evaluation, generation, messages, mixing, quality, raw, running, sandbox, split


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("v")).first()["v"]


def talk(spark, *turns):
    return spark.createDataFrame([([dict(role=r, content=c) for r, c in turns],)], f"messages {messages.MESSAGES}")


@pytest.mark.parametrize("seed", range(4))
def test_two_key_dedup_equals_a_scan(spark, seed):
    rng = random.Random(seed)
    rows = [(i, f"f{rng.randrange(25)}", f"n{rng.randrange(25)}") for i in range(80)]
    seen_a, seen_b, want = set(), set(), []
    for i, a, b in rows:
        if a not in seen_a and b not in seen_b:
            seen_a.add(a)
            seen_b.add(b)
            want.append(i)
    df = spark.createDataFrame(rows, "seq long, fingerprint string, near_fingerprint string")
    assert sorted(r["seq"] for r in dedup.dedup_two_keys(df).collect()) == want


@pytest.mark.parametrize("scan", [0, 20, 200_000])
def test_two_key_dedup_takes_null_keys_and_chains(spark, scan, monkeypatch):
    monkeypatch.setattr(dedup, "SCAN_ROWS", scan)
    rows = [(1, "a", "x"), (2, "a", "y"), (3, None, None), (4, None, None), (5, "b", None), (6, None, "b"), (7, "c", "z")]
    rows += [(100 + k, f"f{(k + 1) // 2}", f"n{k // 2}") for k in range(40)]
    rng = random.Random(9)
    rows += [(1000 + k, rng.choice([None, "p", "q", "r"]), rng.choice([None, "s", "t", "u"])) for k in range(40)]
    seen_a, seen_b, want = set(), set(), []
    for i, a, b in rows:
        a, b = str(a), str(b if b is not None else a)
        if a not in seen_a and b not in seen_b:
            want.append(i)
            seen_a.add(a)
            seen_b.add(b)
    df = spark.createDataFrame(rows, "seq long, fingerprint string, near_fingerprint string")
    assert sorted(r["seq"] for r in dedup.dedup_two_keys(df).collect()) == want


def test_running_sums_and_takes_equal_a_plain_scan(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.randrange(1, 30)) for i in range(500)]
    df = spark.createDataFrame(rows, "seq long, source string, tokens long").repartition(7)
    got = {r["seq"]: r["_before"] for r in running.running(df, "tokens", "seq", "source").collect()}
    assert got == {i: sum(t for j, s, t in rows if s == source and j < i) for i, source, _ in rows}
    order = mixing.hash_order(1, "x", "seq")
    for budget in (0, 1, 100, 3000, 10**6):
        want, held = [], 0
        for r in df.withColumn("h", order).orderBy("h").collect():
            if held < budget:
                want.append(r["seq"])
            held += r["tokens"]
        assert sorted(r["seq"] for r in mixing.take_until(df, budget, order, "tokens").collect()) == sorted(want)
    assert dedup.source_stop(df.limit(0), 10).count() == 0


def test_later_row_stays_where_its_rival_fell(spark):
    df = spark.createDataFrame([(0, "f1", "n1"), (1, "f2", "n1"), (2, "f2", "n2")], "seq long, fingerprint string, near_fingerprint string")
    assert sorted(r["seq"] for r in dedup.dedup_two_keys(df).collect()) == [0, 2]


def test_collection_interleaves_caps_and_duplicates(spark):
    rows = [(0, "s", 0, "a", "a", "g", 10), (1, "s", 1, "b", "b", "g", 10), (2, "s", 2, "b", "b", "h", 10), (3, "s", 3, "c", "a", "h", 10), (4, "s", 4, "d", "d", "h", 10), (5, "s", 5, "e", "e", "k", 10), (6, "t", 0, "b", "x", "k", 5)]
    df = spark.createDataFrame(rows, "seq long, source string, row long, fp string, near string, grp string, tokens long")
    got = {r["seq"]: r["outcome"] for r in dedup.collect_in_order(df, {"s": 30}, 1).collect()}
    assert got == {0: "accepted", 1: "group_limit", 2: "accepted", 3: "near_duplicate", 4: "group_limit", 5: "accepted", 6: "duplicate"}


def test_collection_equals_a_plain_scan(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice("abc"), i // 2, f"f{rng.randrange(60)}", f"n{rng.randrange(50)}", f"g{rng.randrange(9)}", rng.randrange(1, 20)) for i in range(400)]
    exact, near, groups, taken, reading, want = set(), set(), {}, {}, {}, {}
    for i, source, row, f, n, g, tokens in rows:
        if reading.get(source) != row and taken.get(source, 0) >= 150:
            want[i] = "not_read"
            continue
        reading[source] = row
        want[i] = "duplicate" if f in exact else "near_duplicate" if n in near else "group_limit" if groups.get(g, 0) >= 4 else "accepted"
        if want[i] == "accepted":
            exact.add(f)
            near.add(n)
            groups[g] = groups.get(g, 0) + 1
            taken[source] = taken.get(source, 0) + tokens
    df = spark.createDataFrame(rows, "seq long, source string, row long, fp string, near string, grp string, tokens long")
    assert {r["seq"]: r["outcome"] for r in dedup.collect_in_order(df, dict.fromkeys("abc", 150), 4).collect()} == want


def test_allocation_solves_crossed_limits():
    used, total = mixing.allocate({("a", "x"): 10, ("a", "y"): 10, ("b", "x"): 10}, {"a": 10, "b": 10}, {"x": 10, "y": 10})
    assert total == 20 and used == {("a", "y"): 10, ("b", "x"): 10}


def test_plan_meets_targets_within_a_row():
    rng = random.Random(2)
    cells = {(r, c): [rng.randrange(20, 200) for _ in range(80)] for r in "ab" for c in "xyz"}
    plan = mixing.plan_mix(cells, 6000, {"a": 0.6, "b": 0.4}, {"x": 0.2, "y": 0.3, "z": 0.5})
    got = {k: sum(cells[k][:n]) for k, n in plan.prefix.items()}
    for r, goal in plan.targets[0].items():
        assert goal <= sum(v for k, v in got.items() if k[0] == r) < goal + 4 * 200
    assert plan.feasible == 6000


def test_repair_stops_at_full_bands():
    cells = {("a", "x"): [100] * 5, ("a", "y"): [100] * 5}
    plan = mixing.plan_mix(cells, 1000, {"a": 1.0}, {"x": 0.3, "y": 0.7})
    assert plan.prefix == {("a", "x"): 3, ("a", "y"): 5} and plan.feasible == 800


def test_split_never_leaks_nor_empties_train(spark):
    df = spark.createDataFrame([(i, f"g{i // 3}", 10) for i in range(30)], "id long, group_id string, num_tokens long")
    for fraction, least in ((0.0, 0), (0.3, 0), (0.05, 12), (0.99, 29), (0.0, 100)):
        rows = split.split_by_group(df, fraction, least and 7 or 42, least).collect()
        sides = {}
        for r in rows:
            sides.setdefault(r["group_id"], set()).add(r["split"])
        assert len(rows) == 30 and all(len(s) == 1 for s in sides.values())
        n_val = sum(r["split"] == "validation" for r in rows)
        assert n_val < 30 and n_val >= min(least, 27) - 3
    for bad in ((1.0, 0), (-0.1, 0), (0.1, -1)):
        with pytest.raises(ValueError):
            split.split_by_group(df, bad[0], 42, bad[1])


def sequential_segments(turns, most):
    cost = lambda ms: sum(len(c.split()) + 1 for _, c in ms)
    if cost(turns) <= most:
        return [turns]
    at = next((k for k, (r, _) in enumerate(turns) if r == "user"), None)
    if at is None:
        return []
    base = ([turns[0]] if turns[0][0] == "system" else []) + [turns[at]]
    out, now = [], list(base)
    for m in turns[at + 1 :]:
        if cost([*now, m]) <= most:
            now.append(m)
            continue
        if any(r == "assistant" for r, _ in now):
            out.append(now)
        now = [*base, m] if cost([*base, m]) <= most else list(base)
    return out + ([now] if any(r == "assistant" for r, _ in now) else [])


@pytest.mark.parametrize("seed", range(3))
def test_segments_equal_a_sequential_cut(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(40):
        turns = [(rng.choice(["user", "assistant", "tool"]), "w " * rng.randrange(1, 30)) for _ in range(rng.randrange(1, 12))]
        rows.append(([("system", "s s")] if rng.random() < 0.5 else []) + turns)
    df = spark.createDataFrame([(i, [dict(role=r, content=c.strip()) for r, c in t]) for i, t in enumerate(rows)], f"id long, messages {messages.MESSAGES}")
    got = {r["id"]: [[(m["role"], m["content"]) for m in s] for s in r["s"]] for r in df.select("id", messages.segments(F.col("messages"), 40).alias("s")).collect()}
    assert got == {i: sequential_segments([(r, c.strip()) for r, c in t], 40) for i, t in enumerate(rows)}


def test_reject_reasons_in_order(spark):
    reason = lambda *turns, **o: talk(spark, *turns).select(quality.reject_reason(F.col("messages"), **o).alias("r")).first()["r"]
    u, a = ("user", "hi"), ("assistant", "a fine answer")
    assert reason() == "missing_messages"
    assert reason(("user", "key sk-abcdefghijklmnop1234")) == "secret"
    assert reason(a) == "missing_user" and reason(u) == "missing_assistant"
    assert reason(u, a, *[("tool", f"t{i}") for i in range(49)]) == "tool_loop"
    assert reason(u, u, ("user", " HI "), a) == "repeated_messages"
    assert reason(u, ("assistant", "```py\nx")) == "unclosed_block" and reason(u, ("assistant", "<think>x")) == "unclosed_block"
    assert reason(u, ("assistant", "\n".join(["The same long line."] * 4))) == "repeated_lines"
    assert reason(u, ("assistant", "a b c d e f g h " * 8)) == "repeated_ngram"
    assert reason(u, ("assistant", "seen in HumanEval before")) == "benchmark_marker"
    assert reason(u, a, verified=F.lit(False)) == "not_verified" and reason(u, a, patch_needed=True) == "missing_patch"
    assert reason(u, ("assistant", "diff --git a b"), patch_needed=True) is None and reason(u, a, holdout=F.lit(True)) == "evaluation_holdout"
    assert reason(u, a) is None


def test_text_expressions(spark):
    v = F.col("v")
    assert one(spark, T.redact(v), v=" mail A.b@c.org from C:\\Users\\Bob\\x and /home/bob/y \x1b[31mred\x1b[0m ") == "mail <redacted_email> from C:\\Users\\<redacted_user>\\x and /home/<redacted_user>/y red"
    assert len(one(spark, T.cut_middle(v, 200), v="x" * 500)) < 200 and one(spark, T.cut_middle(v, 200), v="x" * 200) == "x" * 200
    assert one(spark, T.without_thinking(v), v="<think>a</think> b <think>c") == "b <think>c"
    assert one(spark, T.without_thinking(v, True), v="<think>a</think> b <think>c\n") == "b"
    assert one(spark, T.normalized_prompt(v), v="Call Foo_1 (x)!\n```py\ncode\n``` Done") == "call function x done"
    assert one(spark, T.normalized_prompt(v, True), v="STRASSE straße ﬁn") == "strasse strasse fin"
    assert one(spark, F.size(T.prompt_ngrams(v)), v="") == 0 and one(spark, F.size(T.prompt_ngrams(v)), v="a b") == 1 and one(spark, F.size(T.prompt_ngrams(v)), v="a b c d e f") == 2
    assert one(spark, T.jaccard(T.prompt_ngrams(v), T.prompt_ngrams(v)), v="") == 1.0
    assert one(spark, T.repetition_fraction(v), v="a b c") == 0 and one(spark, T.repetition_fraction(v), v="a b c d " * 2) == pytest.approx(1 / 5)


def test_fences(spark):
    block = lambda t: one(spark, T.explained_block(F.col("v")), v=t)
    good = block("Here it is:\n```python\nx = 1\n```")
    assert good["valid"] and good["code"] == "x = 1" and good["explanation"] == "Here it is:"
    assert block("```py\nx\n```")["reason"] == "missing_explanation" and block("a ```python\n\n``` b")["reason"] == "empty_code"
    assert block("no code")["reason"] == "fence_count" and block("a ```py\nx\n``` ```")["reason"] == "fence_count"
    assert one(spark, T.only_block(F.col("v")), v="```python\nx\n```") == "x\n" and one(spark, T.only_block(F.col("v")), v="```js\nx\n```") is None


def test_messages(spark):
    m = talk(spark, ("user", "q"), ("assistant", "<think>w w</think>a"), ("tool", "x" * 300))
    got = m.select(messages.with_system(F.col("messages")).alias("s"), messages.sanitize(F.col("messages"), 200).alias("c"), messages.strip_thinking(F.col("messages")).alias("t"), T.reasoning_band(F.col("messages")).alias("b"), messages.made_direct(F.col("messages"), H.stable_hash("k"), 1.0).alias("d")).first()
    assert got["s"][0]["role"] == "system" and len(got["c"][2]["content"]) < 200 and got["t"][1]["content"] == "a" and got["b"] == "short" and got["d"] == got["t"]
    assert one(spark, messages.full_content(F.col("v"), F.lit("why"), None, F.lit("sh")), v="so") == "[tool=sh]\n<think>why</think>\nso"
    calls = F.array(F.struct(F.lit("f").alias("name"), F.lit('{"a":1}').alias("arguments")), F.struct(F.lit("").alias("name"), F.lit("{}").alias("arguments")))
    assert one(spark, messages.tool_calls(calls), v="") == '<tool_call>\n{"arguments":{"a":1},"name":"f"}\n</tool_call>'


def test_hashes(spark):
    import hashlib
    import json

    assert one(spark, H.stable_hash(F.lit(1), F.col("v"), F.lit(None).cast("string")), v="ü") == hashlib.sha256("1\x1fü\x1fNone".encode()).hexdigest()
    turns = [("user", 'say "hi"\n'), ("assistant", "ü")]
    want = hashlib.sha256(json.dumps([{"role": r, "content": c} for r, c in turns], ensure_ascii=False, sort_keys=True).encode()).hexdigest()
    assert talk(spark, *turns).select(T.json_fingerprint(F.col("messages")).alias("h")).first()["h"] == want
    assert H.evidence_sha256({"a": "ü", "sha256": "x"}) == H.canonical_sha256({"a": "ü"}, ascii_only=True) != H.canonical_sha256({"a": "ü"})


def test_contamination_branches(spark):
    tasks = spark.createDataFrame([("e1", "t1", "sort a list of whole numbers in rising order now"), ("e2", None, "Count words")], "id string, template_id string, prompt string")
    rows = [("e1", None, "x"), ("c2", "t1", "y"), ("c3", None, "count, WORDS!"), ("c4", None, "sort a list of whole numbers in rising order now please"), ("c5", None, "other things entirely")]
    cand = spark.createDataFrame(rows, "id string, template_id string, prompt string")
    got = {r["id"]: r["reason"] for r in contamination.report(cand, tasks).collect()}
    assert got == {"e1": "id", "c2": "template", "c3": "prompt_hash", "c4": "similarity"}
    with pytest.raises(ValueError, match="c2"):
        contamination.require_clean(cand.where("id = 'c2'"), tasks)
    contamination.require_clean(cand.where("id = 'c5'"), tasks)


def plain_similar(left, right, threshold, measure):
    """(position left, position right): shared, score; of (id, text), by sets of tuples."""
    sets = lambda rows: [(w := re.findall(r"\w+", t.lower())) and {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} for _, t in rows]
    out = []
    for (x, _), a in zip(left, sets(left)):
        for (y, _), b in zip(right, sets(right)):
            n = len(set(a) & set(b))
            score = n / ((len(set(a) | set(b))) if measure == "jaccard" else len(b)) if n else float(not a and not b)
            if score >= threshold:
                out.append((x, y, n, round(score, 9)))
    return sorted(out)


def prompt_rows(spark, rows):
    return contamination.prompts(spark.createDataFrame(rows, "id long, text string"), "id", "text")


@pytest.mark.parametrize("measure", ["jaccard", "containment"])
@pytest.mark.parametrize("bound", [contamination.BROADCAST_GRAMS, 3])
def test_similar_equals_all_pairs(spark, monkeypatch, measure, bound):
    monkeypatch.setattr(contamination, "BROADCAST_GRAMS", bound)
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    # Short texts, texts without a word, repeated n-grams, and ids that come twice: with other texts, of equal or other sizes.
    right = [(i // 2, text(rng.choice((0, 3, 4, 5, 6, 9)))) for i in range(30)] + [(50, "p q r s t u"), (50, "v w x y z a")]
    left = [(i // 2, text(rng.choice((0, 3, 4, 5, 7, 12, 40)))) for i in range(60)] + [(90, "p q r s t u"), (91, "P q r s t u v w x y z a"), (92, ""), (93, " - ")]
    left = list(dict.fromkeys(left))
    found = contamination.similar(prompt_rows(spark, left + [(94, None)]), prompt_rows(spark, right), 0.3, measure)
    assert found.columns == ["left_id", "right_id", "shared", "score"]
    assert sorted((r[0], r[1], r[2], round(r[3], 9)) for r in found.collect()) == plain_similar(left, right, 0.3, measure)


def test_similar_reads_words_once(spark):
    """No filter on the words is inferred below them, which would tokenize each text again for each use."""
    rows = [(1, "a b c d e f (g)"), (2, "x")]
    found = contamination.similar(prompt_rows(spark, rows), prompt_rows(spark, rows), 0.5, "containment")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1


def test_sandbox_statuses(spark):
    run = lambda code, test, **o: sandbox.run_snippet(code, test, sandbox.SandboxLimits(**o))["status"]
    f = "def f(x):\n    return x + 1"
    assert run(f, "assert f(1) == 2") == "passed" and run(f, "assert f(1) == 3") == "failed"
    assert run("import os", "pass") == "rejected" and run(f, "f.__class__") == "rejected" and run("def f(:", "") == "rejected"
    assert run("while True:\n    pass", "pass", wall_s=1.0) == "timeout"
    assert run("for i in range(5000):\n    print('x' * 100)", "pass", output_bytes=1000) in ("output_limit", "failed")


def test_sandbox_bans_calls_not_names():
    for fine in ("x = dir", "def f(a):\n    def g():\n        nonlocal a\n        a = 1\n    return a", "open = 3", "y.open(1)", "y.eval"):
        sandbox.check_source(fine)
    for bad in ("import os", "from os import path", "class A:\n    pass", "async def f():\n    pass", "with x:\n    pass", "global x", "a.__class__", "__name__", "eval('1')", "vars()", "__import__('os')", "x ="):
        with pytest.raises(sandbox.SandboxViolation):
            sandbox.check_source(bad)
    assert sandbox.limits_report()["wall_s"] == 3.0


def test_repeats_are_counted_exactly(spark):
    gram = "a b c d e f g h "
    for n in (6, 7, 8):
        assert one(spark, quality.repeated_ngram(F.col("v")), v="x ".join([gram] * n)) == (n > 6)
    for n in (3, 4):
        assert one(spark, quality.repeated_lines(F.col("v")), v="\n".join(["The same long line."] * n + ["another line here"])) == (n > 3)
    assert not one(spark, quality.repeated_ngram(F.col("v")), v="") and not one(spark, quality.repeated_lines(F.col("v")), v="")


def variants(spark, column, *values):
    rows = spark.createDataFrame([(k, json.dumps(v)) for k, v in enumerate(values)], "k int, j string").select("k", F.parse_json("j").alias("v"))
    return [r["out"] for r in rows.select("k", column.alias("out")).orderBy("k").collect()]


def test_task_lists_and_messages(spark):
    tests = evaluation.test_list(F.col("v"), "hidden_tests", "tests_hidden")
    assert variants(
        spark, tests, {"hidden_tests": " a "}, {"tests_hidden": ["a", " ", 3, {"code": "b"}, {"test": "c "}, {"code": 1}]},
        {"evaluation": {"hidden_tests": ["x"]}}, {"hidden_tests": None, "evaluation": {"hidden_tests": "y"}}, {}, {"hidden_tests": 5},
    ) == [["a"], ["a", "b", "c"], ["x"], ["y"], [], []]
    asked = variants(
        spark, generation.task_messages(F.col("v")), {"prompt": "p", "system": "s"}, {"messages": [{"role": "user", "content": "u"}], "prompt": "p"},
        {"prompt": " "}, {"prompt": "p", "system": " ", "messages": []},
    )
    assert [m and [tuple(x) for x in m] for m in asked] == [[("system", "s"), ("user", "p")], [("user", "u")], None, [("user", "p")]]


def test_losses_and_policies():
    assert evaluation.parse_losses(["a=b=0.5", "c=0"]) == {"a=b": 0.5, "c": 0.0}
    for bad in ("a", "=1", "a=-1", "a=nan", "a=inf", "a=x"):
        with pytest.raises(ValueError):
            evaluation.parse_losses([bad])
    assert generation.generation_policy("deterministic") == ("direct", {"do_sample": False, "num_beams": 1, "use_cache": True, "max_new_tokens": 512})
    assert generation.generation_policy("sampled")[1] == {"do_sample": True, "temperature": 0.6, "top_p": 0.95, "top_k": 20, "max_new_tokens": 2048}
    for bad in (("deterministic", "thinking", None), ("deterministic", None, 100), ("sampled", None, 0)):
        with pytest.raises(ValueError):
            generation.generation_policy(*bad)


def test_rubric_lists_answers_by_label(spark):
    rows = spark.createDataFrame([("i", "T", "P", "B", "second"), ("i", "T", "P", "A", "first")], "id string, title string, prompt string, label string, answer string")
    sheet = evaluation.rubric(rows).first()["markdown"]
    assert sheet.index("first") < sheet.index("second") and "| A |" in sheet and "`i`" in sheet


def test_raw_rows(spark):
    rows = [{"id": "h", "instance_id": "no", "input": "q", "output": "a", "diff": " "}, {"input": "q", "output": "a", "has_empty_response": True}, {"input": "q", "output": "a", "gitdiff": "x"}, {"input": [], "output": "a"}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)] + [(8, "[1]"), (9, None)], "row_index long, raw string")
    made = raw.from_raw(df, {"name": "s", "category": "c", "require_patch": True, "reject_empty_response": True})
    made = raw.mark_holdout(made, spark.createDataFrame([("no",), ("x",)], "id string"))
    got = {r["row_index"]: r for r in made.collect()}
    assert [got[k]["holdout"] for k in (0, 1, 2, 3, 8, 9)] == [True] + [False] * 5 and got[1]["empty_response"] and not got[0]["empty_response"]
    assert got[8]["messages"] == [] and got[9]["messages"] == [] and got[9]["source_id"] == "9"
    settings = config.DATA_DEFAULTS | {"max_seq_length": 100, "min_tokens": 1}
    reasons = {r["row_index"]: r["reject_reason"] for r in prepare.build_candidates(made, settings).collect()}
    assert reasons == {0: "evaluation_holdout", 1: "empty_response", 2: None, 3: "missing_user", 8: "missing_messages", 9: "missing_messages"}
    counter = messages.counter_of(lambda ms: sum(len(m["content"]) for m in ms), len)
    rows = prepare.build_candidates(made, settings | {"min_tokens": 30}, counter=counter).where("row_index = 2").collect()
    assert rows[0]["num_tokens"] == len(messages.SYSTEM) + 2 and rows[0]["source_id"] == "2" and rows[0]["group_id"] == "s:default:train:2"


def evaluations(spark):
    rows = [(c, f"f{i % 11}", c != "base", True, True, False, False, 1.0, 0.0, 5, True) for c in ("cand", "base") for i in range(33)]
    return spark.createDataFrame(rows, "checkpoint string, family string, functional_pass boolean, contract_pass boolean, format_valid boolean, timeout boolean, truncated boolean, test_fraction double, repetition double, generated_tokens long, ended_with_eos boolean")


def test_evaluation_and_promotion(spark):
    got = {(r["checkpoint"], r["family"]): r for r in evaluation.aggregate(evaluations(spark)).collect()}
    assert len(got) == 24 and got["cand", None]["functional_pass"] == 1.0 and got["base", "f3"]["tasks"] == 3
    models = spark.createDataFrame([("cand", None, 33, 20, 30, 30), ("champ", None, 33, 17, 30, 30), ("cand", "f", 3, 1, 1, 1), ("champ", "f", 3, 2, 1, 1)], "checkpoint string, family string, tasks long, passes long, contract_pass long, format_valid long")
    rates = lambda total: spark.createDataFrame([("cand", 13, 37, 29, 18, total), ("base", 13, 30, 25, 15, 70)], "identity string, tasks long, correctness long, instruction long, explanation long, total long")
    assert evaluation.promotion(models, rates(84), "cand", "champ", "base").first()["promote"]
    assert not evaluation.promotion(models, rates(83), "cand", "champ", "base").first()["promote"]
    assert not evaluation.promotion(models.withColumn("passes", F.when(F.expr("checkpoint = 'cand' and family = 'f'"), 0).otherwise(F.col("passes"))), rates(84), "cand", "champ", "base").first()["no_family_lost"]
    with pytest.raises(ValueError, match="other"):
        evaluation.promotion(models, rates(84), "other", "champ", "base")


def test_ranking_and_checks(spark):
    rows = spark.createDataFrame([("a", 0.5, 1.0, 1.0, 0.0, 0.0), ("b", 0.5, 1.0, 1.0, 0.0, 0.0), ("c", 0.9, 0.0, 0.0, 1.0, 1.0)], "checkpoint string, functional_pass double, contract_pass double, format_valid double, timeout double, truncated double")
    losses = spark.createDataFrame([("b", 0.1)], "checkpoint string, eval_loss double")
    assert [r["checkpoint"] for r in evaluation.rank_models(rows, losses).orderBy("place").collect()] == ["c", "b", "a"]
    with pytest.raises(ValueError, match="lacks"):
        evaluation.rank_by_score(rows.withColumn("timeout", F.when(F.col("checkpoint") == "b", None).otherwise(F.col("timeout"))), {"functional_pass": 1.0}, {"timeout": 1.0})
    with pytest.raises(ValueError, match="duplicate"):
        evaluation.require_unique(rows.union(rows), "checkpoint")
    with pytest.raises(ValueError, match="unknown"):
        evaluation.match(spark.createDataFrame([("x",)], "id string"), spark.createDataFrame([("y",)], "id string"))
    train = spark.createDataFrame([(304_000,)], "num_tokens long")
    assert evaluation.step_preflight(train, 304_000, 2048, 1, 8, 1.0, 15, 25)["steps"] == 19
    with pytest.raises(ValueError):
        evaluation.step_preflight(train, 304_001, 2048, 1, 8, 1.0, 15, 25)
