"""Recipes, preparation, sources, manifests, generators and the online forms."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from sparkloom.functions.hashing import manifest_sha256
from sparkloom.operators import generation, manifest, messages, sandbox
from sparkloom.plans import config, prepare
from sparkloom.sources import jsonl
from sparkloom.streaming import online

RECIPE = {
    "seed": 42,
    "data": {"reasoning_distribution": {"short": 0.5, "direct": 0.5}, "validation_fraction": 0.1, "max_category_deviation": 0.05, "max_reasoning_deviation": 0.05, "min_token_budget_fraction": 0.95},
    "sources": [{"name": "one", "category": "a", "source_weight": 1.0}, {"name": "two", "category": "b", "source_weight": 1.0}, {"name": "idle", "category": "c", "source_weight": 1.0}],
    "stages": {"pilot": {"token_budget": 20_000, "category_weights": {"a": 0.6, "b": 0.4}}, "late": {"token_budget": 10, "category_weights": {"a": 1.0}, "data_stage": "pilot", "data": {"reasoning_distribution": {"direct": 1.0}}}},
}


@pytest.mark.parametrize("path,value", [(("stages", "pilot", "category_weights"), {"a": 0.6, "b": 0.5}), (("stages", "pilot", "category_weights"), {"a": 1.2, "b": -0.2}), (("sources", 0, "source_weight"), 0.5), (("data", "validation_fraction"), 1.0), (("training",), {"learning_rate": 0.02}), (("training",), {"min_steps": 5, "max_steps": 4}), (("stages", "late", "data_stage"), "nowhere"), (("stages", "pilot", "category_weights"), {"z": 1.0}), (("data", "max_category_deviation"), 2)])
def test_wrong_recipes_raise(path, value):
    config.validate(RECIPE)
    wrong = copy.deepcopy(RECIPE)
    at = wrong
    for k in path[:-1]:
        at = at[k]
    at[path[-1]] = value
    with pytest.raises(ValueError):
        config.validate(wrong)


def test_overlays_replace_whole_entries():
    late = config.data_of(RECIPE, "late")
    assert late["reasoning_distribution"]["direct"] == 1.0 and len(late["reasoning_distribution"]) == 1
    assert config.source_targets(RECIPE, "pilot") == {"one": round(12_000 * 1.35), "two": round(8_000 * 1.35)}


def grid(spark, n=400, tokens=100):
    rows = [(f"{i}", i, f"g{i}", "ab"[i % 2], ("short", "direct")[i // 2 % 2], tokens, f"f{i}", f"f{i}", "text") for i in range(n)]
    df = spark.createDataFrame(rows, "id string, seq long, group_id string, category string, reasoning_band string, num_tokens long, fingerprint string, near_fingerprint string, text string")
    return df.withColumn("messages", F.array(messages.message("assistant", F.col("text"))))


def test_prepare_meets_targets_and_writes(spark, tmp_path):
    got = prepare.prepare(grid(spark), RECIPE, "pilot")
    assert got.failed == [] and got.report["mix"]["selected_tokens"] == 20_000 and got.report["mix"]["max_category_deviation"] == 0
    prepare.write(got, str(tmp_path))
    train = jsonl.read_jsonl(spark, f"{tmp_path}/train", "id string, num_tokens long")
    assert train.count() == got.report["split"]["train_examples"] and "fingerprint" not in got.train.columns


def test_prepare_fails_closed(spark, tmp_path):
    got = prepare.prepare(grid(spark, 40), RECIPE, "pilot")
    assert "token_budget" in got.failed
    with pytest.raises(prepare.GateError):
        prepare.write(got, str(tmp_path / "x"))
    assert [p.name for p in (tmp_path / "x").iterdir() if not p.name.startswith(".")] == ["dataset_report.json"]
    good = prepare.prepare(grid(spark), RECIPE, "pilot")
    prepare.write(good, str(tmp_path / "x"))
    assert (tmp_path / "x" / "train").exists()
    with pytest.raises(prepare.GateError):
        prepare.write(got, str(tmp_path / "x"))
    assert [p.name for p in (tmp_path / "x").iterdir() if not p.name.startswith(".")] == ["dataset_report.json"]
    assert "token_budget" in json.loads((tmp_path / "x" / "dataset_report.json").read_text())["failed_gates"]
    assert "train_not_empty" in prepare.prepare(grid(spark, 40).limit(0), RECIPE, "pilot").failed


def test_build_candidates(spark):
    answer = "<think>because</think> " + " ".join(f"word{i}" for i in range(40))
    rows = [("s", "a", "r1", None, [("user", "question"), ("assistant", answer)]), ("s", "a", "r2", "repo", [("user", "q"), ("assistant", "short")]), ("s", "a", "r3", None, [("user", "hf_" + "a" * 24), ("assistant", answer)]), ("s", "b", "r4", None, [("user", "q")] + [("assistant", " ".join(f"w{k}x{i}" for i in range(60))) for k in range(4)])]
    df = spark.createDataFrame([(a, b, c, d, [dict(role=r, content=t) for r, t in m], True) for a, b, c, d, m in rows], f"source string, category string, source_id string, group_key string, messages {messages.MESSAGES}, verified boolean")
    settings = config.DATA_DEFAULTS | {"max_seq_length": 150, "direct_fraction": {"a": 1.1}, "successful_only": True}
    got = {}
    for r in prepare.build_candidates(df, settings).collect():
        got.setdefault(r["source_id"], []).append(r)
    assert got["r1"][0]["reasoning_band"] == "direct" and got["r1"][0]["reject_reason"] is None
    assert got["r2"][0]["reject_reason"] == "length_filter" and got["r2"][0]["group_id"] == "s:repo"
    assert got["r3"][0]["reject_reason"] == "secret"
    assert len(got["r4"]) == 2 and len({r["id"] for r in got["r4"]}) == 2 and all(r["num_tokens"] <= 150 for r in got["r4"])


def test_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"b": 1, "a": "ü"}\n\n{"a": null, "b": 2}\n', encoding="utf-8")
    df = jsonl.read_jsonl(spark, str(tmp_path / "a.jsonl"), "a string, b long")
    assert sorted(r["b"] for r in df.collect()) == [1, 2]
    jsonl.write_jsonl(df, str(tmp_path / "out"), 1)
    lines = [x for p in (tmp_path / "out").glob("part*") for x in p.read_text(encoding="utf-8").splitlines()]
    assert sorted(lines) == ['{"a":"ü","b":1}', '{"b":2}']
    for bad in ("[1]", "{", "3"):
        (tmp_path / "bad.jsonl").write_text('{"a": "x"}\n' + bad + "\n")
        with pytest.raises(ValueError, match="bad.jsonl"):
            jsonl.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "a string")
    (tmp_path / "ids").write_text("# c\n x \n\ny\nx\n")
    assert sorted(r["id"] for r in jsonl.read_id_list(spark, str(tmp_path / "ids")).collect()) == ["x", "y"]
    assert jsonl.read_id_list(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "p.json").write_text(json.dumps([{"id": "1", "title": "t", "prompt": "p"}, {"id": "1", "title": "t", "prompt": "p"}]))
    with pytest.raises(ValueError, match="duplicate"):
        jsonl.read_prompts(spark, str(tmp_path / "p.json"))
    ids = [r["b"] for r in jsonl.shuffled(df, 1, "b").collect()]
    assert sorted(ids) == [1, 2] and ids == [r["b"] for r in jsonl.shuffled(df.repartition(3), 1, "b").collect()]
    assert jsonl.union_active({"x": ("a", df), "y": ("b", df)}, {"a": 1.0, "b": 0}).select("source").distinct().collect()[0][0] == "x"


def candidate(spark, **changes):
    import hashlib

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    body = manifest.make_evidence("passed", "r", 5, code_sha256="c", tests_sha256="t")
    row = {"category": "a", "source": "s", "source_revision": "v", "source_sha256": sha("s"), "revision_sha256": sha("v"), "license": "MIT", "verified": True, "verification_level": "local_hidden_tests", "evidence_json": json.dumps(body), "num_tokens": 9, "reasoning_band": "direct"} | changes
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'boolean' if k == 'verified' else 'long' if k == 'num_tokens' else 'string'}" for k in row))


@pytest.mark.parametrize("changes,reason", [({}, None), ({"verified": False}, "not_verified"), ({"verification_level": "x"}, "verification_level"), ({"license": None}, "license"), ({"source_sha256": "x"}, "source_hash"), ({"revision_sha256": "x"}, "revision_hash"), ({"evidence_json": "{}"}, "evidence_status"), ({"evidence_json": '{"status": "passed"}'}, "evidence_incomplete"), ({"evidence_json": '{"status": "passed", "code_sha256": "c", "tests_sha256": "t", "sha256": "x"}'}, "evidence_tampered"), ({"num_tokens": 3000}, "num_tokens"), ({"reasoning_band": "long"}, "reasoning_band")])
def test_admission(spark, changes, reason):
    assert candidate(spark, **changes).select(manifest.admission_reason(2048).alias("r")).first()["r"] == reason


def test_manifest_shows_tampering(spark):
    df = candidate(spark)
    good = manifest.build(df, "late", 42, ["a", "b"], "exec", {"dev": {"sha256": "x", "count": 11}})
    args = (df, "late", 42, "exec", {"dev": {"sha256": "x", "count": 11}})
    manifest.verify(good, *args)
    for key, value in (("stage", "x"), ("seed", 1), ("executor_sha256", "x"), ("artifacts", {}), ("candidates_sha256", "x"), ("counts", []), ("production_eligible", False)):
        wrong = good | {key: value}
        with pytest.raises(ValueError):
            manifest.verify(wrong, *args)
        with pytest.raises(ValueError):
            manifest.verify(wrong | {"manifest_payload_sha256": manifest_sha256(wrong)}, *args if key != "counts" else (candidate(spark, num_tokens=8), *args[1:]))
    with pytest.raises(ValueError):
        manifest.build(candidate(spark, verified=False), "late", 42, ["a"], "e", {})
    with pytest.raises(ValueError, match="hidden_tests"):
        manifest.require_no_leaks(df.withColumn("hidden_tests", F.lit(1)))


def test_generated_contracts_pass_and_their_wrong_forms_fail(spark):
    n = len(generation.FAMILIES)
    rows = generation.contracts(spark, 3 * n)
    assert {(r["family"], r["archetype"]) for r in rows.collect()} == {(f.name, a) for f in generation.FAMILIES for a in generation.ARCHETYPES}
    done = sandbox.run_tests(rows.where(f"seq < {n}").select("family", "code", F.col("tests").alias("test")), partitions=2)
    assert {r["status"] for r in done.collect()} == {"passed"}
    for f in generation.FAMILIES:
        assert sandbox.run_snippet(f"def g{f.wrong}", "\n".join("assert " + t.replace("{f}", "g") for t in f.tests))["status"] == "failed"
    tasks = generation.evaluation_tasks(spark)
    assert tasks.where("split = 'dev'").count() == 11 and tasks.where("split = 'hidden'").count() == 33


def test_online_forms(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet")
    twice = str(tmp_path / "events")
    events.union(events).repartition(3).write.parquet(twice)
    got = online.run_once(spark, twice, lambda s: online.first_wins(s, "event_id"))
    assert got.count() == events.select("event_id").distinct().count()
    rows = [(s, 10) for s in ("x", "y") for _ in range(9)]
    spark.createDataFrame(rows, "source string, tokens long").coalesce(1).write.parquet(str(tmp_path / "q"))
    kept = online.run_once(spark, str(tmp_path / "q"), lambda s: online.running_quota(s, "source", "tokens", 35, "source string, tokens long"))
    assert {r["source"]: r["count"] for r in kept.groupBy("source").count().collect()} == {"x": 4, "y": 4}


def test_sources_at_their_revision(spark, tmp_path):
    (tmp_path / "lab" / "refs").mkdir(parents=True)
    (tmp_path / "lab" / "refs" / "main").write_text("abc\n")
    (tmp_path / "lab@abc").mkdir()
    (tmp_path / "lab@abc" / "rows.jsonl").write_text("".join(f'{{"id": {k}}}\n' for k in range(50)))
    got = jsonl.read_source(spark, str(tmp_path), {"name": "lab", "file": "rows.jsonl"}, rows=20).collect()
    assert {r["row_index"]: json.loads(r["raw"])["id"] for r in got} == {k: k for k in range(20)}
    assert {(r["requested_revision"], r["resolved_revision"]) for r in got} == {("main", "abc")}
    spark.range(30).repartition(3).write.parquet(str(tmp_path / "tab@v2" / "default" / "train"))
    got = jsonl.read_source(spark, str(tmp_path), {"name": "tab", "revision": "v2"}).collect()
    assert sorted(r["row_index"] for r in got) == list(range(30)) and {json.loads(r["raw"])["id"] for r in got} == set(range(30))
    (tmp_path / "lab@abc" / "rows.jsonl").write_text("[1]\n")
    with pytest.raises(ValueError, match="rows.jsonl"):
        jsonl.read_source(spark, str(tmp_path), {"name": "lab", "file": "rows.jsonl"})


def test_known_categories_and_regression(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("z",), (None,)], "category string")
    kept, lost = jsonl.known_categories(rows, ["a", "b"])
    assert kept.count() == 1 and lost == 2
    with pytest.raises(ValueError):
        jsonl.known_categories(rows, ["a"], strict=True)
    (tmp_path / "r.json").write_text(json.dumps([{"id": str(k), "title": "t", "prompt": "p"} for k in range(13)]))
    assert {r["template_id"] for r in jsonl.read_regression(spark, str(tmp_path / "r.json")).collect()} == {f"regression/{k}" for k in range(13)}
    with pytest.raises(ValueError):
        jsonl.read_regression(spark, str(tmp_path / "r.json"), 12)


def test_corpus_gate_and_first_rows(spark):
    good = {"mix": {"selected_tokens": 304_000, "max_category_deviation": 0.05}, "split": {"train_tokens": 304_000}}
    assert prepare.corpus_gate(good) == 19
    for part, key, value in (("mix", "selected_tokens", 303_999), ("mix", "max_category_deviation", 0.06), ("split", "train_tokens", 200_000)):
        with pytest.raises(prepare.GateError):
            prepare.corpus_gate(good | {part: good[part] | {key: value}})
    assert [r["id"] for r in prepare.first_rows(spark.range(9), 3, "id").collect()] == [0, 1, 2] and prepare.first_rows(spark.range(9), None, "id").count() == 9


def test_older_manifests_and_runs(spark, tmp_path):
    entry = {"path": "p", "sha256": "s", "examples": 1, "tokens": 2}
    assert manifest.candidate_artifact({"artifacts": {"candidates": entry}}) == entry
    assert manifest.candidate_artifact({"candidates_path": "p", "candidates_sha256": "s", "candidate_examples": 1, "candidate_tokens": 2, "artifacts": {}}) == entry
    (tmp_path / "f").write_bytes(b"abc")
    run = manifest.run_manifest(spark, {"x": 1}, "late", {"train": str(tmp_path / "f"), "gone": str(tmp_path / "g"), "none": None})
    assert run["data"]["train"]["sha256"].startswith("ba7816bf") and run["data"]["gone"]["sha256"] is None and run["packages"]["pyspark"]
