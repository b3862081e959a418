"""The pipeline stage by stage against plain Python over the same rows."""

import importlib

import pytest
from pyspark.sql import functions as F

from tests.llm import test_decontam, test_line_dedup, test_mixing, test_quality, test_simhash

pipeline = importlib.import_module("corpus_pipeline")


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{data}/documents.parquet"), []
    for k, (name, stage) in enumerate(pipeline.STAGES):
        after = stage(spark, docs, data)
        after.write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        out.append((name, [r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()]))
        docs = after
    return out


def test_order_and_columns(stages):
    assert [s[0] for s in stages] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "mixing"]
    for name, before, after in stages[:-1]:
        assert set(after[0]) == {"doc_id", "text", "lang", "source", "n_chars"}


def test_quality_keeps_whole_rows_and_drops_failures(stages):
    _, before, after = stages[0]
    rows, kept = {r["doc_id"]: r for r in before}, {r["doc_id"] for r in after}
    assert all(rows[r["doc_id"]] == r for r in after)
    assert all(i not in kept for i, r in rows.items() if test_quality.plain(r["text"])[-1])


def test_line_dedup_drops_what_the_count_says(stages):
    _, before, after = stages[1]
    want = {i: sha for i, _, _, sha in test_line_dedup.plain([(r["doc_id"], r["text"]) for r in before])}
    import hashlib

    assert {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_dedup_leaves_no_near_copies_and_takes_no_others(stages):
    _, before, after = stages[2]
    sets, kept = {r["doc_id"]: test_simhash.shingle_set(r["text"]) for r in before}, {r["doc_id"] for r in after}
    like = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    assert not [(i, j) for i in kept for j in kept if i < j and like(i, j) >= 0.8]
    assert all(max(like(i, j) for j in sets if j != i) >= 0.8 for i in sets if i not in kept)


def test_decontamination_drops_exactly_the_contaminated(stages, spark, data):
    _, before, after = stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {x[0] for x in test_decontam.plain([(r["doc_id"], r["text"]) for r in before], items)}
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - bad


def test_mixing_repeats_rows_as_sampled(stages):
    _, before, after = stages[4]
    want = {i: c for i, _, _, _, c in test_mixing.plain([(r["doc_id"], r["text"], r["source"]) for r in before])}
    got = dict.fromkeys(want, 0)
    for r in after:
        got[r["doc_id"]] += 1
    assert got == want


def test_run_applies_all_stages(spark, data, stages):
    got = sorted((r["doc_id"], r["copy"]) for r in pipeline.run(spark, data).collect())
    assert got == sorted((r["doc_id"], r["copy"]) for r in stages[-1][2])


def test_stages_take_empty_and_null_rows(spark, data, docs_of, tmp_path):
    text = "the quick brown fox jumps over the lazy dog while nobody looks at them"
    for n, docs in enumerate((docs_of([]).limit(0), docs_of([None, "", (None, text), (7, text), (7, text)]))):
        for k, (_, stage) in enumerate(pipeline.STAGES):
            stage(spark, docs, data).write.parquet(f"{tmp_path}/{n}-{k}")
            docs = spark.read.parquet(f"{tmp_path}/{n}-{k}")


def test_stages_keep_extra_columns_whatever_their_names(spark, data, docs_of):
    names = ("gone_id", "m_id", "m_copies", "t", "id", "fp", "size", "rank", "copy", "dropped_lines", "quality", "item_id", "h", "w", "mark")
    docs = docs_of([f"number {i} the quick brown fox jumps over lazy dogs near a river bank while it rains" for i in range(6)])
    for n in names:
        docs = docs.withColumn(n, F.lit(f"own {n}"))
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, data)
    rows = docs.collect()
    assert rows and all(r[n] == f"own {n}" for r in rows for n in names)


def test_near_dedup_keeps_the_smallest_of_each_group_of_similar_sets(stages):
    _, before, after = stages[2]
    before = sorted(before, key=lambda r: r["doc_id"])
    label = test_simhash.exact_components([r["text"] for r in before])
    assert {r["doc_id"] for r in after} == {before[k]["doc_id"] for k in set(label)}
