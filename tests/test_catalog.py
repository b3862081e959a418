"""Every query of the catalogue against its SQL, and the entry points."""

import pytest

import __spark_entry__ as entry
from sparkloom.plans import catalog


def same(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, data, duck, name):
    df = catalog.QUERIES[name](spark, data)
    names = sorted(df.columns)
    got = sorted((tuple(same(r[n]) for n in names) for r in df.collect()), key=str)
    if name not in catalog.ORACLES:
        assert got
        return
    duck.execute(catalog.ORACLES[name])
    columns = [d[0] for d in duck.description]
    assert sorted(columns) == names
    want = sorted((tuple(same(r[columns.index(n)]) for n in names) for r in duck.fetchall()), key=str)
    assert got == want


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("parts", ["1", "17"])
def test_results_do_not_depend_on_partitions(spark, data, parts):
    names = ("quota_mix", "dedup_two_key_general", "min_validation_topup", "collection_outcomes")
    first = {n: sorted(map(str, catalog.QUERIES[n](spark, data).collect())) for n in names}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert {n: sorted(map(str, catalog.QUERIES[n](spark, data).collect())) for n in names} == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("name", ["decontam_anti", "decontam_containment"])
def test_decontamination_tokenizes_once(spark, data, name):
    assert catalog.QUERIES[name](spark, data)._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
