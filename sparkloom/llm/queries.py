"""The registered queries of the llm operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import decontam, langid, line_dedup, mixing, pii, quality, simhash, substring_dedup, toxicity, url_filter
from sparkloom.llm.common import table


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality.judge(docs, quality.fit(docs, trusted))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("n_copies") * F.col("size")).alias("taken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination, op2_pii, op3_language_id, op4_toxicity, op5_substring_dedup,
        op6_url_filters, op7_line_dedup, op8_quality_rules, op9_simhash_near_dedup, op10_source_mixing,
    )
}

WORDS_SQL = r"len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))"
UNIT_SQL = "cast(cast('0x' || substr(sha256({}), 1, 13) as bigint) as double) / 4503599627370496.0"

TOKENS_SQL = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
SHINGLES_SQL = "unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) as s"
LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LINK_SQL = url_filter.LINK.replace("'", "''")
RULES_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)
ROUNDS = url_filter.rounds_for(url_filter.DAMPING, url_filter.TOLERANCE)

ORACLES: dict[str, str] = {
    "op1_benchmark_decontamination": f"""
        with i as (select item_id, {TOKENS_SQL} as w from benchmark),
        it as (select item_id, w, least(len(w), {decontam.SHINGLE}) as k from i where len(w) > 0),
        s as (select distinct item_id, k, {SHINGLES_SQL} from it),
        n as (select item_id, count(*) as n_shingles from s group by 1),
        d as (select doc_id, {TOKENS_SQL} as w from documents),
        ds as (select distinct doc_id, k, {SHINGLES_SQL} from d, (select distinct k from it) where len(w) >= k)
        select doc_id, item_id, n_shingles, count(*) as n_found, count(*) / n_shingles as containment
        from ds join s using (k, s) join n using (item_id) group by doc_id, item_id, n_shingles having count(*) >= {decontam.THRESHOLD}::double * n_shingles - 1e-9""",
    "op6_url_filters": f"""
        with recursive p as (
          select page_id, html, {LOWER_SQL.format("regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1)")} as host,
            regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) as path from pages),
        rules as (select * from (values {RULES_SQL}) x(kind, h, p)),
        fits as (select page_id, arg_max(rules.h || rules.p, length(rules.h || rules.p)) as rule, arg_max(kind, length(rules.h || rules.p)) as by_rule
          from p join rules on (host = rules.h or ends_with(host, '.' || rules.h)) and starts_with(path, rules.p) group by page_id),
        own as (select page_id, host, path, html, rule, by_rule from p left join fits using (page_id)),
        l as (select host as src, unnest(list_distinct(list_transform(regexp_extract_all(coalesce(html, ''), '{LINK_SQL}', 1), lambda x: {LOWER_SQL.format("x")}))) as dst from own),
        links as (select src, dst, count(*)::double as weight from l where src <> '' and dst <> '' and src <> dst group by all),
        ends as (select host from own where host <> '' union select dst from links),
        labels as (select string_split(host, '.') as x from ends),
        steps as (select distinct array_to_string(x[k:], '.') as a, array_to_string(x[k + 1:], '.') as b from (select x, unnest(range(1, len(x) - 1)) as k from labels)),
        edges as (select src, dst, sum(weight) as weight from (select * from links union all select a, b, {url_filter.PARENT}::double from steps union all select b, a, {url_filter.PARENT}::double from steps) group by all),
        w as (select 't' as kind, src as a, dst as b, weight from edges union all select 'd', dst, src, weight from edges),
        ways as (select kind, a, b, {url_filter.DAMPING}::double * weight / sum(weight) over (partition by kind, a) as share from w),
        seeds as (select case by_rule when 'allow' then 't' else 'd' end as kind, host, count(*)::double as weight from own where by_rule is not null and host <> '' group by all),
        r as (
          select 0 as k, kind, host, weight / sum(weight) over (partition by kind) as v from seeds
          union all
          select r.k + 1, ways.kind, ways.b, sum(share * v) from r join ways on r.kind = ways.kind and r.host = ways.a where r.k < {ROUNDS} group by r.k, ways.kind, ways.b),
        scored as (select kind, host, sum(v) as v from r group by all),
        scaled as (select kind, host, v / sum(v) over (partition by kind) as v from scored),
        hosts as (select host, round(coalesce(sum(v) filter (kind = 't'), 0), {url_filter.DIGITS}) as trust, round(coalesce(sum(v) filter (kind = 'd'), 0), {url_filter.DIGITS}) as distrust from scaled group by host)
        select page_id, own.host, path, rule, coalesce(by_rule, case when coalesce(distrust, 0) > {url_filter.RATIO}::double * coalesce(trust, 0) then 'block' else 'allow' end) as verdict,
          coalesce(trust, 0) as trust, coalesce(distrust, 0) as distrust from own left join hosts using (host)""",
    "op7_line_dedup": """
        with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos from documents),
        k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
        h as (select key, max(doc_id) as top from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
        m as (select k.*, h.top is not null and h.top <> doc_id as gone from k left join h using (key))
        select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256 from m group by doc_id""",
    "op10_source_mixing": f"""
        with d as (select doc_id, source, cast({WORDS_SQL} as bigint) as size, {UNIT_SQL.format("'42:' || coalesce(cast(doc_id as varchar), 'null')")} as key, {UNIT_SQL.format("'42:' || coalesce('s' || source, 'null')")} as start from documents),
        s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
        w as (select *, row_number() over (order by source nulls last) - 1 as place, ([3, 1, 2])[(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight, 2 * source_size as cap from s),
        f as (select *, coalesce(sum(cap) over (order by cap / weight, place rows between unbounded preceding and 1 preceding), 0)::double as filled, (sum(weight) over (order by cap / weight, place rows between current row and unbounded following))::double as unfilled, (sum(source_size) over ())::double as total from w),
        v as (select *, (1.5::double * total - filled) / unfilled as level from f),
        t as (select source, source_size, least((select coalesce(arg_min(level, (cap / weight, place)) filter (where level * weight <= cap), 'infinity'::double) from v) * weight, cap::double) as target from v),
        r as (select d.*, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate, row_number() over (partition by d.source order by size, key, doc_id) as rank from d join t on d.source is not distinct from t.source)
        select doc_id, size, source_size, target, cast(least(floor(rank * rate + start) - floor((rank - 1) * rate + start), 2) as bigint) * size as taken from r""",
}
