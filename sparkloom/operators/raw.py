"""Raw rows of any known shape, as JSON text, to ordered messages and the columns that candidates are made of.

A row is parsed once into a variant; what it holds is asked for by expressions, so nothing leaves the JVM.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.functions.fixed import (
    CONTENT_KEYS, GROUP_KEYS, HOLDOUT_KEYS, ID_KEYS, MESSAGE_KEYS, OUTPUT_KEYS, PATCH_KEYS, PROMPT_KEYS,
    REASONING_KEYS, RESPONSE_KEYS, ROLE_KEYS, SUCCESS_KEYS, SUCCESS_WORDS, SYSTEM_KEYS, WRAPPED_KEYS,
)
from sparkloom.functions.hashing import stable_hash
from sparkloom.operators import messages, quality
from sparkloom.storage import broadcast_if_small, materialize

#: Lists within lists that text() opens; what lies deeper is shown as JSON.
DEPTH = 3
BROADCAST_IDS = 1_000_000
Keys = tuple[str, ...]


def is_kind(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def fields(v: Column) -> Column:
    """The fields of an object; null for anything else."""
    return F.when(is_kind(v, "OBJECT"), F.try_variant_get(v, "$", "map<string,variant>"))


def items(v: Column) -> Column:
    """The items of a list; null for anything else."""
    return F.when(is_kind(v, "ARRAY"), F.try_variant_get(v, "$", "array<variant>"))


def opened(v: Column) -> Column:
    """A list or object that is given as JSON text, parsed; anything else as it is."""

    def parsed(x: Column) -> Column:
        text = F.when(is_kind(x, "STRING"), F.try_variant_get(x, "$", "string"))
        return T.let(text, lambda t: F.when(T.strip(t).rlike(r"^[\[{]"), F.coalesce(F.try_parse_json(t), x)).otherwise(x))

    return T.let(v, parsed)


def spaced(json: Column) -> Column:
    """Compact JSON with a blank after each comma and colon outside of strings."""
    return F.regexp_replace(json, r'\G((?:"(?:[^"\\]|\\.)*+"|[^",:])++)([,:])', "$1$2 ")


def shown(v: Column) -> Column:
    """A scalar as text; lists and objects as JSON with sorted keys."""
    return T.let(
        v,
        lambda x: F.when(is_kind(x, "STRING"), F.try_variant_get(x, "$", "string"))
        .when(is_kind(x, "BOOLEAN"), F.when(F.try_variant_get(x, "$", "boolean"), "True").otherwise("False"))
        .when(is_kind(x, "VOID"), "None")
        .otherwise(spaced(F.to_json(x))),
    )


def text(v: Column, depth: int = DEPTH) -> Column:
    """Content as text: a list's blocks, one a line, empty ones left out; a block's own text where it has one."""

    def plain(x: Column) -> Column:
        return F.when(x.isNull() | is_kind(x, "VOID"), "").when(is_kind(x, "STRING"), F.try_variant_get(x, "$", "string")).otherwise(spaced(F.to_json(x)))

    def block(x: Column) -> Column:
        return F.coalesce(shown(F.try_element_at(fields(x), F.lit("text"))), text(x, depth - 1))

    def blocks(x: Column) -> Column:
        joined = lambda own: F.array_join(F.filter(F.transform(own, block), lambda t: t != ""), "\n")
        return T.let(items(x), lambda own: F.when(own.isNotNull(), joined(own)).otherwise(plain(x)))

    return T.let(v, blocks if depth else plain)


def first(own: Column, keys: Keys) -> Column:
    """The value of the first key that has one: not null, nor an empty text, list or object. 0 and false are values."""
    found = F.transform(F.array(*map(F.lit, keys)), lambda k: F.try_element_at(own, k))
    return F.get(F.filter(found, lambda v: v.isNotNull() & ~F.to_json(v).isin("null", '""', "[]", "{}")), F.lit(0))


def truthy(v: Column) -> Column:
    return F.coalesce(~F.to_json(v).isin("null", '""', "[]", "{}", "false", "0", "0.0"), F.lit(False))


def calls(v: Column) -> Column:
    """Tool calls as (name, arguments as JSON text); one call may stand without its list, and inside `function`."""
    listed = T.let(opened(v), lambda x: F.coalesce(items(x), F.array(x)))

    def call(own: Column) -> Column:
        at = lambda k: F.try_element_at(own, F.lit(k))
        name = F.when(truthy(at("name")), shown(at("name"))).when(truthy(at("tool_name")), shown(at("tool_name")))
        return F.struct(name.alias("name"), F.coalesce(F.to_json(opened(F.coalesce(at("arguments"), at("args"), at("input")))), F.lit("{}")).alias("arguments"))

    inner = lambda own: F.coalesce(fields(F.try_element_at(own, F.lit("function"))), own)
    own = F.filter(F.transform(listed, lambda c: fields(c)), lambda c: c.isNotNull())
    return F.transform(F.transform(own, inner), call)


def message(raw: Column) -> Column:
    """One message (an object's fields) as role and content; the role is null where it is unknown."""
    at = lambda k: F.try_element_at(raw, F.lit(k))

    def made(role: Column) -> Column:
        replies = role == "assistant"
        whole = messages.full_content(
            T.strip(text(first(raw, CONTENT_KEYS))),
            F.when(replies, text(at("reasoning_content"))),
            F.when(replies & truthy(at("tool_calls")), calls(at("tool_calls"))),
            F.when((role == "tool") & truthy(at("name")), shown(at("name"))),
        )
        return messages.message(role, whole)

    return T.let(messages.role_of(shown(first(raw, ROLE_KEYS))), made)


def listed(row: Column) -> Column:
    """The messages of a row that lists them, under one of several keys, in an object or as JSON text; null where none does."""

    def within(v: Column) -> Column:
        return T.let(fields(v), lambda own: F.when(own.isNotNull(), items(F.coalesce(first(own, WRAPPED_KEYS), F.parse_json(F.lit("[]"))))).otherwise(items(v)))

    values = F.transform(F.array(*map(F.lit, MESSAGE_KEYS)), lambda k: within(opened(F.try_element_at(row, k))))
    found = F.get(F.filter(values, lambda x: x.isNotNull()), F.lit(0))
    given = items(opened(F.try_element_at(row, F.lit("input"))))
    each = lambda own: F.transform(F.filter(F.transform(own, lambda m: fields(m)), lambda m: m.isNotNull()), message)
    reply = F.array(messages.message("assistant", T.strip(text(first(row, OUTPUT_KEYS)))))
    known = T.let(found, lambda own: each(F.coalesce(own, given)))
    known = F.when(found.isNull(), F.concat(known, reply)).otherwise(known)
    return F.filter(known, lambda m: m["role"].isNotNull() & (m["content"] != ""))


def flat(row: Column) -> Column:
    """The messages of a flat row: system, prompt and response with its reasoning."""
    said = lambda role, keys: T.let(first(row, keys), lambda v: F.when(truthy(v), messages.message(role, text(v))))

    def reply(x: Column) -> Column:
        answer, reasoning = x["answer"], x["reasoning"]
        whole = F.when(truthy(reasoning), T.strip(F.concat(F.lit("<think>"), text(reasoning), F.lit("</think>\n"), text(answer)))).otherwise(text(answer))
        return F.when(truthy(answer) | truthy(reasoning), messages.message("assistant", whole))

    both = F.struct(first(row, RESPONSE_KEYS).alias("answer"), first(row, REASONING_KEYS).alias("reasoning"))
    return F.filter(F.array(said("system", SYSTEM_KEYS), said("user", PROMPT_KEYS), T.let(both, reply)), lambda m: m.isNotNull())


def reports_success(row: Column) -> Column:
    """Whether a row reports success: the first flag decides, before it a positive number or a word that means success."""
    out = F.lit(False)
    for key in reversed(SUCCESS_KEYS):
        v = F.try_element_at(row, F.lit(key))
        number = F.when(~is_kind(v, "STRING"), F.try_variant_get(v, "$", "double"))
        word = F.when(is_kind(v, "STRING"), F.lower(T.strip(F.try_variant_get(v, "$", "string"))).isin(*SUCCESS_WORDS))
        good = F.coalesce(number > 0, F.lit(False)) | F.coalesce(word, F.lit(False))
        out = F.when(is_kind(v, "BOOLEAN"), F.try_variant_get(v, "$", "boolean")).when(good, True).otherwise(out)
    return out


def normalized(rows: DataFrame, raw: str = "raw", system: str = messages.SYSTEM) -> DataFrame:
    """rows with m (the raw row's fields, null where it is no object) and messages, a default system message in front."""
    own = rows.withColumn("v", F.try_parse_json(raw)).withColumn("m", fields(F.col("v"))).drop("v")
    own = own.withColumn("messages", F.coalesce(listed(F.col("m")), F.array().cast(messages.MESSAGES)))
    own = own.withColumn("messages", F.when(F.size("messages") > 0, F.col("messages")).otherwise(F.coalesce(flat(F.col("m")), F.array().cast(messages.MESSAGES))))
    return own.withColumn("messages", messages.with_system(F.col("messages"), system))


def from_raw(rows: DataFrame, source: dict[str, Any], raw: str = "raw", row_index: str = "row_index", system: str = messages.SYSTEM) -> DataFrame:
    """The columns that build_candidates() reads, of one source's raw rows (JSON text and the row's number).

    source: name, category and optionally config_name, split, revision, license, curated, verification_level,
    require_patch and reject_empty_response.
    """
    own = normalized(rows.select(F.col(raw).alias("raw"), F.col(row_index).cast("long").alias("row_index")), system=system)
    m = F.col("m")
    name, config, split = source["name"], source.get("config_name", "default"), source.get("split", "train")
    fixed = {
        "source": name, "source_config": config, "source_split": split, "source_key": f"{name}:{config}:{split}",
        "source_revision": source.get("revision", "main"), "license": source.get("license", "unknown"), "category": source["category"],
    }
    own = own.withColumns({k: F.lit(str(v)) for k, v in fixed.items()} | {"curated": F.lit(bool(source.get("curated", False)))})
    own = own.withColumn("source_id", F.coalesce(shown(first(m, ID_KEYS)), F.col("row_index").cast("string")))
    others = F.transform(F.array(*map(F.lit, HOLDOUT_KEYS)), lambda k: F.try_element_at(m, k))
    others = F.filter(others, lambda v: v.isNotNull() & ~F.to_json(v).isin("null", '""'))
    at = lambda k: F.try_element_at(m, F.lit(k))
    evidence = fields(at("verification_evidence"))
    piece = lambda k: F.when(truthy(F.try_element_at(evidence, F.lit(k))), shown(F.try_element_at(evidence, F.lit(k))))
    given = F.when(evidence.isNotNull(), F.struct(piece("status").alias("status"), piece("sha256").alias("sha256")))
    level = F.coalesce(F.when(truthy(at("verification_level")), shown(at("verification_level"))), F.lit(source.get("verification_level")).cast("string"))
    fallback = stable_hash(F.lit(name), F.col("source_id"), spaced(F.to_json(F.try_parse_json("raw"))))
    proof = quality.verification(given, level, reports_success(m), fallback)
    own = own.withColumns(
        {
            "group_key": shown(first(m, GROUP_KEYS)),
            "identifiers": F.array_distinct(F.concat(F.array("source_id"), F.transform(others, shown))),
            "patch": text(first(m, PATCH_KEYS)),
            "patch_needed": F.lit(bool(source.get("require_patch", False))),
            "empty_response": F.lit(bool(source.get("reject_empty_response", False))) & F.coalesce(F.to_json(at("has_empty_response")) == "true", F.lit(False)),
            "proof": proof,
        }
    )
    own = own.withColumns({"verified": F.col("proof.verified"), "verification_level": F.col("proof.level"), "verification_evidence": F.col("proof.evidence")})
    return own.drop("raw", "m", "proof")


def mark_holdout(rows: DataFrame, holdout: DataFrame, key: str = "row_index") -> DataFrame:
    """rows with holdout: whether one of a row's identifiers is in the list (id); key names a row."""
    each = rows.select(F.col(key).alias("h_key"), F.explode("identifiers").alias("h_id"))
    ids = broadcast_if_small(holdout.select(F.col("id").alias("h_id")).distinct(), BROADCAST_IDS)
    hits = materialize(each.join(ids, "h_id", "left_semi").select("h_key").distinct().withColumn("holdout", F.lit(True)), "holdout-rows")
    joined = rows.join(broadcast_if_small(hits, BROADCAST_IDS), F.col(key) == F.col("h_key"), "left")
    return joined.withColumn("holdout", F.coalesce("holdout", F.lit(False))).drop("h_key")
