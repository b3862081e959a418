"""URL filters: rules first, then link-graph propagation per host.

Hosts are nodes; links between hosts and the step from a host to its parent domain are edges. Trust
is personalised PageRank from hosts whose pages a rule allows, along the edges; distrust is the
same from hosts whose pages a rule blocks, against them. Mass that reaches a host without a way on
returns to the seeds. A host whose distrust outweighs its trust is blocked where no rule speaks.
"""

from __future__ import annotations

import math
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.storage import broadcast_if_small, discard, materialize

#: (verdict, host, path) of each rule.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
DAMPING = 0.85
#: Share of all mass that may be left unspread, and rounds whose result is written as one table.
TOLERANCE = 1e-5
AT_ONCE = 3
#: Edges and seeds that one task may hold, which then runs all rounds of a kind; beyond, each round is a join.
TASK_ROWS = 500_000
#: Edges of a host that one row holds in a join; a hub has several rows.
EDGES = 4096
#: Rows that may be broadcast; beyond, the joins shuffle.
BROADCAST_ROWS = 500_000
#: Digits to which trust and distrust are rounded.
DIGITS = 6
#: A host is blocked if its distrust exceeds this many times its trust.
RATIO = 1.5
#: Weight of the edge between a host and its parent domain; a link between hosts weighs 1 for each page that has it.
PARENT = 0.5
LINK = r"(?i)\bhref\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"


def lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host(url: Column) -> Column:
    return lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)([^?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)([^?#]*)", 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as host and path in one string) and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between different hosts: links on pages (columns host, html), and parents both ways."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)), lambda h: lower(h)))).alias("dst"))
    links = links.where("src != '' and dst != '' and src != dst").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    ends = pages.select("host").union(links.select("dst")).where("host != ''").distinct()
    labels = F.split("host", r"\.")
    chain = F.when(F.size(labels) > 2, F.transform(F.sequence(F.lit(1), F.size(labels) - 2), lambda k: F.struct(F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("a"), F.array_join(F.slice(labels, k + 1, F.size(labels)), ".").alias("b"))))
    steps = ends.select(F.explode(chain).alias("s")).select("s.a", "s.b").distinct()
    both = steps.union(steps.select("b", "a")).select(F.col("a").alias("src"), F.col("b").alias("dst"), F.lit(PARENT).alias("weight"))
    return links.union(both).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def rounds_for(damping: float, tolerance: float) -> int:
    """Rounds after which less than tolerance of all mass is on its way: each round moves on at most damping of it."""
    return AT_ONCE * math.ceil(math.log(tolerance) / math.log(damping) / AT_ONCE)


def rounds_in_a_task(ways: DataFrame, start: DataFrame, rounds: int) -> DataFrame:
    """(kind, host, score) after all rounds, each kind in one task: for graphs of a checked size."""

    def run(seeds: pa.Table, edges: pa.Table) -> pa.Table:
        n, m = seeds.num_rows, edges.num_rows
        names = pa.chunked_array([*seeds["host"].chunks, *edges["a"].chunks, *edges["b"].chunks], pa.string()).combine_chunks().dictionary_encode()
        at, size = names.indices.to_numpy(), len(names.dictionary)
        new = np.bincount(at[:n], seeds["score"].to_numpy(), size)
        score, src, dst, share = new.copy(), at[n : n + m], at[n + m :], edges["share"].to_numpy()
        for _ in range(rounds):
            new = np.bincount(dst, share * new[src], size)
            score += new
        kind = (seeds if n else edges)["kind"][0].as_py()
        return pa.table({"kind": [kind] * size, "host": names.dictionary, "score": score}).filter(pa.array(score > 0))

    return start.groupBy("kind").cogroup(ways.groupBy("kind")).applyInArrow(run, "kind string, host string, score double")


def rounds_by_joins(ways: DataFrame, start: DataFrame, rounds: int) -> DataFrame:
    """(kind, host, score) after all rounds, each a join and a sum: for graphs of any size."""
    part = F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / EDGES)).cast("int").alias("part")
    ways = ways.select("kind", "a", part, F.struct("b", "share").alias("way")).groupBy("kind", "a", "part").agg(F.collect_list("way").alias("ways"))
    # The first part that a host has also carries what the host holds already.
    first = F.row_number().over(Window.partitionBy("kind", "a").orderBy("part")) == 1
    ways = materialize(ways.select(F.col("kind").alias("w_kind"), "a", first.alias("first"), "ways"), "host-ways")
    ways = broadcast_if_small(ways, BROADCAST_ROWS // EDGES)
    ranks = materialize(start.withColumn("new", F.col("score")), "host-ranks")
    held = F.struct("host", "score", F.lit(0.0).alias("new"))
    moved = F.transform("ways", lambda w: F.struct(w["b"].alias("host"), (w["share"] * F.col("new")).alias("score"), (w["share"] * F.col("new")).alias("new")))
    sent = F.concat(F.when(F.coalesce("first", F.lit(True)), F.array(held)).otherwise(F.array()), F.when(F.col("ways").isNotNull() & (F.col("new") > 0), moved).otherwise(F.array()))
    for _ in range(rounds // AT_ONCE):
        after = ranks
        for _ in range(AT_ONCE):
            after = after.join(ways, (F.col("kind") == F.col("w_kind")) & (F.col("host") == F.col("a")), "left").select("kind", F.explode(sent).alias("x")).select("kind", "x.*")
            after = after.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("new").alias("new"))
        old, ranks = ranks, materialize(after, "host-ranks")
        discard(old)
        if ranks.where("new > 0").isEmpty():
            break
    return ranks.where("score > 0")


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, host, score) from seeds (kind t or d, host, weight): t along the edges, d against them; scores of a kind add up to 1.

    A round moves on only what the round before brought. What hosts without a way on would return to the seeds
    spreads as the seeds' own mass does, so it is enough to scale the sums at the end.
    """
    ways = edges.select(F.lit("t").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "weight").union(edges.select(F.lit("d"), F.col("dst"), F.col("src"), "weight"))
    out = ways.groupBy(F.col("kind").alias("o_kind"), F.col("a").alias("o_a")).agg(F.sum("weight").alias("all"), F.count(F.lit(1)).alias("n"))
    ways = ways.join(out, (F.col("kind") == F.col("o_kind")) & (F.col("a") == F.col("o_a")))
    ways = materialize(ways.select("kind", "a", "b", (damping * F.col("weight") / F.col("all")).alias("share"), "n"), "host-edges")
    totals = seeds.groupBy(F.col("kind").alias("s_kind")).agg(F.sum("weight").alias("all"))
    start = seeds.join(totals, F.col("kind") == F.col("s_kind")).select("kind", "host", (F.col("weight") / F.col("all")).alias("score"))
    start, rounds = materialize(start, "host-seeds"), rounds_for(damping, tolerance)
    if ways.limit(TASK_ROWS + 1).count() + start.limit(TASK_ROWS + 1).count() <= TASK_ROWS:
        ranks = materialize(rounds_in_a_task(ways, start, rounds), "host-ranks")
    else:
        ranks = rounds_by_joins(ways, start, rounds)
    # Two rows at most, one for each kind.
    sums = F.broadcast(ranks.groupBy(F.col("kind").alias("s_kind")).agg(F.sum("score").alias("all")))
    return ranks.join(sums, F.col("kind") == F.col("s_kind")).select("kind", "host", (F.col("score") / F.col("all")).alias("score"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES, ratio: float = RATIO, tolerance: float = TOLERANCE) -> DataFrame:
    """Per row of pages: id, host, path, rule, verdict, trust and distrust of the host (rounded; of all trust or distrust there is).

    A null url, or one without ://, has an empty host and path, fits no rule and is allowed. Null
    pages have no links. Repeated rows repeat, and count as pages of their host.
    """
    url = F.col(url_col)
    own = pages.select(F.col(id_col).alias(id_col), host(url).alias("host"), path(url).alias("path"), F.col(html_col).alias("html"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = own.withColumn("rule", name).withColumn("by_rule", verdict)
    seeds = ruled.where("by_rule is not null and host != ''").groupBy(F.when(F.col("by_rule") == "allow", "t").otherwise("d").alias("kind"), "host").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    ranks = propagate(materialize(host_edges(own.select("host", "html")), "host-links"), materialize(seeds, "host-seed-pages"), tolerance=tolerance)
    score = lambda k: F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0))
    hosts = ranks.groupBy(F.col("host").alias("h_host")).agg(F.round(score("t"), DIGITS).alias("trust"), F.round(score("d"), DIGITS).alias("distrust"))
    hosts = broadcast_if_small(materialize(hosts, "host-scores"), BROADCAST_ROWS)
    judged = ruled.drop("html").join(hosts, F.col("host") == F.col("h_host"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when(distrust > ratio * trust, "block").otherwise("allow")
    return judged.select(id_col, "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
