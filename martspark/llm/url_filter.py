"""URL filter: host rules first, link-graph trust and distrust for the rest.

Hosts are judged by two propagated scores over host-to-host link edges:
personalised PageRank from trusted seeds along the links, and from blocked
seeds against the links (a host that links to blocked hosts is suspect).
Everything runs on DataFrame functions.

Defined results: a null url, or one without `://`, has an empty host and
path, fits no rule and is allowed. Null html has no links. Repeated rows are
judged each on their own, and repeated links only add weight. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martspark.llm.common import ascii_lower, stored

#: A rule list is inlined into the plan as one literal array.
MAX_RULES = 1000


@dataclass(frozen=True)
class Rule:
    verdict: str  # "allow" or "block"
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: both empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1))
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as struct(size, verdict, rule); of equal length, block wins."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    none = F.lit(None).cast("struct<size:int,verdict:string,rule:string>")
    if not rules:
        return none
    known = F.array(*[F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.verdict).alias("verdict"), F.lit(r.text).alias("rule"),
                               F.lit(r.host).alias("host"), F.lit("." + r.host).alias("below"), F.lit(r.path).alias("path")) for r in rules])
    fits = F.filter(known, lambda r: ((host == r["host"]) | F.endswith(host, r["below"])) & F.startswith(path, r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(r["size"], r["verdict"], r["rule"])))
    return F.coalesce(best, none)


def link_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): absolute links between different hosts, counted. Input: host, html."""
    link = r"""(?i)\b(?:href|src|action)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'>\s]+)"""
    return (
        pages.where("host <> ''")
        .select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(link), F.lit(1))).alias("dst"))
        .select("src", ascii_lower(F.col("dst")).alias("dst"))
        .where("src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("weight"))
    )


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-4, rounds: int | None = None) -> DataFrame:
    """(host, trust, distrust) by power iteration until no score moves by more than `tolerance`.

    seeds: host, trust, distrust in [0, 1]; scores are scaled so that a lone
    seed keeps its own value. One row travels per host and side and edge;
    sums are combined before the shuffle. Each round is a written table. A round
    moves at most `damping` times what the one before moved, the first at most the seeds' sum, so
    `rounds` is by default what that sum needs; an error tells if they don't suffice.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    into = edges.groupBy("dst").agg(F.sum("weight").alias("total"))
    share = F.col("weight") / F.col("total")
    moves = stored(
        edges.join(out, "src").select(F.lit("trust").alias("side"), F.col("src").alias("host"), F.col("dst").alias("to"), share.alias("share"))
        .unionByName(edges.join(into, "dst").select(F.lit("distrust").alias("side"), F.col("dst").alias("host"), F.col("src").alias("to"), share.alias("share"))),
        "host-moves",
    )
    base = stored(
        seeds.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) as (side, seed)")).where("seed > 0"),
        "host-seeds",
    )
    score = base.select("host", "side", F.col("seed").alias("score"))
    if rounds is None:
        mass = base.groupBy("side").agg(F.sum("seed").alias("mass")).agg(F.max("mass")).first()[0] or 0.0
        rounds = 2 + max(0, math.ceil(math.log(max(mass, tolerance) / tolerance) / -math.log(damping)))
    for _ in range(rounds):
        sent = score.join(moves, ["side", "host"]).select(F.col("to").alias("host"), "side", (F.lit(damping) * F.col("score") * F.col("share")).alias("part"))
        new = (
            sent.unionByName(base.select("host", "side", F.col("seed").alias("part")))
            .groupBy("host", "side").agg(F.sum("part").alias("score"))
        )
        old = score.select("host", "side", F.col("score").alias("before"))
        new = stored(new.join(old, ["host", "side"], "left").select("host", "side", "score", F.coalesce("before", F.lit(0.0)).alias("before")), "host-scores")
        moved = new.agg(F.max(F.abs(F.col("score") - F.col("before")))).first()[0] or 0.0
        score = new.select("host", "side", "score")
        if moved <= tolerance:
            break
    else:
        raise RuntimeError(f"scores still move by {moved} after {rounds} rounds; the tolerance is {tolerance}")
    return score.groupBy("host").agg(
        F.sum(F.when(F.col("side") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("side") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
    )


def judge(pages: DataFrame, rules: list[Rule], trusted: str | None = None, blocked: str | None = None, threshold: float = 0.5, damping: float = 0.85) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust.

    Seeds: a host's share of pages that the rules allow or block, and (weight 1)
    hosts that the regular expressions `trusted` and `blocked` find. Without a rule a page is blocked
    if its host's distrust reaches `threshold` and exceeds its trust.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    ruled = parts.select("page_id", "host", "path", matched_rule(F.col("host"), F.col("path"), rules).alias("hit"))
    seeds = ruled.where("host <> ''").groupBy("host").agg(
        F.avg(F.when(F.col("hit.verdict") == "allow", 1.0).otherwise(0.0)).alias("trust"),
        F.avg(F.when(F.col("hit.verdict") == "block", 1.0).otherwise(0.0)).alias("distrust"),
    ).select(
        "host",
        *[F.when(F.col("host").rlike(by), 1.0).otherwise(F.col(c)).alias(c) if by else F.col(c) for c, by in (("trust", trusted), ("distrust", blocked))],
    )
    scores = propagate(stored(link_edges(parts), "host-edges"), seeds, damping)
    # One row per host, so the join splits a hot host's pages (adaptive skew join).
    return ruled.join(scores, "host", "left").select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), F.when((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
