"""URL filters: host and path rules first, then trust and distrust propagated over the host link graph."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, release, saved

#: (verdict, host and path): the path begins at the first slash.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
_ABSOLUTE_LINK = r"""(?i)href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^"'\s>]+)"""
_RELATIVE_LINK = r"""(?i)href\s*=\s*["']?\s*(?!["'\s>#]|//|[a-z][a-z0-9+.\-]*:)"""


def host_of(url):
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url):
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def match_rules(df: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Adds rule and rule_verdict, of the longest rule that fits host and path; null where none does.

    ``rules`` is a short list (up to some hundreds): it becomes one expression, longest rule first.
    """
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        host, slash, path = rule.partition("/")
        on_host = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits.append(F.when(on_host & F.col("path").startswith(slash + path), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    best = F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")
    return df.withColumn("best", best).withColumn("rule", F.col("best.rule")).withColumn("rule_verdict", F.col("best.verdict")).drop("best")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): pages of src with links to another host dst.

    Links are absolute, or begin with ``//``; relative ones stay on their host, unless the page has a base elsewhere.
    """
    html = F.regexp_replace("html", r"(?i)<base\b[^>]*>", "")
    absolute = F.transform(F.regexp_extract_all(html, F.lit(_ABSOLUTE_LINK), 1), lambda x: host_of(F.when(x.startswith("//"), F.concat(F.lit("http:"), x)).otherwise(x)))
    base = F.regexp_extract("html", r"(?i)<base\b[^>]*" + _ABSOLUTE_LINK.removeprefix("(?i)"), 1)
    base = host_of(F.when(base.startswith("//"), F.concat(F.lit("http:"), base)).otherwise(base))
    based = F.when(html.rlike(_RELATIVE_LINK), F.array(base)).otherwise(F.array().cast("array<string>"))
    linked = pages.where(F.contains("html", F.lit("//"))).select("page_id", host_of(F.col("url")).alias("src"), F.explode(F.array_distinct(F.concat(absolute, based))).alias("dst"))
    return linked.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def propagate(edges: DataFrame, trusted: DataFrame, blocked: DataFrame, damping: float = 0.85, tolerance: float = 1e-8, together: int = 8) -> DataFrame:
    """Personalised PageRank over edges (src, dst, weight): (host, trust, distrust) of the hosts that either reaches.

    Trust flows from ``trusted`` (host) along the edges, distrust from ``blocked`` against them; each sums to 1 where it
    has a seed. Rank that reaches a host without links goes back to its seeds: the ranks are then those of the sum of
    all walks from the seeds, each step damped, over its total, so a step needs no sum over all hosts. Both sides go
    through one loop of joins on the source and sums by target, which Spark combines before the shuffle; ``together``
    steps are one write. It ends when neither side moves by ``tolerance`` of its total in such a round; a step shrinks
    what is left by ``damping``, so that is sure within the rounds that are allowed, and anything else raises.
    """
    seeds = trusted.select("host", F.lit("trust").alias("side")).unionByName(blocked.select("host", F.lit("distrust").alias("side")))
    seeds = saved(seeds.select("side", "host", F.lit(1.0).alias("rank")), "seeds")
    both = edges.select("src", "dst", "weight", F.lit("trust").alias("side")).unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight", F.lit("distrust").alias("side")))
    out = both.groupBy("side", "src").agg(F.sum("weight").alias("total"))
    both = saved(both.join(out, ["side", "src"]).select("side", F.col("src").alias("host"), "dst", (F.col("weight") * damping / F.col("total")).alias("part")), "edges")
    before, state = seeds, None
    rounds = math.ceil(math.log(tolerance * (1 - damping)) / math.log(damping) / together) + 2
    for _ in range(rounds):
        now = before
        for step in range(together):
            sent = both.join(now, ["side", "host"]).select("side", F.col("dst").alias("host"), (F.col("rank") * F.col("part")).alias("rank"), F.lit(0.0).alias("less"))
            new = sent.unionByName(seeds.withColumn("less", F.lit(0.0)))
            if step == together - 1:
                new = new.unionByName(before.select("side", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("less")))
            now = new.groupBy("side", "host").agg(F.sum("rank").alias("rank"), F.sum("less").alias("less"))
        old, state = state, saved(now, "rank")
        before = state.select("side", "host", "rank")
        totals = {r["side"]: r for r in state.groupBy("side").agg(F.sum("rank").alias("total"), F.sum(F.abs(F.col("rank") - F.col("less"))).alias("moved")).collect()}  # two rows at most
        release(old)
        if all(r["moved"] <= tolerance * r["total"] for r in totals.values()):
            side = [F.sum(F.when(F.col("side") == s, F.col("rank") / F.lit(totals[s]["total"] if s in totals else 1.0)).otherwise(0.0)).alias(s) for s in ("trust", "distrust")]
            return before.groupBy("host").agg(*side)
    raise ArithmeticError(f"ranks still move after the {rounds * together} steps that damping {damping} needs")


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, threshold: float = 1.0) -> DataFrame:
    """Verdict for every page: page_id, host, path, rule, verdict, trust, distrust.

    The longest fitting rule decides. Elsewhere the link graph does: hosts on which allowing rules decide more pages
    than blocking ones are trusted seeds, those with the opposite balance blocked seeds. Trust flows along links,
    distrust against them (who links to blocked hosts is distrusted), and a host is blocked where its distrust
    exceeds ``threshold`` times its trust; without evidence it is allowed.

    Null urls and urls without ``://`` have an empty host and path, match no rule and are allowed. Null html counts
    as no links, a null page_id is kept, repeated rows are judged each, an empty table gives no rows, other columns
    are ignored. html is read only for the edges; one host may own most pages, as they are summed before shuffling.
    """
    urls = match_rules(pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), rules)
    balance = urls.where("rule is not null").groupBy("host").agg(F.sum(F.when(F.col("rule_verdict") == "allow", 1).otherwise(-1)).alias("balance"))
    balance = saved(balance, "seed-balance")
    edges = saved(host_edges(pages), "host-edges")
    hosts = propagate(edges, balance.where("balance > 0").select("host"), balance.where("balance < 0").select("host"))
    judged = urls.join(hosts, "host", "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust")})
    verdict = F.coalesce("rule_verdict", F.when(F.col("distrust") > F.col("trust") * threshold, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
