"""URL verdicts: rules by host and path, and for the rest trust and distrust spread over links between hosts.

Hosts are joined by the links of their pages. Trust is a personalised PageRank whose restart is the share
of a host's pages that rules allow; it flows along links. Distrust starts from the share that rules block and
flows against links: a host takes on the mean distrust of what it links to, damped once a link. So distrust
is in seed units at any size of the graph, and one threshold a host decides. Both are summed as
the series of their walks; a round's table is written, which cuts lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import of_row, with_row, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"://([^/?#]*)([^?#]*)"
#: The host that a link names: with a scheme or without, quoted or not.
LINK = r"(?i)href[ \t\n\r]*=[ \t\n\r]*[\"']?[ \t\n\r]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"' \t\n\r>]+)"
#: verdict, host, path
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
MOST_RULES = 1000
DAMPING, ROUNDS, LEAST, THRESHOLD = 0.85, 20, 1e-6, 0.5


def url_parts(url: Column) -> tuple[Column, Column]:
    """host (A-Z lower-cased) and path; both empty for a null and where there is no `://`."""
    given = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(given, URL, 1), UPPER, LOWER), F.regexp_extract(given, URL, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """rule and verdict of the longest rule that fits, null if none does; of equal lengths `block` wins.

    Rules are a short list (1,000 at most) in the plan; a longer list of hosts is for `seeds`.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules: give hosts as seeds")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block", r)):  # the last tested first
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        text, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text), F.when(fits, F.lit(what)).otherwise(verdict)
    return text, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, share: of the links from a host to others, the share that goes to each; a page counts a host once. pages: host, html."""
    to = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), lambda h: F.translate(h, UPPER, LOWER)))
    links = pages.where("host <> '' and html is not null").select(F.col("host").alias("src"), F.explode(to).alias("dst"))
    pairs = written(links.where("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")), "host-links")
    return written(pairs.join(pairs.groupBy("src").agg(F.sum("n").alias("out")), "src").select("src", "dst", (F.col("n") / F.col("out")).alias("share")), "host-edges")


def spread(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, least: float = LEAST) -> DataFrame:
    """host, trust, distrust. seeds: the same, a row a host.

    Each round every walk goes one link on; what falls under `least` for both isn't carried on. Joins by host
    are of distinct pairs of hosts with a row a host, so where one host has a third of all links adaptive
    execution splits its pairs; sums are partial before the shuffle.
    """
    now = written(seeds, "host-seeds")
    tables = [now]
    for _ in range(rounds if edges.head(1) else 0):
        along = now.where("trust > 0").join(edges, F.col("host") == F.col("src")).select(F.col("dst").alias("to"), (damping * F.col("share") * F.col("trust")).alias("t"), F.lit(0.0).alias("d"))
        against = now.where("distrust > 0").join(edges, F.col("host") == F.col("dst")).select(F.col("src").alias("to"), F.lit(0.0).alias("t"), (damping * F.col("share") * F.col("distrust")).alias("d"))
        sums = along.unionByName(against).groupBy(F.col("to").alias("host")).agg(F.sum("t").alias("trust"), F.sum("d").alias("distrust"))
        now = written(sums.where(F.greatest("trust", "distrust") >= least), "host-walks")
        if not now.head(1):
            break
        tables.append(now)
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, seeds: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """`pages` (url, html and what else there is) with host, path, rule and verdict.

    A url without a rule is blocked if its host's distrust is `threshold` or more and above its trust, else
    allowed. seeds (host, trust, distrust; of any size) add to the shares that rules give. A null html has
    no links, a url without a host belongs to no host and is allowed; each row is judged for itself,
    repeated rows too. Columns of `pages` named as the four new ones are replaced.
    """
    host, path = url_parts(F.col("url"))
    rule, said = longest_rule(F.col("host"), F.col("path"), rules)
    parted = with_row(pages, host=host, path=path, html=F.col("html")).withColumns({"rule": rule, "said": said})
    part = lambda v: F.sum(F.when(F.col("said") == v, 1).otherwise(0)) / F.count(F.lit(1))
    own = parted.where("host <> ''").groupBy("host").agg(part("allow").alias("trust"), part("block").alias("distrust"))
    if seeds is not None:
        own = own.unionByName(seeds.select("host", F.col("trust").cast("double"), F.col("distrust").cast("double"))).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
    scores = spread(own.where("trust > 0 or distrust > 0"), host_edges(parted))
    bad = scores.where((F.round("distrust", 9) >= threshold) & (F.round("distrust", 9) > F.round("trust", 9))).select(F.col("host").alias("bad"))
    verdict = F.coalesce("said", F.when(F.col("bad").isNotNull(), "block").otherwise("allow"))
    kept = pages.drop(*[c for c in pages.columns if c in ("host", "path", "rule", "verdict")])
    return parted.drop("html").join(bad, F.col("host") == F.col("bad"), "left").select(*of_row(kept), "host", "path", "rule", verdict.alias("verdict"))
