"""URL filters: rules on host and path, and trust carried along host links for what no rule decides.

Pages that a rule allows or blocks are the seeds of their hosts. Trust flows from a host to those it
links to (personalised PageRank from the trusted seeds); distrust flows the other way, from a blocked
host to those that link to it. A host whose distrust outweighs its trust is blocked. Links count per
pair of hosts, summed before the shuffle; each turn sends one row along each host pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.shared import scratch
from tallyworks.operators.joins import join_hot

DAMPING = 0.85
TURNS = 24
CUT_EVERY = 4
THRESHOLD = 0.5
MOST_RULES = 1_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case (A-Z); else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as ``rule, verdict``, or null. A rule is a host, ``/`` and the start of a path.

    It fits its host and all subdomains if the path starts with the rule's. ``rules`` is a list of at
    most 1,000 (verdict, rule); of equally long ones the first in the alphabet counts.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        name, slash, rest = rule.partition("/")
        if verdict not in ("allow", "block") or not name or not slash:
            raise ValueError(f"not a rule: {verdict} {rule}")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src, dst, n``: links from pages of one host to another host. Links within a host are left out.

    Links without a scheme are within the page's host unless they begin with ``//``.
    """
    linked = pages.filter(F.contains(F.col(html), F.lit("//")))
    links = linked.select(url_host(F.col(url)).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(_LINK), F.lit(1))).alias("_to"))
    absolute = F.when(F.startswith(F.col("_to"), F.lit("//")), F.concat(F.lit("http:"), F.col("_to"))).otherwise(F.col("_to"))
    pairs = links.select("src", url_host(absolute).alias("dst"))
    return pairs.filter("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, turns: int = TURNS, tolerance: float = 1e-6) -> DataFrame:
    """``host, mass``: personalised PageRank of ``seeds`` (``host, seed``) over ``links`` (``src, dst, n``).

    A host hands on ``damping`` of its mass to those it links to, in proportion to the links; what a host
    without links would hand on is lost. Lineage is cut every fourth turn, and it ends when the mass moved
    since the cut before is below ``tolerance`` of all seeds, or after ``turns``.
    """
    out = links.groupBy("src").agg(F.sum("n").alias("_all"))
    shares = scratch(join_hot(links, out, "src").select("src", "dst", (damping * F.col("n") / F.col("_all")).alias("share")))
    home = scratch(seeds.groupBy("host").agg(F.sum("seed").alias("seed")).select("host", ((1 - damping) * F.col("seed")).alias("mass")))
    total = home.agg(F.coalesce(F.sum("mass"), F.lit(0.0))).first()[0]
    now = home
    for turn in range(0, turns, CUT_EVERY):
        then = now
        for _ in range(min(CUT_EVERY, turns - turn)):
            sent = join_hot(shares, now.withColumnRenamed("host", "src"), "src").select(F.col("dst").alias("host"), (F.col("share") * F.col("mass")).alias("mass"))
            now = home.unionByName(sent).groupBy("host").agg(F.sum("mass").alias("mass"))
        now = scratch(now)
        both = now.select("host", "mass").unionByName(then.select("host", (-F.col("mass")).alias("mass")))
        moved = both.groupBy("host").agg(F.abs(F.sum("mass")).alias("d")).agg(F.coalesce(F.sum("d"), F.lit(0.0))).first()[0]
        if moved <= tolerance * total:
            break
    return now


def host_verdicts(pages: DataFrame, links: DataFrame, threshold: float = THRESHOLD, damping: float = DAMPING, turns: int = TURNS) -> DataFrame:
    """``host, trust, distrust, blocked`` for each host that rules or links reach.

    ``pages`` has ``host`` and the rules' ``verdict`` (null: none). A host is blocked if distrust is more
    than ``threshold`` of trust and distrust together, to nine decimals, so that rounding decides nothing.
    """
    decided = pages.filter("verdict IS NOT NULL AND host <> ''").groupBy("host", "verdict").agg(F.count("*").cast("double").alias("seed"))
    turned = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    trust = spread(decided.filter("verdict = 'allow'").select("host", "seed"), links, damping, turns)
    distrust = spread(decided.filter("verdict = 'block'").select("host", "seed"), turned, damping, turns)
    zero = F.lit(0.0)
    both = trust.select("host", F.col("mass").alias("trust"), zero.alias("distrust")).unionByName(distrust.select("host", zero.alias("trust"), F.col("mass").alias("distrust")))
    summed = both.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
    share = F.col("distrust") / (F.col("trust") + F.col("distrust"))
    return summed.withColumn("blocked", F.coalesce(F.round(share, 9) > threshold, F.lit(False)))


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    threshold: float = THRESHOLD,
    damping: float = DAMPING,
    turns: int = TURNS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of each page.

    ``verdict`` is the longest fitting rule's, else that of the page's host by its links: ``block`` if the
    host is blocked, else ``allow``. Pages without a host (null url, no ``://``) fit no rule and are
    allowed. Null or empty html has no links. Repeated rows are all returned, and count as often as they
    occur. An empty table gives an empty table; other columns are left out.
    """
    host, path = url_host(F.col(url)), url_path(F.col(url))
    split = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    judged = split.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
    judged = judged.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("verdict"))
    links = scratch(host_links(pages, url, html))
    hosts = scratch(host_verdicts(judged, links, threshold, damping, turns)).select("host", "blocked")
    whole = join_hot(judged, hosts, "host", "left")
    by_host = F.when(F.coalesce("blocked", F.lit(False)), "block").otherwise("allow")
    return whole.select("page_id", "host", "path", "rule", F.coalesce("verdict", by_host).alias("verdict"))
