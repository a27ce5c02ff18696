"""URL filter: rules where they fit, trust and distrust spread over links between hosts elsewhere.

A rule names a host with its subdomains and the beginning of a path; of those that fit a url the longest decides. Hosts
of pages that rules allow or block are the seeds, each with its number of such pages. Trust is a personalised PageRank
from the trusted seeds along the links between hosts; distrust is the same from the blocked seeds against the links'
direction, so that it reaches hosts that link to blocked ones. A host's other pages are blocked if its distrust exceeds
RATIO times its trust; a host that neither reaches is allowed.

The walk goes on until no step changes a score by more than TOLERANCE of itself. As a newly reached host's score changes
by all of itself, no host that a path leads to is left out, however long the path; what later steps would add to all
scores together is at most TOLERANCE * DAMPING / (1 - DAMPING) of them.

Links are the pages' href values, resolved to hosts; links within a host say nothing about it and are left out. They
are counted for each pair of hosts before anything is joined, so a host with a third of all pages is as many rows as it
has neighbours. What a host sends to each neighbour is moved once, to the partition of the host, and kept there on the
executors' disks for all steps: a step moves scores only. A host with more than PART neighbours is several parts, in
partitions of their own. If an executor is lost, its partitions come again from the written table. Every few steps the
scores are written to the shared folder, and one number, the largest change, reaches the driver.

A url that is null or has no `://` has an empty host and path, fits no rule and is allowed; so is an empty table's
absence. Null html has no links. Repeated rows count as often as they come and are all judged. Other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from snapmart.llm.common import written

DAMPING = 0.85

#: Scores are final when a step changes none by more than this share of itself.
TOLERANCE = 1e-6

#: Steps of the SQL form only, which agrees where paths and cycles are short.
STEPS = 9

#: Distrust blocks a host if it exceeds so many times its trust.
RATIO = 2.0

#: Scores are written after so many steps.
WRITE_EVERY = 3

#: Neighbours of a host that one partition holds.
PART = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """`allow` or `block` for a host, its subdomains and the paths that begin with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Text of the longest rule that fits, else null; of equally long ones the first."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
    return found


def rule_verdict(rule: Column, rules: tuple[Rule, ...]) -> Column:
    out = F.lit(None).cast("string")
    for r in rules:
        out = F.when(rule == r.text, F.lit(r.verdict)).otherwise(out)
    return out


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst and the number of links, for pairs of different hosts. Needs the columns host and html."""
    links = F.regexp_extract_all("html", F.lit(r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""), 1)
    target = F.col("link")
    full = F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target).when(
        target.startswith("//"), F.concat(F.lit(":"), target)
    )
    return (
        pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(links)).alias("link"))
        .select("src", host_of(full).alias("dst"))
        .where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("links"))
    )


def dealt_messages(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What hosts send (host, to, and the shares t of trust and d of distrust), by host and part; and hosts of many parts.

    The second table has host and parts, one row for each PART messages at most.
    """
    out = links.groupBy("src").agg(F.sum("links").alias("all"))
    into = links.groupBy("dst").agg(F.sum("links").alias("all"))
    nothing, share = F.lit(0.0), F.col("links") / F.col("all")
    along = links.join(out, "src").select(
        F.col("src").alias("host"), F.col("dst").alias("to"), share.alias("t"), nothing.alias("d")
    )
    against = links.join(into, "dst").select(
        F.col("dst").alias("host"), F.col("src").alias("to"), nothing.alias("t"), share.alias("d")
    )
    messages = written(along.unionByName(against), "messages")
    parts = F.ceil(F.count(F.lit(1)) / PART).cast("int")
    hubs = written(messages.groupBy("host").agg(parts.alias("parts")).where("parts > 1"), "hubs")
    part = F.pmod(F.xxhash64("to"), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = messages.join(hubs, "host", "left").withColumn("part", part).drop("parts")
    number = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(number, "host", "part"), hubs


def step(messages: DataFrame, hubs: DataFrame, scores: DataFrame, damping: float) -> DataFrame:
    """The scores after one step; what the last one added is sent on, to all parts of its host."""
    nothing = F.lit(0.0)
    moving = scores.where((F.col("new_trust") > 0) | (F.col("new_distrust") > 0)).join(hubs, "host", "left")
    moving = moving.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    sent = messages.join(moving, ["host", "part"]).select(
        F.col("to").alias("host"),
        (damping * F.col("t") * F.col("new_trust")).alias("trust"),
        (damping * F.col("d") * F.col("new_distrust")).alias("distrust"),
    )
    sent = sent.withColumns({"new_trust": F.col("trust"), "new_distrust": F.col("distrust")})
    kept = scores.withColumns({"new_trust": nothing, "new_distrust": nothing})
    columns = ("trust", "distrust", "new_trust", "new_distrust")
    return kept.unionByName(sent).groupBy("host").agg(*[F.sum(c).alias(c) for c in columns])


def propagate(seeds: DataFrame, links: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """host, trust and distrust of the whole walk. `seeds` has these columns, `links` has src, dst and links."""
    messages, hubs = dealt_messages(written(links, "links"))
    messages = messages.persist(StorageLevel.DISK_ONLY)
    # Scores with what the last step added to them, which is all that the next step sends on.
    start = [((1 - damping) * F.col(c)).alias(c) for c in ("trust", "distrust")]
    scores = seeds.select("host", *start).withColumns({"new_trust": F.col("trust"), "new_distrust": F.col("distrust")})
    change = F.greatest(*[F.when(F.col(c) > 0, F.col(f"new_{c}") / F.col(c)) for c in ("trust", "distrust")])
    largest = 1.0
    while largest > tolerance:
        for _ in range(WRITE_EVERY):
            scores = step(messages, hubs, scores, damping)
        seen = Observation()
        scores = written(scores.observe(seen, F.max(change).alias("change")), "scores")
        largest = seen.get["change"] or 0.0
    messages.unpersist()
    return scores.select("host", "trust", "distrust")


def judge(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of `pages` (page_id, url, html)."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    judged = judged.withColumn("ruled", rule_verdict(F.col("rule"), rules))
    seeds = written(
        judged.where(F.col("ruled").isNotNull())
        .groupBy("host")
        .agg(
            F.count(F.when(F.col("ruled") == "allow", 1)).cast("double").alias("trust"),
            F.count(F.when(F.col("ruled") == "block", 1)).cast("double").alias("distrust"),
        ),
        "seeds",
    )
    scores = propagate(seeds, host_links(pages.select(host.alias("host"), "html")))
    blocked = scores.where(F.col("distrust") > RATIO * F.col("trust")).select("host", F.lit("block").alias("spread"))
    return judged.join(blocked, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", "spread", F.lit("allow")).alias("verdict"),
    )
