"""URL filter: rules, and trust propagated over the links between hosts.

Rules name a host and a path prefix and decide the pages they fit. Every other
page takes its host's verdict. A host is trusted by the share of its pages
that rules allow and distrusted by the share they block. Trust follows links
from trusted hosts (personalised PageRank), distrust follows them backwards
from blocked ones: who links to a blocked host is suspect. Distrust is the
chance that a walk along a host's links, given up with 1 - ``DAMPING`` at each
step, meets a blocked page; how many others link to the blocked host does not
matter. Trust is made comparable: of all the PageRank a host has, the share that
comes from trusted pages, that is the chance that a surfer who is there began at
one, times ``DAMPING``. It is below ``DAMPING`` however many trusted hosts link
there, so links to a host cannot make up for what it links to itself. A host
without links keeps what it has. A host is blocked if its distrust reaches the
threshold, is no less than its trust and exceeds the share of its own pages that
rules allow, or if the share of its own pages that rules block does so by itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import Workspace

DAMPING = 0.85
# Rounds of the SQL equivalent, enough for ``SETTLED``; the query stops when nothing moves.
ROUNDS = 150
SETTLED = 1e-9
DISTRUST = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# An absolute or protocol-relative link; relative ones stay on their host.
LINK = r"""href\s*=\s*["']?\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, on paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        there = (host == self.host) | F.endswith(host, F.lit("." + self.host))
        return there & F.startswith(path, F.lit(self.path))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for a url without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _first(rules: Sequence[Rule], host: Column, path: Column, value: str) -> Column:
    """The value of the longest rule that fits, null if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        found = F.when(rule.fits(host, path), F.lit(getattr(rule, value))).otherwise(found)
    return found


def links(pages: DataFrame) -> DataFrame:
    """Distinct links between different hosts: src, dst."""
    host, _ = host_and_path(F.col("url"))
    found = F.regexp_extract_all(F.col("html").cast("string"), F.lit(LINK), F.lit(1))
    rows = pages.select(host.alias("src"), F.explode(F.array_distinct(found)).alias("dst"))
    return (
        rows.withColumn("dst", F.translate("dst", UPPER, LOWER)).filter("src <> '' and src <> dst").distinct()
    )


def propagate(seeds: DataFrame, edges: DataFrame, work: Workspace, name: str, share: bool = False) -> DataFrame:
    """``host`` and ``mass``, settled, from ``seeds`` (host, seed) along ``edges`` (src, dst).

    A host passes its mass on in equal parts; one without links keeps it. With
    ``share``, each host takes the mean of those that it links to instead,
    ``DAMPING`` of it for the part that is not its own seed.
    """
    degree = edges.groupBy("src").agg(F.count("*").alias("degree"))
    nodes = seeds.join(degree, seeds["host"] == degree["src"], "left").select("host", "seed", "degree")
    nodes = work.write(nodes, f"{name}-nodes")
    now, k = nodes.select("host", F.col("seed").alias("mass")), 0
    seed, part = F.col("seed"), F.coalesce("part", F.lit(0.0))
    while True:
        if share:
            sent = now.filter("mass <> 0").join(edges, F.col("host") == edges["dst"])
            sent = sent.select(F.col("src").alias("host"), "mass")
            mass = seed + (1 - seed) * DAMPING * part / F.coalesce("degree", F.lit(1))
        else:
            sent = nodes.filter("degree is not null").select("host", "degree").join(now, "host").filter("mass <> 0")
            sent = sent.join(edges, F.col("host") == edges["src"])
            sent = sent.select(F.col("dst").alias("host"), (F.col("mass") / F.col("degree")).alias("mass"))
            # What a host without links keeps in all rounds, added up.
            kept = seed + DAMPING / (1 - DAMPING) * part
            mass = F.when(F.col("degree").isNull(), kept).otherwise((1 - DAMPING) * seed + DAMPING * part)
        received = sent.groupBy("host").agg(F.sum("mass").alias("part"))
        new = work.write(nodes.join(received, "host", "left").select("host", mass.alias("mass")), f"{name}-{k}")
        moved = F.abs(F.col("mass") - F.col("was")) / F.greatest(F.lit(1.0), F.col("mass"))
        change = new.join(now.withColumnRenamed("mass", "was"), "host").agg(F.max(moved)).first()[0]
        if k:
            work.drop(f"{name}-{k - 1}")
        now, k = new, k + 1
        if (change or 0.0) < SETTLED:
            return now


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per page: page_id, host, path, rule and verdict (``allow`` or ``block``).

    A page without url or host is allowed, unless a rule says otherwise. Null
    html has no links. Repeated pages are judged each. Pages that only occur as
    link targets count as hosts too. Only ``page_id``, ``url`` and ``html`` are
    read; html is read once, for links.

    Pages are counted per host before they are shuffled, and only narrow rows
    join the hosts' verdicts.
    """
    work = Workspace(pages.sparkSession, "url-filter")
    host, path = host_and_path(F.col("url"))
    narrow = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = narrow.withColumns(
        {
            "rule": _first(rules, F.col("host"), F.col("path"), "name"),
            "said": _first(rules, F.col("host"), F.col("path"), "verdict"),
        }
    )
    edges = work.write(links(pages), "edges")
    hosts = judged.filter("host <> ''").groupBy("host").agg(
        F.avg(F.when(F.col("said") == "allow", 1.0).otherwise(0.0)).alias("allowed"),
        F.avg(F.when(F.col("said") == "block", 1.0).otherwise(0.0)).alias("blocked"),
    )
    linked = edges.select(F.col("dst").alias("host"), F.lit(0.0).alias("allowed"), F.lit(0.0).alias("blocked"))
    hosts = hosts.unionByName(linked.distinct()).groupBy("host").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked"))
    hosts = work.write(hosts, "hosts")
    trust = propagate(hosts.select("host", F.col("allowed").alias("seed")), edges, work, "trust")
    distrust = propagate(hosts.select("host", F.col("blocked").alias("seed")), edges, work, "distrust", share=True)
    ranks = propagate(hosts.select("host", F.lit(1.0).alias("seed")), edges, work, "ranks")
    trust = trust.join(ranks.withColumnRenamed("mass", "rank"), "host")
    trust = trust.select("host", (DAMPING * F.col("mass") / F.col("rank")).alias("trust"))
    verdicts = trust.join(distrust.withColumnRenamed("mass", "distrust"), "host").join(hosts, "host")
    suspect = (F.col("distrust") >= DISTRUST) & (F.col("distrust") >= F.col("trust"))
    suspect = suspect & (F.col("distrust") > F.col("allowed"))
    blocked = (F.col("blocked") >= DISTRUST) & (F.col("blocked") > F.col("allowed"))
    result = judged.join(verdicts, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce(
            "said",
            F.when(suspect | blocked, "block").otherwise("allow"),
        ).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
    result = work.write(result, "result")
    work.keep("result")
    return result
