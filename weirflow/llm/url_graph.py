"""URL filter: rules for hosts and paths, and link-graph propagation for what no rule decides.

Rules fit a host with its subdomains and a beginning of the path; the longest wins.  Pages that rules
allow or block make their hosts seeds.  Over the edges between hosts two personalised PageRanks run
side by side: trust starts at allowed seeds and follows the edges, distrust starts at blocked seeds
and follows them backwards.  A host is blocked if its share of distrust reaches ``THRESHOLD``.

Edges are hyperlinks to other hosts, and a host and its parent domain vouch for each other.  Ranks are
tables that are joined with the table of edges and summed with map-side combine; after some rounds
they are written to the shared folder and compared with those before.  Rounds go on until no host is
reached that was not, and no rank changes by more than ``TOLERANCE`` of itself, however long the chains.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm.common import without, write_table

# The rules of the registered query (given).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
DAMPING = 0.85
ROUNDS = 8  # rounds between two looks at what has changed
TOLERANCE = 1e-8  # largest change of a rank over these rounds, as a share of the rank
THRESHOLD = 0.5
STEPS_PER_TASK = 200_000  # edges that one task of a round follows
SLACK = 1e-6  # shares this close to the threshold, in parts of them, have reached it
OUTPUT = ["host", "path", "rule", "verdict", "trust", "distrust"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?i)(?:href|src)\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s>]+)"


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(F.col(url), _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), _URL, 2), F.lit(""))


def rule_table(spark: SparkSession, rules) -> DataFrame:
    """(host + path, verdict) pairs as (rule, rule_host, rule_path, rule_verdict)."""
    rows = [(r, r.partition("/")[0], "/" + r.partition("/")[2] if "/" in r else "", v) for r, v in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, rule_verdict string")


def apply_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (host, path) -> with the longest rule that fits and its verdict, or nulls.

    A host is joined by each of its suffixes, so the number of rules does not matter; Spark picks the
    kind of join by their size.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    spread = addresses.select("host", "path", F.explode(suffixes).alias("rule_host"))
    fits = spread.join(rules, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    longest = fits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "rule_verdict")).alias("best"))
    return addresses.join(longest, ["host", "path"], "left").select("host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict"))


def host_edges(pages: DataFrame, html: str) -> DataFrame:
    """(src, dst): distinct edges between different hosts; ``pages`` has ``host``."""
    targets = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(_LINK), F.lit(1))
    links = pages.select(F.col("host").alias("src"), F.explode(targets).alias("dst")).select("src", F.translate("dst", UPPER, LOWER).alias("dst")).distinct()
    links = write_table(links, "url-hyperlinks")  # so that the pages' texts are searched once
    hosts = pages.select(F.col("host").alias("h")).union(links.select("dst")).distinct()
    above = F.regexp_replace("h", r"^[^.]*\.", "")
    kin = hosts.filter("h like '%.%.%'").select(F.col("h").alias("src"), above.alias("dst"))
    both = kin.union(kin.select("dst", "src"))
    return links.union(both).filter("src <> dst and src <> '' and dst <> ''").distinct()


def propagate(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust), each summing to one over all hosts.

    ``seeds`` is (kind, host, weight) with kinds ``trust`` and ``distrust``.  Rank that reaches a host
    without edges goes back to the seeds; that only scales the ranks of a kind, so it is left out here
    and made good by the division at the end.
    """
    forward = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"))
    backward = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"))
    steps = forward.union(backward)
    degree = steps.groupBy("kind", "host").agg(F.count("*").alias("n"))
    weighted = write_table(steps.join(degree, ["kind", "host"]).select("kind", "host", "to", (1 / F.col("n")).alias("w")), "url-edges")
    tasks = max(1, weighted.count() // STEPS_PER_TASK)  # many short rounds: no more tasks and files than their rows need
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("all"))
    start = write_table(seeds.join(total, "kind").select("kind", "host", (F.col("weight") / F.col("all")).alias("r")), "url-seeds")

    def beside(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        """Joined by host.  Where one task does a round it merges both sides there: a broadcast each round would
        pass through the driver, and what hundreds of them leave there outgrows its memory."""
        if tasks > 1:
            return left.join(right, ["kind", "host"], how)
        return left.coalesce(1).join(right.coalesce(1).hint("merge"), ["kind", "host"], how)

    ranks = start
    for _ in count():
        before, later = ranks, ranks
        for _ in range(ROUNDS):
            moved = beside(later, weighted).select("kind", F.col("to").alias("host"), (F.col("r") * F.col("w") * damping).alias("r"))
            both = moved.union(start.select("kind", "host", F.col("r") * (1 - damping))).coalesce(tasks)
            later = both.groupBy("kind", "host").agg(F.sum("r").alias("r")).coalesce(tasks)
        ranks = write_table(later, "url-ranks")
        old = before.select("kind", "host", F.col("r").alias("old"))
        change = beside(ranks, old, "left").agg(F.max(F.abs(F.col("r") - F.coalesce("old", F.lit(0.0))) / F.col("r"))).first()[0]
        if change is None or change <= tolerance:
            break
    whole = ranks.groupBy("kind").agg(F.sum("r").alias("all"))
    share = ranks.join(whole, "kind").select("kind", "host", (F.col("r") / F.col("all")).alias("r"))
    sides = [F.sum(F.when(F.col("kind") == k, F.col("r")).otherwise(0.0)).alias(k) for k in ("trust", "distrust")]
    return share.groupBy("host").agg(*sides)


def judge(pages: DataFrame, rules=RULES, url: str = "url", html: str = "html", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """All rows and columns of ``pages`` with host, path, rule, verdict, trust and distrust.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is in no graph.
    Hosts that neither trust nor distrust reaches are allowed.  Repeated rows count as often as they
    are there.  An empty table, or one without seeds, gives rows that only rules decide.
    """
    source = pages.select(*without(pages, OUTPUT))
    placed = source.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    counted = write_table(placed.groupBy("host", "path").agg(F.count("*").alias("pages")), "url-addresses")
    ruled = write_table(apply_rules(counted.select("host", "path"), rule_table(pages.sparkSession, rules)), "url-rules")
    votes = counted.join(ruled, ["host", "path"]).filter("rule is not null and host <> ''").groupBy("host", "rule_verdict").agg(F.sum("pages").alias("n"))
    both = votes.groupBy("host").agg(F.sum("n").alias("all"))
    seeds = votes.join(both, "host").select(F.when(F.col("rule_verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host", (F.col("n") / F.col("all")).alias("weight"))
    edges = write_table(host_edges(placed.select("host", F.col(html).alias("html")), "html"), "url-links")
    scores = propagate(edges, seeds, tolerance)
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    suspect = distrust * (1 - threshold) * (1 + SLACK) >= trust * threshold
    known = ruled.join(scores, "host", "left").select(
        "host", "path", "rule", F.coalesce("rule_verdict", F.when((distrust > 0) & suspect, "block").otherwise("allow")).alias("verdict"), trust.alias("trust"), distrust.alias("distrust")
    )
    return placed.join(write_table(known, "url-verdicts"), ["host", "path"]).select(*source.columns, *OUTPUT)
