"""URL filter: explicit rules first, host trust and distrust for the rest.

Hosts get trust by personalised PageRank over host links, started from hosts
whose pages an allow rule fits, and distrust the same way over reversed links,
started from hosts whose pages a block rule fits. A host whose distrust exceeds
``ratio`` times its trust is blocked. Everything is DataFrame operations: page
links become host edges with their counts before anything is joined, so a hot
host is one row per neighbour, a hub's links are joined in slices, and each
round's sums are combined before their shuffle. Rounds end when every host that
mass can reach is reached, no verdict can change and each host's masses are
within ``tolerance`` of the full series, by a bound for each host.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and is blocked; a null html has no links; links of a host to
itself are ignored; a host that no mass reaches is allowed; repeated pages each
get a row (and count each); other columns of the pages are neither read nor
returned, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltway.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
TIE = 1e-9
#: Links of a host that a task joins together.
SLICE = 10_000
#: Gains must have shrunk this much from window to window, at every host, before they bound what is to come.
MOST_SHRINK = 0.95
LINK_HOST = r"""(?i)\bhref\s*+=\s*+["']?+(?:[a-z][a-z0-9+.\-]*+:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host, its subdomains and a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules that the query applies.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...], give: str) -> Column:
    """``give`` (name or verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, give))).otherwise(found)
    return found


def judged_by_rules(pages: DataFrame, rules: tuple[Rule, ...], id_column: str, url_column: str) -> DataFrame:
    """page id, host, path, rule, rule_verdict."""
    split = pages.select(F.col(id_column), host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path"))
    return split.select(
        id_column, "host", "path",
        longest_rule(F.col("host"), F.col("path"), rules, "name").alias("rule"),
        longest_rule(F.col("host"), F.col("path"), rules, "verdict").alias("rule_verdict"),
    )


def host_edges(pages: DataFrame, url_column: str, html_column: str) -> DataFrame:
    """source, target, share: links between different hosts, as shares of the source's and of the target's links."""
    links = pages.select(
        host_of(F.col(url_column)).alias("source"),
        F.explode(F.regexp_extract_all(F.col(html_column), F.lit(LINK_HOST), F.lit(1))).alias("target"),
    )
    links = links.withColumn("target", F.translate("target", UPPER, LOWER))
    links = links.filter("source <> '' and target <> '' and source <> target")
    return links.groupBy("source", "target").agg(F.count("*").alias("n"))


def directed_shares(edges: DataFrame) -> DataFrame:
    """kind, source, slice, target, share, slices: forward for trust, reversed for distrust; shares of a source sum to 1.

    A source's links are dealt to slices of about ``SLICE``, so a hub isn't one
    task; ``slices`` is how many the target has as a source itself, 0 if it isn't one.
    """
    both = edges.select(F.lit("trust").alias("kind"), "source", "target", "n").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "n")
    )
    totals = both.groupBy("kind", "source").agg(F.sum("n").alias("total"), F.ceil(F.count("*") / SLICE).cast("int").alias("own"))
    own_slice = F.pmod(F.xxhash64("target"), F.col("own")).cast("int")
    shares = both.join(totals, ["kind", "source"]).select("kind", "source", own_slice.alias("slice"), "target", (F.col("n") / F.col("total")).alias("share"))
    onward = totals.select("kind", F.col("source").alias("target"), F.col("own").alias("slices"))
    return shares.join(onward, ["kind", "target"], "left").select("kind", "source", "slice", "target", "share", F.coalesce("slices", F.lit(0)).alias("slices"))


def exceeds(distrust: Column, trust: Column, ratio: float) -> Column:
    """Whether distrust is more than ``ratio`` times trust; a difference within rounding (``TIE``) is none."""
    return distrust > ratio * trust * (1 + TIE)


def by_kind(mass: DataFrame, *names: str) -> DataFrame:
    """host, trust, distrust, and ``names`` of each kind."""
    of = lambda k, n: F.sum(F.when(F.col("kind") == k, F.col(n)).otherwise(0.0))
    return mass.groupBy("host").agg(*(of(k, n).alias(k if n == "mass" else f"{k}_{n}") for n in ("mass", *names) for k in ("trust", "distrust")))


def settled(state: DataFrame, tolerance: float, ratio: float) -> bool:
    """Whether no further round can change a verdict, nor any host's mass by more than ``tolerance`` of it.

    What arrives follows from what arrived before by the same non-negative steps.
    So if no host has gained more than ``shrink`` (below 1) times what it gained in
    the window before, that holds for every later window too, and a host can gain
    ``shrink / (1 - shrink)`` times its last gain at most: a bound for each host
    by itself, that doesn't wait for the smallest masses of the graph.
    """
    new = F.when(F.col("gained") > 0, F.when(F.col("gained_before") > 0, F.col("gained") / F.col("gained_before")).otherwise(F.lit(float("inf"))))
    kinds = state.groupBy("kind").agg(F.sum("moving").alias("moving"), F.max(new).alias("shrink"), F.max(F.col("gained") / F.col("mass")).alias("share")).collect()  # two rows
    more = {"trust": 0.0, "distrust": 0.0}
    for r in kinds:
        if not r["moving"]:
            continue
        if r["shrink"] is None or r["shrink"] > MOST_SHRINK:
            return False
        more[r["kind"]] = r["shrink"] / (1 - r["shrink"])
        if more[r["kind"]] * r["share"] > tolerance:
            return False
    if not any(more.values()):
        return True
    t, d = F.col("trust"), F.col("distrust")
    more_t, more_d = F.col("trust_gained") * more["trust"], F.col("distrust_gained") * more["distrust"]
    sure = exceeds(d, t + more_t, ratio) | ~exceeds(d + more_d, t, ratio) | ((more_t <= TIE / 10 * t) & (more_d <= TIE / 10 * d))
    return by_kind(state, "gained").filter((t > 0) & (d > 0) & ~sure).isEmpty()


def propagated(
    seeds: DataFrame, shares: DataFrame, damping: float, tolerance: float, ratio: float, rounds: int | None = None, step: int = 4,
) -> tuple[DataFrame, int]:
    """kind, host, mass: the sum of ``damping**i`` times each seed's mass after i links, with weight 1 - damping; and the rounds.

    Mass at hosts without links ends there. It isn't returned to the seeds: that
    would scale a kind by its seeds elsewhere, and unrelated pages could turn a
    verdict. Only mass that can still travel counts as moving. Rounds go on until
    ``settled``, or end after ``rounds`` where that is given. A checkpoint every
    ``step`` rounds, a window of what ``settled`` compares, ends the lineage.
    """
    onward = shares.groupBy("kind", F.col("source").alias("host")).agg((F.max("slice") + 1).alias("slices"))
    mass, none = (1 - damping) * F.col("mass"), F.lit(0.0)
    known = seeds.join(onward, ["kind", "host"], "left").withColumn("slices", F.coalesce("slices", F.lit(0)))
    travels = lambda m: F.when(F.col("slices") > 0, m).otherwise(0.0)
    state = common.checkpointed(known.select("kind", "host", "slices", mass.alias("mass"), travels(mass).alias("moving"), none.alias("gained"), none.alias("gained_before")))
    by_source, done = shares.select("kind", F.col("source").alias("host"), "slice", "target", "share", F.col("slices").alias("target_slices")), 0
    while (rounds is None or done < rounds) and not (state.filter("moving > 0").isEmpty() if not done else settled(state, tolerance, ratio)):
        state = state.withColumn("gained_before", F.col("gained")).withColumn("gained", none)
        for _ in range(step):
            copies = state.filter("moving > 0").select("kind", "host", "moving", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
            sent = copies.join(by_source, ["kind", "host", "slice"]).select("kind", F.col("target").alias("host"), F.col("target_slices").alias("slices"), (damping * F.col("moving") * F.col("share")).alias("mass"))
            moved = sent.select("*", travels(F.col("mass")).alias("moving"), F.col("mass").alias("gained"), none.alias("gained_before"))
            state = (
                state.withColumn("moving", none).unionByName(moved).groupBy("kind", "host")
                .agg(F.max("slices").alias("slices"), *(F.sum(n).alias(n) for n in ("mass", "moving", "gained", "gained_before")))
            )
        state = common.checkpointed(state)
        done += step
    return state.select("kind", "host", "mass"), done


def host_scores(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "page_id", url_column: str = "url",
    html_column: str = "html", damping: float = 0.85, tolerance: float = 0.01, ratio: float = 1.0, rounds: int | None = None,
) -> DataFrame:
    """host, trust, distrust: in units of seed pages."""
    seeds = (
        judged_by_rules(pages, rules, id_column, url_column)
        .filter("rule is not null and host <> ''")
        .groupBy(F.when(F.col("rule_verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
        .agg(F.count("*").cast("double").alias("mass"))
    )
    shares = common.checkpointed(directed_shares(common.checkpointed(host_edges(pages, url_column, html_column))))
    return by_kind(propagated(seeds, shares, damping, tolerance, ratio, rounds)[0])


def filtered_urls(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "page_id", url_column: str = "url",
    html_column: str = "html", ratio: float = 1.0, **propagation: float,
) -> DataFrame:
    """page id, host, path, rule, verdict, trust, distrust; one row per page."""
    scores = host_scores(pages, rules, id_column, url_column, html_column, ratio=ratio, **propagation)
    scores = common.written(scores, "scores")  # of known size, so pages aren't dealt by host where it is small
    found = judged_by_rules(pages, rules, id_column, url_column).join(scores, "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when((F.col("host") == "") | exceeds(distrust, trust, ratio), "block").otherwise("allow")
    return found.select(
        id_column, "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
